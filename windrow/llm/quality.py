"""Quality classification by the perplexity of an interpolated modified Kneser-Ney model over characters.

Documents are bound once into bundles of about ``BUNDLE`` characters (compressed Arrow), written; a row is known by its
bundle and its place there from then on.

* counts: trusted rows of each bundle are counted by n-gram and by fold; sums by n-gram, continuation counts, discounts and
  interpolation are aggregates and joins keyed by the n-gram, and give the model, a table of (gram, logp, backoff);
* scores: the model is cut into shards of a bounded number of entries, by the two characters before the predicted one, so that all
  that a prediction needs lies in one shard. Each shard passes over the bundles, and the sums of what all give, by bundle and place,
  are the documents' log probabilities. The plan is the same for one shard and for many.

Trusted rows are split in folds by a hash of their id: fold 0, which the model has not seen, gives the quantiles of
perplexity for each language and class of length that a document must not exceed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import likely_in, materialize, release, releasing, text_of

ORDER = 5
#: Characters of a bundle of documents, unless one text is longer; a size of work, it changes no result.
BUNDLE = 4_000_000
#: Entries of the model that one scoring pass holds; more make more passes, not a smaller model.
SHARD_ENTRIES = 2_500_000
#: Characters scored at a time.
CHUNK = 500_000
#: Folds of trusted rows; fold 0 calibrates.
HELD_OUT = 5
START, END = "\x02", "\x03"
_B = np.uint64(0x9E3779B97F4A7C15)
#: Predictions handled at a time.
STRETCH = 250_000
#: Row groups of a few bundles, so that a reader holds few at a time.
_BOUND = {"parquet.block.size": str(16 << 20)}


class Positions:
    """The predictions of some texts: white space as spaces, each text led by ORDER - 1 starts and closed by an end.

    Characters of a text that look like a start or an end count as spaces.
    """

    def __init__(self, texts: list[str]):
        padded = [START * (ORDER - 1) + t + END for t in texts]
        self.codes = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), "<u4").copy()
        self.at = np.cumsum([0, *map(len, padded)])
        inside = np.ones(len(self.codes), bool)
        for k in range(ORDER - 1):
            inside[self.at[:-1] + k] = False
        self.last = np.flatnonzero(inside)
        inside[self.at[1:] - 1] = False
        space = inside & ((self.codes >= 9) & (self.codes <= 13) | (self.codes == 2) | (self.codes == 3))
        self.codes[space] = 32
        there = np.zeros(int(self.codes.max(initial=0)) + 2, bool)
        there[self.codes] = True
        self.rank = np.cumsum(there).astype(np.uint64) - np.uint64(1)
        self.base = np.uint64(max(2, int(there.sum())))
        self.parts = None
        if int(self.base) ** ORDER >= 1 << 63:  # too many different characters for one number: two numbers, each by its rank here
            r = self.rank[self.codes]
            high = r[:-1] * self.base + r[1:]
            self.parts = np.unique(high), np.unique(high[:-1] * self.base + r[2:])

    def keys(self, grams: list[np.ndarray]) -> np.ndarray:
        """A number for each n-gram of these texts, its own; ``grams`` are the columns of their characters."""
        r = [self.rank[c] for c in grams]
        if self.parts is None:
            key = r[0]
            for c in r[1:]:
                key = key * self.base + c
            return key
        high, low = self.parts
        first = np.searchsorted(high, r[0] * self.base + r[1]).astype(np.uint64)
        return first * np.uint64(len(low)) + np.searchsorted(low, (r[2] * self.base + r[3]) * self.base + r[4]).astype(np.uint64)

    def stretches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of predicted characters, and the keys of the n-grams that they close."""
        for k in range(0, len(self.last), STRETCH):
            own = self.last[k : k + STRETCH]
            yield own, self.keys([self.codes[own - j] for j in range(ORDER - 1, -1, -1)])

    def distinct(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct n-grams, as an Arrow array without an object for each, and their counts."""
        keys, places, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for own, h in self.stretches():
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            keys.append(u)
            places.append(own[first])
            counts.append(n)
        _, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        keys.clear()
        total = np.bincount(back, np.concatenate(counts), len(first)).astype(np.int64)
        codes = self.codes[np.concatenate(places)[first][:, None] + np.arange(1 - ORDER, 1)]
        sizes = sum((codes >= limit).sum(1) for limit in (0x80, 0x800, 0x10000)) + ORDER  # bytes in UTF-8
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), sizes])).astype(np.int32)
        text = codes.tobytes().decode("utf-32-le").encode("utf-8")
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(text)), total


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def bind(docs: DataFrame, characters: int = BUNDLE) -> DataFrame:
    """Bundles of ``docs``, written: m, bundle, ids, langs, sizes (characters of ``__text``), rows (all columns, compressed).

    ``docs`` has __m (the model that scores the row), __id, __lang and __text beside any others.
    """
    m_at, id_at, lang_at, text_at = (docs.columns.index(c) for c in ("__m", "__id", "__lang", "__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[int, list[pa.RecordBatch]] = {}
        sizes: dict[int, int] = {}

        def bundle(m: int) -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(held.pop(m))
            sizes[m] = 0
            kinds = (pa.int32(), pa.int64(), pa.list_(rows.column(id_at).type), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary())
            cells = (m, number, rows.column(id_at).to_pylist(), rows.column(lang_at).to_pylist(), pa.compute.utf8_length(rows.column(text_at)).to_pylist(), _packed(rows))
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=["m", "bundle", "ids", "langs", "sizes", "rows"])

        for batch in batches:
            for m in pa.compute.unique(batch.column(m_at)).to_pylist():
                own = batch.filter(pa.compute.equal(batch.column(m_at), m))
                begin = 0
                for k, n in enumerate(pa.compute.utf8_length(own.column(text_at)).to_pylist()):
                    sizes[m] = sizes.get(m, 0) + n + ORDER
                    if sizes[m] >= characters:
                        held.setdefault(m, []).append(own.slice(begin, k + 1 - begin))
                        yield bundle(m)
                        begin = k + 1
                if begin < own.num_rows:
                    held.setdefault(m, []).append(own.slice(begin))
        for m in list(held):
            yield bundle(m)

    kind = docs.schema["__id"].dataType.simpleString()
    return materialize(docs.mapInArrow(releasing(run), f"m int, bundle long, ids array<{kind}>, langs array<string>, sizes array<int>, rows binary"), "bound", **_BOUND)


def places(bound: DataFrame) -> DataFrame:
    """(bundle, at, id, lang, size) of each row of ``bound``."""
    rows = bound.select("bundle", F.posexplode(F.arrays_zip("ids", "langs", "sizes")).alias("at", "row"))
    return rows.select("bundle", "at", F.col("row.ids").alias("id"), F.col("row.langs").alias("lang"), F.col("row.sizes").alias("size"))


def marked(bound: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bundle, at, id, lang, fold) of the rows of ``bound`` that have a text and whose id is one of ``trusted`` (id, fold), written."""
    return materialize(places(bound).where("size > 0").join(trusted, "id").select("bundle", "at", "id", "lang", "fold"), "marked")


def _of_bundles(bound: DataFrame, marks: DataFrame, use, schema: str) -> DataFrame:
    """``use(rows, marks)`` of each bundle that has marks (at, fold)."""

    def run(bundles: pa.Table) -> pa.Table:
        try:
            return pa.concat_tables([use(_unpacked(raw.as_py()), own) for raw, own in zip(bundles.column("rows"), bundles.column("marks").to_pylist(), strict=True)])
        finally:
            release()

    lists = marks.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("at", "fold"))).alias("marks"))
    return bound.select("bundle", "rows").join(lists, "bundle").groupBy("bundle").applyInArrow(run, schema)


def _counted(texts: list[str], fold: int) -> pa.RecordBatch:
    grams, n = Positions(texts).distinct()
    return pa.RecordBatch.from_arrays([grams, pa.array(np.full(len(grams), fold, np.int32)), pa.array(n)], names=["gram", "fold", "c"])


def _by_fold(counts: DataFrame) -> DataFrame:
    """(gram, c0, c1, ...): counts in each fold, written."""
    return materialize(counts.groupBy("gram").agg(*[F.sum(F.when(F.col("fold") == k, F.col("c")).otherwise(0)).alias(f"c{k}") for k in range(HELD_OUT)]), "grams")


def count_trusted(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """(gram, c0, c1, ...) over the ``__text`` of ``rows`` whose ``__id`` is one of ``trusted`` (id, fold).

    A broadcast filter of fixed size keeps most other texts from the join. That is no semi-join, which Spark would put before the filter.
    """
    texts = rows.select(F.col("__id").alias("id"), "__text").where("id is not null and __text <> ''")
    told = likely_in(texts, "id", trusted.select("id")).join(trusted, "id").select("fold", "__text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[str]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            for fold, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(fold, []).append(text.as_py())
                sizes[fold] = sizes.get(fold, 0) + len(held[fold][-1])
                if sizes[fold] > BUNDLE // 2:
                    yield _counted(held.pop(fold), fold)
                    sizes[fold] = 0
        for fold, own in held.items():
            yield _counted(own, fold)

    return _by_fold(told.mapInArrow(releasing(count), "gram string, fold int, c long"))


def train(texts: DataFrame) -> DataFrame:
    """The model of the column ``text``: gram, logp (interpolated, natural log), backoff (log weight as a context)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for t in batch.column(0).to_pylist():
                held.append(t)
                size += len(t)
                if size > BUNDLE:
                    yield _counted(held, 1)
                    held, size = [], 0
            if held:
                yield _counted(held, 1)

    return models_of(_by_fold(texts.select(text_of().alias("text")).mapInArrow(releasing(count), "gram string, fold int, c long")), [0]).drop("m")


def models_of(counts: DataFrame, models: Iterable[int]) -> DataFrame:
    """The models m that have seen all folds but fold m, at once: m, gram, logp, backoff."""
    own = [F.struct(F.lit(m).alias("m"), sum((F.col(f"c{k}") for k in range(HELD_OUT) if k != m), F.lit(0)).cast("long").alias("c")) for m in models]
    order = counts.select("gram", F.explode(F.array(*own)).alias("s")).select("s.m", "gram", "s.c").where("c > 0")
    union = order
    for n in range(ORDER - 1, 0, -1):  # below the highest order: how many characters precede the gram
        # a gram of nothing but starts is no prediction; an end closes the last gram of a text
        order = order.select("m", F.substring("gram", 2, n).alias("gram")).where(~F.col("gram").endswith(START)).groupBy("m", "gram").agg(F.count("*").alias("c"))
        union = union.unionByName(order)
    orders = materialize(union, "orders").withColumn("n", F.char_length("gram"))
    times = [F.greatest(F.count_if(F.col("c") == i), F.lit(1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.expr("n1 / (n1 + 2 * n2)")
    discounts = [F.greatest(F.lit(0.05), F.least(F.lit(0.95 * i), i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))).alias(f"d{i}") for i in (1, 2, 3)]
    # a row for each model and order
    stats = orders.groupBy("m", "n").agg(*times, F.count("*").alias("types")).select("m", "n", "types", *discounts)
    rows = orders.join(F.broadcast(stats), ["m", "n"])
    discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.select("m", "n", "gram", "c", discount.alias("d"), F.substring("gram", F.lit(1), F.col("n") - 1).alias("context"), F.lit(1.0).alias("one") / (F.col("types") + 1))
    rows = rows.toDF("m", "n", "gram", "c", "d", "context", "uniform")
    contexts = materialize(rows.groupBy("m", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("kept_back")), "contexts")
    parts = rows.join(contexts, ["m", "context"]).select("m", "n", "gram", "uniform", ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), (F.col("kept_back") / F.col("total")).alias("weight"))
    parts = materialize(parts, "parts")
    p = parts.where("n = 1").select("m", "gram", (F.col("own") + F.col("weight") * F.col("uniform")).alias("p"))
    unigrams, every = stats.where("n = 1").select(F.col("m").alias("m1"), (1.0 / (F.col("types") + 1)).alias("least")), p
    for n in range(2, ORDER + 1):
        lower = p.select(F.col("m").alias("m0"), F.col("gram").alias("suffix"), F.col("p").alias("p_low"))
        high = parts.where(F.col("n") == n).join(lower, (F.col("m") == F.col("m0")) & (F.substring("gram", 2, n - 1) == F.col("suffix")), "left")
        high = high.join(F.broadcast(unigrams), F.col("m") == F.col("m1"))
        p = materialize(high.select("m", "gram", (F.col("own") + F.col("weight") * F.coalesce("p_low", "least")).alias("p")), f"order{n}")
        every = every.unionByName(p)
    weights = contexts.select("m", F.col("context").alias("gram"), F.log(F.col("kept_back") / F.col("total")).alias("backoff"))
    return materialize(every.select("m", "gram", F.log("p").alias("logp")).join(weights, ["m", "gram"], "full").select("m", "gram", "logp", "backoff"), "model")


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of the n-grams whose characters the columns hold."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = (h + c + np.uint64(1)) * _B
        h ^= h >> np.uint64(29)
    return h


class Scorer:
    """An open-addressing table of (gram's hash, logp, backoff)."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, backoff: np.ndarray, unseen: float):
        self.mask = np.uint64((1 << max(4, (5 * len(keys) // 4).bit_length())) - 1)
        self.keys = np.zeros(int(self.mask) + 1, np.uint64)
        self.row = np.full(int(self.mask) + 1, len(keys), np.int32)
        self.logp, self.backoff = np.append(logp, np.nan).astype(np.float32), np.append(backoff, 0).astype(np.float32)
        self.unseen = unseen
        left, slot = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = self.row[slot] == len(keys)
            _, first = np.unique(slot, return_index=True)
            wins = np.zeros(len(left), bool)
            wins[first] = True
            wins &= free
            self.keys[slot[wins]], self.row[slot[wins]] = keys[left[wins]], left[wins]
            left, slot = left[~wins], (slot[~wins] + np.uint64(1)) & self.mask

    def find(self, h: np.ndarray) -> np.ndarray:
        """The row of each gram, or the number of rows where it is not there."""
        slot = h & self.mask
        row = self.row[slot]
        miss = np.flatnonzero((self.keys[slot] != h) & (row != len(self.logp) - 1))
        while len(miss):
            slot[miss] = (slot[miss] + np.uint64(1)) & self.mask
            row[miss] = self.row[slot[miss]]
            miss = miss[(self.keys[slot[miss]] != h[miss]) & (row[miss] != len(self.logp) - 1)]
        return row

    def score(self, texts: list[str], shard: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """For each text the log probability of its predictions that belong to the shard of the model, and the number of all its predictions."""
        held = Positions(texts)
        codes, at, where = held.codes.astype(np.uint64), held.at, held.last
        if shards > 1:
            where = where[shard_of(codes[where - 2], codes[where - 1], shards) == shard]
        total = np.zeros(len(where), np.float32)
        left = np.arange(len(where))
        for n in range(ORDER, 0, -1):
            last = where[left]
            row = self.find(_hash([codes[last - k] for k in range(n - 1, -1, -1)]))
            got = self.logp[row]
            seen = ~np.isnan(got)
            total[left[seen]] += got[seen]
            left = left[~seen]
            if not len(left):
                break
            if n > 1:  # the weight of the context that did not lead on
                last = where[left]
                total[left] += self.backoff[self.find(_hash([codes[last - k] for k in range(n - 1, 0, -1)]))]
        total[left] += self.unseen
        sums = np.zeros(len(codes) + 1)
        sums[where + 1] = total
        return np.diff(np.cumsum(sums)[at]), np.diff(at) - (ORDER - 1)


_HELD: dict[str, Scorer] = {}


def _scorer(name: str, sent) -> Scorer:
    """The table of this Python worker, made once for each shard of a model."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Scorer(*sent.value)
    return _HELD[name]


def shard_of(before: np.ndarray, last: np.ndarray, shards: int) -> np.ndarray:
    return (_hash([before, last]) >> np.uint64(33)) % np.uint64(shards)


def _scorers(model: DataFrame, entries: int):
    """(shard, shards, broadcast columns of a scorer) one after another; each has its own long grams, and all grams of up to two."""
    size = model.count()
    shards = max(1, -(-size // entries))
    # a character never seen: the weight of the empty context over all symbols and one more
    weight = model.where("gram = ''").agg(F.max("backoff")).first()[0]
    unseen = float((weight or 0) - np.log(model.where((F.length("gram") == 1) & F.col("logp").isNotNull()).count() + 1))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, owner = np.zeros(batch.num_rows, np.uint64), np.full(batch.num_rows, -1, np.int64)
            grams = batch.column(0).to_pylist()
            sizes = np.array([len(g) for g in grams], int)
            for n in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == n)
                codes = np.frombuffer("".join([grams[i] for i in rows.tolist()]).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(-1, n) if n else np.zeros((len(rows), 0), np.uint64)
                if n:
                    h[rows] = _hash([codes[:, k] for k in range(n)])
                if n > 2 and shards > 1:
                    # as a prediction a gram belongs to the two characters before its last, as a context to its last two: it may be in two shards
                    owner[rows] = shard_of(codes[:, -3], codes[:, -2], shards).astype(np.int64) * shards + shard_of(codes[:, -2], codes[:, -1], shards).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(1).cast(pa.float32()), batch.column(2).cast(pa.float32()), pa.array(owner)], names=["h", "logp", "backoff", "owner"])

    hashed = materialize(model.mapInArrow(releasing(split), "h long, logp float, backoff float, owner long"), "model-rows")
    for shard in range(shards):
        mine = (F.col("owner") < 0) | (F.floor(F.col("owner") / shards) == shard) | (F.col("owner") % shards == shard)
        rows = hashed.where(mine).select("h", "logp", "backoff").toArrow()  # a shard has a bounded number of entries
        logp, backoff = (rows.column(c).to_numpy() for c in ("logp", "backoff"))
        yield shard, shards, model.sparkSession.sparkContext.broadcast((rows.column("h").to_numpy().view(np.uint64), logp, np.nan_to_num(backoff), unseen))


def score(bound: DataFrame, models: DataFrame, numbers: Iterable[int], entries: int) -> DataFrame:
    """(m, bundle, at, logp, n_tokens) of each row of ``bound``, written; model m scores the bundles of m."""
    parts = None
    for m in numbers:
        mine = bound.where(F.col("m") == m).select("bundle", "rows")
        for shard, shards, sent in _scorers(models.where(F.col("m") == m).drop("m"), entries):

            def run(batches: Iterator[pa.RecordBatch], name=uuid.uuid4().hex, shard=shard, shards=shards, sent=sent) -> Iterator[pa.RecordBatch]:
                scorer = _scorer(name, sent)
                for batch in batches:
                    for number, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                        texts = _unpacked(raw.as_py()).column("__text")
                        sizes, begin = pa.compute.utf8_length(texts).to_pylist(), 0
                        while begin < len(sizes):
                            end, size = begin + 1, sizes[begin]
                            while end < len(sizes) and size + sizes[end] <= CHUNK:
                                size += sizes[end]
                                end += 1
                            logp, n = scorer.score(texts.slice(begin, end - begin).to_pylist(), shard, shards)
                            columns = (np.full(len(n), number), np.arange(begin, end, dtype=np.int32), logp, n)
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bundle", "at", "logp", "n_tokens"])
                            begin = end

            # written before the next pass, so that a worker holds one shard of a model at a time
            part = materialize(mine.mapInArrow(releasing(run), "bundle long, at int, logp double, n_tokens long").withColumn("m", F.lit(m)), "pass")
            sent.destroy()
            parts = part if parts is None else parts.unionByName(part)
    return materialize(parts.groupBy("m", "bundle", "at").agg(F.sum("logp").alias("logp"), F.max("n_tokens").alias("n_tokens")), "scores")


def _fields(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def _perplexity():
    return F.when(F.col("n_tokens") > 1, F.exp(-F.col("logp") / F.col("n_tokens"))).alias("perplexity")


def perplexity(docs: DataFrame, model: DataFrame, entries: int = SHARD_ENTRIES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, logp, perplexity of each row; texts without tokens but their end have no perplexity.

    The model is held in shards of about ``entries`` entries.
    """
    bound = bind(_prepared(docs, [], id_col, None, text_col))
    scores = score(bound, model.withColumn("m", F.lit(0)), [0], entries)
    return places(bound).join(scores, ["bundle", "at"]).select(F.col("id").alias(id_col), "n_tokens", "logp", _perplexity())


def length_class(tokens: str = "n_tokens"):
    """0: under 200 characters, 1: under 1,000, 2: any longer."""
    return F.when(F.col(tokens) < 200, 0).when(F.col(tokens) < 1000, 1).otherwise(2)


def _judged(docs: DataFrame, bound: DataFrame, labels: DataFrame, quantile: float, margin: float, entries: int) -> DataFrame:
    """bundle, at, id, lang, n_tokens, perplexity, threshold, keep of the rows of ``bound``, the bundles of ``docs``."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select(F.col("doc_id").alias("id")).where("id is not null").distinct()
    rows = places(bound)
    trusted = materialize(good.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)).cast("int")), "trusted")
    marks = marked(bound, trusted)
    if marks.where("fold > 0").isEmpty():
        return rows.select("bundle", "at", "id", "lang", F.lit(None).cast("long").alias("n_tokens"), F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), (F.col("size") > 0).alias("keep"))
    scores = score(bound, models_of(count_trusted(docs, trusted), [0]), [0], entries).withColumn("perplexity", _perplexity()).withColumn("class", length_class())
    scored = rows.join(scores, ["bundle", "at"])
    seen = marks.where("fold = 0").select("bundle", "at").join(scored, ["bundle", "at"]).select("lang", "perplexity", "class").where("perplexity is not null")
    seen = materialize(seen, "calibration")
    cut = [F.percentile_approx("perplexity", quantile, 100_000).alias("q"), F.count("*").alias("n")]
    whole = seen.agg(*cut).first()
    limits = seen.groupBy("lang").agg(*cut).toDF("l1", "q1", "n1")
    fine = seen.groupBy("lang", "class").agg(*cut, F.var_samp(F.log("perplexity")).alias("v")).toDF("l2", "k2", "q2", "n2", "v2")
    # one row for each class of length: how far log perplexities spread within a language
    spread = fine.where("l2 is not null").groupBy(F.col("k2").alias("k3")).agg(F.sqrt(F.try_divide(F.sum(F.col("v2") * (F.col("n2") - 1)), F.sum(F.col("n2") - 1))).alias("spread"))
    # a row or few for each language: joined in a way that Spark may broadcast after it has seen the size
    found = scored.join(fine, (F.col("lang") == F.col("l2")) & (F.col("class") == F.col("k2")), "left").join(limits, F.col("lang") == F.col("l1"), "left").join(F.broadcast(spread), F.col("class") == F.col("k3"), "left")

    def beyond(q: str, n: str):
        """The quantile, or what lies beyond the greatest of few rows: the tail of log perplexities falls off by their spread."""
        return F.col(q) * F.pow(F.greatest(F.lit(1.0), 1 / (max(1 - quantile, 1e-6) * F.col(n))), F.coalesce("spread", F.lit(0.0)))

    found = found.withColumns({"q0": F.lit(whole["q"]).cast("double"), "n0": F.lit(whole["n"])})
    limit = margin * F.coalesce(beyond("q2", "n2"), beyond("q1", "n1"), F.when(F.col("n0") > 0, beyond("q0", "n0")))
    keep = F.coalesce(F.col("perplexity") <= limit, F.lit(False)) if whole["q"] is not None else F.col("perplexity").isNotNull()
    return found.select("bundle", "at", "id", "lang", "n_tokens", "perplexity", limit.alias("threshold"), keep.alias("keep"))


def _prepared(docs: DataFrame, passed: list[str], id_col: str | None, lang_col: str | None, text_col: str) -> DataFrame:
    """The columns that :func:`bind` needs, and those passed under names of our own."""
    own = [F.col(id_col) if id_col else F.lit(None).cast("long"), F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")]
    named = [c.alias(n) for c, n in zip(own, ("__id", "__lang"), strict=True)]
    return docs.select(*[F.col(c).alias(f"__c{k}") for k, c in enumerate(passed)], F.lit(0).alias("__m"), *named, text_of(text_col).alias("__text"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.999, margin: float = 1.05, entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, keep of each row of ``docs`` (doc_id, text, lang).

    Trusted are rows labelled quality 1 and not toxic (``labels``: doc_id, quality, toxic). A document stays if its
    perplexity is at most ``margin`` times the ``quantile`` of held-out trusted rows of its language and class of length.
    Null texts count as empty; a text without characters has no perplexity and is not kept. Null ids and null
    languages take part (the latter, and languages without held-out rows, meet the quantile of all; a class of length without any meets that of
    its language; without a column ``lang`` all languages are null). Of n held-out rows, fewer than 1 / (1 - quantile), the quantile is beyond
    their greatest: it is taken to lie 1 / (n (1 - quantile)) to the power of the spread of log perplexities above it, for any n alike. Rows that repeat are
    judged each. Without any trusted rows there is no model and all rows with a text stay. Empty tables give no rows.
    Other columns of ``docs`` are neither read nor returned.
    """
    rows = _prepared(docs, [], "doc_id", "lang", "text")
    judged = _judged(rows, bind(rows), labels, quantile, margin, entries)
    return judged.select(F.col("id").alias("doc_id"), "lang", "n_tokens", "perplexity", "threshold", "keep")


def keep_documents(docs: DataFrame, labels: DataFrame, quantile: float = 0.999, margin: float = 1.05, entries: int = SHARD_ENTRIES, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`classify` does not keep; all columns stay, whatever their names."""
    # a text that is kept is never null, so it need not be held twice
    passed = [c for c in docs.columns if c != text_col or docs.schema[c].dataType.simpleString() != "string"]
    inner = [f"__c{k}" for k in range(len(passed))] + ["__text"]
    names = dict(zip([*passed, *[c for c in docs.columns if c not in passed]], inner, strict=False))
    rows = _prepared(docs, passed, id_col, lang_col, text_col)
    bound = bind(rows)
    kept = _judged(rows, bound, labels, quantile, margin, entries).where("keep").select("bundle", "at", F.lit(0).alias("fold"))

    def take(rows: pa.Table, marks: list[dict]) -> pa.Table:
        return rows.take(pa.array([m["at"] for m in marks])).select(inner)

    stay = _of_bundles(bound, kept, take, _fields(rows.select(*inner)))
    return stay.select(*[F.col(names[c]).alias(c) for c in docs.columns])
