"""Near copies by the Jaccard similarity of word shingles, verified exactly.

Fingerprints and MinHash bands only propose: texts whose SimHash fingerprints are linked (see :mod:`windrow.llm.simhash`), or
that agree in one band of ``ROWS`` least hashes, meet in a bucket, where their whole sets of shingles (as 64-bit hashes) are compared. A pair at similarity s is missed by all bands with probability
(1 - s^ROWS)^BANDS: 7e-6 at 0.8, 2e-8 at 0.85. Texts of one set are one class throughout. Buckets with the same members
are compared once, large ones in chunks of which every two meet, and each gives a spanning forest, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import by_position, likely_in, materialize, releasing
from windrow.llm.simhash import components, components_of

BANDS, ROWS = 30, 5
#: Classes, and shingles, that a chunk of a bucket holds about.
CHUNK, SHINGLES = 512, 1_000_000
_XOR, _ODD = np.random.default_rng(8).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_ODD |= np.uint64(1)
_B = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of so many words; of all its words, where there are fewer."""
    import xxhash

    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    return np.unique(np.array([digest(joined[s:e], seed) for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)], np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A hash for each band, of the least values that its functions take on the shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, ((hashes[at : at + 2048] ^ _XOR[:, None]) * _ODD[:, None]).min(1), out=least)
    v = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        v = (v + column + np.uint64(1)) * _B
        v ^= v >> np.uint64(29)
    return v


def _list_of(arrays: list[np.ndarray]) -> pa.ListArray:
    at = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def _signed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            names, sizes, found = [], [], []
            for t in batch.column(2):
                h = shingles(t.as_py(), words)
                names.append(xxhash.xxh64_intdigest(h.tobytes()))
                sizes.append(len(h))
                found.append(bands(h))
            columns = [batch.column(0), batch.column(1), pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), _list_of(found)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rk", "class", "n", "bands"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), _list_of([shingles(t.as_py(), words) for t in part.column(1)])], names=["class", "hashes"])

    return run


def _forest(flat: np.ndarray, at: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between sets: set k is ``flat[at[k]:at[k + 1]]``."""
    _, flat = np.unique(flat, return_inverse=True)
    sizes, rest, edges = np.diff(at), np.arange(len(at) - 1), []
    mark, sums = np.zeros(flat.max(initial=0) + 1, bool), np.zeros(len(flat) + 1, np.int64)
    while len(rest) > 1:
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            k = front.pop()
            mark[:] = False
            mark[flat[at[k] : at[k + 1]]] = True
            np.cumsum(mark[flat], out=sums[1:])
            common = (sums[at[1:]] - sums[at[:-1]])[rest]
            near = common >= similarity * (sizes[k] + sizes[rest] - common) - 1e-9
            found = rest[near].tolist()
            edges += [(k, x) for x in found]
            front, rest = front + found, rest[~near]
    return edges


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            names, sets = lists.flatten().flatten()
            names, values, at = names.to_numpy(), sets.values.to_numpy(), sets.offsets.to_numpy().astype(np.int64)
            pairs: list[tuple[int, int]] = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                pairs += [(a + x, a + y) for x, y in _forest(values[at[a] : at[b]], at[a : b + 1] - at[a], similarity)]
            x, y = names[np.array(pairs, np.int64).reshape(-1, 2)].T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def links(docs: DataFrame, classes: DataFrame, similarity: float, words: int, text_col: str = "text", linked: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) that connect the classes (class, rk of one of their rows, n, bands) as their similar pairs do; ``docs`` has the key __rk.

    ``linked`` (class, root) names components of fingerprints, whose classes meet as those of a band do.
    """
    keys = classes.select("class", "n", F.posexplode("bands").alias("k", "v"))
    if linked is not None:
        keys = keys.unionByName(classes.select("class", "n").join(linked, "class").select("class", "n", F.lit(BANDS).alias("k"), F.col("root").alias("v")))
    counts = keys.groupBy("k", "v").agg(F.count("*").alias("m"), F.sum("n").alias("held")).where("m > 1")
    chunks = F.greatest(F.ceil(F.col("m") / CHUNK), F.least(F.ceil(F.col("held") / SHINGLES), F.col("m"))).cast("int")
    met = keys.join(counts, ["k", "v"]).withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j != F.col("own"))
    tasks = met.select("class", "k", "v", "own", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(others)).alias("other"))
    dealt = tasks.groupBy("k", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    met = dealt.agg(F.array_sort(F.collect_list("class")).alias("members")).where(F.size("members") > 1)
    numbered = materialize(met.select("members").distinct().withColumn("task", F.monotonically_increasing_id()), "buckets")
    members = numbered.select("task", F.explode("members").alias("class"))
    wanted = materialize(members.select("class").distinct().join(classes.select("class", "rk"), "class"), "members")
    rows = likely_in(docs.select("__rk", F.col(text_col).cast("string").alias("text")), "__rk", wanted.select(F.col("rk").alias("__rk")))
    texts = rows.join(wanted, F.col("__rk") == F.col("rk")).select("class", "text")
    sets = materialize(texts.mapInArrow(releasing(_sets(words)), "class long, hashes array<long>").dropDuplicates(["class"]), "shingles")
    whole = members.join(sets, "class").groupBy("task").agg(F.collect_list(F.struct("class", "hashes")).alias("sets"))
    return whole.select("sets").mapInArrow(releasing(_verified(similarity)), "a long, b long").distinct()


def drop_near_copies(docs: DataFrame, similarity: float = 0.8, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row, that of the smallest id, of each group that pairs of at least this similarity connect.

    Words are told apart by ASCII white space and lower-cased where they are ASCII. Null texts and texts without words are
    alike. Null ids come last; of rows that repeat one stays; an empty table gives no rows. Columns may have any names.
    """
    names = docs.columns
    docs, (id_col, text_col) = by_position(docs, id_col, text_col)
    keyed = docs.withColumn("__rk", F.xxhash64(id_col, text_col))
    signed = keyed.select(F.col(id_col).cast("long"), "__rk", F.col(text_col).cast("string")).mapInArrow(releasing(_signed(words)), "doc_id long, rk long, class long, n long, bands array<long>")
    rows = materialize(signed, "minhashes")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rk"))
    classes = materialize(rows.groupBy("class").agg(first.alias("first"), F.first(F.struct("n", "bands")).alias("s")).select("class", "first", "first.rk", "s.*"), "classes")
    fingerprints = components_of(docs, id_col=id_col, text_col=text_col).select("rk", "root")
    linked = materialize(rows.select("rk", "class").join(fingerprints, "rk").select("class", "root").distinct(), "linked")
    roots = components(links(keyed, classes, similarity, words, text_col, linked))
    rooted = materialize(classes.join(roots, F.col("class") == F.col("node"), "left").select("class", "first", F.coalesce("root", "class").alias("root")), "near-copies")
    stays = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    of = rooted.join(stays, "root").select("class", F.col("stays.rk").alias("__stays"))
    gone = rows.select("rk", "class").join(of, "class").where("rk <> __stays").select(F.col("rk").alias("__gone")).distinct()
    stay = keyed.join(gone, F.col("__rk") == F.col("__gone"), "left_anti")
    if not rows.groupBy("rk").count().where("count > 1").isEmpty():  # rows that repeat both id and text
        stay = stay.dropDuplicates(["__rk"])
    return stay.select(*docs.columns).toDF(*names)
