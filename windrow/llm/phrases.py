"""Phrase collocations from vertical lists of positions: the longer a list, the more frequent its phrase.

Input tasks bind the texts of each language into segments of a bounded number of words, in which each occurrence has a position; pieces
and documents are set apart by a position that nothing holds. A segment keeps, for each word, the list of its positions (gaps, as
variable-length integers). Lengths of lists, dealt into buckets by word, add up to exact frequencies over all segments, and each segment is told which of its
words are frequent. Their lists are joined within the segment: a list's positions meet those one further on, which gives the lists of pairs; frequent pairs that overlap in a word give
triples by the same merge. Only lists of frequent phrases go on to the next round, as no phrase is more frequent than its parts.

A bucket gets one row of each segment at most, whatever a phrase's frequency, and the number of buckets follows that of input partitions, so none outgrows a task.

Null texts are empty, null languages are ``und``. Repeated rows count as often as they are there.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm import _varints
from windrow.llm._common import materialize, releasing

#: Words after which a segment is full, over all languages of a task (a longer document still goes into one), and buckets for each input partition.
SEGMENT_WORDS, BUCKETS = 2_000_000, 4

_BREAK = b"\xff"  # in no UTF-8 text
#: Lower case, tabs as spaces, and what ends a piece as a break.
_BYTES = bytes(255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)).lower()

#: What a segment leaves: a row with its lists (ids, lengths, positions), and a row for each bucket with phrases (words, or heads and tails) and their lengths there;
#: ``places`` are the numbers of those phrases in the segment. ``held`` counts the words of its texts.
_LEFT = "part int, segment int, lang string, held long, bucket int, words binary, heads binary, tails binary, places binary, lengths binary, ids binary, positions binary"
#: What a bucket finds: a row for each frequent phrase, and a row for each segment with the ids and places of those it has.
_FOUND = "part int, segment int, id long, lang string, word string, head long, tail long, f long, ids binary, places binary"


def _bytes(numbers: np.ndarray) -> bytes:
    return _varints.encode(numbers)[0].tobytes()


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def _gathered(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``keys``, how often each is there, and the values of ``at``, which ascend, one key after another."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(np.append(first, len(keys))), at[order]


def _gaps(n: np.ndarray, at: np.ndarray) -> bytes:
    """Lists of ``n`` ascending positions each, as gaps."""
    gaps = np.diff(at, prepend=0)
    first = np.cumsum(n) - n
    gaps[first] = at[first]
    return _bytes(gaps)


def _positions(gaps: bytes, n: np.ndarray) -> np.ndarray:
    """What :func:`_gaps` wrote."""
    running = np.cumsum(_varints.decode(gaps))
    before = np.concatenate([[0], running[np.cumsum(n)[:-1] - 1]]) if len(n) else running
    return running - np.repeat(before, n)


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each bucket's members."""
    order = np.argsort(buckets, kind="stable")
    cut = np.flatnonzero(np.diff(buckets[order])) + 1
    return ((int(buckets[places[0]]), places) for places in np.split(order, cut) if len(places))


class _Segment:
    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_BREAK]
        self.texts: list[np.ndarray] = []
        self.held = 0

    def add(self, text: str) -> int:
        words = (text.encode("utf-8", "replace").translate(_BYTES).replace(_BREAK, b" \xff ") + b" \xff").split(b" ")
        numbers = np.fromiter(map(self.numbers.__getitem__, filter(None, words)), np.int32)
        self.texts.append(numbers)
        self.held += len(numbers)
        return len(numbers)

    def left(self, part: int, segment: int, lang: str, buckets: int) -> pa.Table:
        numbers = np.concatenate(self.texts)
        at = np.flatnonzero(numbers)
        _, n, positions = _gathered(numbers[at], at)  # the words have the numbers from one on
        own = {"part": part, "segment": segment, "lang": lang}
        rows = [own | {"held": len(at), "lengths": _bytes(n), "positions": _gaps(n, positions)}]
        words = [*self.numbers][1:]
        for bucket, places in _by_bucket(np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))):
            rows.append(own | {"bucket": bucket, "words": b"\n".join(words[i] for i in places), "places": _bytes(places), "lengths": _bytes(n[places])})
        return _table(rows, _LEFT)


def word_lists(docs: DataFrame, buckets: int, lang: str = "lang", text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The written segments with the lists of all their words."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment, held = TaskContext.get().partitionId(), 0, 0
        open_: defaultdict[str, _Segment] = defaultdict(_Segment)

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal segment, held
            for code, s in open_.items():
                yield from s.left(part, segment, code, buckets).to_batches()
                segment += 1
            open_.clear()
            held = 0

        for batch in batches:
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held += open_[code].add(t.as_py())
                if held >= segment_words:
                    yield from full()
        yield from full()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    return materialize(rows.mapInArrow(run, _LEFT), "phrase-words")


def _frequent(least: int, buckets: int):
    """Adds up one bucket's lengths: its frequent phrases, and which of them each segment has."""

    def run(table: pa.Table) -> pa.Table:
        rows, bucket = table.to_pylist(), table["bucket"][0].as_py()
        n = [_varints.decode(r["lengths"]) for r in rows]
        out: list[dict] = []
        if rows[0]["words"] is not None:
            words = [[(r["lang"], w) for w in r["words"].split(b"\n")] for r in rows]
            sums: Counter = Counter()
            for some, counts in zip(words, n, strict=True):
                for w, c in zip(some, counts.tolist(), strict=True):
                    sums[w] += c
            ids = {w: bucket + buckets * i for i, w in enumerate(w for w, c in sums.items() if c >= least)}
            out = [{"id": i, "lang": w[0], "word": w[1].decode(), "f": sums[w]} for w, i in ids.items()]
            known = [np.array([ids.get(w, -1) for w in some], np.int64) for some in words]
        else:
            heads, tails = (np.concatenate([_varints.decode(r[c]) for r in rows]) for c in ("heads", "tails"))
            order = np.lexsort((tails, heads))
            new = (np.diff(heads[order], prepend=-1) != 0) | (np.diff(tails[order], prepend=-1) != 0)
            first = np.flatnonzero(new)
            sums_ = np.add.reduceat(np.concatenate(n)[order], first)
            kept = sums_ >= least
            number = np.where(kept, bucket + buckets * (np.cumsum(kept) - 1), -1)
            out = [{"id": int(i), "head": int(h), "tail": int(t), "f": int(f)} for i, h, t, f in zip(number[kept], heads[order][first][kept], tails[order][first][kept], sums_[kept], strict=True)]
            each = np.empty(len(heads), np.int64)
            each[order] = number[np.cumsum(new) - 1]
            known = np.split(each, np.cumsum([len(x) for x in n])[:-1])
        for r, ids_ in zip(rows, known, strict=True):
            hit = ids_ >= 0
            if hit.any():
                out.append({"part": r["part"], "segment": r["segment"], "ids": _bytes(ids_[hit]), "places": _bytes(_varints.decode(r["places"])[hit])})
        return _table(out, _FOUND)

    return run


def _extended(n: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists of phrases that are one word longer: each position of a phrase meets that of the phrase one word on. (head, tail, n, positions)"""
    order = np.argsort(positions, kind="stable")
    at, row = positions[order], np.repeat(np.arange(len(n)), n)[order]
    meets = np.flatnonzero(at[1:] == at[:-1] + 1)
    keys, count, at = _gathered(row[meets] * max(1, len(n)) + row[meets + 1], at[meets])
    return *np.divmod(keys, max(1, len(n))), count, at


def _next(first: bool, last: bool, buckets: int):
    """A segment's next round: the lists that it left, made one word longer but in the ``first`` round, as far as they are frequent; and what those meet."""

    def run(left: pa.Table, found: pa.Table) -> pa.Table:
        if not len(left) or not len(found):
            return _table([], _LEFT)
        own = left.to_pylist()[0]
        n = _varints.decode(own["lengths"])
        positions = _positions(own["positions"], n)
        if not first:
            _, _, n, positions = _extended(n, positions)
        places, ids = (np.concatenate([_varints.decode(b) for b in found[c].to_pylist()]) for c in ("places", "ids"))
        order = np.argsort(places)
        ids, chosen = ids[order], np.zeros(len(n), bool)
        chosen[places] = True
        positions, n = positions[np.repeat(chosen, n)], n[chosen]
        own = {k: own[k] for k in ("part", "segment", "lang")}
        rows = [] if last else [own | {"lengths": _bytes(n), "positions": _gaps(n, positions)}]
        head, tail, count, _ = _extended(n, positions)
        head, tail = ids[head], ids[tail]
        for bucket, at in _by_bucket((head * 2_654_435_761 + tail * 40_503) % 4_294_967_291 % buckets):
            rows.append(own | {"bucket": bucket, "heads": _bytes(head[at]), "tails": _bytes(tail[at]), "places": _bytes(at), "lengths": _bytes(count[at])})
        return _table(rows, _LEFT)

    return run


def frequent_phrases(docs: DataFrame, least: int = 10, longest: int = 3, segment_words: int = SEGMENT_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """Words by language, and for each length the phrases that occur ``least`` times: (id, head, tail, lang, words, starts, ends).

    ``starts`` and ``ends`` are the frequencies of a phrase's first and last words, from one word to all; ``head`` and ``tail`` are the phrases without the last and the first word.
    """
    buckets = BUCKETS * docs.select().rdd.getNumPartitions() + 1
    left = word_lists(docs, buckets, segment_words=segment_words)
    totals = left.where("bucket IS NULL").groupBy("lang").agg(F.sum("held").alias("n"))
    levels: list[DataFrame] = []
    for size in range(1, longest + 1):
        found = materialize(left.where("bucket IS NOT NULL").groupBy("bucket").applyInArrow(_frequent(least, buckets), _FOUND), f"phrase-found-{size}")
        phrases = found.where("id IS NOT NULL")
        if size == 1:
            levels.append(phrases.select("id", "head", "tail", "lang", F.array("word").alias("words"), F.array("f").alias("starts"), F.array("f").alias("ends")))
        else:
            heads = levels[-1].select(F.col("id").alias("head"), "lang", F.col("words").alias("__words"), F.col("starts").alias("__starts"))
            tails = levels[-1].select(F.col("id").alias("tail"), F.element_at("words", -1).alias("__word"), F.col("ends").alias("__ends"))
            joined = phrases.select("id", "head", "tail", "f").join(heads, "head").join(tails, "tail")
            own = F.array("f")
            levels.append(materialize(joined.select("id", "head", "tail", "lang", F.concat("__words", F.array("__word")).alias("words"), F.concat("__starts", own).alias("starts"), F.concat("__ends", own).alias("ends")), f"phrases-{size}"))
        if size < longest:
            lists = left.where("bucket IS NULL").select("part", "segment", "lang", "lengths", "positions").groupBy("part", "segment")
            told = found.where("id IS NULL").select("part", "segment", "ids", "places").groupBy("part", "segment")
            left = materialize(lists.cogroup(told).applyInArrow(_next(size == 1, size + 1 == longest, buckets), _LEFT), f"phrase-lists-{size + 1}")
    return totals, levels


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, covered: int = 50, keep: int = 2000, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Each language's ``keep`` best phrases of two to ``longest`` words that occur ``least`` times.

    A phrase's score is that of its weakest cut: floor(10^6 a^2 / (l r)) of its frequency a and those of both parts. Phrases within a longer one that has at least
    ``covered`` percent of their occurrences give way to it: (lang, rank, phrase, a, l, r, n, score). Ranks go by score, frequency, and the phrase's bytes.
    Products are decimals of up to 38 digits: exact for frequencies below 10^14.
    """
    totals, levels = frequent_phrases(docs, least, longest, segment_words)
    scored = None
    for size, phrases in enumerate(levels[1:], 2):
        rows = phrases.withColumn("a", F.element_at("starts", -1))
        if size < longest:
            # a longer phrase that contains this one holds one that is a word longer, and no less frequent
            longer = levels[size].select("head", "tail", F.element_at("starts", -1).alias("f"))
            most = longer.select(F.col("head").alias("id"), "f").unionAll(longer.select("tail", "f")).groupBy("id").agg(F.max("f").alias("__most"))
            rows = rows.join(most, "id", "left").where(F.coalesce(100 * F.col("__most") < covered * F.col("a"), F.lit(True)))
        whole = "cast(a as decimal(14)) * cast(a as decimal(14)) * cast(1000000 as decimal(7))"
        cuts = f"transform(sequence(1, {size - 1}), k -> struct(({whole}) div (cast(starts[k - 1] as decimal(14)) * cast(ends[{size - 1} - k] as decimal(14))) as score, k as k, starts[k - 1] as l, ends[{size - 1} - k] as r))"
        rows = rows.withColumn("__cut", F.array_min(F.expr(cuts))).select("lang", F.array_join("words", " ").alias("phrase"), "a", "__cut.l", "__cut.r", "__cut.score")
        scored = rows if scored is None else scored.unionByName(rows)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= keep)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
