"""Substring dedup by recompression.

Words are symbols. Rounds rename the text: first runs of two equal words, then pairs whose left
symbol falls in one half of all names and whose right symbol falls in the other. A name is a hash of what
it stands for, so it is the same wherever it occurs, without exchanging name tables, and whether two symbols
merge depends on them alone. After one run round and two pair rounds a symbol spans at most 8
words, and it is settled by the 8 words on either side of it: equal stretches of text have equal
symbols but for 8 words at their ends.

So any window of 35 words holds whole symbols whose names depend on the window only. It elects the one
with the smallest name; equal windows elect alike. Windows that elect the same symbol form a group
with two keys: the symbol with the context that all its windows share, and all the text its windows cover.

* Groups that share both keys are repeats throughout: all their windows occur again.
* A group that shares only the first may hold repeats up to an edge: its windows are compared one by one.
* All others hold none. Only keys and positions travel for this; texts travel once, compressed.

A word has two hashes, each a sum of values that depend on byte and place without any algebra between them. Symbols and the first
key come from one, the second key from the other; both keys are compared together (128 bits), edges by 128-bit hashes of the windows' bytes.
Rows are known by a number that is written with their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import materialize, partitions, releasing, text_of

#: Words that settle a symbol on either side, and the most words that a symbol spans.
MARGIN, LONGEST = 8, 8
#: Bytes of text that one call of the kernel sees, unless one document is longer.
CHUNK = 2_000_000
_LOW = np.uint64((1 << 24) - 1)
_BYTE, _KEY, _SPAN = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
_ROWS = "rk long, key long, span long, low int, high int, kind int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as were asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> "_Powers":
        if len(self.up) < n:
            n = max(n, 1 << 20)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self

    def stretches(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of values[start:end] for each stretch, the same wherever it stands."""
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.upto(len(values) + 1).up[: len(values)], out=sums[1:])
        return _mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


_POWERS = {b: _Powers(b) for b in (_KEY, _SPAN)}


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts, and both its hashes."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    place = np.arange(len(raw), dtype=np.uint64)
    sizes = (ends - starts).astype(np.uint64)
    begin = np.zeros(len(raw), np.uint64)
    begin[starts] = starts
    place -= np.maximum.accumulate(begin)
    value = _mix((place << np.uint64(8)) + raw + np.uint64(1))
    sums = np.zeros(len(raw) + 1, np.uint64)
    hashes = []
    for _ in range(2):
        np.cumsum(value, out=sums[1:])
        hashes.append(_mix(sums[ends] - sums[starts] + sizes))
        value = (value ^ (value >> np.uint64(31))) * _BYTE  # no linear function of the values before
    return starts, *hashes


def recompress(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a sequence of words after all rounds: their names, and where each starts."""

    def merge(names: np.ndarray, starts: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(left)
        names = names.copy()
        names[at] = _mix(names[at] * _KEY + names[at + 1] * _SPAN + np.uint64(1))
        stay = np.ones(len(names), bool)
        stay[at + 1] = False
        return names[stay], starts[stay]

    names, starts = words, np.arange(len(words))
    same = np.concatenate([[False], words[1:] == words[:-1], [False, False]])  # same[i]: word i equals the one before
    two = same[1 : len(words) + 1] & ~same[: len(words)] & ~same[2 : len(words) + 2]
    names, starts = merge(names, starts, two)
    for _ in range(2):
        right = (names >> np.uint64(40)) & np.uint64(1) == 1
        names, starts = merge(names, starts, np.concatenate([~right[:-1] & right[1:], [False]]))
    return names, starts


def groups(words: np.ndarray, others: np.ndarray, doc_of: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Groups of windows: first and last start of their windows, and both keys. words, others: both hashes; doc_of: ascending, a number for each word."""
    n = len(words) - window + 1
    at = np.flatnonzero(doc_of[:n] == doc_of[window - 1 :]) if n > 0 else np.zeros(0, np.int64)
    if not len(at):
        return (at, at, at.astype(np.uint64), at.astype(np.uint64))
    names, starts = recompress(words)
    ends = np.append(starts[1:], len(words))
    a = np.searchsorted(starts, at + MARGIN)
    b = np.searchsorted(ends, at + window - MARGIN, "right")
    order = (_mix(names) & ~_LOW) | np.arange(len(names), dtype=np.uint64)
    smallest = np.empty(len(at), np.uint64)
    size, best = 1, order
    while True:  # minima of runs of 1, 2, 4, ... symbols; two of them cover any range
        own = np.flatnonzero((b - a >= size) & (b - a < 2 * size))
        if len(own):
            smallest[own] = np.minimum(best[a[own]], best[b[own] - size])
        size *= 2
        if size > window or len(best) <= size // 2:
            break
        best = np.minimum(best[: -size // 2], best[size // 2 :])
    elected = (smallest & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (elected[1:] != elected[:-1]) | (at[1:] != at[:-1] + 1)]))
    low, high = at[first], at[np.append(first[1:], len(at)) - 1]
    s, e = starts[elected[first]], ends[elected[first]]
    key = _POWERS[_KEY].stretches(words, s - MARGIN, e + MARGIN) ^ _mix((e - s).astype(np.uint64))
    span = _POWERS[_SPAN].stretches(others, low, high + window) ^ _mix(((s - low) * 1000 + (high - low)).astype(np.uint64))
    return low, high, key, span


def _chunk_rows(rks: list[int], texts: list[bytes], window: int) -> pa.RecordBatch:
    """The groups of some documents. Repeats among them are settled here, so that each key leaves once."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    starts, words, others = words_of(raw)
    doc_of = np.searchsorted(begins, starts, "right") - 1
    first_word = np.searchsorted(starts, begins)
    parts = []
    step = 1 << 23  # a document of more words is seen in stretches that overlap by a window
    for k in range(0, max(len(words), 1), step):
        found = groups(*(c[k : k + step + window - 1] for c in (words, others, doc_of)), window)
        parts.append((found[0] + k, found[1] + k, *found[2:]))
    low, high, key, span = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((low, span, key))
    low, high, key, span = (c[order] for c in (low, high, key, span))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (span[1:] != span[:-1])]) if len(low) else np.zeros(0, bool)
    counts = np.diff(np.append(np.flatnonzero(new), len(new)))
    kind = np.where(new, np.repeat(counts > 1, counts).astype(np.int32), 2)
    doc = doc_of[low] if len(low) else np.zeros(0, np.int64)
    rest = kind == 2
    runs = _join(doc[rest], low[rest], high[rest])
    rk = np.array(rks, np.int64)
    columns = [
        (rk[doc[~rest]], rk[runs[0]]),
        (key[~rest].view(np.int64), _mix(rk[runs[0]].view(np.uint64) + runs[1].astype(np.uint64)).view(np.int64)),
        (span[~rest].view(np.int64), np.zeros(len(runs[0]), np.int64)),
        ((low - first_word[doc])[~rest], runs[1] - first_word[runs[0]]),
        ((high - first_word[doc])[~rest], runs[2] - first_word[runs[0]]),
        (kind[~rest], np.full(len(runs[0]), 2)),
    ]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds, strict=True)], names=["rk", "key", "span", "low", "high", "kind"])


def _join(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that follow one another in a document, as one run."""
    order = np.argsort(low, kind="stable")
    doc, low, high = doc[order], low[order], high[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (low[1:] != high[:-1] + 1)]) if len(low) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return doc[first], low[first], high[np.append(first[1:], len(low)) - 1] if len(low) else high


def _gather(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        rks, texts, held = [], [], 0
        for batch in batches:
            for rk, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = unpack(packed.as_py())
                rks.append(rk)
                texts.append(raw)
                held += len(raw)
                if held > CHUNK:
                    yield _chunk_rows(rks, texts, window)
                    rks, texts, held = [], [], 0
        if rks:
            yield _chunk_rows(rks, texts, window)

    return run


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of their keys: repeats (edge 0) and groups to look into (edge 1). It holds one row."""
    key = span = held = None
    shared = many = False
    for batch in batches:
        k, s, kind = (batch.column(c).to_numpy() for c in (1, 2, 5))
        # alone in its batch with its first key: it matters only at the batch's ends
        alone = np.concatenate([[False], k[1:] != k[:-1]]) & np.concatenate([k[1:] != k[:-1], [False]]) & (kind == 0)
        rows = np.flatnonzero(~alone)
        out: list[tuple[int, int, int, int]] = []
        cells = zip(*(batch.column(c).take(pa.array(rows)).to_pylist() for c in (0, 3, 4)), k[rows].tolist(), s[rows].tolist(), kind[rows].tolist(), strict=True)
        for rk, low, high, own_key, own_span, own_kind in cells:
            row = (rk, low, high)
            if own_kind == 2:
                out.append((*row, 0))
                continue
            if own_key != key:
                key, span, held, shared, many = own_key, own_span, row, own_kind == 1, False
                if shared:
                    out.append((*row, 0))
            elif own_span == span:
                if not shared:
                    shared = True
                    out.append((*held, 0))
                out.append((*row, 0))
            else:
                if not many:
                    many = True
                    out.append((*held, 1))
                span, held, shared = own_span, row, own_kind == 1
                if shared:
                    out.append((*row, 0))
                out.append((*row, 1))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["rk", "low", "high", "edge"])


def _kept(words: list[bytes], spans: np.ndarray, window: int) -> tuple[int, str]:
    """The number of words that windows starting in the spans cover, and the digest of all others."""
    if not len(spans):
        return 0, hashlib.sha256(b" ".join(words)).hexdigest()
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, spans[:, 0], 1)
    np.add.at(steps, np.minimum(spans[:, 1] + window, len(words)), -1)
    covered = np.cumsum(steps[:-1]) > 0
    return int(covered.sum()), hashlib.sha256(b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c])).hexdigest()


def _apply(window: int):
    """Remove what is settled; give the hashes of the windows that are not, along with the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for rk, doc_id, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpack(packed).split()
                cells = np.array([(g["low"], g["high"], g["edge"]) for g in found or ()], np.int64).reshape(-1, 3)
                spans = cells[cells[:, 2] == 0, :2]
                removed, digest = _kept(words, spans, window)
                starts = sorted({i for low, high in cells[cells[:, 2] == 1, :2].tolist() for i in range(low, high + 1)})
                hashes = [xxhash.xxh3_128_digest(b" ".join(words[i : i + window])) for i in starts]
                edges = [{"at": i, "a": int.from_bytes(h[:8], "little", signed=True), "b": int.from_bytes(h[8:], "little", signed=True)} for i, h in zip(starts, hashes, strict=True)]
                out.append((rk, doc_id, len(words), removed, digest, packed if edges else None, spans.astype(np.int32).tobytes() if edges else None, edges))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.struct([("at", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])))
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["rk", "doc_id", "n_words", "n_removed", "kept_sha256", "packed", "spans", "edges"])

    return run


_APPLIED = "rk long, doc_id long, n_words long, n_removed long, kept_sha256 string, packed binary, spans binary, edges array<struct<at:int,a:long,b:long>>"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _finish(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc_id, packed, spans, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpack(packed).split()
                at = np.array(more or [], np.int64)
                spans = np.concatenate([np.frombuffer(spans, np.int32).reshape(-1, 2).astype(np.int64), np.stack([at, at], 1)])
                out.append((doc_id, len(words), *_kept(words, spans, window)))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [pack(t.as_py().encode("utf-8", "replace")) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["rk", "doc_id", "packed"])


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row: words covered by a window that occurs again are removed.

    Windows of other documents and of the same one count alike, and all are judged on the input. Null texts have
    no words; texts of fewer words than a window keep them all. Null ids take part, and of rows that repeat both id
    and text each is a repeat of the other. An empty table gives no rows.
    """
    if window < 2 * MARGIN + 2 * LONGEST - 1:
        raise ValueError(f"a window needs at least {2 * MARGIN + 2 * LONGEST - 1} words to hold a settled symbol")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).withColumn("rk", F.monotonically_increasing_id())
    texts = materialize(rows.select("rk", "doc_id", "text").mapInArrow(releasing(_pack), "rk long, doc_id long, packed binary"), "texts")
    keyed = texts.select("rk", "packed").mapInArrow(releasing(_gather(window)), _ROWS)
    decided = keyed.repartition(partitions(spark), "key").sortWithinPartitions("key", "span").mapInArrow(releasing(_decide), "rk long, low int, high int, edge int")
    found = materialize(decided, "repeats")
    by_row = found.groupBy("rk").agg(F.collect_list(F.struct("low", "high", "edge")).alias("found"))
    joined = texts.join(by_row, "rk", "left").select("rk", "doc_id", "packed", "found")
    applied = materialize(joined.mapInArrow(releasing(_apply(window)), _APPLIED), "applied")
    edges = applied.select("rk", F.explode("edges").alias("edge")).select("rk", "edge.*")
    again = edges.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    more = edges.join(again, ["a", "b"]).groupBy("rk").agg(F.collect_set("at").alias("more"))
    open_rows = applied.where("packed is not null").select("rk", "doc_id", "packed", "spans").join(more, "rk", "left")
    closed = applied.where("packed is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return closed.unionByName(open_rows.select("doc_id", "packed", "spans", "more").mapInArrow(releasing(_finish(window)), _RESULT))
