"""Best-fit packing by patterns of few pieces.

Texts become token ids ended by one separator, and only documents longer than a sequence are cut.
The histogram of piece lengths (at most ``size`` rows, whatever the corpus) goes to the driver, which

1. enumerates patterns of one to three lengths that fill a sequence exactly,
2. fits their repeat counts to the histogram by non-negative least squares,
3. rounds them, carrying the remainders along, never above what the histogram holds, and
4. packs the pieces that are left by best fit decreasing on the histogram.

The plan says for each run of ranks of a length which sequences and offsets it gets. Pieces learn
their rank among those of their length from a count for each task, so no length is sorted in one place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm._common import materialize, releasing
from windrow.llm.word_ids import worker_ids

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, separator: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of each document, with the task that made them and their number there among those of their length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_ids(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        end = separator.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.packed(t.as_py() for t in batch.column(1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    piece = ids[at : at + 4 * size]
                    n = len(piece) // 4
                    nth = seen.get(n, 0)
                    seen[n] = nth + 1
                    for column, value in zip(out, (doc, k, at // 4, n, zlib.crc32(piece), part, nth), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(releasing(cut), _PIECES)


def full_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Rows of up to three lengths, largest first and zero where unused, that add up to ``size``."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    rows = [[size, 0, 0]] if there[size] else []
    a = lengths[(lengths * 2 >= size) & (lengths < size)]
    two = a[there[size - a]]
    parts = [np.array(rows, int).reshape(-1, 3), np.stack([two, size - two, np.zeros_like(two)], 1)]
    for x in lengths[(lengths * 3 >= size) & (lengths < size)]:
        y = lengths[(lengths <= x) & (lengths * 2 >= size - x) & (lengths < size - x)]
        y = y[there[size - x - y]]
        parts.append(np.stack([np.full_like(y, x), y, size - x - y], 1))
    return np.concatenate(parts)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative least squares for the repeats of each pattern, by accelerated projected gradients.

    Errors count by the square root of the histogram, so that rare lengths are met as well as common ones.
    """
    if not len(patterns):
        return np.zeros(0)
    scale = 1 / np.sqrt(np.maximum(histogram, 1.0))
    scale[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        return scale * sum(np.bincount(patterns[:, k], x, len(histogram)) for k in range(3))

    def back(r: np.ndarray) -> np.ndarray:
        return (scale * r)[patterns].sum(1)

    wanted = scale * histogram
    v = np.ones(len(patterns))
    for _ in range(20):
        v = back(forward(v))
        v /= max(np.linalg.norm(v), 1e-300)
    step = 1 / (1.05 * max(np.linalg.norm(back(forward(v))), 1e-12))
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(forward(y) - wanted))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def round_repeats(patterns: np.ndarray, repeats: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeats within the histogram, and what is left of it; remainders carry over to the next pattern."""
    left, whole, carry = histogram.astype(np.int64).copy(), np.zeros(len(patterns), np.int64), 0.0
    for i in np.flatnonzero(repeats > 1e-9):
        carry += repeats[i]
        n = int(carry)
        if n:
            need: dict[int, int] = {}
            for v in patterns[i].tolist():
                if v:
                    need[v] = need.get(v, 0) + 1
            n = min(n, *(int(left[v]) // k for v, k in need.items()))
            carry = min(carry - n, 1.0)
            for v, k in need.items():
                left[v] -= n * k
            whole[i] = n
    return whole, left


def best_fit(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of best fit decreasing over a histogram; equal sequences are handled together."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], n: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((lengths, n))

    for length in range(size, 0, -1):
        n = int(histogram[length])
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                lengths, m = groups[room].pop()
                fits = max(1, min(room // length, n // m)) if n >= m else 1
                used = min(m, n // fits)
                if used < m:
                    groups[room].append((lengths, m - used))
            else:
                room, lengths = size, ()
                fits = min(size // length, n)
                used = n // fits
            if room in groups and not groups[room]:
                del groups[room]
                rooms.remove(room)
            put(room - fits * length, lengths + (length,) * fits, used)
            n -= used * fits
    return [g for room in groups.values() for g in room]


#: The share of each fitted repeat left to best fit, so that the residue holds pieces of all lengths.
RESERVE = 0.05


def plan(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) for all sequences."""
    patterns = full_patterns(np.flatnonzero(histogram), size)
    whole, left = round_repeats(patterns, (1 - RESERVE) * fit_repeats(patterns, histogram.astype(float)), histogram)
    fitted = [(tuple(v for v in patterns[i].tolist() if v), int(whole[i])) for i in np.flatnonzero(whole)]
    return fitted + best_fit(left, size)


def slots(sequences: list[tuple[tuple[int, ...], int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank) of runs of ranks, the sequence of each run's first piece, and its offset."""
    ranks = np.zeros(size + 1, np.int64)
    keys, first, offsets, sequence = [], [], [], 0
    for lengths, n in sequences:
        at = 0
        for v in lengths:
            keys.append((v << 44) + int(ranks[v]))
            first.append(sequence)
            offsets.append(at)
            ranks[v] += n
            at += v
        sequence += n
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return tuple(np.array(c, np.int64)[order] for c in (keys, first, offsets))


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the separator alone. Repeated rows and null ids are packed like any others.
    An empty table gives no rows. Special tokens that a text spells out become their ids, as the library does by default.
    The plan's size is bound by the number of patterns (some hundred thousand runs at most), not by the corpus.
    """
    pieces = materialize(cut_pieces(docs, tokenizer, size, separator, id_col, text_col), "pieces")
    by_task = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(size + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length, at most size
        histogram[r["length"]] = r["n"]
    keys, first, offsets = slots(plan(histogram, size), size)
    sent = pieces.sparkSession.sparkContext.broadcast((keys, first, offsets))
    before = by_task.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, offsets = sent.value
        for batch in batches:
            key = (batch.column(3).to_numpy() << 44) + batch.column(5).to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(first[at] + key - keys[at]), pa.array(offsets[at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(releasing(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
