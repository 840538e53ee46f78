"""SimHash near-dedup over pigeonhole blocks.

Fingerprints of 64 bits that differ in at most four places agree in at least two of six blocks, so
close pairs meet in one of the 15 buckets named by two blocks and their bits. Equal fingerprints are
one class throughout. A bucket gives the edges of a spanning forest of its links, never all its pairs;
a large bucket is cut into chunks and every two chunks meet in a task of their own, so that no link is lost.
Components follow by propagating the smallest label, with pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import materialize, partitions

#: Bits of the six blocks.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of a bucket that one task compares at a time; larger buckets become several tasks.
CHUNK = 2048
_LITTLE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def _bits(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    if n < 64:
        counts = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        lanes = hashes.view(np.uint8).reshape(n, 8)
        counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _LITTLE for k in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint of a text; zero where it has no words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return _bits(np.array([digest(joined[s:e], seed) for s, e in spans], "<u8"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rk (a hash of id and text) and fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["doc_id", "rk", "fp"])

    rk = F.xxhash64(id_col, text_col)
    return docs.select(F.col(id_col).cast("long"), rk, F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, rk long, fp long")


def _forest(x: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between distinct fingerprints."""
    edges: list[tuple[int, int]] = []
    rest = x
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            some, front = front[:256], front[256:]
            near = np.bitwise_count(some[:, None] ^ rest[None, :]) <= distance
            hit = near.any(0)
            if hit.any():
                found = rest[hit]
                edges += zip(some[near[:, hit].argmax(0)].tolist(), found.tolist(), strict=True)
                front, rest = np.concatenate([front, found]), rest[~hit]
    return edges


def _links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values, at = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sizes, a, b = np.diff(at), [], []
            for n in range(2, 9):  # small buckets, all of one size at a time
                starts = at[:-1][sizes == n]
                for i, j in combinations(range(n), 2):
                    x, y = values[starts + i], values[starts + j]
                    close = np.bitwise_count(x ^ y) <= distance
                    a.append(x[close])
                    b.append(y[close])
            for k in np.flatnonzero(sizes > 8):
                if edges := _forest(np.unique(values[at[k] : at[k + 1]]), distance):
                    x, y = np.array(edges, np.uint64).T
                    a.append(x)
                    b.append(y)
            x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def links(classes: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (a, b) that connect the distinct values of ``fp`` as their links of at most ``distance`` bits do."""
    if distance > len(BLOCKS) - 2:
        raise ValueError("too few blocks for this distance")
    lows = np.concatenate([[0], np.cumsum(BLOCKS)[:-1]]).tolist()
    block = [F.shiftrightunsigned("fp", low).bitwiseAND((1 << n) - 1) for low, n in zip(lows, BLOCKS, strict=True)]
    names = [(F.lit(k).alias("k"), (F.shiftleft(block[i], 11) + block[j]).cast("int").alias("v")) for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    keys = classes.select("fp", F.explode(F.array(*[F.struct(*n) for n in names])).alias("key")).select("fp", "key.*")
    counts = keys.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(counts, ["k", "v"]).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j != F.col("own"))
    tasks = met.withColumn("own", own).select(
        "fp", "k", "v", "own", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(others)).alias("other")
    )
    pair = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    dealt = tasks.select("fp", "k", "v", *pair).repartition(partitions(classes.sparkSession), "k", "v", "i", "j")
    buckets = dealt.groupBy("k", "v", "i", "j").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return buckets.select("fps").mapInArrow(_links(distance), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): the smallest node that it reaches."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))), "edges")
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(label, both.b == label.node).groupBy("a").agg(F.min("root").alias("near"))
        lower = label.join(near, label.node == near.a).select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        lower = materialize(lower, "lower")
        # pointer jumping: the label of one's label
        jump = lower.select(F.col("node").alias("at"), F.col("low").alias("next"))
        new = materialize(lower.join(jump, lower.low == jump.at).select("node", "old", F.least("low", "next").alias("root")), "labels")
        if new.where("root <> old").isEmpty():
            return new.select("node", "root")
        label = new.select("node", "root")


def components_of(docs: DataFrame, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rk, fp, root (the component's smallest fingerprint) and component_id of each row."""
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, distance))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = materialize(rooted.select("fp", "root").join(named, "root").select(F.col("fp").alias("__fp"), "root", "component_id"), "components")
    return rows.join(of, F.col("fp") == F.col("__fp")).select("doc_id", "rk", "fp", "root", "component_id")


def near_dedup(docs: DataFrame, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (hex), component_id (the smallest id that its links reach).

    Null texts and texts without words have fingerprint zero and link like any other. Null ids take part but name
    a component only if it has no other (then null). Repeated rows share a component; an empty table gives no rows.
    """
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return components_of(docs, distance, id_col, text_col).select("doc_id", digits.alias("fingerprint"), "component_id")
