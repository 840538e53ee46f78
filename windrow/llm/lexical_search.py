"""Ranked lexical search: a sharded inverted index, and a document-at-a-time merge of its postings for each query.

*Index.* Each input task binds the rows it reads into shards of a bounded number of terms, and writes for each shard its documents
(ids in order, lengths) and for each term of it the postings: gaps of document ordinals and occurrences, as variable-length integers.

*Search.* The distinct terms of the queries meet the index by term, which gives document frequencies over all shards, hence
weights. What then travels to a shard's merge are the postings of query terms only. There, for each query, a heap holds the next document of
each list; the smallest leaves it with all its lists, so documents are scored one at a time, in the order of their ids. A second, bounded heap keeps the best by score, then
by id. Lists whose greatest contributions together cannot lift a document above the worst that is kept leave the first heap, and are probed for
documents that the rest brings up: results are exact. The best of all shards are merged by query.

Null texts and texts without a term are no documents of the collection; queries without a term have no result. Repeated documents each have
a place of their own; rows with the same query id are one query, of all their terms. Documents with null ids come after others of the same score.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm import _varints
from windrow.llm._common import likely_in, materialize, releasing

#: Occurrences of terms after which a shard is full (a longer document still goes into one), and queries merged at a time.
SHARD_TERMS, BLOCK = 4_000_000, 512

_INDEX = "part int, shard int, term string, df int, postings binary, ids binary, lengths binary"
#: Bytes that no term holds become spaces, A-Z lower case; those of other characters stay.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
#: In place of a null id: behind all others.
_NO_ID = np.iinfo(np.int64).max


def terms_of(text: Column) -> Column:
    """The terms of a text, in order: maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda t: t != "")


class _Shard:
    """Documents that are being bound into a shard."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.rows: list[np.ndarray] = []
        self.ids: list[int] = []
        self.held = 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = text.encode("utf-8", "replace").translate(_TERM_BYTES).split()
        if words:
            numbers = self.numbers
            self.rows.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
            self.ids.append(_NO_ID if doc_id is None else doc_id)
            self.held += len(words)

    def batch(self, part: int, shard: int) -> pa.RecordBatch:
        """Its rows: one for each term with its postings, and one, without a term, with the documents."""
        ids = np.array(self.ids, np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lengths = np.fromiter(map(len, self.rows), np.int64, len(self.rows))
        pairs = np.concatenate(self.rows).astype(np.int64) * len(ids) + np.repeat(place, lengths)
        pairs, tf = np.unique(pairs, return_counts=True)
        term, doc = np.divmod(pairs, len(ids))
        first = np.flatnonzero(np.diff(term, prepend=-1))
        gaps = np.diff(doc, prepend=0)
        gaps[first] = doc[first]
        data, at = _varints.encode(np.stack([gaps, tf], 1).ravel())
        offsets = np.append(at[:-1:2][first], at[-1]).astype(np.int32)
        n = len(first)
        words = [*self.numbers, None]
        postings = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
        none = pa.nulls(n, pa.binary())
        one = lambda a: pa.array([a.tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, part, np.int32)),
                pa.array(np.full(n + 1, shard, np.int32)),
                pa.array(words, pa.binary()).cast(pa.string()),
                pa.array(np.append(np.diff(np.append(first, len(term))), self.held).astype(np.int32)),
                pa.concat_arrays([postings, pa.nulls(1, pa.binary())]),
                pa.concat_arrays([none, one(ids[order])]),
                pa.concat_arrays([none, one(_varints.encode(lengths[order])[0])]),
            ],
            names=["part", "shard", "term", "df", "postings", "ids", "lengths"],
        )


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The written index of all rows of ``docs``: (part, shard, term, df, postings), and a row for each shard, without a term,
    with its documents' ids and lengths; its ``df`` counts all their terms."""

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, open_ = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if t.is_valid:
                    open_.add(doc_id, t.as_py())
                if open_.held >= shard_terms:
                    yield open_.batch(part, shard)
                    shard, open_ = shard + 1, _Shard()
        if open_.held:
            yield open_.batch(part, shard)

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, _INDEX), "lexical-index")


class _List:
    """Postings of a term in a shard: ordinals, what the term adds to each document's score, and the most that it adds."""

    def __init__(self, postings: bytes, weight: int, m: np.ndarray):
        numbers = _varints.decode(postings)
        docs, tf = np.cumsum(numbers[::2]), numbers[1::2]
        adds = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
        self.docs, self.adds, self.most = docs, adds, int(adds.max(initial=0))
        self._lists: tuple[list[int], list[int]] | None = None

    def lists(self) -> tuple[list[int], list[int]]:
        if self._lists is None:
            self._lists = self.docs.tolist(), self.adds.tolist()
        return self._lists

    def of(self, docs: np.ndarray) -> np.ndarray:
        """What it adds to each of ``docs``."""
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.adds[at], 0)


def merged(lists: list[_List], k: int) -> list[tuple[int, int]]:
    """The ``k`` best (score, ordinal), scores above zero, equal scores by ordinal, by a document-at-a-time merge."""
    lists = sorted((x for x in lists if x.most > 0), key=lambda x: x.most)
    if not lists:
        return []
    bounds = np.cumsum([x.most for x in lists]).tolist()  # what the first i + 1 lists add at most together
    # the documents of the lists that add most give a first bar: k of them score so much at least
    some: list[np.ndarray] = []
    for x in reversed(lists):
        some.append(x.docs)
        if sum(map(len, some)) >= 8 * k:
            break
    sample = np.unique(np.concatenate(some))
    sums = np.sum([x.of(sample) for x in lists], axis=0)
    bar = int(np.partition(sums, -k)[-k]) - 1 if len(sums) >= k else 0
    best: list[tuple[int, int]] = []  # (score, -ordinal), the worst first
    n, probed = len(lists), 0
    while probed < n and bounds[probed] <= bar:
        probed += 1
    docs, adds = zip(*(x.lists() for x in lists), strict=True)
    at = [0] * n
    heads = [docs[j][0] * n + j for j in range(probed, n)]
    heapq.heapify(heads)
    while heads:
        doc, j = divmod(heads[0], n)
        score, after = 0, (doc + 1) * n
        while heads and heads[0] < after:
            j = heads[0] - doc * n
            i = at[j]
            score += adds[j][i]
            at[j] = i = i + 1
            if i < len(docs[j]):
                heapq.heapreplace(heads, docs[j][i] * n + j)
            else:
                heapq.heappop(heads)
        for j in range(probed - 1, -1, -1):
            if score + bounds[j] <= bar:
                break
            i = at[j] = bisect_left(docs[j], doc, at[j])
            if i < len(docs[j]) and docs[j][i] == doc:
                score += adds[j][i]
        if score <= bar or score <= 0:
            continue
        if len(best) < k:
            heapq.heappush(best, (score, -doc))
        else:
            heapq.heapreplace(best, (score, -doc))
        if len(best) == k and best[0][0] > bar:
            bar, was = best[0][0], probed
            while probed < n and bounds[probed] <= bar:
                probed += 1
            if probed > was:
                heads = [h for h in heads if h % n >= probed]
                heapq.heapify(heads)
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def _merge(k: int, total: int, occurrences: int):
    """The merge of one shard for one block of queries."""

    def run(table: pa.Table) -> pa.Table:
        ids = lengths = None
        rows = []
        for batch in table.to_batches():
            got = batch.to_pydict()
            for term, weight, queries, postings, own, length in zip(*(got[c] for c in ("term", "weight", "queries", "postings", "ids", "lengths")), strict=True):
                if term is None:
                    ids, lengths = np.frombuffer(own, np.int64), _varints.decode(length)
                else:
                    rows.append((weight, queries, postings))
        m = 10 + (90 * lengths * total) // occurrences
        by_query: dict[int, list[_List]] = {}
        for weight, queries, postings in rows:
            held = _List(postings, weight, m)
            for q in queries:
                by_query.setdefault(q, []).append(held)
        out: tuple[list, list, list] = ([], [], [])
        for q, lists in by_query.items():
            for score, doc in merged(lists, k):
                for column, v in zip(out, (q, int(ids[doc]), score), strict=True):
                    column.append(v)
        columns = [pa.array(c, pa.int64()) for c in out]
        return pa.table({"query": columns[0], "id": pa.array([None if i == _NO_ID else i for i in out[1]], pa.int64()), "score": columns[2]})

    return run


def search(indexed: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of an :func:`index` for each query: (``key``, rank, doc_id, score)."""
    spark = queries.sparkSession
    asked = queries.select(F.col(key).alias("__key"), F.explode(F.array_distinct(terms_of(F.col(text)))).alias("term"))
    keys = materialize(asked.select("__key").distinct().withColumn("query", F.monotonically_increasing_id()), "lexical-queries")
    asked = asked.distinct().join(keys, asked["__key"].eqNullSafe(keys["__key"])).select("query", "term")
    shards = indexed.where("term IS NULL").select("part", "shard", "ids", "lengths")
    sums = indexed.where("term IS NULL").agg(F.sum(F.expr("octet_length(ids) div 8")), F.sum("df")).first()
    total, occurrences = (n or 0 for n in sums)
    blocks = -(-keys.count() // BLOCK)
    if not total or not blocks:
        return spark.createDataFrame([], f"{key} {queries.schema[key].dataType.simpleString()}, rank int, doc_id long, score long")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    by_term = asked.groupBy("term", "block").agg(F.collect_list("query").alias("queries"))
    # only postings of terms that some query has travel; a filter of fixed size picks them, and the joins decide
    hits = materialize(likely_in(indexed.where("term IS NOT NULL").select("part", "shard", "term", "df", "postings"), "term", asked.select("term").distinct()), "lexical-hits")
    df = hits.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total + 2) / (2 * F.col("df") + 1)))
    weights = df.select("term", weight.cast("long").alias("weight")).where("weight > 0").join(by_term, "term")
    lists = hits.join(weights, "term").select("part", "shard", "block", "term", "weight", "queries", "postings", F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("lengths"))
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    every = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    owners = every.select("part", "shard", "block", null("string", "term"), null("long", "weight"), null("array<long>", "queries"), null("binary", "postings"), "ids", "lengths")
    found = lists.unionByName(owners).groupBy("part", "shard", "block").applyInArrow(_merge(k, total, occurrences), "query long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    top = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.join(keys, "query").select(F.col("__key").alias(key), "rank", F.col("id").alias("doc_id"), "score")


def top_documents(docs: DataFrame, queries: DataFrame, k: int = 10, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Index ``docs`` and search it for ``queries``."""
    return search(index(docs, shard_terms=shard_terms), queries, k)
