"""Exact dedup as a log-structured merge index, in DataFrame operations only.

* flush: every input split is a memtable; its (digest, id) entries are sorted in place and
  written as one sorted run with a bloom filter on the digest. No shuffle, no text.
* compaction: runs merge by digest; the smallest id of each digest and the group's size stay,
  written sorted and with a filter again. Map-side partial aggregation folds hot digests.
* lookup: a bit filter of fixed size over the digests of groups tells which rows can be
  copies; only those carry their text to the comparison with the text of the row that stays.
* bytes decide: should equal digests have unequal texts, those digests are grouped again by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import SPACE, by_position, materialize, text_of

#: Runs of white space other than one space, so that text without them is left untouched quickly.
_ODD_SPACE = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"
_WORD_BITS = 32768


def normalised(column: str = "text") -> Column:
    """The text with each run of white space as one space; null is the empty text."""
    return F.regexp_replace(text_of(column), _ODD_SPACE, " ")


def sha_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def flush(docs: DataFrame, digest=sha_digest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sorted runs of (digest, doc_id), one for each split of ``docs``, each with a filter on the digest."""
    entries = docs.select(digest(normalised(text_col)).alias("digest"), F.col(id_col).alias("doc_id"))
    return materialize(entries.sortWithinPartitions("digest", "doc_id"), "run", **_filters())


def compact(*levels: DataFrame) -> DataFrame:
    """Merge runs, or levels compacted before: (digest, keep_id, group_size), the smallest id staying."""
    rows = None
    for level in levels:
        part = level if "keep_id" in level.columns else level.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
        rows = part if rows is None else rows.unionByName(part)
    merged = rows.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return materialize(merged.sortWithinPartitions("digest"), "level", **_filters())


def _filters() -> dict[str, str]:
    return {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _bit_filter(index: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) over the digests of groups: at most ``bits / 8`` bytes however many digests there are."""
    at = F.pmod(F.xxhash64("digest"), F.lit(bits))
    marked = index.where("group_size > 1").select(F.floor(at / _WORD_BITS).alias("__bucket"), (at % _WORD_BITS).alias("__bit"))
    return marked.groupBy("__bucket").agg(F.expr("bitmap_construct_agg(__bit)").alias("__bitmap"))


def exact_dedup(docs: DataFrame, digest=sha_digest, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 1 << 24) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` is the index key, a function of the normalised text; any key gives the same result,
    as bytes decide. ``filter_bits`` is the size of the broadcast filter (2 MB by default).

    Null texts equal empty ones. Ids may be null: null sorts after all ids, and a group of null ids keeps
    one row. Of rows that repeat both id and text, exactly one is kept. Empty tables give no rows.
    """
    index = compact(flush(docs, digest, id_col, text_col))
    at = F.pmod(F.xxhash64("digest"), F.lit(filter_bits))
    probe = (
        docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("__text"))
        .withColumn("digest", digest(F.col("__text")))
        .withColumn("__bucket", F.floor(at / _WORD_BITS))
        .withColumn("__bit", at % _WORD_BITS)
        .join(F.broadcast(_bit_filter(index, filter_bits)), "__bucket", "left")
    )
    byte = F.conv(F.hex(F.expr("substring(__bitmap, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(__byte, cast(__bit % 8 as int)) & 1 = 1"), F.lit(False))
    probe = probe.withColumn("__byte", byte).select(
        "doc_id", "digest", F.sha2("__text", 256).alias("text_sha256"), F.when(hit, F.col("__text")).alias("__text")
    )
    groups = index.where("group_size > 1").select(F.col("digest").alias("__digest"), "keep_id")
    stay = (
        probe.where("__text is not null")
        .join(groups, (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest")
        .agg(F.min("__text").alias("__kept_text"))
    )
    level = materialize(index.join(stay, "digest", "left").select(F.col("digest").alias("__digest"), "keep_id", "group_size", "__kept_text"), "verify")
    same = F.when(F.col("group_size") == 1, True).otherwise(F.coalesce(F.col("__text") == F.col("__kept_text"), F.lit(False)))
    found = materialize(
        probe.join(level, F.col("digest") == F.col("__digest"), "left").select("doc_id", "digest", "keep_id", "group_size", "text_sha256", same.alias("__same")),
        "found",
    )
    if not found.where("not __same").isEmpty():
        found = _by_bytes(docs, found, digest, id_col, text_col)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    kept = found.where(stays)
    repeated = kept.groupBy("digest", "text_sha256").count().where("count > 1")
    if repeated.isEmpty():
        return found.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")
    return _once(found, repeated, stays)


def _by_bytes(docs: DataFrame, found: DataFrame, digest, id_col: str, text_col: str) -> DataFrame:
    """Group the rows of digests with unequal texts by their whole texts."""
    bad = found.where("not __same").select("digest").distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("__text")).withColumn("digest", digest(F.col("__text"))).join(bad, "digest", "left_semi")
    texts = rows.groupBy("digest", "__text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).withColumnRenamed("__text", "__key").withColumnRenamed("digest", "__digest")
    again = rows.join(texts, (F.col("digest") == F.col("__digest")) & (F.col("__text") == F.col("__key")))
    again = again.select("doc_id", "digest", "keep_id", "group_size", F.sha2("__text", 256).alias("text_sha256"), F.lit(True).alias("__same"))
    return materialize(found.join(bad, "digest", "left_anti").unionByName(again), "found")


def _once(found: DataFrame, repeated: DataFrame, stays: Column) -> DataFrame:
    """Keep one of the rows that repeat both the id and the text of the row that stays."""
    rows = materialize(found.withColumn("__row", F.monotonically_increasing_id()), "rows")
    first = rows.where(stays).join(repeated.select("digest", "text_sha256"), ["digest", "text_sha256"], "left_semi").groupBy("digest", "text_sha256").agg(F.min("__row").alias("__first"))
    joined = rows.join(first, ["digest", "text_sha256"], "left")
    kept = stays & (F.col("__first").isNull() | (F.col("__row") == F.col("__first")))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` does not keep. Columns may have any names."""
    names = docs.columns
    docs, (id_col, text_col) = by_position(docs, id_col, text_col)
    found = materialize(exact_dedup(docs, id_col=id_col, text_col=text_col), "copies")
    keyed = docs.withColumn("__sha", F.sha2(normalised(text_col), 256))
    gone = found.where("not doc_id <=> keep_id").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__gone")).distinct()
    stay = keyed.join(gone, (F.col("__sha") == F.col("__gone")) & F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
    if not found.where("doc_id <=> keep_id and not kept").isEmpty():  # rows that repeat both id and text
        stay = stay.dropDuplicates([id_col, "__sha"])
    return stay.select(*docs.columns).toDF(*names)
