"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the fractional rank
``(rank + 1/2) / rows of the source`` spreads each source evenly over [0, 1). Sorting by it
interleaves all sources in proportion, and cutting that sequence into equal runs gives
shards whose mixture matches the whole to within two rows for each source (one where a run begins, one where it ends).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm._common import materialize, with_rank


def stratified_shards(docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A shard and a slot (gapless from 0) for each row: id, source, size, text_crc32, shard, slot.

    The law that holds is ``rows``: row counts of two shards differ by at most one, whatever the sizes.
    Null ids and sources take part (a null source is a source of its own), a null text has size 1 and
    the checksum of an empty text. Repeated rows are ranked one after another; an empty table gives no rows.
    Other columns of ``docs`` are neither read nor returned.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.col(text_col).cast("string")
    narrow = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.lit(seed), F.col(id_col)).alias("__key"),
        ),
        "shard-rows",
    )
    ranked = with_rank(narrow, [F.col("source"), F.col("__key"), F.col("doc_id"), F.col("text_crc32")], "__rank")
    strata = ranked.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("__n"), F.min("__rank").alias("__first"))
    # a plain join: Spark broadcasts the strata only if they prove small, and splits a hot source otherwise
    spread = ranked.join(strata, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__at", (F.col("__rank") - F.col("__first") + 0.5) / F.col("__n"))
    order = [F.col("__at"), F.xxhash64("source", F.lit(seed)), F.col("__key"), F.col("doc_id"), F.col("text_crc32")]
    placed = with_rank(spread.drop("__source", "__n", "__first", "__rank").withColumnRenamed("__at", "__spread"), [F.col("__spread"), *order[1:]], "__g")
    total = narrow.count()
    shard = F.expr(f"__g * {shards} div {max(total, 1)}")
    return placed.withColumn("__shard", shard).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.col("__shard").cast("int").alias("shard"),
        (F.col("__g") - F.expr(f"(__shard * {total} + {shards - 1}) div {shards}")).alias("slot"),
    )
