"""Positions in a global order, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.shared import materialize


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the gapless position (from 0) of each row in the order of ``order``.

    A range partitioned sort, written so that positions hold when tasks run again; a count for each of its partitions; and their
    running sum, joined back: one row for each partition, which is what is broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()), "positions")
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    starts = sizes.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("s")).selectExpr(
        "inline(transform(s, (x, i) -> struct(x.part as __part, aggregate(slice(s, 1, i), 0L, (a, y) -> a + y.n) as __before)))"
    )
    joined = rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return joined.withColumn(name, F.col("__before") + local).drop("__id", "__part", "__before")
