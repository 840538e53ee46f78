"""What several operators share: tables in the shared folder, and distributed ranks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.order import with_position
from windrow.shared import materialize as _materialize

#: White space of the contracts, as a Java character class.
SPACE = r"\x20\x09-\x0D"


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed but lies beside the driver's code."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Like :func:`windrow.shared.materialize`, with this package in reach of Python workers."""
    reachable(df.sparkSession)
    return _materialize(df, name, **options)


def releasing(run):
    """``run``, an Arrow function of batches, giving memory that it no longer needs back to the system when a task ends.

    Python workers live on between tasks and stages; what their allocators keep would count against those that come after.
    """

    @functools.wraps(run)
    def released(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return released


def release() -> None:
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without such a call
        ctypes.CDLL(None).malloc_trim(0)


def text_of(column: str = "text") -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def by_position(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by position, so that none can meet a name of the plan's own; and the new names of those wanted."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]), [f"c{docs.columns.index(c)}" for c in wanted]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Add ``rank``: the gapless position (from 0) of each row in the order of ``order``; see :func:`windrow.operators.order.with_position`."""
    return with_position(df, order, rank)


def likely_in(rows: DataFrame, key: str, keys: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """The rows of ``rows`` whose ``key`` may be among those of ``keys``, by a broadcast filter of at most ``bits / 8`` bytes.

    It lets no member out, whatever the number of keys; a join that follows decides, and has less to shuffle.
    """
    word = 32768
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    marked = keys.select(F.floor(at / word).alias("__bucket"), (at % word).alias("__bit"))
    bitmap = marked.groupBy("__bucket").agg(F.expr("bitmap_construct_agg(__bit)").alias("__bitmap"))
    # as numbers of four bytes, first byte highest, so that a probe is an index and a shift
    four = "transform(sequence(0, %d), k -> cast(conv(hex(substring(__bitmap, 4 * k + 1, 4)), 16, 10) as bigint))" % (word // 32 - 1)
    bitmap = bitmap.select("__bucket", F.expr(four).alias("__four"))
    probed = rows.withColumn("__at", at).withColumn("__bucket", F.floor(F.col("__at") / word)).join(F.broadcast(bitmap), "__bucket")
    held = f"__four[cast(__at % {word} div 32 as int)]"
    hit = probed.where(f"shiftright({held}, cast(24 - 8 * (__at % 32 div 8) + __at % 8 as int)) & 1 = 1")
    return hit.select(*rows.columns)
