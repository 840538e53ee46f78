"""Files of notices, labels and examples: readers, writers, and what is asked about files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from windrow.functions.json_text import json_object, json_value, labeled_line, message_list
from windrow.schemas import LABELED, NOTICE


class MissingSource(FileNotFoundError):
    """A source is not there."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def require(spark: SparkSession, path: str) -> str:
    """The path, if there is something there, in whatever store it is."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        raise MissingSource(path)
    return path


def read_array(spark: SparkSession, path: str, schema: StructType = NOTICE) -> DataFrame:
    """A file that is one JSON array; the schema is given, never inferred."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(require(spark, path))


def read_lines(spark: SparkSession, path: str, schema: StructType = LABELED) -> DataFrame:
    """JSON lines. Blank lines, lines that are no JSON, and lines that are no object are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(require(spark, path))


def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    """Labeled items with each entry as raw JSON: the text that Python would write for it, so that a round trip gives the same bytes."""
    lines = spark.read.text(require(spark, path)).where(F.ltrim("value").startswith("{"))
    return lines.select(labeled_line("value").alias("__item")).where("__item.ok").select(*[f"__item.{f}" for f in LABELED.fieldNames()])


def line_count(spark: SparkSession, path: str) -> int:
    return spark.read.text(require(spark, path)).count()


def _line(df: DataFrame, raw: str | None = None) -> Column:
    """A row as JSON, null fields kept, with a space after each comma and colon; ``raw`` is a column of arrays of JSON values."""

    def of(c: str) -> Column:
        if c == raw:
            return F.coalesce(F.concat(F.lit("["), F.array_join(c, ", ", "null"), F.lit("]")), F.lit("null"))
        return json_value(F.col(c), df.schema[c].dataType)

    return json_object({c: of(c) for c in df.columns}).alias("value")


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines with null fields kept; with ``mode='append'`` an incremental sink."""
    df.select(_line(df)).write.mode(mode).text(path)


def write_labeled(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Labeled items as JSON lines; entries keep their raw JSON."""
    df.select(_line(df, "runway_entries")).write.mode(mode).text(path)


def export_array(df: DataFrame, path: str) -> None:
    """One file with one JSON array, for small exports: the rows pass through one task by nature of the format, which sorts them by their numbers (with spill)
    and holds none, so that brackets and rows stand in order however partitions were grouped."""
    rows = df.select(F.lit(1).alias("part"), F.monotonically_increasing_id().alias("at"), _line(df))
    ends = df.sparkSession.range(0, 2, 1, 1).select((F.col("id") * 2).cast("int").alias("part"), F.lit(0).cast("long").alias("at"), F.when(F.col("id") == 0, "[").otherwise("]").alias("value"))
    sorted_rows = rows.unionByName(ends).coalesce(1).sortWithinPartitions("part", "at")
    follows = (F.monotonically_increasing_id() > 1) & (F.col("part") == 1)  # the bracket is row 0
    sorted_rows.select(F.concat(F.when(follows, ",").otherwise(""), F.col("value")).alias("value")).write.mode("overwrite").text(path)


def write_routes(classified: DataFrame, path: str) -> None:
    """Relevant and excluded rows side by side, in a partition each."""
    classified.write.mode("overwrite").partitionBy("is_relevant").parquet(path)


def message_line(messages: Column) -> Column:
    """An array of messages (role, content) as a line of JSON."""
    return message_list(F.transform(messages, lambda m: m.role), F.transform(messages, lambda m: m.content))


def write_split(split: DataFrame, path: str) -> None:
    """train, valid and test in a partition each; a line is an array of two messages."""
    split.select("split", message_line(F.col("messages")).alias("value")).write.mode("overwrite").partitionBy("split").text(path)


def replace(df: DataFrame, path: str) -> str:
    """Write labels beside ``path``, move the old ones to a backup, and the new ones in; returns the backup's path.

    The path may be one that ``df`` reads from: nothing is overwritten before all is written.
    """
    spark = df.sparkSession
    new, backup = f"{path}.{uuid.uuid4().hex}", f"{path}.bak-{uuid.uuid4().hex[:8]}"
    write_labeled(df, new)
    (old, fs), (source, _), (kept, _) = _path(spark, path), _path(spark, new), _path(spark, backup)
    there = fs.exists(old)
    if there and not fs.rename(old, kept):
        raise OSError(f"{path} could not be moved to {backup}; the new labels are in {new}")
    if not fs.rename(source, old):
        if there:
            fs.rename(kept, old)
        raise OSError(f"{new} could not be moved to {path}, where the old labels are again")
    return backup


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, size and time of change of each file under ``path``, folders below included. Contents are not read. Like all of Spark's file scans it leaves out files without any content."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _streamed_md5(block: int):
    """MD5 of files by blocks, so that a task holds one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyarrow import fs

        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                digest = hashlib.md5(usedforsecurity=False)
                with store.open_input_stream(name) as stream:
                    while data := stream.read(block):
                        digest.update(data)
                yield pa.RecordBatch.from_pydict({"path": [path], "size": [size], "md5": [digest.hexdigest()]})

    return run


def checksums(spark: SparkSession, path: str, longest: int = 1 << 30, block: int = 8 << 20) -> DataFrame:
    """path, size and MD5 of each file that has any content.

    Files over ``longest`` bytes, which a row might not hold, are streamed by blocks, each file by one task; Arrow must know their store.
    """
    found = spark.read.format("binaryFile").load(path)
    size = F.col("length").alias("size")
    short = found.where(F.col("length") <= longest).select("path", size, F.md5("content").alias("md5"))
    long = found.where(F.col("length") > longest).select("path", size)
    return short.unionByName(long.mapInArrow(_streamed_md5(block), "path string, size long, md5 string"))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The file changed last; of those changed at once the last by name."""
    return spark.read.format("binaryFile").load(path).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def first_named(spark: SparkSession, pattern: str) -> str | None:
    """The file or folder that comes first by name among those that match the pattern, such as ``/tools/kit_v*``; None without any."""
    p, fs = _path(spark, pattern)
    return min((s.getPath().toString() for s in fs.globStatus(p) or []), default=None)


def version_of(path_col: str) -> Column:
    """What follows the last ``_v`` of a name."""
    return F.regexp_replace(path_col, ".*_v", "")
