"""Answers of a labeler that are kept as they come.

What is to be asked waits in a queue of files. A stream takes some of them at a time and deals their notices in lots to tasks, each of which calls the
labeler for its lot and commits the answers by itself, whatever becomes of the others: a run that is killed loses the calls that were under way, at most
``per_commit`` of them, and the next run goes on from there. Queue, answers and the stream's checkpoint lie in one folder, in any store that Spark writes to.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.keywords import is_blank
from windrow.operators import labels
from windrow.schemas import NOTICE
from windrow.sources import files

#: What is queued and, with the model's text, answered.
ANSWERED = T.StructType([*NOTICE.fields, T.StructField("response", T.StringType())])
#: A notice in the queue is known by the call that put it there and its number in that call.
PLACE = T.StructType([T.StructField("call", T.StringType()), T.StructField("at", T.LongType())])
QUEUED = T.StructType([*NOTICE.fields, *PLACE.fields])
#: Tasks of a micro-batch, about; a size of work.
LOTS = 400
#: A task's file is in its place when the task ends, not when all do.
BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All answers so far. A notice that the labeler failed on is there with a null response, until it is answered."""
    rows = spark.createDataFrame([], ANSWERED)
    for part in ("answers", "given"):  # the first held a file for each task of a micro-batch, and is no longer written
        try:
            rows = rows.unionByName(spark.read.schema(ANSWERED).parquet(files.require(spark, f"{folder}/{part}")).select(*ANSWERED.fieldNames()))
        except files.MissingSource:
            pass
    given = rows.where("response IS NOT NULL")
    return given.unionByName(labels.pending(rows.where("response IS NULL").distinct(), given))


def _at_once(spark: SparkSession, most: int) -> tuple[int, bool]:
    """Tasks that will call at once, ``most`` or fewer, and whether the session might run more of them."""
    conf = spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true" or conf.contains("spark.default.parallelism"):
        return most, True  # nothing tells how many
    slots = spark.sparkContext.defaultParallelism
    return min(slots, most), slots > most


def _drain(spark: SparkSession, folder: str, labeler: labels.Labeler, per_commit: int, concurrency: int) -> None:
    """Ask for what is queued and has no committed answer.

    A lot is so small that those of all tasks at work hold ``per_commit`` notices at most. Tasks call one at a time; where more could run than
    calls may be under way, a job gets no more tasks than that, and a micro-batch one file.
    """
    most = max(1, min(concurrency, per_commit))

    def step(batch: DataFrame, number: int) -> None:
        session, out = batch.sparkSession, f"{folder}/given/batch={number}"
        at_once, wide = _at_once(spark, most)
        left = batch.withColumn("lot", F.expr(f"at div {max(1, per_commit // at_once)}"))
        try:  # a batch that is run again
            left = left.join(session.read.schema(PLACE).parquet(files.require(session, out)), PLACE.fieldNames(), "left_anti")
        except files.MissingSource:
            pass
        lots = [(r["call"], r["lot"]) for r in left.select("call", "lot").distinct().collect()]
        width = at_once if wide else max(1, len(lots))
        for first in range(0, len(lots), width):
            part = [(*key, task) for task, key in enumerate(lots[first : first + width])]
            tasks = session.createDataFrame(part, "call string, lot long, task int")
            dealt = left.join(F.broadcast(tasks), ["call", "lot"]).repartitionById(len(part), F.col("task"))
            labels.ask(dealt.select(*QUEUED.fieldNames()), labeler).write.mode("append").options(**BY_TASK).parquet(out)

    at_once, wide = _at_once(spark, most)
    queued = spark.readStream.schema(QUEUED).option("maxFilesPerTrigger", 1 if wide else max(1, LOTS // at_once)).parquet(f"{folder}/queued")
    queued.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()


def answer(notices: DataFrame, labeler: labels.Labeler, folder: str, per_commit: int = 20, concurrency: int = 20) -> DataFrame:
    """Ask for each of ``notices`` that has text and no readable answer yet, and return all answers: :func:`read`.

    What an earlier run left in the queue is asked first. Notices that the labeler failed on, or whose answers could not be read, are asked
    again by each call. Repeats within ``notices`` are all asked. At most ``concurrency`` calls are under way, as long as no executors join while
    the queue is read; speculative execution should be off.
    """
    spark = notices.sparkSession
    try:
        _drain(spark, files.require(spark, f"{folder}/queued").removesuffix("/queued"), labeler, per_commit, concurrency)
    except files.MissingSource:
        pass  # the first run
    wanted = notices.select(*NOTICE.fieldNames()).where(~is_blank(F.col("notam_text")))
    waiting = labels.pending(wanted, labels.labeled(read(spark, folder)))
    placed = waiting.withColumn("call", F.lit(uuid.uuid4().hex)).withColumn("at", F.monotonically_increasing_id())
    placed.write.mode("append").option("maxRecordsPerFile", per_commit).parquet(f"{folder}/queued")
    _drain(spark, folder, labeler, per_commit, concurrency)
    return read(spark, folder)
