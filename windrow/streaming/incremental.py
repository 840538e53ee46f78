"""Incremental runs as streams: classify notices as files land, and label what is new. An extra beside the batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from windrow.operators import classify, labels
from windrow.schemas import NOTICE
from windrow.shared import materialize
from windrow.sources import files
from windrow.streaming import answers


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """Notices of JSON lines files as they land."""
    return spark.readStream.schema(NOTICE).json(folder)


def classify_stream(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Classify all that has landed since the last run, once each, and stop."""
    rows = classify.classified(landed(spark, folder))
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("is_relevant").trigger(availableNow=True).start()


def label_stream(spark: SparkSession, folder: str, labeler: labels.Labeler, out: str, checkpoint: str) -> StreamingQuery:
    """Label relevant notices of each micro-batch that have no label yet; repeats within one batch are all labeled.

    Answers are committed beside ``out`` as they come, so that a batch which is run again asks for none of them twice.
    """

    def step(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        try:
            done = materialize(files.read_labeled(session, out).select("notam_id"), "done")
        except files.MissingSource:
            done = session.createDataFrame([], "notam_id string")
        given = answers.answer(labels.pending(classify.relevant(batch), done), labeler, f"{out}.answers")
        files.write_labeled(labels.labeled(labels.pending(given, done)), out, mode="append")

    return landed(spark, folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
