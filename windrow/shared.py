"""Tables in the shared folder that a session names, which cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session gets a folder of its own; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="windrow-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Tasks that failed are run again and only the output of one attempt of each is committed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/windrow-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
