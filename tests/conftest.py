"""One small session for all tests, and a comparison of registered queries with their SQL."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{ROOT}/tests:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.fixture(scope="session")
def same(spark, duck):
    """Compares a query with its SQL, row by row in any order."""

    def check(query, sql):
        df = query(spark, DATA)
        names = sorted(df.columns)
        got = sorted(tuple(map(str, r)) for r in df.select(*names).collect())
        columns = ", ".join(f'"{n}"' for n in names)
        assert sorted(duck.sql(sql).columns) == names
        assert got == sorted(tuple(map(str, r)) for r in duck.sql(f"SELECT {columns} FROM ({sql})").fetchall())

    return check
