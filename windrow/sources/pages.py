"""Paged notices: a data source over an offset-paged service, and pages that have landed as files.

Pages after the first that fails or is empty do not count, as a sequential reader would have stopped there.
"""

from __future__ import annotations

import json
import os
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from windrow.schemas import NOTICE, NOTICE_FIELDS, PAGE

SIZE, TIMEOUT = 100, 30

#: A fetch takes a limit and an offset, and returns {"data": [...], "pagination": {"total": n}}.
Fetch = Callable[[int, int], dict]


def http_fetch(url: str, token: str) -> Fetch:
    """Fetch by GET with a bearer token."""

    def fetch(limit: int, offset: int) -> dict:
        request = urllib.request.Request(f"{url}?limit={limit}&offset={offset}", headers={"Authorization": f"Bearer {token}"})
        with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:  # noqa: S310
            return json.load(answer)

    return fetch


class _Page(InputPartition):
    def __init__(self, offset: int, limit: int = SIZE):
        self.offset, self.limit = offset, limit


def _row(at: int, page: int, found: dict) -> tuple:
    return (at, page, *(None if found.get(f) is None else str(found.get(f)) for f in NOTICE_FIELDS))


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, size: int):
        self.fetch, self.size = fetch, size

    def partitions(self) -> list[_Page]:
        total = self.fetch(self.size, 0).get("pagination", {}).get("total", 0)  # unguarded: without it there is no scan
        return [_Page(o) for o in range(0, total, self.size)]

    def read(self, page: _Page) -> Iterator[tuple]:
        try:
            rows = self.fetch(self.size, page.offset).get("data", [])
        except Exception:  # noqa: BLE001  a page that fails ends the prefix; see whole_prefix
            rows = []
        for i, r in enumerate(rows):
            yield _row(page.offset + i, page.offset, r)


class _StreamReader(DataSourceStreamReader):
    """Offsets are rows of the service: what is below them has been read and committed.

    A page that fails, or holds fewer rows than its service promised, fails its batch, which the next run asks for again; nothing is skipped.
    """

    def __init__(self, fetch: Fetch, size: int, refresh: bool):
        self.fetch, self.size, self.refresh, self.total = fetch, size, refresh, None

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        if self.total is None or self.refresh:
            found = self.fetch(1, 0).get("pagination", {}).get("total", 0)
            self.total = max(found, self.total or 0)
        return {"row": self.total}

    def partitions(self, start: dict, end: dict) -> list[_Page]:
        return [_Page(o, min(self.size, end["row"] - o)) for o in range(start["row"], end["row"], self.size)]

    def read(self, page: _Page) -> Iterator[tuple]:
        rows = self.fetch(page.limit, page.offset).get("data", [])
        if len(rows) < page.limit:
            raise OSError(f"the page at {page.offset} has {len(rows)} rows of {page.limit}")
        for i, r in enumerate(rows[: page.limit]):
            yield _row(page.offset + i, page.offset, r)

    def commit(self, end: dict) -> None:
        pass


class PagedNotices(DataSource):
    """``spark.read.format("paged_notices")`` with the options url, token_env, size; or a subclass with its own fetch.

    With ``spark.readStream`` it goes on where the checkpoint says, and asks for what came since. The total is read once a run; with the option
    ``refresh`` it is read at each trigger, for streams that stay.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_notices"

    def schema(self) -> str:
        return "seq long, page_offset long, " + ", ".join(f"{f} string" for f in NOTICE_FIELDS)

    def fetch(self) -> Fetch:
        token = os.environ.get(self.options.get("token_env", "NOTICE_TOKEN"))
        if not token:
            raise ValueError("no token in the environment")
        return http_fetch(self.options["url"], token)

    def reader(self, schema: object) -> _Reader:
        return _Reader(self.fetch(), int(self.options.get("size", SIZE)))

    def streamReader(self, schema: object) -> _StreamReader:
        return _StreamReader(self.fetch(), int(self.options.get("size", SIZE)), str(self.options.get("refresh", "")).lower() == "true")


def download_new(spark: SparkSession, out: str, checkpoint: str, source: str = "paged_notices", **options: str) -> StreamingQuery:
    """Append what the service has had since the last run to ``out``, and stop."""
    rows = spark.readStream.format(source).options(**options).load()
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def whole_prefix(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows of the pages before the first gap. Materialise ``rows`` first: a second read asks the service again.

    The offsets form one row for each page; the first gap is the least offset that follows a page but has none.
    """
    pages = rows.select("page_offset").where(F.col("page_offset") % size == 0).distinct()
    after = pages.select((F.col("page_offset") + size).alias("__gap")).unionByName(rows.sparkSession.range(1).select(F.col("id").alias("__gap")))
    gap = after.join(pages, F.col("__gap") == F.col("page_offset"), "left_anti").agg(F.min("__gap").alias("__gap"))  # one row
    return rows.join(F.broadcast(gap), (F.col("page_offset") < F.col("__gap")) & (F.col("page_offset") % size == 0)).drop("__gap")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Notices of pages that landed as JSON files, one page each, in the order of the files' names."""
    pages = spark.read.schema(PAGE).option("multiLine", True).json(path).withColumn("page", F.input_file_name())
    return pages.select("page", F.posexplode("data").alias("at", "n")).select("page", "at", *[f"n.{f.name}" for f in NOTICE.fields])
