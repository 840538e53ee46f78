"""What stages ran on, so that those whose inputs are as they were are left out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from windrow.sources import files

_ROW = "stage string, inputs string, output string, run long"


@dataclass
class Manifest:
    """A table (JSON lines at ``path``) of stages, the fingerprint of their inputs, and their outputs; a row for each run that ended well."""

    spark: SparkSession
    path: str

    def fingerprint(self, inputs: list[str], settings: str = "") -> str:
        """Of the names, sizes and times of all files of the inputs, which must be there; their contents are not read. Empty files count for nothing."""
        parts = [settings]
        for path in inputs:
            some = files.listing(self.spark, files.require(self.spark, path)).where("size > 0")
            n, size, names = some.agg(F.count("*"), F.sum("size"), F.bit_xor(F.xxhash64("path", "size", "changed"))).first()
            parts.append(f"{path}:{n}:{size}:{names}")
        return "|".join(parts)

    def last(self, stage: str) -> tuple[str, str] | None:
        """The fingerprint and output of the last run of a stage."""
        try:
            rows = self.spark.read.schema(_ROW).json(files.require(self.spark, self.path))
        except files.MissingSource:
            return None
        found = rows.where(F.col("stage") == stage).agg(F.max_by(F.struct("inputs", "output"), "run")).first()[0]
        return tuple(found) if found else None

    def run(self, stage: str, inputs: list[str], output: str, work: Callable[[], object], settings: str = "") -> bool:
        """Do the work unless it was done on the same inputs with the same settings and its output is there; whether it was done now.

        A missing input is refused, and a run that fails leaves no row. The fingerprint is that of before the work, so a stage that rewrites its
        input, or whose input changes meanwhile, is done once more.
        """
        now = self.fingerprint(inputs, settings)
        if self.last(stage) == (now, output):
            try:
                files.require(self.spark, output)
                return False
            except files.MissingSource:
                pass
        work()
        files.require(self.spark, output)
        self.spark.createDataFrame([(stage, now, output, time.time_ns())], _ROW).coalesce(1).write.mode("append").json(self.path)
        return True
