"""The batch preparation: classify, label, patch, fix, format and split; each step's output is written once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators import classify, examples, labels, normalize, review
from windrow.plans.manifest import Manifest
from windrow.schemas import NOTICE
from windrow.shared import materialize
from windrow.sources import files, pages as paged
from windrow.streaming import answers


@dataclass
class Prepare:
    """Steps over a folder: all_notams.json (or landed pages) → filtered, silver, train/valid/test."""

    spark: SparkSession
    folder: str
    labeler: labels.Labeler | None = None
    skip_download: bool = True
    skip_labeling: bool = False
    split_by_notice: bool = False
    page_size: int = paged.SIZE
    per_commit: int = 20
    skip_unchanged: bool = False
    counts: dict[str, int] = field(default_factory=dict)

    def at(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def download(self, pages: DataFrame | None = None) -> DataFrame:
        """The notices: from ``pages``, which are written as far as the first gap, or from what was downloaded before."""
        if pages is not None and not self.skip_download:
            if "page_offset" in pages.columns:
                pages = paged.whole_prefix(materialize(pages, "pages"), self.page_size).drop("seq", "page_offset")
            files.write_lines(pages, self.at("all_notams.jsonl"))
        return self.spark.read.schema(NOTICE).json(files.require(self.spark, self.at("all_notams.jsonl")))

    def filter(self, notices: DataFrame) -> DataFrame:
        files.write_routes(classify.classified(notices), self.at("classified"))
        return self.relevant()

    def relevant(self) -> DataFrame:
        return self.spark.read.parquet(self.at("classified")).where(F.col("is_relevant").cast("boolean"))

    def label(self, notices: DataFrame) -> DataFrame:
        """New labels are appended; what the labeler did not answer stays pending for the next run. Answers without labels are listed in ``quarantine``.

        Answers are committed as they come, so a run that is killed asks for none of them twice.
        """
        silver = self.at("silver_dataset")
        if not self.skip_labeling:
            if self.labeler is None:
                raise ValueError("labeling needs a labeler")
            try:
                done = materialize(files.read_labeled(self.spark, silver).select("notam_id"), "done")
            except files.MissingSource:
                done = self.spark.createDataFrame([], "notam_id string")
            given = answers.answer(labels.pending(notices, done), self.labeler, self.at("answers"), self.per_commit)
            new = labels.pending(given, done)
            files.write_lines(labels.quarantined(new), self.at("quarantine"))
            files.write_labeled(labels.labeled(new), silver, mode="append")
        return files.read_labeled(self.spark, silver)

    def finish(self, labeled: DataFrame, patches: DataFrame | None = None) -> DataFrame:
        """Patches, repair, examples and split. What the repair could not read is listed in ``unrepaired``."""
        reviewed = materialize(review.apply_patches(labeled, patches), "reviewed") if patches is not None else labeled
        files.write_lines(normalize.unrepaired(reviewed), self.at("unrepaired"))
        fixed, issues = normalize.fix_counted(reviewed)
        if patches is not None or any(issues.values()):
            files.replace(fixed, self.at("silver_dataset"))
            fixed = files.read_labeled(self.spark, self.at("silver_dataset"))
        rows = examples.messages(examples.examples(fixed))
        split = examples.split_by(rows, "notam_id") if self.split_by_notice else examples.exact_split(rows.withColumn("__key", _key()), "__key").drop("__key")
        files.write_split(split, self.at("examples"))
        return split

    def stage(self, name: str, source: str, output: str, work: Callable[[], object], settings: str = "") -> bool:
        """Do a stage's work; with ``skip_unchanged`` only where its source has changed, its output is gone, or its settings are others."""
        if not self.skip_unchanged:
            work()
            return True
        return Manifest(self.spark, self.at("manifest")).run(name, [self.at(source)], self.at(output), work, settings)

    def run(self, pages: DataFrame | None = None, patches: DataFrame | None = None) -> dict[str, int]:
        """All steps; the numbers of examples in each split."""
        notices = self.download(pages)
        self.stage("filter", "all_notams.jsonl", "classified", lambda: self.filter(notices))
        labeled = self.label(self.relevant())
        if patches is not None:  # rows without files, so without a fingerprint
            self.finish(labeled, patches)
        else:
            self.stage("finish", "silver_dataset", "examples", lambda: self.finish(labeled), f"by notice: {self.split_by_notice}")
        for r in self.spark.read.text(self.at("examples")).groupBy("split").count().collect():  # three rows
            self.counts[r["split"]] = r["count"]
        return self.counts


def _key() -> Column:
    return F.concat_ws(":", F.coalesce("notam_id", F.lit("")), "entry_idx", F.md5(F.concat("user", "assistant").cast("binary")))
