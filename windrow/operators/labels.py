"""Incremental labeling: what is pending, calling a labeler, and what becomes of its responses."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.json_text import repair_response
from windrow.functions.keywords import is_blank
from windrow.schemas import NOTICE_FIELDS

#: A labeler takes a prompt and returns the model's text; it may raise, and the notice is then tried again in the next run.
Labeler = Callable[[str], str]


def pending(notices: DataFrame, done: DataFrame, key: str = "notam_id") -> DataFrame:
    """Notices whose key is not among the done; null matches null, and repeats within ``notices`` all stay."""
    ids = done.select(F.col(key).alias("__done")).distinct()
    return notices.join(ids, F.col(key).eqNullSafe(F.col("__done")), "left_anti")


def all_labels(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new labels together; repeats stay."""
    return old.unionByName(new)


def extraction_prompt(notam_id: Column, text: Column, fields: tuple[str, ...] | None = None) -> Column:
    """A prompt that asks for one JSON object for each runway."""
    from windrow.schemas import CONTAMINATION_TYPES, ENTRY_FIELDS

    wanted = ", ".join(f"{n} ({k})" for n, k in ENTRY_FIELDS.items() if fields is None or n in fields)
    return F.concat(
        F.lit("Read the aviation notice below. Answer with a JSON array only: one object for each runway whose conditions differ, [] if no runway performance is concerned.\nFields, null where they do not apply: " + wanted + ".\nTypes of contamination: " + ", ".join(CONTAMINATION_TYPES) + ".\nKeep units as stated. The confidence goes from 0 to 1.\n\nNotice "),
        F.coalesce(notam_id, F.lit("UNKNOWN")),
        F.lit(":\n"),
        text,
    )


def ask(notices: DataFrame, labeler: Labeler, threads: int = 1) -> DataFrame:
    """``notices`` with text, with the column ``response``, null where the labeler raised; partitions stay as they are, with ``threads`` calls at once in each."""
    asked = notices.where(~is_blank(F.col("notam_text"))).withColumn("response", extraction_prompt(F.col("notam_id"), F.col("notam_text")))

    def safe(prompt: str) -> str | None:
        try:
            return labeler(prompt)
        except Exception:  # noqa: BLE001  whatever a remote call raises: the notice stays pending
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            each = pool.map if threads > 1 else map  # a call that waits for none needs no thread of its own
            for batch in batches:
                at = batch.schema.get_field_index("response")
                answers = pa.array(each(safe, batch.column(at).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([answers if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return asked.mapInArrow(run, asked.schema)


def respond(notices: DataFrame, labeler: Labeler, concurrency: int = 20, tasks: int | None = None) -> DataFrame:
    """``notices`` with text, with the column ``response``; null where the labeler raised.

    At most ``concurrency`` calls are under way over all tasks. Write the result once: another evaluation calls the
    model again, for which speculative execution should be off as well.
    """
    n = min(tasks or concurrency, concurrency)
    return ask(notices.where(~is_blank(F.col("notam_text"))).repartition(n), labeler, max(1, concurrency // n))


def labeled(responded: DataFrame) -> DataFrame:
    """Labeled items of the responses that hold entries: the notice's five fields, the entries, the least confidence."""
    parsed = responded.where(F.col("response").isNotNull()).withColumn("__r", repair_response("response"))
    return parsed.where("__r.ok").select(*NOTICE_FIELDS, F.col("__r.entries").alias("runway_entries"), F.col("__r.min_confidence").alias("min_confidence"))


def quarantined(responded: DataFrame) -> DataFrame:
    """Responses without entries that could be read, and those with null confidences, with the reason."""
    parsed = responded.withColumn("__r", F.when(F.col("response").isNotNull(), repair_response("response")))
    why = F.when(F.col("response").isNull(), "no_response").when(~F.col("__r.ok"), "unreadable").when(F.col("__r.odd_confidence"), "null_confidence")
    return parsed.withColumn("problem", why).where("problem is not null").drop("__r")
