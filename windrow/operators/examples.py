"""Training examples from labeled items, and their split into exact shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.json_text import example_text, runway_of
from windrow.functions.keywords import is_blank, is_canceled
from windrow.operators.order import with_position
from windrow.schemas import ENTRY_FIELDS
from windrow.shared import materialize


def exploded(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """One row for each entry, in order; none for items without text or entries."""
    kept = labeled.where(~is_blank(F.col("notam_text")) & (F.size(F.coalesce(F.col(entries), F.array().cast("array<string>"))) > 0))
    return kept.select("*", F.posexplode(entries).alias("entry_idx", "entry")).drop(entries)


def _or_none(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def prompt(runway: Column) -> Column:
    """The user's message: a notice in its context. Nulls show as None, and no runway as ALL."""
    # fixed values: the wording of the prompt
    shown = F.coalesce(F.nullif(runway, F.lit("")), F.lit("ALL"))
    return F.concat(
        F.lit("Extract runway performance data from this NOTAM.\n\nAirport: "), _or_none(F.col("icao_location")),
        F.lit("\nRunway: "), shown,
        F.lit("\nEffective: "), _or_none(F.col("effective_start")), F.lit(" to "), _or_none(F.col("effective_end")),
        F.lit("\n\nNOTAM "), _or_none(F.col("notam_id")), F.lit(":\n"), F.col("notam_text"),
    )


#: The keys of a response: of the notice, of the entry with what stands for a missing one, and the last two.
HEAD = ("airportID", "runway", "effectiveStart", "effectiveEnd", "isCanceled")
BODY = {f: [] if f == "contaminations" else None for f in ENTRY_FIELDS if f not in ("runway", "confidence", "notes")}
TAIL = ("sourceNOTAMIds", "notes")


def examples(labeled: DataFrame) -> DataFrame:
    """notam_id, entry_idx, user and assistant message of each entry: a notice in its context, and JSON of 30 keys in fixed order.

    An entry is parsed once, for both.
    """
    rows = exploded(labeled)
    values = dict(airportID="icao_location", effectiveStart="effective_start", effectiveEnd="effective_end", sourceNOTAMIds="notam_id")
    notice = F.struct(*[F.col(c).alias(k) for k, c in values.items()], is_canceled(F.col("notam_text")).alias("isCanceled"))
    made = rows.withColumn("__made", example_text(HEAD, BODY, TAIL)("entry", notice))
    return made.select("notam_id", "entry_idx", prompt(F.col("__made.runway")).alias("user"), F.col("__made.response").alias("assistant"))


def prompts(labeled: DataFrame) -> DataFrame:
    """notam_id, entry_idx and user message of :func:`examples`; the assistant's message is not made."""
    made = exploded(labeled).withColumn("__runway", runway_of("entry"))
    return made.select("notam_id", "entry_idx", prompt(F.col("__runway")).alias("user"))


def messages(rows: DataFrame) -> DataFrame:
    """``rows`` with the message pair as an array."""
    pair = F.array(F.struct(F.lit("user").alias("role"), F.col("user").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("assistant").alias("content")))
    return rows.withColumn("messages", pair)


def example_counts(labeled: DataFrame) -> DataFrame:
    """Examples, items with examples, and items skipped."""
    n = F.when(is_blank(F.col("notam_text")), 0).otherwise(F.size(F.coalesce(F.col("runway_entries"), F.array().cast("array<string>"))))
    return labeled.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("examples"), F.count_if(n > 0).alias("converted"), F.count_if(n == 0).alias("skipped"))


def exact_split(rows: DataFrame, key: str, train: float = 0.8, valid: float = 0.1, seed: int = 42) -> DataFrame:
    """``rows`` with ``split``: train and valid are whole floors of their shares of the rows, and test is the rest.

    Rows are shuffled by a hash of seed and key, equal keys in the order of the rest of the row's hash. They are written once, as they come; what is sorted, by range,
    is a hash and a number for each, so no task sorts the whole table and no wide row goes through the sort.
    """
    held = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "split")
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key), F.xxhash64(*[F.col(c) for c in rows.columns])]
    narrow = held.select("__row", *[c.alias(f"__by{i}") for i, c in enumerate(order)])
    placed = with_position(narrow, [F.col(f"__by{i}") for i in range(len(order))], "__at").select("__row", "__at")
    n = held.count()
    first, second = int(n * train), int(n * train) + int(n * valid)
    split = F.when(F.col("__at") < first, "train").when(F.col("__at") < second, "valid").otherwise("test")
    return held.join(placed, "__row").withColumn("split", split).drop("__row", "__at")


def split_by(rows: DataFrame, group: str, train: float = 0.8, valid: float = 0.1, seed: int = 42) -> DataFrame:
    """Like :func:`exact_split`, but whole groups (such as all entries of a notice) stay together; shares are of groups."""
    groups = exact_split(rows.select(group).distinct(), group, train, valid, seed).withColumnRenamed(group, "__group")
    return rows.join(groups, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("n"))
