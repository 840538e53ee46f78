"""Counts and shares over notices, labels and outputs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.entries import let_parsed, truthy_in
from windrow.operators.classify import RELEVANT, reason


def reason_counts(notices: DataFrame, text_col: str = "notam_text") -> DataFrame:
    """Rows by reason; map-side combined, so only a handful of rows shuffle."""
    return notices.groupBy(reason(F.col(text_col)).alias("reason")).agg(F.count("*").alias("n"))


def exclusion_counts(notices: DataFrame, seq: str, text_col: str = "notam_text") -> DataFrame:
    """Reasons of excluded rows by falling count; equal counts in the order of first sight."""
    marked = notices.select(F.col(seq).alias("seq"), reason(F.col(text_col)).alias("reason")).where(F.col("reason") != RELEVANT)
    counts = marked.groupBy("reason").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    return counts.orderBy(F.desc("n"), "first_seq")


def relevance_totals(notices: DataFrame, text_col: str = "notam_text") -> DataFrame:
    """Totals and percentages with one decimal; null shares where there are no rows."""
    hit = reason(F.col(text_col)) == RELEVANT
    t = notices.agg(F.count("*").alias("total"), F.count_if(hit).alias("relevant")).withColumn("excluded", F.col("total") - F.col("relevant"))
    share = lambda c: F.round(F.try_divide(100.0 * F.col(c), F.col("total")), 1)
    return t.select("total", "relevant", "excluded", share("relevant").alias("relevant_percent"), share("excluded").alias("excluded_percent"))


def location_counts(notices: DataFrame, location: str = "icao_location", seq: str | None = None) -> DataFrame:
    """Rows by location, null as UNKNOWN; ``first_seq`` breaks ties as a stable sort would."""
    known = F.coalesce(F.col(location), F.lit("UNKNOWN")).alias("location")
    first = [F.min(seq).alias("first_seq")] if seq else []
    return notices.groupBy(known).agg(F.count("*").alias("n"), *first)


def top_locations(notices: DataFrame, seq: str, n: int = 10, location: str = "icao_location") -> DataFrame:
    return location_counts(notices, location, seq).orderBy(F.desc("n"), "first_seq").limit(n)


def distinct_locations(notices: DataFrame, location: str = "icao_location") -> DataFrame:
    return notices.agg(F.count_distinct(F.coalesce(F.col(location), F.lit("UNKNOWN"))).alias("locations"))


def entry_totals(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """Items, entries, and entries by what they report: conditional counts in one pass over ``labeled``, each entry parsed once."""
    e = F.col("e")
    reports = {"contaminated": ("contaminations",), "shortened": ("takeoffShortening", "landingShortening"), "with_obstacle": ("obstacleHeight",), "closed": ("runwayClosed",)}

    def flags(parsed: Column) -> Column:
        return F.struct(*[reduce(or_, [truthy_in(parsed, e, f) for f in fields]).alias(n) for n, fields in reports.items()])

    spread = labeled.select(F.posexplode_outer(entries).alias("at", "e")).select("at", "e", let_parsed(e, flags).alias("has"))
    items = F.count_if(F.coalesce(F.col("at"), F.lit(0)) == 0)  # an item without entries has a row of its own
    return spread.agg(items.alias("items"), F.count("e").alias("entries"), *[F.count_if(F.col("has")[n]).alias(n) for n in reports])


def low_confidence(labeled: DataFrame, below: float = 0.8, column: str = "min_confidence") -> DataFrame:
    """Items strictly below the cut; a null confidence counts as one."""
    return labeled.where(F.coalesce(F.col(column), F.lit(1.0)) < below)


def progress(notices: DataFrame, done: DataFrame, labeled: DataFrame) -> DataFrame:
    """Counts of all, done, pending, labeled and low-confidence items."""
    from windrow.operators.labels import pending

    counts = [df.agg(F.count("*").alias(n)) for n, df in (("all", notices), ("done", done), ("pending", pending(notices, done)), ("labeled", labeled), ("low", low_confidence(labeled)))]
    out = counts[0]
    for c in counts[1:]:
        out = out.crossJoin(c)  # single rows
    return out


def percent(n: Column, of: Column) -> Column:
    """A share as text with one decimal; null without a base."""
    return F.call_function("format_number", F.try_divide(100.0 * n, of), F.lit("0.0"))
