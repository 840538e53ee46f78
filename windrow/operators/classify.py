"""The ordered rule cascade over notices, and its routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.keywords import INCLUSION, contains_any, is_blank, is_navigation_only, is_taxiway_only

RELEVANT = "has_relevant_keyword"


def reason(text: Column, strict_taxiway: bool = False) -> Column:
    """The first rule that decides. A null text counts as empty. ``strict_taxiway``: any runway on the line, before or after, counts."""
    upper = F.upper(text)
    taxiway = text.rlike(r"(?idUu)\bTWY\b") & ~text.rlike(r"(?idUu)\bRWY\b") if strict_taxiway else is_taxiway_only(text)
    return (
        F.when(is_blank(text), "empty_text")
        .when(taxiway, "taxiway_only")
        .when(is_navigation_only(upper), "navigation_only")
        .when(contains_any(upper, INCLUSION), RELEVANT)
        .otherwise("no_relevant_keywords")
    )


def classified(notices: DataFrame, text_col: str = "notam_text", strict_taxiway: bool = False) -> DataFrame:
    """``notices`` with ``reason`` and ``is_relevant``."""
    return notices.withColumn("reason", reason(F.col(text_col), strict_taxiway)).withColumn("is_relevant", F.col("reason") == RELEVANT)


def relevant(notices: DataFrame, text_col: str = "notam_text") -> DataFrame:
    return notices.where(reason(F.col(text_col)) == RELEVANT)


def excluded(notices: DataFrame, text_col: str = "notam_text") -> DataFrame:
    """The rest, with the rule that excluded each."""
    return notices.withColumn("_exclusion_reason", reason(F.col(text_col))).where(F.col("_exclusion_reason") != RELEVANT)


def preview(notices: DataFrame, seq: str, n: int = 5, chars: int = 100, text_col: str = "notam_text") -> DataFrame:
    """The first relevant notices in input order, their texts cut short."""
    return relevant(notices, text_col).orderBy(seq).limit(n).withColumn(text_col, F.substring(text_col, 1, chars))
