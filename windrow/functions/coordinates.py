"""Coordinates in eight notations, as decimal degrees in text. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.functions.entries import let

# The patterns of the notations, anchored at the start.
DECIMAL = r"^(?:-?\d+\.\d+,\s*-?\d+\.\d+)"
COMPACT_SECONDS = r"^(?:(\d{2})(\d{2})(\d{2}(?:\.\d+)?)([NS])\s*(\d{2,3})(\d{2})(\d{2}(?:\.\d+)?)([EW]))"
COMPACT_MINUTES = r"^(?:(\d{2})(\d{2})([NS])\s*(\d{2,3})(\d{2})([EW]))"
DEGREE_MINUTES = r"^(?:(\d+)[°](\d+)['\s]*([NS])\s*(\d+)[°](\d+)['\s]*([EW]))"
SPACED_LEADING = r"^(?:([NS])(\d+)\s+(\d+)\s+(\d+(?:\.\d+)?)\s*/\s*([EW])(\d+)\s+(\d+)\s+(\d+(?:\.\d+)?))"
DEGREE_SECONDS = r"""^(?:(\d+)°(\d+)'(\d+(?:\.\d+)?)["″]?\s*([NS])[,\s]+(\d+)°(\d+)'(\d+(?:\.\d+)?)["″]?\s*([EW]))"""
COMPACT_LEADING = r"^(?:([NS])(\d{2})(\d{2})(\d{2}(?:\.\d+)?)\s+([EW])(\d{2,3})(\d{2})(\d{2}(?:\.\d+)?))"
TENTHS = r"^(?:(\d{2})(\d{2})(\d{3})([NS])(\d{3})(\d{2})(\d{2,3})([EW]))"


STARTS = r"^[ /]*(?:\d|[NSnsſ]\d)"


def degrees(whole: Column, minutes: Column, seconds: Column | None, side: Column) -> Column:
    """Signed degrees; south and west are negative, and zero may be."""
    value = whole.cast("double") + minutes.cast("double") / 60
    if seconds is not None:
        value = value + seconds / 3600
    return F.when(side.isin("S", "W"), -value).otherwise(value)


def fixed(value: Column, digits: int) -> Column:
    """The exact double rounded half to even, without grouping."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def _pair(text: Column, pattern: str, groups: str, digits: int, tenths: bool = False) -> Column:
    """The pair that ``pattern`` reads from ``text``, or null. ``groups`` names its groups: d, m, s, h for each half."""
    half = len(groups) // 2

    def pair(at: Column) -> Column:
        values = []
        for k in (0, half):
            part = {g: at[k + i] for i, g in enumerate(groups[k : k + half])}
            seconds = part["s"].cast("double") if "s" in part else None
            if tenths:  # three digits are seconds and tenths
                seconds = F.when(F.length(part["s"]) == 3, seconds / 10).otherwise(seconds)
            values.append(fixed(degrees(part["d"], part["m"], seconds, part["h"]), digits))
        return F.concat(values[0], F.lit(", "), values[1])

    # all groups by one match; none holds a bar
    parts = F.split(F.regexp_replace(text, f"(?s){pattern}.*", "|".join(f"${i + 1}" for i in range(len(groups)))), r"\|")
    return F.when(text.rlike(pattern), let(parts, pair))


def parse_one(text: Column) -> Column:
    """Decimal degrees of a single coordinate, or null if no notation fits at its start."""

    def read(upper: Column, clean: Column) -> Column:
        return F.coalesce(
            _pair(clean, COMPACT_SECONDS, "dmshdmsh", 6),
            _pair(clean, COMPACT_MINUTES, "dmhdmh", 4),
            _pair(upper, DEGREE_MINUTES, "dmhdmh", 4),
            _pair(upper, SPACED_LEADING, "hdmshdms", 6),
            _pair(text, DEGREE_SECONDS, "dmshdmsh", 6),
            _pair(upper, COMPACT_LEADING, "hdmshdms", 6),
            F.when(F.contains(clean, F.lit(",")), _pair(F.translate(clean, ",", "."), COMPACT_SECONDS, "dmshdmsh", 6)),
            _pair(clean, TENTHS, "dmshdmsh", 6, tenths=True),
        )

    # every notation begins with a digit, or a side before one
    held = let(F.upper(text), lambda upper: let(F.translate(upper, " /", ""), lambda clean: read(upper, clean)))
    return F.when(text.rlike(STARTS), held)


def is_decimal(text: Column) -> Column:
    return text.rlike(DECIMAL)


def parse_coordinate(text: Column) -> Column:
    """Decimal degrees of the first coordinate that can be read; a decimal start and anything unreadable stay. Empty is null."""
    firsts = [F.when(F.contains(text, F.lit(sep)), F.split_part(text, F.lit(sep), F.lit(1))) for sep in (" - ", ", ", ",")]
    # one parser over the candidates, rather than a copy of it for each; none is read after one that could be
    read = F.aggregate(F.array(*firsts, text), F.lit(None).cast("string"), lambda found, t: F.when(found.isNotNull(), found).when(t.isNotNull(), parse_one(t)))
    return F.when(text == "", None).when(is_decimal(text), text).otherwise(F.coalesce(read, text))
