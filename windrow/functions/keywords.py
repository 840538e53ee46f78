"""Text predicates of notices: keywords are substrings of the upper-cased text, not words."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule's keyword lists.
INCLUSION = ("RWY", "RUNWAY", "THR", "THRESHOLD", "FICON", "CONTAMINATED", "ICE", "SNOW", "SN", "SLUSH", "WATER", "WET", "COMPACTED", "BRAKING", "OBST", "OBSTACLE", "CRANE", "TOWER", "HTG", "CLSD", "CLOSED", "DSPLCD", "DISPLACED")
NAVIGATION = ("ILS", "VOR", "GPS", "NDB", "DME", "RNAV", "LOC", "GS", "PAPI", "VASI")
PROCEDURE = ("APCH", "APPROACH", "DEP", "DEPARTURE", "SID", "STAR", "IAP")
RUNWAY = ("RWY", "RUNWAY")
PERFORMANCE = ("DSPLCD", "CLSD", "CLOSED", "FICON", "CONTAMINATED")
STATUS = ("U/S", "OTS", "NOT AVBL", "INOP", "ON TEST", "MAINT")
CANCELLATION = ("CANCEL", "NOTAMC", "CNL", "CNCL", "WITHDRAWN")


def contains_any(upper: Column, keywords: Iterable[str]) -> Column:
    """Whether the upper-cased text holds one of the keywords; those that hold another keyword add nothing."""
    keywords = list(keywords)
    needed = [k for k in keywords if not any(o != k and o in k for o in keywords)]
    return reduce(or_, [F.contains(upper, F.lit(k)) for k in needed])


def is_blank(text: Column) -> Column:
    """Only white space, as Unicode and the separators U+001C to U+001F have it. Null is blank."""
    return ~F.coalesce(text, F.lit("")).rlike("(?U)[^\\s\\x1c-\\x1f]")


def is_taxiway_only(text: Column) -> Column:
    """A taxiway that no runway follows on its line: a runway before it does not count."""
    return text.rlike(r"(?idUu)\bTWY\b(?!.*\bRWY\b)")


def is_navigation_only(upper: Column) -> Column:
    """Navigation or procedure words, and either no runway or a mere equipment status without a performance word."""
    runway, performance, status = (contains_any(upper, k) for k in (RUNWAY, PERFORMANCE, STATUS))
    return (contains_any(upper, NAVIGATION) | contains_any(upper, PROCEDURE)) & (~runway | (~performance & status))


def is_canceled(text: Column) -> Column:
    return contains_any(F.upper(F.coalesce(text, F.lit(""))), CANCELLATION)
