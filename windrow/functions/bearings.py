"""Bearings in degrees, from numbers or compass points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The sixteen compass points, a sixteenth of a turn apart.
POINTS = {p: 22.5 * i for i, p in enumerate(("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"))}
_NUMBER = r"^[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+)?$"


def parse_bearing(text: Column) -> Column:
    """Degrees of a bearing in text: a number, or a compass point in any case; anything else is null (its value is lost)."""
    s = F.upper(F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    points = F.create_map(*[x for p, v in POINTS.items() for x in (F.lit(p), F.lit(v))])
    special = F.regexp_replace(s, r"^[+]", "")
    return (
        F.when(s.rlike(_NUMBER), F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
        .when(special.isin("NAN", "INF", "INFINITY", "-INF", "-INFINITY", "-NAN"), F.when(F.contains(special, F.lit("NAN")), F.lit(float("nan"))).when(special.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .otherwise(F.try_element_at(points, s))
    )


def is_unread_bearing(text: Column) -> Column:
    """Whether a bearing in text has more than digits, points and minus signs (or none but those signs)."""
    rest = F.regexp_replace(text, r"[.-]", "")
    return ~rest.rlike(r"(?U)^\d+$")
