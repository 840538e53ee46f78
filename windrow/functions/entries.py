"""Values of raw JSON entries, with Python's notions of missing, null and truth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, where an expression uses it many times over."""
    return F.element_at(F.transform(F.array(c), f), 1)


def value(entry: Column, field: str) -> Column:
    """The field's text (a number's lexeme, a string without quotes); null if missing or null."""
    return F.get_json_object(entry, f"$.{field}")


def kind(entry: Column, field: str) -> Column:
    """STRING, BOOLEAN, a numeric type, ARRAY<...> or OBJECT<...>; null if missing or null."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(entry), f"$.{field}", "variant"))


def is_string(entry: Column, field: str) -> Column:
    return F.coalesce(kind(entry, field) == "STRING", F.lit(False))


def truthy(entry: Column, field: str) -> Column:
    """Not null, false, zero, empty text, or an empty list or object."""
    v = value(entry, field)
    number = F.coalesce(v.try_cast("double") != 0, F.lit(True))
    filled = F.when(v.isNull(), False).when(is_string(entry, field), v != "").when(v.isin("false", "[]", "{}"), False).otherwise(number)
    return F.coalesce(filled, F.lit(False))


def let_parsed(entry: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of the entry parsed once, as a variant: null where Spark's parser does not read what Python's does, such as NaN."""
    return let(F.try_parse_json(entry), f)


def kind_in(parsed: Column, field: str) -> Column:
    """Like :func:`kind`, of an entry that is parsed already."""
    return F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))


def text_in(parsed: Column, entry: Column, field: str) -> Column:
    """Like :func:`value`, of an entry that is parsed already, numbers without their lexeme; one that could not be is read as :func:`value` does."""
    return F.when(parsed.isNull(), value(entry, field)).otherwise(F.try_variant_get(parsed, f"$.{field}", "string"))


def truthy_text(v: Column, kind: Column) -> Column:
    """Like :func:`truthy`, of a value whose text and kind are read already; only what is no string is tried as a number."""
    number = F.coalesce(v.try_cast("double") != 0, F.lit(True))
    filled = F.when(v.isNull(), False).when(kind == "STRING", v != "").when(v.isin("false", "[]", "{}"), False).otherwise(number)
    return F.coalesce(filled, F.lit(False))


def truthy_in(parsed: Column, entry: Column, field: str) -> Column:
    """Like :func:`truthy`, of an entry that is parsed already; one that could not be is read as :func:`truthy` does."""
    v = F.try_variant_get(parsed, f"$.{field}", "string")
    number = F.coalesce(v.try_cast("double") != 0, F.lit(True))
    plain = F.when(v.isin("", "false", "[]", "{}"), False).otherwise(number)
    filled = F.when(v.isNull(), False).when(plain, True).otherwise((v != "") & (kind_in(parsed, field) == "STRING"))
    return F.when(parsed.isNull(), truthy(entry, field)).otherwise(F.coalesce(filled, F.lit(False)))


def has_key(entry: Column, field: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(entry), field), F.lit(False))


def confidences(entries: Column) -> Column:
    """The confidence of each entry, one where it is missing, null or no number."""
    return F.transform(entries, lambda e: F.coalesce(value(e, "confidence").try_cast("double"), F.lit(1.0)))


def min_confidence(entries: Column) -> Column:
    """The least confidence; one without entries."""
    return F.coalesce(F.array_min(confidences(entries)), F.lit(1.0))
