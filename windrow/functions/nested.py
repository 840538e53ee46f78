"""Filters and values deep inside JSON documents, as variants: each document is parsed once, and paths are read from it.

A value is a variant at a path; missing and null are the same. Paths are written like ``$.attributes.version``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at(doc: Column, path: str) -> Column:
    """The value at a path; null if it is missing."""
    return F.try_variant_get(doc, path, "variant")


def kind(doc: Column, path: str) -> Column:
    """The type of the value at a path, such as STRING, BIGINT or ARRAY<...>; null for missing and null."""
    return F.nullif(F.schema_of_variant(at(doc, path)), F.lit("VOID"))


def text(doc: Column, path: str) -> Column:
    """The value as a text: strings as they are, all else as JSON."""
    return F.try_variant_get(doc, path, "string")


def equals(doc: Column, path: str, wanted: str) -> Column:
    """Whether there is a string at the path, and this one; never null. A number with the same digits is no such string."""
    return F.coalesce((kind(doc, path) == "STRING") & (text(doc, path) == wanted), F.lit(False))


def or_else(doc: Column, path: str, default: str) -> Column:
    """The value as a text, or the default where it is missing, null or false."""
    no = kind(doc, path).isNull() | ((kind(doc, path) == "BOOLEAN") & (text(doc, path) == "false"))
    return F.when(no, default).otherwise(text(doc, path))


def prefix(doc: Column, path: str, n: int) -> Column:
    """The first ``n`` characters of a string; null for all else."""
    return F.when(kind(doc, path) == "STRING", F.substring(text(doc, path), 1, n))


def length(doc: Column, path: str) -> Column:
    """Characters of a string, items of an array, keys of an object, 0 for missing and null; null for numbers and booleans."""
    k = kind(doc, path)
    found = (
        F.when(k.isNull(), 0)
        .when(k == "STRING", F.char_length(text(doc, path)))
        .when(k.startswith("ARRAY"), F.size(F.try_variant_get(doc, path, "array<variant>")))
        .when(k.startswith("OBJECT"), F.size(F.try_variant_get(doc, path, "map<string,variant>")))
    )
    return found.cast("long")


def select_items(rows: DataFrame, json: str, path: str, where: Callable[[Column], Column], item: str = "item") -> DataFrame:
    """A row for each item of the array at ``path`` that meets ``where``, with the item in place of the text ``json``.

    Texts that are null or no JSON, and those without an array there, give no rows.
    """
    kept = [c for c in rows.columns if c != json]
    items = rows.select(*kept, F.explode(F.try_variant_get(F.try_parse_json(json), path, "array<variant>")).alias(item))
    return items.where(where(F.col(item)))
