"""JSON that must match Python's to the byte: parsing of model responses, and serialising. Arrow-batched.

These are the only Python functions outside labeling: Spark's own JSON functions accept trailing text, lose
number lexemes and escape differently.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.entries import let
from windrow.schemas import LABELED, NOTICE_FIELDS

REPAIRED = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("entries", T.ArrayType(T.StringType())), T.StructField("min_confidence", T.DoubleType()), T.StructField("odd_confidence", T.BooleanType())])


#: Made once: ``json.dumps`` makes an encoder for each call that has options.
_AS_IS = json.JSONEncoder(ensure_ascii=False)


def unescaped(value: object) -> str:
    """JSON as Python writes it, characters beyond ASCII as they are, unless they are halves of pairs that no file could hold."""
    text = _AS_IS.encode(value)
    if text.isascii():
        return text
    try:
        text.encode()
    except UnicodeEncodeError:
        return json.dumps(value)
    return text


def repair(text: str | None) -> tuple[bool, list[str], float, bool]:
    """Entries of a response: all of it as JSON, or else its widest list, or else its widest object.

    A list that is there but is no JSON fails without a look at objects. Responses whose entries
    are not all objects fail. Null confidences count as one, and are flagged.
    """
    failed = (False, [], 1.0, False)
    content = (text or "").strip()
    try:
        try:
            found = json.loads(content)
        except ValueError:
            if hit := re.search(r"\[.*\]", content, re.DOTALL):
                found = json.loads(hit[0])
            elif hit := re.search(r"\{.*\}", content, re.DOTALL):
                found = [json.loads(hit[0])]
            else:
                return failed
    except (ValueError, RecursionError):
        return failed
    if found == "" and isinstance(found, str):
        return True, [], 1.0, False
    entries = [found] if isinstance(found, dict) else found
    if not isinstance(entries, list) or not all(isinstance(e, dict) for e in entries):
        return failed
    given = [e.get("confidence", 1.0) for e in entries]
    if any(isinstance(c, str | list | dict) for c in given):
        return failed
    odd = any(c is None for c in given)
    least = min((1.0 if c is None else float(c) for c in given), default=1.0)
    return True, [unescaped(e) for e in entries], least, odd


#: How Python writes the control characters that Spark writes otherwise, after Spark's way.
CONTROLS = {f"\\u{n:04X}": f"\\u{n:04x}" for n in range(32) if f"{n:04X}" != f"{n:04x}"}


def quoted(text: Column) -> Column:
    """A JSON string as Python writes it, characters beyond ASCII as they are; or null."""
    inner = let(F.to_json(F.array(text)), lambda w: w.substr(F.lit(2), F.length(w) - 2))
    odd = reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), CONTROLS.items(), F.replace(inner, F.lit("\\\\"), F.lit("\x00")))
    held = F.when(text.rlike(r"[\x0a-\x1f]") & text.rlike(r"[\x0b\x0e\x0f\x1a-\x1f]"), F.replace(odd, F.lit("\x00"), F.lit("\\\\"))).otherwise(inner)
    return F.coalesce(F.when(text.isNotNull(), held), F.lit("null"))


@F.pandas_udf(T.StringType())
def message_list(roles: pd.Series, contents: pd.Series) -> pd.Series:
    """Messages as a list of objects with role and content, as Python writes it."""
    made = ([{"role": r, "content": c} for r, c in zip(some, texts, strict=True)] for some, texts in zip(roles, contents, strict=True))
    return pd.Series([unescaped(m) for m in made], dtype=object)


def python_float(number: Column) -> Column:
    """A float as Python writes it: the shortest digits that read back the same, with an exponent from 1e16 up and below 1e-4. Null stays null."""

    def written(short: Column) -> Column:
        exact = F.when(short.cast("double") == number, short).otherwise(F.format_string("%.16e", number))
        return let(exact, placed)

    def placed(e: Column) -> Column:
        sign = F.when(e.startswith("-"), "-").otherwise("")
        power = F.substring_index(e, "e", -1).try_cast("int")
        digits = F.regexp_replace(F.regexp_replace(F.substring_index(e, "e", 1), "[-.]", ""), "0+$", "")
        size, rest = F.abs(power).cast("string"), F.substr(digits, F.lit(2))
        wide = F.concat(F.substring(digits, 1, 1), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.when(power < 0, "e-").otherwise("e+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
        after = F.substr(digits, power + 2)
        whole = F.concat(F.rpad(F.substr(digits, F.lit(1), power + 1), power + 1, "0"), F.lit("."), F.when(after == "", "0").otherwise(after))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        return F.concat(sign, F.when((power >= 16) | (power < -4), wide).when(power >= 0, whole).otherwise(small))

    def hundredths(n: Column) -> Column:
        # two digits behind the point that read back the same are the shortest there are
        size, rest = F.abs(n), F.abs(n) % 100
        digits = F.when(rest % 10 == 0, (rest / 10).cast("int").cast("string")).otherwise(F.lpad(rest.cast("string"), 2, "0"))
        short = F.concat(F.when(n < 0, "-").otherwise(""), F.floor(size / 100).cast("string"), F.lit("."), digits)
        return F.when((F.abs(number) < 1e9) & (n != 0) & (n / 100 == number), short).otherwise(let(F.format_string("%.15e", number), written))

    endless = F.when(number > 0, "Infinity").otherwise("-Infinity")
    return F.when(number.isNull(), None).when(F.isnan(number), "NaN").when(F.abs(number) == float("inf"), endless).otherwise(let(F.rint(number * 100).try_cast("long"), hundredths))


def json_value(value: Column, kind: T.DataType) -> Column:
    """A value of any type as Python's ``json.dumps(..., ensure_ascii=False)`` writes it: structs and maps as objects, arrays as lists, null fields kept.

    Dates, times and binary values are strings, as Spark writes them.
    """
    held = _json_value(value, kind)
    return F.coalesce(F.when(value.isNotNull(), held), F.lit("null"))


def _json_value(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return quoted(value)
    if isinstance(kind, T.StructType):
        return json_object({f.name: json_value(value[f.name], f.dataType) for f in kind.fields}) if kind.fields else F.lit("{}")
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: json_value(x, kind.elementType)), ", "), F.lit("]"))
    if isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.concat(quoted(e.key.cast("string")), F.lit(": "), json_value(e.value, kind.valueType)))
        return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
    if isinstance(kind, T.DoubleType | T.FloatType):
        return python_float(value if isinstance(kind, T.DoubleType) else value.cast("string").cast("double"))
    if isinstance(kind, T.IntegralType | T.BooleanType | T.DecimalType):
        return value.cast("string")
    return let(F.to_json(F.array(value)), lambda w: w.substr(F.lit(2), F.length(w) - 2))


def json_object(fields: dict[str, Column]) -> Column:
    """An object of JSON values, with a space after each comma and colon."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f"{json.dumps(k, ensure_ascii=False)}: "), v) for k, v in fields.items()]), F.lit("}"))


@F.pandas_udf(REPAIRED)
def repair_response(responses: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([repair(r) for r in responses], columns=["ok", "entries", "min_confidence", "odd_confidence"])


def runway_text(entry: dict) -> str | None:
    """How Python prints an entry's runway; null where that is false."""
    runway = entry.get("runway")
    return str(runway) if runway else None


@F.pandas_udf(T.StringType())
def runway_of(entries: pd.Series) -> pd.Series:
    return pd.Series([runway_text(json.loads(raw)) for raw in entries], dtype=object)


RENDERED = T.StructType([T.StructField("runway", T.StringType()), T.StructField("response", T.StringType())])


def example_text(head: tuple[str, ...], body: dict[str, object], tail: tuple[str, ...]):
    """A function of a raw entry and a struct of texts and booleans, which parses the entry once.

    Its response is an object of the struct's fields named in ``head`` (``runway`` comes from the entry), the entry's fields of ``body`` with a
    value for those that are missing, and those of ``tail``, in Python's ASCII form. Its runway is how Python prints the entry's, null where that is false.
    """

    @F.pandas_udf(RENDERED)
    def run(entries: pd.Series, notice: pd.DataFrame) -> pd.DataFrame:
        names, start = list(notice.columns), {**dict.fromkeys(head), **body, **dict.fromkeys(tail)}
        listed, own = [k for k in tail if k in names], ({"runway", *body, *tail} & start.keys()) - set(names)
        runways, responses = [], []
        for raw, *values in zip(entries, *(notice[k] for k in names), strict=True):
            e = json.loads(raw)
            fields = start | dict(zip(names, values, strict=True))
            for k in listed:
                fields[k] = [fields[k]]
            for k in own & e.keys():
                fields[k] = e[k]
            runways.append(runway_text(e))
            responses.append(json.dumps(fields))
        return pd.DataFrame({"runway": runways, "response": responses}, dtype=object)

    return run


LINE = T.StructType([*LABELED.fields, T.StructField("ok", T.BooleanType())])


def labeled_item(line: str | None) -> tuple:
    """The labeled item of a line of JSON; not ok if it is none, or no object. Entries keep all that Python's own reading keeps."""
    try:
        item = json.loads(line or "")
    except (ValueError, RecursionError):
        item = None
    if not isinstance(item, dict):
        return (*[None] * len(LABELED.fields), False)
    text = lambda v: v if v is None or isinstance(v, str) else unescaped(v)
    entries, least = item.get("runway_entries"), item.get("min_confidence")
    number = float(least) if isinstance(least, int | float) and not isinstance(least, bool) else None
    return (*(text(item.get(f)) for f in NOTICE_FIELDS), [unescaped(e) for e in entries] if isinstance(entries, list) else None, number, True)


@F.pandas_udf(LINE)
def labeled_line(lines: pd.Series) -> pd.DataFrame:
    found = pd.DataFrame([labeled_item(x) for x in lines], columns=LINE.fieldNames(), dtype=object)
    return found.astype({"ok": bool, "min_confidence": float})


def set_fields(rows: DataFrame, entries: str, fields: str) -> DataFrame:
    """``rows`` with each entry's given fields replaced, without ``fields``: for each entry a JSON object of the new values."""

    def one(raw: list[str] | None, new: list[str | None] | None) -> list[str] | None:
        if raw is None:
            return None
        return [e if not n or n == "{}" else unescaped({**json.loads(e), **json.loads(n)}) for e, n in zip(raw, new, strict=True)]

    kept = [f for f in rows.schema if f.name != fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            both = zip(columns[entries].to_pylist(), columns[fields].to_pylist(), strict=True)
            columns[entries] = pa.array([one(e, n) for e, n in both], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in kept], names=[f.name for f in kept])

    return rows.mapInArrow(run, T.StructType(kept))
