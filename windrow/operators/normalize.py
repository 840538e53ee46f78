"""Repair of labeled entries: coordinates, bearings, and the runway that means all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from windrow.functions.bearings import is_unread_bearing, parse_bearing
from windrow.functions.coordinates import is_decimal, parse_coordinate
from windrow.functions.entries import is_string, kind_in, let, let_parsed, text_in, truthy, truthy_in, truthy_text, value
from windrow.functions.json_text import python_float, set_fields
from windrow.shared import materialize


ISSUES = ("all_runways", "coordinates", "bearings")


def issues_of(entry: Column, parsed: Column) -> dict[str, Column]:
    """What needs repair in an entry that is parsed already."""
    coordinates, bearing = text_in(parsed, entry, "obstacleCoordinates"), text_in(parsed, entry, "obstacleBearing")
    no = F.lit(False)
    found = (
        F.coalesce(text_in(parsed, entry, "runway") == "ALL", no),
        F.when(coordinates.isNotNull() & ~is_decimal(coordinates), truthy_in(parsed, entry, "obstacleCoordinates")).otherwise(no),
        F.when(bearing.isNotNull() & is_unread_bearing(bearing), F.coalesce(kind_in(parsed, "obstacleBearing") == "STRING", no) & (bearing != "")).otherwise(no),
    )
    return dict(zip(ISSUES, found, strict=True))


def issue_counts(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """Entries in need of each repair, over the whole table."""
    rows = labeled.select(F.explode(entries).alias("e"))
    found = rows.select(let_parsed(F.col("e"), lambda p: F.struct(*[c.alias(n) for n, c in issues_of(F.col("e"), p).items()])).alias("found"))
    return found.agg(*[F.count_if(F.col("found")[n]).alias(n) for n in ISSUES])


COUNTS = ("all_remaining", "decimal_coordinates", "numeric_bearings")


def _is_number(kind: Column) -> Column:
    return ~kind.isin("STRING", "BOOLEAN", "VOID") & ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT")


def repaired_counts(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """After a repair: runways that still mean all, decimal coordinates, numeric bearings."""
    e = F.col("e")

    def flags(parsed: Column) -> Column:
        decimal = is_decimal(text_in(parsed, e, "obstacleCoordinates")) & truthy_in(parsed, e, "obstacleCoordinates")
        found = (text_in(parsed, e, "runway") == "ALL", decimal, _is_number(kind_in(parsed, "obstacleBearing")))
        return F.struct(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in zip(COUNTS, found, strict=True)])

    found = labeled.select(F.explode(entries).alias("e")).select(let_parsed(e, flags).alias("found"))
    return found.agg(*[F.count_if(F.col("found")[n]).alias(n) for n in COUNTS])


def _is_unread(entry: Column) -> Column:
    """Whether Spark's parser does not read an entry, as one with NaN or with a key given twice."""
    return entry.isNotNull() & F.try_parse_json(entry).isNull()


def _repaired_values(labeled: DataFrame, entries: str) -> DataFrame:
    """A row for each entry that Spark's parser reads: whether it needs a repair, and what is counted of its values, as they are (``now``) and repaired (``then``).

    Each step is a projection of its own: Spark compiles it, and computes each of its values once.
    """
    fields = {"runway": "runway", "place": "obstacleCoordinates", "bearing": "obstacleBearing"}
    rows = labeled.select(F.explode(entries).alias("e")).select("e", F.try_parse_json("e").alias("parsed"))
    rows = rows.select((F.col("e").isNotNull() & F.col("parsed").isNull()).alias("unread"), *[F.try_variant_get("parsed", f"$.{f}", "variant").alias(n) for n, f in fields.items()])
    kinds = [F.schema_of_variant(n).alias(f"{n}_kind") for n in ("place", "bearing")]
    rows = rows.select("unread", *[F.try_variant_get(n, "$", "string").alias(n) for n in fields], *kinds)

    runway, place, bearing, kind = F.col("runway"), F.col("place"), F.col("bearing"), F.col("bearing_kind")
    rows = rows.select("*", truthy_text(place, F.col("place_kind")).alias("placed"), truthy_text(bearing, kind).alias("turned"), is_decimal(place).alias("decimal"))
    unknown = (kind == "STRING") & (bearing != "") & is_unread_bearing(bearing)
    read = F.when((F.col("place_kind") == "STRING") & (place != "") & ~F.col("decimal"), parse_coordinate(place))
    rows = rows.withColumn("issue", (runway == "ALL") | (F.col("placed") & ~F.col("decimal")) | unknown).withColumn("read", read).withColumn("degrees", F.when(F.col("turned"), parse_bearing(bearing)))

    now = (runway == "ALL", F.col("decimal") & F.col("placed"), _is_number(kind))
    then = (F.when(runway != "ALL", runway) == "ALL", F.when(F.col("read").isNotNull(), is_decimal(F.col("read"))).otherwise(now[1]), F.when(F.col("turned"), F.col("degrees").isNotNull()).otherwise(now[2]))
    return rows.select("unread", "issue", F.struct(*[c.alias(n) for n, c in zip(COUNTS, now, strict=True)]).alias("now"), F.struct(*[c.alias(n) for n, c in zip(COUNTS, then, strict=True)]).alias("then"))


def counted_repair(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """The :func:`repaired_counts` of :func:`fix`, without a row written: values are repaired and counted as they are read, in the one pass that finds the issues of the table-wide gate.

    Entries that Spark's parser does not read are written, repaired by :func:`fix_entries` and counted after that. ``labeled`` is evaluated a second time for them alone, if there are any.
    """
    sums = [F.count_if(F.col(state)[n]).alias(f"{state}_{n}") for state in ("now", "then") for n in COUNTS]
    found = _repaired_values(labeled, entries).agg(F.count_if("unread").alias("unread"), F.count_if("issue").alias("issues"), *sums).first()
    odd = None
    if found.unread:
        odd = materialize(labeled.select(F.filter(entries, _is_unread).alias(entries)).where(F.size(entries) > 0), "odd")
    open_gate = found.issues or (odd is not None and any(issue_counts(odd, entries).first()))
    counts = {n: found[f"{'then' if open_gate else 'now'}_{n}"] for n in COUNTS}
    if odd is not None:
        rest = repaired_counts(fix_entries(odd, entries) if open_gate else odd, entries).first()
        counts = {n: k + rest[n] for n, k in counts.items()}
    return labeled.sparkSession.range(1).select(*[F.lit(k).cast("long").alias(n) for n, k in counts.items()])


def _json_string(text: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")


def _degrees_json(bearing: Column) -> Column:
    """The bearing's new JSON value. Compass points of the eight-part rose are integers, all other degrees floats."""
    whole = ~bearing.rlike("[0-9]")

    def written(d: Column) -> Column:
        endless = F.when(d > 0, "Infinity").otherwise("-Infinity")
        return F.when(d.isNull(), "null").when(F.isnan(d), "NaN").when(F.abs(d) == float("inf"), endless).when(whole & (d % 45 == 0), d.cast("long").cast("string")).otherwise(python_float(d))

    return let(parse_bearing(bearing), written)


def _changes(entry: Column, parsed: Column) -> Column:
    """A JSON object of the fields that a repair sets in an entry that is parsed already."""
    text = lambda field: text_in(parsed, entry, field)
    runway = F.when(text("runway") == "ALL", F.lit('"runway": null'))
    named = kind_in(parsed, "obstacleCoordinates") == "STRING"
    coordinates = let(text("obstacleCoordinates"), lambda v: F.when((v != "") & named, F.concat(F.lit('"obstacleCoordinates": '), _json_string(parse_coordinate(v)))))
    turned = F.when(truthy_in(parsed, entry, "obstacleBearing"), let(text("obstacleBearing"), lambda v: F.concat(F.lit('"obstacleBearing": '), _degrees_json(v))))
    return F.concat(F.lit("{"), F.concat_ws(", ", runway, coordinates, turned), F.lit("}"))


def fix_entries(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """Every entry repaired: ALL becomes null, coordinates decimal, truthy bearings degrees (or null). Other fields stay as they are."""
    changes = F.transform(entries, lambda e: let_parsed(e, lambda p: _changes(e, p)))
    return set_fields(labeled.withColumn("__changes", changes), entries, "__changes")


def unrepaired(labeled: DataFrame, entries: str = "runway_entries", key: str = "notam_id") -> DataFrame:
    """What a repair cannot read, a row for each: notam_id, entry_idx, field, problem and value.

    ``not_text``: coordinates that are neither text nor empty; they stay as they are. ``unread``: coordinates in no known notation; they
    stay too, so that each later run finds them in need of repair again. ``lost``: bearings that a repair sets to null.
    """
    rows = labeled.select(F.col(key).alias("notam_id"), F.posexplode(entries).alias("entry_idx", "e"))
    e = F.col("e")
    odd = let(value(e, "obstacleCoordinates"), lambda v: F.when(~is_decimal(v), F.when(~is_string(e, "obstacleCoordinates"), F.when(truthy(e, "obstacleCoordinates"), "not_text")).when((v != "") & (parse_coordinate(v) == v), "unread")))
    lost = let(value(e, "obstacleBearing"), lambda v: F.when(v.isNotNull() & parse_bearing(v).isNull() & truthy(e, "obstacleBearing"), "lost"))
    found = [F.struct(F.lit(f).alias("field"), problem.alias("problem"), value(e, f).alias("value")) for f, problem in (("obstacleCoordinates", odd), ("obstacleBearing", lost))]
    listed = rows.select("notam_id", "entry_idx", F.explode(F.filter(F.array(*found), lambda x: x.problem.isNotNull())).alias("x"))
    return listed.select("notam_id", "entry_idx", "x.field", "x.problem", "x.value")


def fix_counted(labeled: DataFrame, entries: str = "runway_entries") -> tuple[DataFrame, dict[str, int]]:
    """All rows repaired if the table as a whole has any issue, and none otherwise; and the entries in need of each repair.

    Rows are written once, with what a repair would set, and the issues are counted while they are: the gate needs no run of its own, and ``labeled`` is evaluated once.
    """
    seen = Observation("issues")

    def repair(e: Column) -> Column:
        return let_parsed(e, lambda p: F.struct(_changes(e, p).alias("changes"), *[c.alias(n) for n, c in issues_of(e, p).items()]))

    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.coalesce(F.size(F.filter(F.col("__repair"), lambda r: r[name])), F.lit(0))), F.lit(0)).alias(name)

    seen_rows = labeled.withColumn("__repair", F.transform(entries, repair)).observe(seen, *[count(name) for name in ISSUES])
    rows = materialize(seen_rows.withColumn("__changes", F.transform("__repair", lambda r: r.changes)).drop("__repair"), "fix")
    found = dict(seen.get)
    return (set_fields(rows, entries, "__changes") if any(found.values()) else rows.drop("__changes")), found


def fix(labeled: DataFrame, entries: str = "runway_entries") -> DataFrame:
    """The rows of :func:`fix_counted`."""
    return fix_counted(labeled, entries)[0]
