"""Rules on fixed inputs, against plain Python, and on files."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from windrow.functions import bearings, coordinates, entries, json_text, keywords
from windrow.operators import classify, examples, labels, metrics, normalize, order, review
from windrow.plans.prepare import Prepare
from windrow.schemas import ENTRY_FIELDS, LABELED, NOTICE
from windrow.sources import files, pages
from windrow.streaming import incremental


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select(f(F.col("v")), "i").orderBy("i").collect()]


TEXTS = {
    "RWY 09/27 CLSD": "has_relevant_keyword", "TWY A CLSD": "taxiway_only", "twy b clsd": "taxiway_only", "TWY B CLSD BTN RWY 09 AND APRON": "has_relevant_keyword",
    "RWY 18 THR DSPLCD 500FT AT TWY C": "taxiway_only", "TWY C CLSD\nRWY 18 OPEN": "taxiway_only", "TWYA CLSD": "has_relevant_keyword", "RWY 04 ILS U/S": "navigation_only",
    "RUNWAY 27 PAPI INOP": "navigation_only", "RWY 04 ILS U/S RWY CLSD": "has_relevant_keyword", "RWY 04 ILS CAT II ONLY": "has_relevant_keyword", "VOR OUT OF SERVICE": "navigation_only",
    "BLDGS LIT": "navigation_only", "CRANE 200FT AGL LOCATED 1NM N": "navigation_only", "CRANE 200FT AGL": "has_relevant_keyword", "SNOW REMOVAL STARTED": "navigation_only",
    "FUEL SERVICE LIMITED": "has_relevant_keyword", "BIRD ACTIVITY": "no_relevant_keywords", " \t\n": "empty_text", " ": "empty_text", None: "empty_text",
}


def test_classification(spark):
    assert column(spark, list(TEXTS), classify.reason) == list(TEXTS.values())
    assert column(spark, ["RWY 18 AT TWY C", "TWY C"], lambda t: classify.reason(t, strict_taxiway=True)) == ["has_relevant_keyword", "taxiway_only"]


def test_taxiway_rule_is_pythons(spark):
    random.seed(1)
    texts = ["".join(random.choices(["TWY", "RWY", "twy", " ", "\n", "\r", " ", "é", "A", "."], k=8)) for _ in range(3000)]
    expected = [bool(re.search(r"\bTWY\b(?!.*\bRWY\b)", t, re.IGNORECASE)) for t in texts]
    assert column(spark, texts, keywords.is_taxiway_only) == expected


def test_canceled(spark):
    assert column(spark, ["RWY 09 CLSD CNL", "rwy closure withdrawn", "RWY 09 CLSD", None], keywords.is_canceled) == [True, True, False, False]


COORDINATES = {
    "6449N14751W": "64.8167, -147.8500", "010641N1040624E": "1.111389, 104.106667", "101529.6N1235820.2E": "10.258222, 123.972278", "243433.9N 814228.8W": "24.576083, -81.708000",
    "243433.9N0814228.8W": "24.576083, -81.708000", "64°49'N 147°51'W": "64.8167, -147.8500", "N24 34 33.9/W81 42 28.8": "24.576083, -81.708000",
    "37°5'7.3\"N, 127°2'26.1\"E": "37.085361, 127.040583", "35°44'50.6\"N 139°20'37.6\"E": "35.747389, 139.343778", "N521603.9 E1042055.1": "52.267750, 104.348639",
    "363818.4N 0062043,6W": "36.638444, -6.345444", "4500511S1684416E": "-45.014194, 168.737778", "6449N14751W005": "64.8167, -147.8500", "5022N00330E - 5030N00400E": "50.3667, 3.5000",
    "0000S00000W": "-0.0000, -0.0000", "37.1, -122.2": "37.1, -122.2", "garbage": "garbage", "": None, None: None,
}


def test_coordinates(spark):
    assert column(spark, list(COORDINATES), coordinates.parse_coordinate) == list(COORDINATES.values())


def test_bearings(spark):
    given = {"N": 0.0, "nne": 22.5, "SW": 225.0, "NNW": 337.5, "180": 180.0, " 90 ": 90.0, "NORTH": None, "18d": None, "1_000": 1000.0, "-5.5": -5.5, None: None}
    assert column(spark, list(given), bearings.parse_bearing) == list(given.values())


REPAIRS = [
    ('[{"runway":"09","confidence":0.9}]', 1, 0.9), ('{"runway":"09"}', 1, 1.0), ("[]", 0, 1.0), ('so: [{"confidence":0.5},{"confidence":0.7}]', 2, 0.5), ('so: {"runway":"09"}', 1, 1.0),
    ('so: {"runway":"09","contaminations":[]}', 0, 1.0), ("so: [1, {] x", None, None), ("no json", None, None), ("5", None, None), ("null", None, None), ("[1]", None, None), ('""', 0, 1.0),
    ('[{"confidence":null}]', 1, 1.0), ('```json\n[{"runway":"09"}]\n```', 1, 1.0), (None, None, None),
]


def test_repair(spark):
    got = column(spark, [r[0] for r in REPAIRS], json_text.repair_response)
    assert [(len(g.entries), g.min_confidence) if g.ok else (None, None) for g in got] == [r[1:] for r in REPAIRS]


def test_truth_is_pythons(spark):
    values = [None, 0, 0.0, -0.0, 1, 0.5, "", "0", "false", "x", True, False, [], [1], {}, {"a": 1}]
    texts = [json.dumps({"f": v}) for v in values] + ["{}"]
    assert column(spark, texts, lambda e: entries.truthy(e, "f")) == [bool(v) for v in values] + [False]


def item(spark, *raw, text="RWY 09 CLSD", key="1"):
    return spark.createDataFrame([(key, "KJFK", text, "a", None, list(raw), 1.0)], LABELED)


def test_gate(spark):
    clean = item(spark, '{"obstacleBearing": "180", "runway": "09"}')
    assert normalize.fix(clean).collect() == clean.collect()
    dirty = item(spark, '{"obstacleBearing": "180", "runway": "ALL", "TORA": 500}', '{"obstacleBearing": 0, "obstacleCoordinates": "6449N14751W"}', '{"obstacleBearing": "NORTH"}')
    assert [json.loads(e) for e in normalize.fix(dirty).first().runway_entries] == [{"obstacleBearing": 180.0, "runway": None, "TORA": 500}, {"obstacleBearing": 0, "obstacleCoordinates": "64.8167, -147.8500"}, {"obstacleBearing": None}]


def test_response_is_pythons(spark):
    entry = {"runway": ["09", "27"], "TORA": 500, "TODA": 500.5, "notes": 'é "x"\n😀\x7f', "contaminations": [{"type": "ice", "depth": None}], "runwayClosed": True}
    made = examples.examples(item(spark, json.dumps(entry), "{}", text="RWY é CNL"))
    rows = made.orderBy("entry_idx").collect()
    for row, e in zip(rows, (entry, {}), strict=True):
        expected = {"airportID": "KJFK", "runway": e.get("runway"), "effectiveStart": "a", "effectiveEnd": None, "isCanceled": True}
        expected |= {f: e.get(f, [] if f == "contaminations" else None) for f in ENTRY_FIELDS if f not in ("runway", "confidence", "notes")}
        expected |= {"sourceNOTAMIds": ["1"], "notes": e.get("notes")}
        assert row.assistant == json.dumps(expected) and len(expected) == 30
    assert "Runway: ['09', '27']\n" in rows[0].user and "Runway: ALL\nEffective: a to None" in rows[1].user


@pytest.mark.parametrize(("n", "sizes"), [(0, (0, 0, 0)), (1, (0, 0, 1)), (9, (7, 0, 2)), (10, (8, 1, 1)), (19, (15, 1, 3)), (1000, (800, 100, 100))])
def test_split_sizes(spark, n, sizes):
    got = {r.split: r.n for r in examples.split_counts(examples.exact_split(spark.range(n), "id")).collect()}
    assert tuple(got.get(s, 0) for s in ("train", "valid", "test")) == sizes


def test_positions(spark):
    rows = order.with_position(spark.range(500).withColumn("k", F.col("id") % 7), [F.col("k"), F.desc("id")], "at").orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(500)) and rows[0].id == 497


def test_resume(spark):
    source = spark.createDataFrame([("1",), (None,), ("7",), ("7",)], "notam_id string")
    done = spark.createDataFrame([(None,)], "notam_id string")
    assert sorted(r[0] for r in labels.pending(source, done).collect()) == ["1", "7", "7"]


def test_patches(spark):
    rows = item(spark, '{"runway": "09", "confidence": 0.5}', '{"runway": "27"}').unionByName(item(spark, "{}", key="2"))
    patches = spark.createDataFrame(
        [("1", 1, 1, "set", "TORA", "500"), ("1", 2, 1, "set", "LDA", "bad"), ("1", 3, 2, "contamination_add", None, '{"type": "ice", "coverage": "80"}'), ("1", 4, 2, "contamination_add", None, '{"type": "lava"}'), ("1", 5, 9, "delete", None, None), ("1", 6, None, "add", None, None)],
        "notam_id string, seq int, entry_idx int, op string, field string, value string",
    )
    got = {r.notam_id: r for r in review.apply_patches(rows, patches).collect()}
    first = [json.loads(e) for e in got["1"].runway_entries]
    assert first[0] == {"runway": "09", "confidence": 0.5, "TORA": 500.0, "LDA": None}
    assert first[1]["contaminations"] == [{"type": "ice", "coverage": 80, "depth": None, "depthUnits": None}] and first[2] == review.DEFAULT_ENTRY
    assert got["1"].min_confidence == 0.5 and got["2"].runway_entries == ["{}"]


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"notam_id":"1"}\n\nBAD{\n{"notam_id":"2"}\n[1]\n')
    assert files.read_lines(spark, str(tmp_path / "a.jsonl"), NOTICE).count() == 2
    (tmp_path / "a.json").write_text('[{"notam_id": "1", "x": 2}, {"notam_text": "é"}]')
    assert [r.notam_text for r in files.read_array(spark, str(tmp_path / "a.json")).collect()] == [None, "é"]
    with pytest.raises(files.MissingSource):
        files.read_array(spark, str(tmp_path / "none"))
    path = str(tmp_path / "silver")
    files.write_labeled(item(spark, '{"TORA": 500.0, "runway": "ALL"}'), path)
    files.replace(normalize.fix(files.read_labeled(spark, path)), path)
    assert files.read_labeled(spark, path).first().runway_entries == ['{"TORA": 500.0, "runway": null}'] and files.line_count(spark, path) == 1


RAW = [
    '{"runway": "09", "TORA": 1e5, "notes": "é \\u00e9 \\"q\\" \\n / \\u2028", "n": 12345678901234567890, "x": 0.00001, "y": -0.0, "z": 1e22, "w": 1.10, "l": [1, {"a": []}, null, true]}',
    '{}', '{"a": {"b": "c,d: e"}, "runway": "ALL"}', '{"half": "\\ud800"}',
]


def test_lines_after_a_round_trip_are_pythons(spark, tmp_path):
    """Read, write, fix and write again: bytes are those of Python's own reading and writing."""
    item = {"notam_id": "1", "icao_location": None, "notam_text": "t é \x01\x1f\x7f\b\f \\", "effective_start": "a", "effective_end": "b", "runway_entries": [json.loads(r) for r in RAW], "min_confidence": 0.85}
    (tmp_path / "in").write_text(json.dumps(item) + "\n[1]\nBAD\n\n" + '{"notam_id": 5, "runway_entries": null}\n')
    path = str(tmp_path / "out")
    files.write_labeled(files.read_labeled(spark, str(tmp_path / "in")), path)
    odd = {f: None for f in LABELED.fieldNames()} | {"notam_id": "5"}
    whole = json.dumps(item, ensure_ascii=False).replace("\ud800", "\\ud800")
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted([whole, json.dumps(odd)])
    files.replace(normalize.fix(files.read_labeled(spark, path)), path)
    item["runway_entries"][2]["runway"] = None
    assert json.dumps(item, ensure_ascii=False).replace("\ud800", "\\ud800") in [r.value for r in spark.read.text(path).collect()]


def test_values_of_any_type_as_python_writes_them(spark):
    rng = random.Random(5)
    floats = [0.0, -0.0, 1.0, 0.1, 1e7, 12345678.9, 1e15, 1e16, 123456789012345680.0, 1e22, 1e-3, 0.00012, 1e-4, 9.99e-5, 1e-5, -2.5e-7, 1.5e300, float("inf"), float("-inf")]
    floats += [round(rng.uniform(-1, 1) * 10 ** rng.randint(-9, 25), rng.randint(0, 9)) for _ in range(200)]
    got = column(spark, floats, json_text.python_float, "double")
    assert got == [json.dumps(x) for x in floats]
    assert column(spark, [float("nan"), None], json_text.python_float, "double") == ["NaN", None]
    schema = "s struct<a: int, b: array<struct<c: string, d: double>>, m: map<string, array<double>>>, n: boolean"
    row = ({"a": None, "b": [{"c": 'q"é', "d": 1e20}, None], "m": {"k": [0.5, None]}}, True)
    df = spark.createDataFrame([row, (None, None)], schema.replace(", n: boolean", ", n boolean"))
    made = [r[0] for r in df.select(json_text.json_value(F.struct("s", "n"), df.schema)).collect()]
    assert made == [json.dumps({"s": row[0], "n": True}, ensure_ascii=False), '{"s": null, "n": null}']


class Flaky(pages.PagedNotices):
    @classmethod
    def name(cls):
        return "flaky_notices"

    def fetch(self):
        bad = int(self.options.get("bad", "-1"))

        def fetch(limit, offset):
            if offset == bad:
                raise OSError("gone")
            return {"data": [{"notam_id": i} for i in range(offset, min(offset + limit, 250))], "pagination": {"total": 250}}

        return fetch


@pytest.mark.parametrize(("bad", "n"), [("-1", 250), ("200", 200), ("100", 100)])
def test_pages(spark, bad, n):
    spark.dataSource.register(Flaky)
    rows = spark.read.format("flaky_notices").option("bad", bad).load().cache()
    assert pages.whole_prefix(rows).count() == n


def _stub(prompt):
    if "fail" in prompt:
        raise OSError("no answer")
    return '[{"runway": "ALL", "confidence": 0.7, "TORA": 500}]'


def test_preparation(spark, tmp_path):
    notices = [(str(i), "KJFK", t, "a", "b") for i, t in enumerate(["RWY 09 CLSD", "TWY A CLSD", "RWY 18 CLSD fail", "RWY 27 CLSD"])]
    plan = Prepare(spark, str(tmp_path), labeler=_stub, skip_download=False)
    assert plan.run(spark.createDataFrame(notices, NOTICE)) == {"train": 1, "test": 1}
    assert metrics.low_confidence(files.read_labeled(spark, plan.at("silver_dataset"))).count() == 2


def test_output_lines_are_pythons(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'é "q"\n/', 2, None)], "notam_id string, notam_text string, n int, x double")
    files.write_lines(rows, str(tmp_path / "lines"))
    assert [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == [json.dumps({"notam_id": "1", "notam_text": 'é "q"\n/', "n": 2, "x": None}, ensure_ascii=False)]
    pair = [{"role": "user", "content": "a\té"}, {"role": "assistant", "content": '{"k": 1}'}]
    made = examples.messages(spark.createDataFrame([("a\té", '{"k": 1}')], "user string, assistant string"))
    assert made.select(files.message_line(made.messages)).first()[0] == json.dumps(pair, ensure_ascii=False)
    files.export_array(spark.range(0, 5, 1, 3).withColumn("t", F.lit("é")), str(tmp_path / "array"))
    (part,) = (tmp_path / "array").glob("part-*")
    assert json.loads(part.read_text()) == [{"id": i, "t": "é"} for i in range(5)]


def test_quarantine_and_pages_in_the_plan(spark, tmp_path):
    spark.dataSource.register(Flaky)
    fetched = spark.read.format("flaky_notices").option("bad", "100").load()
    plan = Prepare(spark, str(tmp_path), labeler=lambda p: "no json", skip_download=False)
    assert sorted(plan.download(fetched).columns) == sorted(f.name for f in NOTICE.fields) and plan.download(fetched).count() == 100
    notices = spark.createDataFrame([("1", "KJFK", "RWY 09 CLSD", "a", "b")], NOTICE)
    assert plan.label(notices).count() == 0
    assert spark.read.json(plan.at("quarantine")).select("notam_id", "problem").collect() == [("1", "unreadable")]


def test_files_that_are_asked_about(spark, tmp_path):
    (tmp_path / "m_v1").write_text("one")
    (tmp_path / "m_v2").write_text("two")
    sums = {r.path.rpartition("/")[2]: (r.size, r.md5) for r in files.checksums(spark, str(tmp_path)).collect()}
    assert sums["m_v1"] == (3, "f97c5d29941bfb1b2fdab0874906ab82") and files.latest(spark, str(tmp_path)).count() == 1
    rows = spark.createDataFrame([("x/m_v2", 1, 8)], "p string, n int, of int")
    assert rows.select(files.version_of("p"), metrics.percent(rows.n, rows.of)).first() == ("2", "12.5")


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"notam_id": str(k), "notam_text": "RWY 09 CLSD"}) + "\n")
        incremental.classify_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
        incremental.label_stream(spark, str(tmp_path / "in"), _stub, str(tmp_path / "labels"), str(tmp_path / "c2")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 1
        assert files.read_labeled(spark, str(tmp_path / "labels")).count() == k + 1


BAD = [("contamination_add", None, '{"type": "ice", "coverage": "x"}'), ("contamination_add", None, '{"type": "ice", "coverage": 50.5}'), ("contamination_edit", "1", '{"coverage": "50.5"}'), ("contamination_edit", "1", "[1]"),
       ("contamination_edit", "one", "{}"), ("contamination_delete", None, None), ("add", None, "{"), ("set", "TORA", "wide"), ("set", None, "x"), ("odd", None, None), (None, None, None)]


def test_bad_patches_change_nothing_and_are_listed(spark):
    entry = json.dumps({"TORA": 500, "contaminations": [{"type": "ice", "coverage": 80, "depth": 1.0, "depthUnits": "in"}]})
    labeled = item(spark, entry)
    key = labeled.first().notam_id
    rows = [(key, i, 1, *p) for i, p in enumerate(BAD)]
    patches = spark.createDataFrame([*rows, (key, 99, 1, "contamination_edit", "1", '{"coverage": "null", "depth": "2", "depthUnits": "mm"}')], "notam_id string, seq int, entry_idx int, op string, field string, value string")
    after = json.loads(review.apply_patches(labeled, patches).first().runway_entries[0])
    assert after == {"TORA": 500, "contaminations": [{"type": "ice", "coverage": None, "depth": 2.0, "depthUnits": "mm"}]}
    assert sorted(r.seq for r in review.rejected(patches).collect()) == [*range(len(BAD))]


def test_view(spark):
    full = {"runway": "09", "runwayClosed": True, "takeoffShortening": 0, "landingShortening": 2.50, "landingShorteningUnits": "ft", "TORA": 1e5, "TODA": 0.0, "obstacleDistance": 3, "obstacleDistanceUnits": "NM", "obstacleBearing": 22.5, "obstacleReferencePoint": "THR",
            "contaminations": [{"type": "ice", "coverage": 0, "depth": 0.5, "depthUnits": "in"}, {}], "requiredClimbGradient": 4, "confidence": None, "notes": "n"}
    lines = ["  --- Runway Entry 1/2: 09 [CLOSED] ---", "  Shortening:", "    takeoffShortening: 0 ", "    landingShortening: 2.5 ft", "  Declared Distances:", "    TORA: 100000.0 ", "  Obstacle:", "    distance: 3 NM", "    bearing: 22.5°", "    reference: THR",
             "  Contaminations:", "    [1] ice, 0.5 in", "    [2] None", "  Climb:", "    requiredClimbGradient: 4 ", "  confidence: None", "  notes: n", "", "  --- Runway Entry 2/2: null ---", "  confidence: None"]
    rows = spark.createDataFrame([([json.dumps(full), "{}"],), ([],), (None,)], "runway_entries array<string>")
    assert [r.view for r in review.item_view(rows).collect()] == ["\n".join(lines), "", ""]


@pytest.mark.parametrize("run", [lambda df: normalize.fix(df), lambda df: examples.exact_split(df, "notam_id")])
def test_rows_are_computed_once(spark, run):
    """A gate over the whole table, and a sort by range, do not evaluate what they get twice."""
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    rows = item(spark, '{"runway": "ALL"}').crossJoin(spark.range(0, 200, 1, 4)).drop("id")
    assert run(rows.mapInArrow(counting, rows.schema)).count() == 200 and passed.value == 200


def test_fix_counts_its_issues(spark):
    fixed, issues = normalize.fix_counted(item(spark, '{"runway": "ALL", "obstacleBearing": "N"}', '{"obstacleCoordinates": "x"}'))
    assert issues == {"all_runways": 1, "coordinates": 1, "bearings": 1} and json.loads(fixed.first().runway_entries[0]) == {"runway": None, "obstacleBearing": 0}
    calm, none = normalize.fix_counted(item(spark, '{"obstacleBearing": 180}').unionByName(spark.createDataFrame([], LABELED)))
    assert not any(none.values()) and calm.first().runway_entries == ['{"obstacleBearing": 180}']
    empty, nothing = normalize.fix_counted(spark.createDataFrame([], LABELED))
    assert empty.count() == 0 and not any(nothing.values())


def test_cursor(spark, tmp_path):
    path = str(tmp_path / "queue")
    review.write_queue(spark.range(25).withColumn("c", F.col("id") % 5), "id", [F.col("c"), F.col("id")], path, per_bucket=10)
    read = review.at(spark, path, 12, 10)
    assert [r.id for r in read.collect()] == [12] and review.at(spark, path, 25, 10).isEmpty()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    steps = [(0, "n", 1), (0, "", 1), (0, "p", 0), (7, "p", 6), (9, " N ", 10), (24, "n", None), (3, "25", 24), (3, "26", 3), (3, "0", 3), (3, "x", 3), (3, "-1", 3), (3, "1", 0)]
    assert [review.step(spark, path, p, c, 10) for p, c, _ in steps] == [s for _, _, s in steps]
    assert [r.position for r in spark.read.parquet(path).where("NOT has_next OR NOT has_previous").orderBy("position").collect()] == [0, 24]
