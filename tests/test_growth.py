"""What must not grow with the table, or with the number of fields that are asked for."""

from __future__ import annotations

import json

from conftest import DATA
from pyspark.sql import functions as F

from windrow import queries
from windrow.functions.coordinates import parse_coordinate
from windrow.functions.entries import let_parsed, truthy, truthy_in
from windrow.functions.json_text import python_float
from windrow.operators import examples, metrics, review


def test_coordinates_are_parsed_in_all_tasks(spark):
    assert queries.parse_coordinates(spark, DATA).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_coordinates_read_groups_by_one_match(spark):
    plan = spark.range(1).select(parse_coordinate(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract" not in plan
    texts = ["3452N12345W", "ſ34 52 10 / E123 45 10", " 3452N12345W", "N34 52 10.5/W123 45 10", "34°52'N 123°45'W", "/3452N12345W", "345210,5N1234510W", "3452|N12345W"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_coordinate(F.col("t"))).collect()
    assert dict(map(tuple, rows)) == {
        texts[0]: "34.8667, -123.7500", texts[1]: "-34.869444, 123.752778", texts[2]: "34.8667, -123.7500", texts[3]: "34.869583, -123.752778",
        texts[4]: "34.8667, -123.7500", texts[5]: "34.8667, -123.7500", texts[6]: "34.869583, -123.752778", texts[7]: texts[7],
    }


def test_entries_parsed_once_have_the_same_truth(spark):
    values = ['""', '"0"', '"false"', '"[]"', "0", "0.0", "-0.0", "1e5", "1e400", "0.5", "true", "false", "null", "[]", "[null]", "{}", '{"a": 1}', "NaN", '"x"', "12345678901234567890123456789012345678901234567890"]
    rows = spark.createDataFrame([(f'{{"a": {v}}}',) for v in values] + [("{}",), ("no json",), (None,)], "e string")
    both = rows.select("e", truthy(F.col("e"), "a"), let_parsed(F.col("e"), lambda p: truthy_in(p, F.col("e"), "a"))).collect()
    assert [r for r in both if r[1] != r[2]] == []


def test_totals_read_their_rows_once(spark):
    rows = spark.createDataFrame([(['{"runwayClosed": true}', '{"landingShortening": 2}'],), ([],), (None,), (['{"contaminations": [{}]}'],)], "runway_entries array<string>")
    counted = metrics.entry_totals(rows)
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert counted.first().asDict() == {"items": 4, "entries": 3, "contaminated": 1, "shortened": 1, "with_obstacle": 0, "closed": 1}


def test_a_step_lists_one_bucket(spark, tmp_path):
    path = str(tmp_path / "queue")
    review.write_queue(spark.range(10).withColumnRenamed("id", "k"), "k", [F.col("k")], path, per_bucket=2)
    (tmp_path / "queue" / "strange").mkdir()
    (tmp_path / "queue" / "strange" / "part-0.parquet").write_bytes(b"no parquet")  # a listing of all buckets would meet it
    assert [r.k for r in review.at(spark, path, 7, 2).collect()] == [7]
    assert review.at(spark, path, 70, 2).isEmpty()
    assert [review.step(spark, path, 9, "n", 2), review.step(spark, path, 0, "10", 2), review.step(spark, path, 4, "p", 2)] == [None, 9, 3]


def test_rows_without_patches_are_not_parsed(spark):
    labeled = spark.createDataFrame([("1", ["no json"], 0.5), ("2", ["{}"], 0.5), ("3", None, None)], "notam_id string, runway_entries array<string>, min_confidence double")
    patches = spark.createDataFrame([("2", 1, 1, "set", "notes", "x")], "notam_id string, seq int, entry_idx int, op string, field string, value string")
    after = {r[0]: tuple(r)[1:] for r in review.apply_patches(labeled, patches).collect()}
    assert after == {"1": (["no json"], 0.5), "2": (['{"notes": "x"}'], 1.0), "3": (None, None)}


def test_prompts_make_no_responses(spark):
    rows = spark.createDataFrame([("1", "K1", "RWY 09", "a", None, ['{"runway": ["09", 1]}', '{"runway": ""}'])], "notam_id string, icao_location string, notam_text string, effective_start string, effective_end string, runway_entries array<string>")
    prompts = examples.prompts(rows)
    assert "isCanceled" not in prompts._jdf.queryExecution().optimizedPlan().toString()
    assert [r.user for r in prompts.orderBy("entry_idx").collect()] == [r.user for r in examples.examples(rows).orderBy("entry_idx").collect()]


def test_hundredths_as_python_writes_them(spark):
    numbers = [0.5, 22.5, 180.0, -0.05, 0.29, 1.005, 999999999.99, 1e9, 1e16, 0.1 + 0.2, -0.0, 0.0, 1e300, float("nan"), float("inf"), 0.01, 123.4]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select(python_float(F.col("n"))).collect()
    assert [r[0] for r in rows] == [json.dumps(n) for n in numbers]
