"""The counts after a repair: one pass over the rows, nothing written, and what :func:`normalize.fix` and a count would give."""

from __future__ import annotations

import json

import pytest
from conftest import DATA

from windrow import queries
from windrow.operators import normalize

VALUES = ['""', '"0"', '"ALL"', "0", "0.0", "5", "-12.5", "1e5", "true", "false", "null", "[]", '["1.5, 2.5"]', "{}", '{"a": 1}', '"N"', '" nne "', '"180"', '"1_0"', '"NORTH"', '"1.5, 2.5"', '"1.5,2.5x"', '"3452N12345W"', '"near, 3452N12345W"', '"near the tower"', '"ſ34 52 10 / E123 45 10"']
UNREAD = ['{"runway": "ALL", "runway": "09", "obstacleBearing": "N"}', '{"runway": "09", "runway": "ALL", "obstacleBearing": 5}', '{"obstacleCoordinates": "1.5, 2.5", "obstacleBearing": "SW", "obstacleBearing": "N"}', '{"TORA": NaN, "obstacleBearing": "N"}', "no json"]


def rows(spark, *items):
    return spark.createDataFrame([(list(i) if i is not None else None,) for i in items], "runway_entries array<string>")


def fields(*names):
    return [f'{{"{n}": {v}}}' for n in names for v in VALUES]


CASES = {
    "odd values": [fields("runway"), fields("obstacleCoordinates"), fields("obstacleBearing"), ["{}", None], [], None],
    "both": [[f'{{"obstacleCoordinates": {v}, "obstacleBearing": {w}}}' for v in VALUES for w in VALUES]],
    "gate closed": [['{"obstacleBearing": "180", "obstacleCoordinates": "1.5, 2.5"}', '{"obstacleBearing": 90, "runway": "09"}', '{"obstacleBearing": 0}']],
    "unread": [[*UNREAD, '{"obstacleBearing": "180"}'], ["{}"], None],
    "unread alone open the gate": [UNREAD, ['{"obstacleBearing": "180"}']],
    "unread, gate closed": [['{"obstacleBearing": 5, "obstacleBearing": 6}', '{"obstacleBearing": "180"}', '{"obstacleBearing": 7}']],
    "nothing": [],
}


@pytest.mark.parametrize("case", CASES)
def test_same_as_fix_and_count(spark, case):
    table = rows(spark, *CASES[case])
    assert normalize.counted_repair(table).collect() == normalize.repaired_counts(normalize.fix(table)).collect()


def test_endless_bearings_are_numbers(spark):
    table = rows(spark, [json.dumps({"obstacleBearing": b, "obstacleCoordinates": "1.5, 2.5"}) for b in ("nan", "inf", "-Infinity", "x")])
    assert tuple(normalize.counted_repair(table).first()) == (0, 4, 3)


def test_rows_are_read_once_and_nothing_is_written(spark, monkeypatch):
    def refuse(df, name, **options):
        raise AssertionError(f"{name} was written")

    monkeypatch.setattr(normalize, "materialize", refuse)
    reads = spark.sparkContext.accumulator(0)
    table = rows(spark, *CASES["odd values"])

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    assert normalize.counted_repair(table.mapInArrow(seen, table.schema)).first().all_remaining == 0
    assert reads.value == len(CASES["odd values"])
    assert queries.repaired_counts(spark, DATA).first().all_remaining == 0


def test_keys_are_dealt_without_texts(spark):
    plan = queries.labeled(spark, DATA).select("runway_entries")._jdf.queryExecution().optimizedPlan()
    dealt = [n for n in plan.toString().split("\n") if "RepartitionByExpression" in n]
    assert len(dealt) == 1 and "entry" not in dealt[0]
    at = plan.toString().split("\n").index(dealt[0])
    assert "obstacleBearing" not in "\n".join(plan.toString().split("\n")[at:])
