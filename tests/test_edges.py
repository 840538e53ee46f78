"""Values that a repair cannot read, settings, landed pages, prompts, and renames that fail."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from windrow import config
from windrow.operators import labels, normalize
from windrow.plans.prepare import Prepare
from windrow.schemas import CONTAMINATION_TYPES, ENTRY_FIELDS, LABELED
from windrow.sources import files, pages


def labeled(spark, *raw):
    return spark.createDataFrame([("1", "KJFK", "RWY 09 CLSD", "a", None, [json.dumps(e) for e in raw], 1.0)], LABELED)


ODD = [{"obstacleCoordinates": c} for c in ("tower", "", "1.5, 2.5", "6449N14751W", 12.5, 0, [1.5], [], {"a": 1}, True, False, None)] + [{"obstacleBearing": b} for b in ("NORTH", "", "NNE", "180", 90, 0, True, [1], None)] + [{}]


def test_what_a_repair_cannot_read(spark):
    rows = labeled(spark, *ODD)
    got = sorted((r.entry_idx, r.problem) for r in normalize.unrepaired(rows).collect())
    assert got == [(0, "unread"), (4, "not_text"), (6, "not_text"), (8, "not_text"), (9, "not_text"), (12, "lost"), (18, "lost"), (19, "lost")]
    after = normalize.fix(rows)
    # coordinates are listed again after a repair, which left them as they were; bearings are null by then
    again = {r.entry_idx: r.problem for r in normalize.unrepaired(after).collect()}
    assert again == {i: p for i, p in got if p != "lost"}
    repaired = [json.loads(e) for e in after.first().runway_entries]
    assert [repaired[i] for i, p in got if p != "lost"] == [ODD[i] for i, p in got if p != "lost"]
    assert normalize.unrepaired(rows.limit(0)).count() == 0 and normalize.unrepaired(rows.withColumn("runway_entries", F.lit(None).cast("array<string>"))).count() == 0


def test_a_plan_lists_them(spark, tmp_path):
    plan = Prepare(spark, str(tmp_path))
    files.write_labeled(labeled(spark, {"obstacleCoordinates": 5, "obstacleBearing": "NORTH"}), plan.at("silver_dataset"))
    plan.finish(files.read_labeled(spark, plan.at("silver_dataset")))
    assert sorted(r.problem for r in spark.read.json(plan.at("unrepaired")).collect()) == ["lost", "not_text"]


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "env").write_text("# none\n\nexport W_ONE='a=b'\nW_TWO= two \nW_SET=new\nodd line\n")
    for name in ("W_ONE", "W_TWO"):  # known to monkeypatch, so that they go after the test
        monkeypatch.setenv(name, "")
        monkeypatch.delenv(name)
    monkeypatch.setenv("W_SET", "old")
    config.load_dotenv(str(tmp_path / "env"))
    assert (config.setting("W_ONE"), config.setting("W_TWO"), config.setting("W_SET")) == ("a=b", "two", "old")
    assert config.setting("W_NONE", "x") == "x"
    monkeypatch.setenv("W_EMPTY", "")
    for name in ("W_NONE", "W_EMPTY"):
        with pytest.raises(config.MissingSetting, match=name):
            config.setting(name)


def test_landed_pages(spark, tmp_path):
    for k, ids in enumerate((["a", "b"], [], ["c"])):
        (tmp_path / f"page{k}.json").write_text(json.dumps({"data": [{"notam_id": i, "more": 1} for i in ids], "pagination": {"total": 3}}, indent=1))
    rows = pages.read_landed(spark, str(tmp_path)).orderBy("page", "at").collect()
    assert [(r.at, r.notam_id, r.notam_text) for r in rows] == [(0, "a", None), (1, "b", None), (0, "c", None)]


def test_prompt(spark):
    rows = spark.createDataFrame([("A1", "RWY 09 CLSD"), (None, "x"), ("A2", None)], "i string, t string")
    whole, nameless, none = (r.p for r in rows.select(labels.extraction_prompt(rows.i, rows.t).alias("p")).collect())
    assert whole.endswith("Notice A1:\nRWY 09 CLSD") and nameless.endswith("Notice UNKNOWN:\nx") and none is None
    assert all(f"{n} ({k})" in whole for n, k in ENTRY_FIELDS.items()) and all(t in whole for t in CONTAMINATION_TYPES)
    short = rows.select(labels.extraction_prompt(rows.i, rows.t, ("runway",)).alias("p")).first().p
    assert "runway (" in short and "TORA" not in short


class Unmoved:
    """A file system that refuses its n-th rename."""

    def __init__(self, fs, refused):
        self.fs, self.left = fs, refused

    def exists(self, path):
        return self.fs.exists(path)

    def rename(self, old, new):
        self.left -= 1
        return self.left != 0 and self.fs.rename(old, new)


@pytest.mark.parametrize("refused", [1, 2])
def test_renames_that_fail_leave_the_old_labels(spark, tmp_path, monkeypatch, refused):
    path = str(tmp_path / "silver")
    files.write_labeled(labeled(spark, {"runway": "09"}), path)
    plain = files._path
    fs = Unmoved(plain(spark, path)[1], refused)
    monkeypatch.setattr(files, "_path", lambda spark, p: (plain(spark, p)[0], fs))
    with pytest.raises(OSError, match="could not be moved"):
        files.replace(labeled(spark, {"runway": "18"}), path)
    monkeypatch.undo()
    assert [json.loads(e)["runway"] for e in files.read_labeled(spark, path).first().runway_entries] == ["09"]
    backup = files.replace(labeled(spark, {"runway": "18"}), path)
    assert [json.loads(files.read_labeled(spark, p).first().runway_entries[0])["runway"] for p in (path, backup)] == ["18", "09"]


@pytest.mark.parametrize(("n", "parts"), [(0, 1), (1, 3), (40, 7)])
def test_arrays_stand_in_order(spark, tmp_path, n, parts):
    rows = spark.range(0, n, 1, parts).select("id", F.lit("é,\n]").alias("part"))
    files.export_array(rows, str(tmp_path / "array"))
    (file,) = (tmp_path / "array").glob("part-*")
    assert json.loads(file.read_text()) == [{"id": i, "part": "é,\n]"} for i in range(n)]
    files.export_array(spark.createDataFrame([], "id long"), str(tmp_path / "none"))
    (file,) = (tmp_path / "none").glob("part-*")
    assert json.loads(file.read_text()) == []
