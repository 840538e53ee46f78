"""Answers and pages that survive a run that is killed or fails."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import time
from pathlib import Path

import pytest

from windrow.plans.prepare import Prepare
from windrow.schemas import NOTICE
from windrow.sources import files, pages
from windrow.streaming import answers

N, PER_COMMIT = 60, 4


def slow(prompt, log):
    """Notes the call, then takes its time."""
    with open(log, "a") as f:
        f.write(prompt.split("\n\nNotice ")[1].split(":")[0] + "\n")
    time.sleep(0.3)
    return '[{"runway": "09", "confidence": 0.5}]'


def many(spark):
    return spark.createDataFrame([(str(i), "KJFK", "RWY 09 CLSD", "a", "b") for i in range(N)], NOTICE)


def alone(folder, log):
    """The run that gets killed."""
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
    answers.answer(many(spark), lambda p: slow(p, log), folder, PER_COMMIT, PER_COMMIT)


def test_a_killed_run_loses_only_calls_under_way(spark, tmp_path):
    folder, log = str(tmp_path / "run"), str(tmp_path / "calls")
    Path(log).touch()
    code = f"import sys; sys.path[:0] = {[str(Path(__file__).parent), str(Path(__file__).parents[1])]!r}; import test_durable; test_durable.alone({folder!r}, {log!r})"
    run = subprocess.Popen([sys.executable, "-c", code], start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        until = time.time() + 90
        while len(Path(log).read_text().split()) < 22 and time.time() < until and run.poll() is None:
            time.sleep(0.05)
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    time.sleep(1)
    before = len(Path(log).read_text().split())
    kept = answers.read(spark, folder).count()
    assert 22 <= before < N and before - PER_COMMIT <= kept <= before
    after = answers.answer(many(spark), lambda p: slow(p, log), folder, PER_COMMIT, PER_COMMIT)
    assert sorted(int(r.notam_id) for r in after.collect()) == [*range(N)]
    calls = Path(log).read_text().split()
    assert len(set(calls)) == N and len(calls) <= N + PER_COMMIT


def test_answers_that_fail_are_asked_again(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "RWY 09 CLSD", None, None), ("2", None, "fail", None, None), ("3", None, "  ", None, None), ("4", None, "no json", None, None), (None, None, "RWY", None, None)], NOTICE)

    def some(prompt):
        if "fail" in prompt:
            raise OSError("no answer")
        return "sorry" if "no json" in prompt else "[]"

    first = answers.answer(rows, some, str(tmp_path), per_commit=1)
    assert sorted((str(r.notam_id), r.response) for r in first.collect()) == [("1", "[]"), ("2", None), ("4", "sorry"), ("None", "[]")]
    second = answers.answer(rows, lambda p: '[{"TORA": 1}]', str(tmp_path), per_commit=1)
    got = sorted((str(r.notam_id), r.response) for r in second.collect())
    assert got == [("1", "[]"), ("2", '[{"TORA": 1}]'), ("4", '[{"TORA": 1}]'), ("4", "sorry"), ("None", "[]")]


def logged(prompt, log, wait=0.0):
    """Notes when the call began and ended, and for which notice."""
    began = time.time()
    time.sleep(wait)
    with open(log, "a") as f:
        f.write(f"{prompt.split('Notice ')[-1].split(':')[0]} {began} {time.time()}\n")
    return "[]"


def test_batches_hold_many_commits_and_a_batch_run_again_asks_none_twice(spark, tmp_path):
    folder, log = tmp_path / "run", str(tmp_path / "calls")
    answers.answer(many(spark), lambda p: logged(p, log), str(folder), PER_COMMIT, PER_COMMIT)
    done = [f for f in folder.glob("*/commits/*") if f.name.isdigit()]
    assert len(done) == 1  # not one for each PER_COMMIT notices
    sizes = [spark.read.parquet(str(f)).count() for f in folder.rglob("batch=*/part-*.parquet")]
    assert sum(sizes) == N and max(sizes) == 1  # four tasks at once lose four calls at most
    lost = [f for f in folder.rglob("batch=*/part-*.parquet")][:7]
    for f in [*done, *lost]:  # as if the run had been killed before
        f.unlink()
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    again = answers.answer(many(spark), lambda p: logged(p, log), str(folder), PER_COMMIT, PER_COMMIT)
    assert sorted(int(r.notam_id) for r in again.collect()) == [*range(N)]
    assert len(Path(log).read_text().splitlines()) == N + len(lost)


def test_no_more_calls_at_once_than_are_allowed(spark, tmp_path):
    log = str(tmp_path / "calls")
    got = answers.answer(many(spark).limit(12), lambda p: logged(p, log, 0.3), str(tmp_path / "run"), per_commit=6, concurrency=2)
    calls = [tuple(map(float, line.split()[1:])) for line in Path(log).read_text().splitlines()]
    assert got.count() == len(calls) == 12
    assert max(sum(b <= began < e for b, e in calls) for began, _ in calls) <= 2


def test_answers_of_the_former_layout_are_read(spark, tmp_path):
    old = spark.createDataFrame([("1", "KJFK", "RWY 09 CLSD", "a", "b", "[]")], answers.ANSWERED)
    old.write.parquet(str(tmp_path / "answers"))
    rows = spark.createDataFrame([(i, "KJFK", "RWY 09 CLSD", "a", "b") for i in "12"], NOTICE)
    got = answers.answer(rows, lambda p: '[{"TORA": 1}]', str(tmp_path))
    assert sorted((r.notam_id, r.response) for r in got.collect()) == [("1", "[]"), ("2", '[{"TORA": 1}]')]


def test_a_plan_goes_on_after_answers_without_labels(spark, tmp_path):
    plan = Prepare(spark, str(tmp_path), labeler=lambda p: "sorry" if "2" in p.split("Notice ")[1][:2] else '[{"runway": "09"}]')
    rows = spark.createDataFrame([(str(i), "KJFK", "RWY CLSD", "a", "b") for i in (1, 2, 3)], NOTICE)
    assert plan.label(rows).count() == 2
    assert [r.notam_id for r in spark.read.json(plan.at("quarantine")).collect()] == ["2"]
    plan.labeler = lambda p: "[]"
    assert sorted(r.notam_id for r in plan.label(rows).collect()) == ["1", "2", "3"]


class Growing(pages.PagedNotices):
    """A service whose rows and failures files tell; it notes what it was asked."""

    @classmethod
    def name(cls):
        return "growing_notices"

    def fetch(self):
        home = Path(self.options["home"])

        def fetch(limit, offset):
            total, bad = int((home / "total").read_text()), (home / "bad").read_text()
            with (home / "asked").open("a") as f:
                f.write(f"{offset}+{limit}\n")
            if str(offset) == bad:
                raise OSError("gone")
            return {"data": [{"notam_id": i} for i in range(offset, min(offset + limit, total))], "pagination": {"total": total}}

        return fetch


def test_pages_as_a_stream(spark, tmp_path):
    spark.dataSource.register(Growing)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(total, bad=""):
        for name, text in (("total", str(total)), ("bad", bad), ("asked", "")):
            (tmp_path / name).write_text(text)
        pages.download_new(spark, out, checkpoint, "growing_notices", home=str(tmp_path), size="100").awaitTermination()
        return sorted((tmp_path / "asked").read_text().split())

    assert run(250) == ["0+1", "0+100", "100+100", "200+50"]
    assert run(250) == ["0+1"]
    assert run(430) == ["0+1", "250+100", "350+80"]
    with pytest.raises(Exception, match="gone"):
        run(500, bad="430")
    assert spark.read.parquet(out).count() == 430
    assert run(500) == ["430+70"]  # the batch that failed, as it was planned
    rows = spark.read.parquet(out)
    assert rows.count() == 500 and rows.selectExpr("count(DISTINCT notam_id) n", "count_if(CAST(notam_id AS LONG) = seq) s").first() == (500, 500)
    assert files.require(spark, checkpoint)
