"""Stages left out by their manifest, listings, checksums of long files, and filters deep inside documents."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from windrow.functions import nested
from windrow.plans.manifest import Manifest
from windrow.plans.prepare import Prepare
from windrow.schemas import NOTICE
from windrow.sources import files


def test_a_stage_runs_again_only_when_it_must(spark, tmp_path):
    source, output = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    manifest, done = Manifest(spark, str(tmp_path / "manifest")), []

    def work():
        done.append(1)
        output.mkdir(exist_ok=True)

    def run(settings=""):
        return manifest.run("s", [str(source)], str(output), work, settings)

    (source / "a").write_text("1")
    assert run() and not run() and len(done) == 1
    (source / "b").write_text("")  # nothing in it
    assert not run()
    (source / "b").write_text("2")
    assert run() and not run()
    assert run("other") and not run("other")
    output.rmdir()
    assert run("other") and len(done) == 4
    with pytest.raises(files.MissingSource):
        manifest.run("s", [str(tmp_path / "nowhere")], str(output), work)
    with pytest.raises(ZeroDivisionError):
        manifest.run("t", [str(source)], str(output), lambda: 1 // 0)
    assert manifest.last("t") is None and len(done) == 4


def test_prepare_leaves_out_what_is_unchanged(spark, tmp_path, monkeypatch):
    notices = [(str(i), "KJFK", "RWY 09 CLSD" if i % 3 else "BIRD ACTIVITY", "a", "b") for i in range(30)]
    files.write_lines(spark.createDataFrame(notices, NOTICE), str(tmp_path / "all_notams.jsonl"))
    prepare = Prepare(spark, str(tmp_path), labeler=lambda p: '[{"runway": "ALL", "confidence": 0.5}]', skip_unchanged=True)
    calls = []
    for name in ("filter", "finish"):
        real = getattr(prepare, name)
        monkeypatch.setattr(prepare, name, lambda *a, name=name, real=real: (calls.append(name), real(*a))[1])
    first = dict(prepare.run())
    assert sum(first.values()) == 20 and calls == ["filter", "finish"]
    assert prepare.run() == first and calls == ["filter", "finish", "finish"]  # the repair had rewritten the labels
    assert prepare.run() == first and len(calls) == 3
    prepare.split_by_notice = True
    prepare.run()
    assert calls[3:] == ["finish"]
    files.write_lines(spark.createDataFrame([("99", "KJFK", "RWY 27 CLSD", "a", "b")], NOTICE), str(tmp_path / "all_notams.jsonl"), mode="append")
    assert sum(prepare.run().values()) == 21 and calls[4:] == ["filter", "finish"]


def test_listing_reads_no_contents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b", "a", "sub/c"):
        (tmp_path / name).write_text(name)
        os.chmod(tmp_path / name, 0o000 if os.getuid() else 0o644)
    found = files.listing(spark, str(tmp_path))
    assert sorted((os.path.relpath(r.path.removeprefix("file:"), tmp_path), r["size"]) for r in found.collect()) == [("a", 1), ("b", 1), ("sub/c", 5)]
    assert "content:binary" not in found._jdf.queryExecution().executedPlan().toString()


def test_first_by_name_and_last_by_time(spark, tmp_path):
    for name in ("kit_v26_1_0", "kit_v26_0_0", "other"):
        (tmp_path / name).mkdir()
    assert files.first_named(spark, f"{tmp_path}/kit_v*").endswith("/kit_v26_0_0")
    assert files.first_named(spark, f"{tmp_path}/nothing*") is None
    for name in ("x", "z", "y"):
        (tmp_path / "other" / name).write_text(name)
        os.utime(tmp_path / "other" / name, (10, 10))
    assert files.latest(spark, str(tmp_path / "other")).first().path.endswith("/z")


def test_checksums_of_files_longer_than_a_row(spark, tmp_path):
    with open(tmp_path / "long", "wb") as f:
        f.truncate(2**31 + 7)
    (tmp_path / "short").write_bytes(b"abc")
    (tmp_path / "empty").write_bytes(b"")
    want = {"short": hashlib.md5(b"abc").hexdigest()}  # a file without content is left out
    digest = hashlib.md5()
    for _ in range(2**31 >> 24):
        digest.update(bytes(1 << 24))
    digest.update(bytes(7))
    want["long"] = digest.hexdigest()
    assert {r.path.rsplit("/", 1)[1]: r.md5 for r in files.checksums(spark, str(tmp_path)).collect()} == want
    assert {r.path.rsplit("/", 1)[1]: r.md5 for r in files.checksums(spark, str(tmp_path / "short"), longest=0, block=2).collect()} == {"short": want["short"]}


def test_values_deep_inside(spark):
    texts = ['{"a": {"b": "caf\u00e9s", "n": 1, "f": false, "t": true, "z": null, "o": {"x": 1, "y": 2}, "l": [1, null]}}', "[1]", "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_parse_json("t").alias("d"))
    d = F.col("d")
    got = df.select(
        nested.text(d, "$.a.b"), nested.prefix(d, "$.a.b", 3), nested.prefix(d, "$.a.n", 3), nested.equals(d, "$.a.n", "1"), nested.equals(d, "$.a.b", "caf\u00e9s"),
        *[nested.or_else(d, f"$.a.{k}", "d") for k in "nftzq"], *[nested.length(d, f"$.a.{k}") for k in "bolzqn"],
    )
    none = (None, None, None, False, False, *"ddddd", 0, 0, 0, 0, 0, 0)
    assert [tuple(r) for r in got.collect()] == [("caf\u00e9s", "caf", None, False, True, "1", "d", "true", "d", "d", 5, 2, 2, 0, 0, None), none, none, none]


def test_items_that_meet_a_condition(spark):
    rows = [(1, '{"data": [{"id": "p", "k": "x"}, {"id": "q", "k": 1}, null, 5]}'), (2, '{"data": {}}'), (3, "{}"), (4, None), (5, "no json"), (6, '{"data": []}'), (7, '{"data": [{"id": "r", "k": "x"}]}')]
    found = nested.select_items(spark.createDataFrame(rows, "n long, doc string"), "doc", "$.data", lambda i: nested.equals(i, "$.k", "x"))
    assert sorted(map(tuple, found.select("n", nested.text(F.col("item"), "$.id")).collect())) == [(1, "p"), (7, "r")]
