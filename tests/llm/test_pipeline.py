"""Every stage on its own input, on odd tables and on empty ones."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from conftest import DATA
from test_near_copies import brute_kept
from test_operators import DOCS, base_spans, brute_copies

STAGES = dict(corpus_pipeline.STAGES)


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (-7, "x y", "en", "s", 3), (-7, "x y", "en", "s", 3)], DOCS))
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    kept = STAGES["quality"](spark, docs, DATA)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)

    once = STAGES["exact_dedup"](spark, docs, DATA)
    assert once.columns == docs.columns and Counter(r.doc_id for r in once.collect()) == Counter({k for _, k, _, _ in brute_copies(rows)})

    unlike = STAGES["near_dedup"](spark, docs, DATA)
    last = 1 << 60  # where null ids sort
    assert unlike.columns == docs.columns
    assert sorted(last if r.doc_id is None else r.doc_id for r in unlike.collect()) == brute_kept([(last if i is None else i, t) for i, t in rows])

    clean = STAGES["pii"](spark, docs, DATA)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert all(base_spans(r.text) == "" for r in clean.collect())

    packed = STAGES["packing"](spark, docs, DATA)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == Counter(i for i, _ in rows)


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    for stage in STAGES.values():
        assert stage(spark, none, DATA).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
