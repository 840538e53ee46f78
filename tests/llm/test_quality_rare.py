"""Thresholds of a language with few trusted rows."""

from __future__ import annotations

import random

from windrow.llm import quality


def test_rare_language_keeps_its_clean_rows(spark):
    random.seed(5)
    common = ["the", "river", "runs", "past", "old", "mill", "and", "town"]
    rows = [(i, " ".join(random.choices(common, k=60)), "en") for i in range(800)]
    rows += [(1000 + i, " ".join("".join(random.choices("qxzjkvwyåøæ", k=6)) for _ in range(30)), "xx") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows if i < 1020], "doc_id long, quality int, toxic int")
    # at this quantile the common language's rows set that of all, as they do at 0.999 on large tables
    got = quality.classify(docs, labels, quantile=0.9).collect()
    assert sum(r.keep for r in got if r.lang == "xx") >= 24 and sum(r.keep for r in got if r.lang == "en") >= 700
