"""Folds, thresholds and decisions of the quality classifier against the rule written out in plain Python."""

from __future__ import annotations

import math
import random
import struct
from statistics import variance

import xxhash
from test_quality_brute import brute_scores

from windrow.llm import quality


def fold(i):
    h = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
    return (h - (1 << 64) * (h >> 63)) % 5


def brute(rows, labels, quantile, margin):
    good = {i for i, q, t in labels if i is not None and q == 1 and not t}
    scored = [(i, lang, t, *brute_scores_of(rows, good)[k]) for k, (i, t, lang) in enumerate(rows)]
    seen = [(lang, c, p) for i, lang, _, p, c in scored if i in good and fold(i) == 0 and p is not None]

    def top(values):
        return sorted(values)[max(math.ceil(quantile * len(values)), 1) - 1]

    def of(want):
        return [p for lang, c, p in seen if want(lang, c)]

    out = {}
    for i, lang, _, p, c in scored:
        cells = {(x, k) for x, k, _ in seen if k == c and x is not None}
        held = [[math.log(v) for v in of(lambda x, k, cell=cell: (x, k) == cell)] for cell in cells]
        free = sum(len(h) - 1 for h in held)
        spread = math.sqrt(sum(variance(h) * (len(h) - 1) for h in held if len(h) > 1) / free) if free else 0.0
        own = (lang is not None and (of(lambda x, k: (x, k) == (lang, c)) or of(lambda x, k: x == lang))) or of(lambda x, k: True)
        limit = margin * top(own) * max(1, 1 / ((1 - quantile) * len(own))) ** spread
        out[i] = (limit, p is not None and p <= limit, p)
    return out


_SCORES = {}


def brute_scores_of(rows, good):
    key = id(rows)
    if key not in _SCORES:
        texts = [t for _, t, _ in rows]
        logp = brute_scores([t for i, t, _ in rows if i in good and fold(i) > 0 and t], texts)
        _SCORES[key] = [(math.exp(-s / (len(t) + 1)) if t else None, 0 if len(t) + 1 < 200 else 1 if len(t) + 1 < 1000 else 2) for s, t in zip(logp, texts, strict=True)]
    return _SCORES[key]


def test_thresholds_and_decisions(spark):
    random.seed(11)
    rows = []
    for i in range(160):
        lang = ("en", "en", "fr", None, "xx")[i % 5] if i % 40 else "rare"
        letters = "qzxjk " if i % 11 == 0 else {"fr": "aéio nst", "xx": "wyåø "}.get(lang, "abcde ")
        rows.append((i, "".join(random.choices(letters, k=random.choice((30, 80, 150, 260, 400, 1100)))), lang))
    rows += [(500, "", "en"), (501, "abc", "none"), (502, "zzzz~~~~" * 5, None), (503, "a", "fr")]
    labels = [(i, 1 if i % 11 else 0, 1 if i % 13 == 0 else None) for i, _, _ in rows if i % 7 and i < 500]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for quantile, margin in ((0.999, 1.05), (0.5, 1.0)):
        want = brute(rows, labels, quantile, margin)
        got = {r.doc_id: r for r in quality.classify(docs, table, quantile, margin).collect()}
        assert got.keys() == want.keys()
        for i, (limit, keep, p) in want.items():
            assert abs(got[i].threshold - limit) < 5e-3 * limit, i
            if p is None or abs(p - limit) > 5e-3 * limit:
                assert got[i].keep == keep, i
        kept = sum(k for _, k, _ in want.values())
        assert 0 < kept < len(rows)
