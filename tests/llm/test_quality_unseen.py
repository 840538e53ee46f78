"""The scorer against the model's formula, with characters that no trusted text has."""

from __future__ import annotations

import math

from windrow.llm import quality


def test_scorer_follows_the_formula(spark):
    model = quality.train(spark.createDataFrame([("abab cab abc bca",), ("cabbage",), (" ab ab",)], "text string"))
    rows = model.collect()
    logp = {r.gram: r.logp for r in rows if r.logp is not None}
    backoff = {r.gram: r.backoff for r in rows if r.backoff is not None}
    symbols = sum(len(g) == 1 for g in logp)

    def score(text):
        codes, total = "\x02" * 4 + text + "\x03", 0.0
        for at in range(4, len(codes)):
            context, w = codes[at - 4 : at], codes[at]
            known = next((k for k in range(5) if context[k:] + w in logp), None)
            total += sum(backoff.get(context[j:], 0) for j in range(5 if known is None else known))
            total += -math.log(symbols + 1) if known is None else logp[context[known:] + w]
        return total

    texts = ["abba", "a~b", "~~~", "Ã©cab ж", "zab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for entries in (quality.SHARD_ENTRIES, 20):
        for r in quality.perplexity(docs, model, entries=entries).collect():
            assert abs(r.logp - score(texts[r.doc_id])) < 1e-3
