"""Perplexities of the quality model against interpolated modified Kneser-Ney written out in plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter

from windrow.llm import quality

START, END = "\x02", "\x03"


def brute_scores(trained, texts):
    def padded(t):
        return START * 4 + "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t) + END

    def windows(t):
        return [padded(t)[k : k + 5] for k in range(len(t) + 1)]

    orders = {5: Counter(g for t in trained for g in windows(t))}
    for n in (4, 3, 2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1] if not g[1:].endswith(START))
    symbols, d, total, kept = len(orders[1]), {}, Counter(), Counter()
    for n, seen in orders.items():
        n1, n2, n3, n4 = (max(sum(c == i for c in seen.values()), 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d[n] = [max(0.05, min(0.95 * i, i - (i + 1) * y * b / a)) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        for g, c in seen.items():
            total[g[:-1]] += c
            kept[g[:-1]] += d[n][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / (symbols + 1)
        if g[:-1] not in total:
            return p(g[1:])
        c = orders[len(g)][g]
        own = c - d[len(g)][min(c, 3) - 1] if c else 0
        return own / total[g[:-1]] + kept[g[:-1]] / total[g[:-1]] * p(g[1:])

    return [sum(math.log(p(g)) for g in windows(t)) for t in texts]


def test_scores_are_those_of_the_formula(spark):
    random.seed(8)
    trained = ["".join(random.choices("abcd é\n", weights=[9, 7, 5, 2, 6, 1, 1], k=random.randint(1, 60))) for _ in range(60)]
    texts = [*trained[:10], "", "zz", "ab zz\tcd", "ж" * 9, "é\n" * 20, *["".join(random.choices("abcdez ", k=40)) for _ in range(20)]]
    model = quality.train(spark.createDataFrame([(t,) for t in trained], "text string"))
    want = brute_scores(trained, texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for entries in (quality.SHARD_ENTRIES, 50):
        got = {r.doc_id: r for r in quality.perplexity(docs, model, entries=entries).collect()}
        for k, t in enumerate(texts):
            assert got[k].n_tokens == len(t) + 1 and abs(got[k].logp - want[k]) < 1e-3 * max(1, abs(want[k]))
            assert (got[k].perplexity is None) == (t == "")
