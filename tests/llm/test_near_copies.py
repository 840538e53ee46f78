"""The pipeline's third stage against brute force over all pairs."""

from __future__ import annotations

import random

import corpus_pipeline
from conftest import DATA
from test_operators import DOCS

from windrow.llm import near_copies


def brute_kept(rows):
    """The smallest id of each group that pairs of a Jaccard similarity of at least 0.8 of their five-word shingles connect."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted(least.values())


def near(rows, spark):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, DATA).collect())


def test_stage_finds_every_similar_pair(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-1, None), (-2, ""), (-3, "a b"), (-4, "A  b"), (-5, "a b c")]
    assert near(rows, spark) == brute_kept(rows)


def test_chains_and_large_groups(spark, monkeypatch):
    random.seed(4)
    rows = []
    for g in range(6):
        base = [f"w{random.randrange(10**6)}" for _ in range(100)]
        for _ in range(40):  # one word of a hundred makes a similarity of about 0.9, two just over or under 0.8
            w = list(base)
            for k in random.sample(range(100), random.randint(0, 3)):
                w[k] = f"x{random.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
        for k in range(8):  # a chain, each alike only to its neighbours
            rows.append((len(rows), " ".join(base[6 * k :] + [f"t{g}.{x}" for x in range(6 * k)])))
    random.shuffle(rows)
    want = brute_kept(rows)
    assert near(rows, spark) == want and len(want) < len(rows)
    monkeypatch.setattr(near_copies, "CHUNK", 16)
    assert near(rows, spark) == want


def test_linked_fingerprints_propose_and_similarity_decides(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join([*words, "end"]), " ".join(f"v{k}" for k in range(400))]
    docs = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "doc_id long, __rk long, text string")
    no_bands = spark.createDataFrame([(k, k, 396, []) for k in range(3)], "class long, rk long, n long, bands array<long>")
    linked = spark.createDataFrame([(k, 7) for k in range(3)], "class long, root long")
    edges = near_copies.links(docs, no_bands, 0.8, 5, linked=linked)
    assert [tuple(r) for r in edges.collect()] == [(0, 1)]


def test_stage_links_fingerprints(spark, monkeypatch):
    asked, own = [], near_copies.components_of
    monkeypatch.setattr(near_copies, "components_of", lambda *a, **k: asked.append(1) or own(*a, **k))
    assert near([(1, "a b c d e f"), (2, "A b c d  e f"), (3, None)], spark) == [1, 3] and asked
