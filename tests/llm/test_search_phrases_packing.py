"""Lexical search, phrase collocations and binary packing against plain versions of their definitions, odd rows included."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from windrow.llm import _varints, byte_ids, decompose, lexical_search, phrases
from windrow.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "id string, term string, part string, shard string, n string, score string, query string, block string, __key string, positions string, start string, length string"


def odd_rows(spark, rows, names):
    """The rows as (doc_id, lang, text), with other columns of the names that operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    return df.selectExpr("*", *[f"'x' AS {c.split()[0]}" for c in names.split(", ")])


def made_up(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "Été", "été", "naïve", "x1", "日本", *[f"w{i}" for i in range(40)]]
    joins = [" ", " ", " ", "\t", ", ", ".", "\n", "-", "  ", "'"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.choice([0, 1, 5, 30, 80])))
        out.append((rng.choice([i, i, i - 1]), rng.choice(["en", "de", None, "und"]), text))
    return [*out, (None, "en", "the w1 w2"), (None, None, "the w1 w2"), (-5, "en", None), (7, "en", ""), (8, "en", " .,; "), *[(900 + i, "en", "same same text w3") for i in range(25)], *[(9, "en", "the w9")] * 3]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62)))
def test_varints(numbers):
    data, starts = _varints.encode(np.array(numbers, np.int64))
    assert _varints.decode(data.tobytes()).tolist() == numbers and starts[-1] == len(data)


def ranked(docs, queries, k=10):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    held = [(d, Counter(terms(t))) for d, _, t in docs]
    held = [(d, c) for d, c in held if c]
    total, all_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for q, t in queries:
        asked[q] |= set(terms(t))
    out = []
    for q, wanted in asked.items():
        scores = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * total // all_terms
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(q, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_terms", [1, 60, 10**6])
def test_search(spark, shard_terms):
    docs = made_up(1)
    queries = [(1, "the of w1"), (2, "W3 text same"), (3, "日本 été Été"), (4, None), (5, "..."), (6, "absent"), (7, "w9"), (7, "w8 the"), (None, "x1")]
    asked = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS query", "3 AS doc_id")
    got = lexical_search.top_documents(odd_rows(spark, docs, CLASHING).repartition(3), asked, shard_terms=shard_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(docs, queries)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.top_documents(docs, some).count() == 0
    assert lexical_search.top_documents(some.withColumnRenamed("item_id", "doc_id"), some.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1), min_size=1, max_size=7), st.integers(1, 12))
def test_merge(lists, k):
    """The merge skips lists, and finds what a full sum finds."""
    made = []
    for x in lists:
        item = object.__new__(lexical_search._List)
        docs = sorted(x)
        item.docs, item.adds, item._lists = np.array(docs), np.array([x[d] for d in docs]), None
        item.most = max(x.values())
        made.append(item)
    sums = Counter()
    for x in lists:
        sums.update(x)
    want = sorted(((s, d) for d, s in sums.items()), key=lambda y: (-y[0], y[1]))[:k]
    assert lexical_search.merged(made, k) == want


def mined(docs, least, keep, covered=50):
    counts, totals = defaultdict(Counter), Counter()
    for _, lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p for p, a in f.items() if len(p) > 1 and a >= least}
        longer = [p for p in found if len(p) == 3]
        rows = []
        for p in found:
            a = f[p]
            if len(p) == 2 and any(p in (q[:2], q[1:]) and 100 * f[q] >= covered * a for q in longer):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:keep], 1)]
    return sorted(out)


@pytest.mark.parametrize("segment_words", [1, 500, 10**6])
def test_phrases(spark, segment_words):
    docs = made_up(2, 200)
    got = phrases.collocations(odd_rows(spark, docs, CLASHING).repartition(3), least=4, keep=40, segment_words=segment_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == mined(docs, 4, 40)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None), (2, "en", "a b")], "doc_id long, lang string, text string")).count() == 0


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_phrase_collocations"])
def test_registered(same, name):
    same(QUERIES[name], ORACLE_SQL[name])


PARTS = [" ", "Ñandú, ", "word).\x27 ", "naïve;\x27s", " x_y ", "ſtª ", "ǆ. ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", " ", "　", "a", "Word", "it's", "été", "日本語", "1999", "!?", "'", "<|endoftext|>", "\U0001f600", "don't ", " x", "é"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=30))
def test_byte_ids(text):
    """Ids by cut parts are the library's, wherever white space stands."""
    encoder = byte_ids.worker_ids(tokenizer_file("byte_bpe_50k.json"))
    assert encoder.cuts
    assert np.frombuffer(next(iter(encoder.packed([text]))), np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_byte_ids_of_other_files():
    """A vocabulary with a normaliser or another split is used as a whole."""
    encoder = byte_ids.ByteIds(tokenizer_file("word_bpe_49k.json"))
    assert not encoder.cuts
    assert np.frombuffer(next(iter(encoder.packed(["Some  Words"]))), np.uint32).tolist() == encoder.tokenizer.encode("Some  Words", add_special_tokens=False).ids


def test_binary_packing(spark):
    docs = [*made_up(3), (77, "en", "long text " * 4000), (78, "en", "x" * 50_000)]
    pieces = decompose.decompose(odd_rows(spark, docs, CLASHING).repartition(3), tokenizer_file("byte_bpe_50k.json"), size=64, batch_tokens=256)
    rows = pieces.collect()
    tokenizer = byte_ids.worker_ids(tokenizer_file("byte_bpe_50k.json")).tokenizer
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,)) for d, _, t in docs)
    got, taken = Counter(), {}
    rows.sort(key=lambda r: r["sequence_id"])
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for r in rows:
        assert r["length"] == 1 << r["bucket"] <= 64 and r["offset"] == 0 and len(r["ids"]) == 4 * r["length"]
        if r["start"] == 0:
            taken = {"doc": r["doc_id"], "ids": [], "n": r["doc_tokens"]}
        assert (taken["doc"], len(taken["ids"]), taken["n"]) == (r["doc_id"], r["start"], r["doc_tokens"])
        taken["ids"] += np.frombuffer(r["ids"], np.uint32).tolist()
        if len(taken["ids"]) == taken["n"]:
            got[taken["doc"], tuple(taken["ids"])] += 1
    assert got == want
    batches = defaultdict(list)
    for r in rows:
        batches[r["batch_id"]].append(r["length"])
    assert all(len(set(b)) == 1 and sum(b) <= 256 for b in batches.values())
    for bad in (0, 3, 100):
        with pytest.raises(ValueError):
            decompose.decompose(odd_rows(spark, docs, CLASHING), "none", size=bad)


def test_binary_buckets(spark, tmp_path):
    docs = spark.createDataFrame(made_up(4), "doc_id long, lang string, text string")
    decompose.write_buckets(decompose.decompose(docs, tokenizer_file("byte_bpe_50k.json"), size=32), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("length != shiftleft(1, bucket)").count() == 0
    row = back.where("length = 32").first()
    assert zlib.crc32(row["ids"]) == back.where(f"sequence_id = {row['sequence_id']}").selectExpr("crc32(ids) AS c").first()["c"]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 127, 200])
def test_binary_lengths(n):
    lengths = decompose.binary_lengths(n, 64)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 64 for x in lengths) and lengths == sorted(lengths, reverse=True)
    assert len({x for x in lengths if x < 64}) == len([x for x in lengths if x < 64])
