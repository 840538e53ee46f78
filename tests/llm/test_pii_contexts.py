"""What contexts of personal data find: identifiers of any shape, one after another, and after long words."""

from __future__ import annotations

import pytest

from windrow.llm import pii
from windrow.llm._common import likely_in


def spans(spark, rows):
    return {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_seeds_and_findings_without_digits(spark):
    names = ["alice", "bob", "carol", "dave", "erin", "frank"]
    rows = [(k, f"please write to: {n}@example.com soon") for k, n in enumerate(names)]
    found = spans(spark, [*rows, (20, "do write to: jane-at-host soon"), (21, "do write too: jane soon")])
    assert found[20] == "id:13:25" and found[21] == "" and found[0] == "email:17:34"


def test_words_before_may_be_identifiers(spark):
    rows = [(k, f"case 12{k} born 3/{k} ref7 from: user{k}@example.com") for k in range(6)]
    rows += [(10 + k, f"\tx ID7  no5: 10.0.0.{k}\n") for k in range(6)]
    found = spans(spark, [*rows, (20, "zz ref7 from: someone1"), (21, "y id7 no5: 10-0")])
    assert found[20] == "id:14:22" and found[21] == "id:11:15"


def test_redact_removes_what_is_learned(spark):
    rows = [(k, f"please write to: {'abcdef'[k]}@example.com") for k in range(6)] + [(20, "é😀 write to: jane-at-host soon")]
    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20] == "é😀 write to: <ID> soon" and got[0] == "please write to: <EMAIL>"


def test_words_before_of_any_length(spark):
    long = "https://example.org/" + "a" * 120
    rows = [(k, f"from {long} user{k}@example.com") for k in range(6)]
    assert spans(spark, [*rows, (20, f"from {long} someone1")])[20] == f"id:{len(long) + 6}:{len(long) + 14}"


def test_contexts_of_few_seeds_are_left_out(spark):
    texts = [f"mail to: user{k}@example.com" for k in range(3)] + ["mail to: nobody"] * 27 + [f"and of u{k}@example.com" for k in range(3)] + ["and of it"] * 28
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "row long, __text string").cache()
    told = pii._seeds(rows).groupBy("context", "instance").count().withColumnRenamed("count", "times")
    sure = pii._selective(rows, told)
    names = spark.createDataFrame([("mail", "to:"), ("and", "of")], "a string, b string").withColumn("context", pii._context("a", "b"))
    assert [r.a for r in sure.join(names, "context").collect()] == ["mail"] and sure.count() == 1


def test_broadcast_filter_lets_no_member_out(spark):
    rows, keys = spark.range(3000).toDF("k"), spark.range(0, 3000, 7).toDF("k")
    got = likely_in(rows, "k", keys, bits=1 << 17)
    assert got.join(keys, "k", "left_anti").count() < 30 and got.join(keys, "k").count() == keys.count()


def test_the_slice_counted_first_changes_no_result(spark, monkeypatch):
    texts = [f"a{k % 7} b u{k}@example.com" for k in range(60)] + [f"a{k % 7} b it" for k in range(700) if k % 7 < 4 or k < 350]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "row long, __text string").cache()
    told = pii._seeds(rows).groupBy("context", "instance").count().withColumnRenamed("count", "times")
    kept = []
    for part in (1, 3, 64):
        monkeypatch.setattr(pii, "SLICE", part)
        kept.append({r.context for r in pii._selective(rows, told).collect()})
    assert kept[0] == kept[1] == kept[2] and 0 < len(kept[0]) < 7


def _planted(share, seed):
    """Contexts with a share of seeds, identifiers of shapes that no seed pattern matches, and ordinary words: texts, identifiers, words."""
    import random

    rng = random.Random(seed)
    shapes = [lambda: f"EMP{rng.randint(10000, 99999)}", lambda: f"{rng.choice('ABCXYZ')}{rng.randint(10, 99)}-{rng.randint(1000, 9999)}-{rng.choice('KLM')}", lambda: f"usr_{rng.randint(100, 999)}x{rng.randint(10, 99)}", lambda: f"{rng.randint(100, 999)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"]
    ordinary = ["everyone", "support", "the", "our", "monday", "nobody", "well-known", "it's", *[a + b for a in ("sun", "moon", "star", "rain") for b in ("light", "fall", "rise", "shine")]]
    rows, found, plain = [], [], []
    for c in range(4):
        for k in range(120):
            kind = k / 120
            if kind < share:
                word = f"{rng.choice('abcdef')}{k}c{c}@example.com"
            elif kind < share + 0.25:
                word = rng.choice(shapes)()
                found.append(len(rows))
            else:
                word = rng.choice(ordinary)
                plain.append(len(rows))
            rows.append((len(rows), f"note {k} contact{c} via: {word} today"))
    return rows, found, plain


@pytest.mark.parametrize("share", [0.1, 0.3, 0.36, 0.6])
def test_precision_and_recall_of_learned_spans(spark, share):
    rows, identifiers, words = _planted(share, int(share * 100))
    got = spans(spark, rows)
    learned = {k for k, s in got.items() if "id:" in s}
    assert len(learned & {*identifiers}) >= 0.9 * len(identifiers)
    assert len(learned & {*identifiers}) >= 0.9 * len(learned)


def test_other_patterns_speak_for_a_word_of_a_weak_shape(spark):
    """A word with an inner sign is marked where its other patterns are sure of it, in a pattern that alone would not be sure enough; plain words are not."""
    names = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    rows = [(100 * c + k, f"log{c} by: user{k}@example.com") for c in range(4) for k in range(30)] + [(100 * c + 40 + k, f"log{c} by: zoe_smith") for c in range(4) for k in range(2)]
    rows += [(1000 + k, f"seen by: user{k}@example.com") for k in range(24)] + [(1100 + k, f"seen by: {n}") for k, n in enumerate(names[:12])] + [(1200, "seen by: zoe_smith"), (1201, "seen by: kim_lee")]
    got = spans(spark, rows)
    assert "id:" in got[1200] and "id:" not in got[1201] and not any("id:" in got[1100 + k] for k in range(12))


def test_ordinary_words_beside_seeds_stay(spark):
    """A context with 36 % of seeds does not vouch for the rest of what it introduces, nor do ten that share their words."""
    rows = [(k, f"c{k % 10} say to: user{k}@example.com") for k in range(72)] + [(100 + k, f"c{k % 10} say to: {'abcdefghijklmnopqrstuvwxyz'[k % 26]}word{'xyz'[k % 3]}") for k in range(128)]
    assert not any("id:" in s for s in spans(spark, rows).values())
    many = [(1000 * c + k, f"say to{c}: user{k}@example.com") for c in range(10) for k in range(20)] + [(1000 * c + 500 + k, f"say to{c}: word{'abcdefghijklmnopqrstuvwxyz'[k]}") for c in range(10) for k in range(26)]
    assert not any("id:" in s for s in spans(spark, many).values())


def test_redact_keeps_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "to a@b.com", 5), (1, "to a@b.com", 5), (None, None, 6), (2, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row long").selectExpr("*", "'x' AS __s", "'y' AS __rk", "'z' AS c0", "1 AS pos")
    got = pii.redact(df)
    assert got.columns == df.columns
    assert sorted(map(str, ((r.doc_id, r.text, r.row, r["__s"], r.c0) for r in got.collect()))) == sorted(map(str, [(1, "to <EMAIL>", 5, "x", "z")] * 2 + [(None, None, 6, "x", "z"), (2, "", 7, "x", "z")]))


def test_credentials_in_their_contexts_are_marked(spark):
    rows = [(k, f'set token = "{k}a{"0123456789abcdef" * 2}" now') for k in range(5)] + [(9, "set token = no")]
    got = spans(spark, rows)
    assert [got[k] for k in range(5)] == ["id:13:47"] * 5 and got[9] == ""


def test_redact_writes_whole_texts_once(spark, monkeypatch):
    written, write = [], pii.materialize
    monkeypatch.setattr(pii, "materialize", lambda df, name, **options: written.append(write(df, name, **options)) or written[-1])
    texts = [f"please write to: {'abcdef'[k % 6]}@example.com {k}" for k in range(12)]
    pii.redact(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    held = [df.columns for df in written if any(kind == "string" and {r[c] for r in df.select(c).collect()} >= set(texts) for c, kind in df.dtypes)]
    assert len(written) > 5 and len(held) == 1
