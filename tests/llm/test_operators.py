"""The ten operators against brute force, exact round trips and SQL, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from windrow.llm import chat, exact_dedup, kd_search, packing, pii, piece_codec, queries, quality, sharding, simhash, substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table, with odd rows, and with columns named like those that operators make."""
    odd = [(-1, None, None, None, None), (None, "no id", "en", "s", 5), (-2, "", "en", "", 0), (-3, "a b c", "xx", "s", 5), (-4, "a\t b  c", "xx", "s", 6), (-5, "long " * 30_000, "en", "s", 1)]
    table = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(spark.createDataFrame(odd, DOCS))
    clash = ("digest", "keep_id", "group_size", "kept", "fp", "rk", "row", "key", "span", "shard", "slot", "n", "k", "v", "root", "class", "logp", "perplexity", "__text", "component_id")
    return table.select("*", *[F.lit("x").alias(c) for c in clash]).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(same, name):
    same(queries.QUERIES[name], queries.ORACLE_SQL[name])


# exact dedup


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            out.append((i, keep, len(ids), sha(t)))
    return Counter(out)


def test_exact_dedup(docs, texts):
    found = exact_dedup.exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute_copies(texts)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_exact_dedup_bytes_decide(docs, texts):
    """With an index key of a few values most hits are false."""
    found = exact_dedup.exact_dedup(docs, digest=lambda t: F.pmod(F.xxhash64(t), F.lit(7))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute_copies(texts)


def test_exact_dedup_repeated_rows(spark, none):
    df = spark.createDataFrame([(3, "x"), (3, "x"), (5, "x"), (None, "y"), (None, "y"), (8, None), (9, "")], "doc_id long, text string")
    found = exact_dedup.exact_dedup(df).collect()
    kept = Counter((r.keep_id, r.text_sha256) for r in found if r.kept)
    assert len(found) == 7 and kept == {(3, sha("x")): 1, (None, sha("y")): 1, (8, sha("")): 1}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in exact_dedup.drop_copies(df).collect()) == [(False, 3), (False, 8), (True, 0)]
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_index_merges_levels(docs):
    half = docs.where(F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0), docs.where(F.coalesce(F.col("doc_id"), F.lit(0)) % 2 != 0)
    stepwise = exact_dedup.compact(exact_dedup.compact(exact_dedup.flush(half[0])), exact_dedup.flush(half[1]))
    once = exact_dedup.compact(exact_dedup.flush(docs))
    assert stepwise.exceptAll(once).isEmpty() and once.exceptAll(stepwise).isEmpty()


# top-k


def test_top_k(spark):
    random.seed(1)
    rows = [(i, [random.choice([-1.0, 0.0, 0.25, 1.0]) for _ in range(6)]) for i in range(700)]
    rows += [(700, None), (750, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] * 6), (850, [float("inf")] * 6), (900, [1.0, 2.0]), (901, [1.0, 1.0]), (None, [1.0] * 6), (10, [1.0] * 6), (1000, [1e18] * 6), (1001, [1e17] * 6), (1050, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = defaultdict(list)
    for r in sorted(kd_search.top_k(df, F.col("vec_id") % 50 == 0, block=6).collect()):
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = {}
    for q, v in ((q, v) for q, v in good if q % 50 == 0):
        scores = [(min(sum(a * b for a, b in zip(v, w, strict=True)), 2**63 - 1), i) for i, w in good if i != q and len(w) == len(v)]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:5]
        if best:
            expected[q] = [(k + 1, i, s) for k, (s, i) in enumerate(best)]
    assert found == expected
    assert kd_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_scores_beyond_doubles(spark):
    """Components near 1e8 give scores that no double tells apart."""
    random.seed(3)
    rows = [(i, [float(10**8 + random.randint(0, 3)) for _ in range(2)]) for i in range(120)]
    found = kd_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, scale=1).collect()
    expected = []
    for q, v in rows[::50]:
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, found)) == expected


def test_top_k_components_beyond_doubles(spark):
    """A component that passes the doubles when scaled counts as the largest double of its sign."""
    most = int(np.finfo(np.float64).max)
    rows = [(i, [float(i % 7), float(i % 5) - 2]) for i in range(1, 300)] + [(300, [1e308, -1e308]), (350, [1e308, 1.0]), (301, [-1e308, 0.0]), (302, [0.0, 1e308])]
    found = kd_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 50 == 0).collect()

    def whole(x):
        y = np.floor(256 * x) if abs(x) < 1e300 else np.inf * x
        return int(y) if np.isfinite(y) else most if y > 0 else -most

    held = dict((i, [whole(x) for x in v]) for i, v in dict(rows).items())
    expected = []
    for q in sorted(i for i in held if i % 50 == 0):
        scores = [(-max(-(2**63), min(sum(a * b for a, b in zip(held[q], v, strict=True)), 2**63 - 1)), i) for i, v in held.items() if i != q]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:5])]
    assert sorted(map(tuple, found)) == expected


def test_trees_prune():
    """The queue leaves boxes unvisited, and the result is that of all rows."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(4096, 3)) * 256)
    order, nodes = kd_search.build_tree(x, 64)
    x, ids = x[order], order.astype(np.int64)
    low, high = (np.stack([f(x[a:b], 0) for a, b in nodes[:, :2].tolist()]) for f in (np.min, np.max))
    best = kd_search.Best(ids[:50], x[:50], 5)
    best.shard(ids, x, nodes, low, high)
    assert best.visited < best.leaves / 4
    for q in range(50):
        s = (x @ x[q]).astype(int)
        assert [(a, b) for a, b in zip(best.score[q].tolist(), best.found[q].tolist(), strict=True)] == [(-a, b) for a, b in sorted(zip((-s).tolist(), ids.tolist(), strict=True)) if b != ids[q]][:5]


# quality


def test_quality(spark, docs, none):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    more_labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.classify(more, more_labels).join(more_labels, "doc_id").toPandas()
    clean, junk = scored[(scored.quality == 1) & (scored.toxic == 0)], scored[scored.quality == 0]
    assert clean.keep.mean() > 0.98 and junk.keep.mean() < 0.5
    odd = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(odd) == docs.select("doc_id").distinct().count() and not odd[-1].keep and odd[-1].perplexity is None and None in odd
    assert quality.classify(none, labels).count() == 0
    assert quality.classify(docs, labels.limit(0)).where("keep").count() == docs.where("length(text) > 0").count()


def test_quality_shards_agree(docs):
    model = quality.train(docs.where("doc_id > 0").limit(60).select(F.col("text")))
    total = model.where("length(gram) > 0 and logp is not null").count()
    assert total > 1000
    whole = {r.doc_id: r for r in quality.perplexity(docs, model).collect()}
    cut = {r.doc_id: r for r in quality.perplexity(docs, model, entries=total // 3).collect()}
    for i, r in whole.items():
        assert r.n_tokens == cut[i].n_tokens and (r.perplexity is None or abs(r.logp - cut[i].logp) < 1e-3 * max(1, abs(r.logp)))


def test_quality_model_sums_to_one(spark):
    """After any context the model's probabilities of all symbols add up to one."""
    model = quality.train(spark.createDataFrame([("abab cab abc bca",), ("cabbage",), (" ab ab",)], "text string")).collect()
    logp = {r.gram: r.logp for r in model if r.logp is not None}
    backoff = {r.gram: r.backoff for r in model if r.backoff is not None}
    symbols = [g for g in logp if len(g) == 1]

    def p(context, w):
        for k in range(len(context) + 1):
            if (g := context[k:] + w) in logp:
                return np.exp(logp[g] + sum(backoff.get(context[j:], 0) for j in range(k)))
        return np.exp(sum(backoff.get(context[j:], 0) for j in range(len(context) + 1)) - np.log(len(symbols) + 1))

    for context in ("", "a", "ab", "abab", "zzz", "\x02" * 4):
        unseen = p(context, "~")
        assert abs(sum(p(context, w) for w in symbols) + unseen - 1) < 1e-6 or context == ""


# sentencepiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))


def test_codec_is_the_library(texts, library):
    codec = piece_codec.PieceCodec(queries.tokenizer_file("piece_bpe_32k.model"))
    random.seed(4)
    alphabet = "ab e▁ \n\t é名€́\x00😀thein,.<0x0A></s>"
    hard = ["", "  ", " a", "a ", "▁", "<s>", "<0x0A>", " \nx", "x \n"] + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(800)]
    for t in hard + [t or "" for _, t in texts[:80]]:
        ids = library.encode(t)
        assert codec.encode(t) == ids and codec.decode(ids) == library.decode(ids)
        assert codec.digest(t) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    for _ in range(500):
        ids = [random.randrange(3, 259) if random.random() < 0.5 else random.randrange(32000) for _ in range(6)]
        assert codec.decode(ids) == library.decode(ids)


def test_codec_over_tables(docs, texts, library, none):
    model = queries.tokenizer_file("piece_bpe_32k.model")
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in piece_codec.digest_documents(docs, model).collect())
    ids = [(i, library.encode(t or "")) for i, t in texts]
    assert found == Counter((i, len(x), sha(",".join(map(str, x)))) for i, x in ids)
    back = piece_codec.decode_documents(piece_codec.encode_documents(docs, model), model)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, library.decode(x)) for i, x in ids)
    assert piece_codec.digest_documents(none, model).count() == 0


# packing


def test_packing(docs, texts, none):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("word_bpe_49k.json")
    rows = packing.pack(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            piece = np.array(ids[k : k + 2048], "<u4")
            expected[i, k // 2048, k, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in rows) // 2048) + 3
    assert packing.pack(none, path).count() == 0


def test_plan_uses_each_piece_once():
    random.seed(2)
    for _ in range(20):
        lengths = [random.randint(1, 64) for _ in range(random.randint(1, 500))]
        histogram = np.bincount(lengths, minlength=65)
        plan = packing.plan(histogram, 64)
        used = np.zeros(65, int)
        for sequence, n in plan:
            assert sum(sequence) <= 64
            for v in sequence:
                used[v] += n
        assert (used == histogram).all()
        bfd = sum(n for _, n in packing.best_fit(histogram, 64))
        assert sum(n for _, n in plan) <= max(bfd + 2, 1.03 * bfd)


def test_words_encode_as_the_library_does():
    from windrow.llm.word_ids import WordIds

    encoder = WordIds(queries.tokenizer_file("word_bpe_49k.json"))
    hard = ["A<|endoftext|>b <|STARTOFTEXT|>", "İSTANBUL ΣΑΣ ß é é ﬁ don't I'LL x's 12ab\x1c\x1d q.. , .", "名字 и Русский ТЕКСТ. ǅ ⅷ Ⅷ ª", "the&&& THE!!", None, ""]
    for t, got in zip(hard, encoder.packed(hard), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


# substring dedup


def brute_repeats(rows, size=35):
    found, seen = [(i, words(t)) for i, t in rows], Counter()
    for _, w in found:
        seen.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = Counter()
    for i, w in found:
        covered = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                covered[k : k + size] = True
        out[i, len(w), int(covered.sum()), sha(" ".join(x for x, c in zip(w, covered, strict=True) if not c))] += 1
    return out


def test_substring_dedup(spark, docs, texts, none):
    got = substring_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(texts)
    random.seed(3)
    base = [[random.choice("abcdefgh") for _ in range(200)] for _ in range(5)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(random.randint(0, 5)):
            kind, b, a = random.random(), random.choice(base), random.randint(0, 150)
            w += b[a : a + random.randint(20, 60)] if kind < 0.4 else [random.choice("xy")] * random.randint(1, 80) if kind < 0.6 else random.choice([["p", "q"], ["m", "m", "n"]]) * random.randint(1, 40) if kind < 0.75 else [random.choice("abcdefghijkl") for _ in range(random.randint(1, 60))]
        rows.append((i, " ".join(w)))
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(df).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_repeats(rows)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substring_dedup_of_words_that_polynomials_confuse(spark):
    """A word of a and b by the parity of ones in its places, and its complement, have one polynomial hash modulo 2**64, whatever the base."""
    odd = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    rest = [f"w{k}" for k in range(34)]
    rows = [(1, " ".join([odd, *rest])), (2, " ".join([odd.translate(str.maketrans("ab", "ba")), *rest]))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 0)]


# chat


def test_chat_round_trip(spark):
    random.seed(6)
    alphabet = ["~", "0", "1", "2", "3", "<", "|", "end", ">", "[", "INST", "]", "\n", "é", "😀", "\\", "</s>", "<|end|>\n", "<|user|>\n"]
    rows = [(c, t, random.choice(["user", "assistant", "system", None, "x\n|>\ny<", "assistant"]), random.choice([None, ""]) if random.random() < 0.1 else "".join(random.choices(alphabet, k=12))) for c in range(60) for t in range(random.randint(1, 6))]
    rows += [(None, None, None, None), (61, 1, "user", "b"), (61, 1, "user", "a"), (61, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df.select("*", chat.text_parts(F.col("text")).alias("parts")).withColumn("loss", F.lit(1)))
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    for c, turns in by.items():
        if c is not None:
            turns.sort()
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in turns]
        assert back[c].loss_text == "".join(x for _, r, x in turns if r == "assistant")
    assert chat.format_conversations(df.select("*", chat.text_parts(F.col("text")).alias("parts")).limit(0)).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see <", None, None, None, None, None), ("image", None, "a.png", 30, 14, None, None), ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 2), ("odd", "x", None, None, None, None, None), ("text", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    r = chat.format_conversations(df).first()
    assert r.formatted == "<|user|>\nsee ~1<|image|><|audio|><|document|><|end|>\n<|assistant|>\n<|end|>\n"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 38), (0, "document", "c.pdf", 512)]


# simhash


def brute_components(rows):
    import xxhash

    prints = []
    for _, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
        prints.append(sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h)) if len(h) else 0)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 4:
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)] += [i] if i is not None else []
    return Counter((i, f"{prints[k]:016x}", min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows))


def test_simhash(docs, texts, none):
    assert Counter(map(tuple, simhash.near_dedup(docs).collect())) == brute_components(texts)
    assert simhash.near_dedup(none).count() == 0


def test_simhash_large_buckets(spark, monkeypatch):
    """Chains, clusters and buckets of several chunks lose no link and emit no square of a group."""
    random.seed(9)
    monkeypatch.setattr(simhash, "CHUNK", 16)
    center, prints = random.getrandbits(64), set()
    for _ in range(300):
        x = center
        for b in random.sample(range(64), random.randint(0, 3)):
            x ^= 1 << b
        prints.add(x)
    x = random.getrandbits(64)
    for _ in range(80):  # a chain
        for b in random.sample(range(64), 4):
            x ^= 1 << b
        prints.add(x)
    prints |= {random.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    values, parent = sorted(signed), {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v

    for k, a in enumerate(values):
        for b in values[:k]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert all(roots.get(v, v) == find(v) for v in values)


# personal data


KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base_spans(text):
    out = []
    for k, (_, pattern) in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum((2 * int(c) - (9 if int(c) > 4 else 0)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
            if (k == 0) or (k == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (k == 2 and 14 <= len(d) <= 19 and luhn) or (k == 3 and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(out))


def test_pii(spark, docs, texts, none):
    random.seed(2)
    parts = ["1", "2.", "255", "256", ".", "@", "a.b", "x@y.z", "+1", " (5", "-", "4111 1111 1111 1111", "4111-1111-1111-1111", "1.2.3.4", "é", "😀", " ", "\n", "_", "d@e.f", "000", "+44 20 7946 0958", "%", "5555555555554444"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 25)))) for i in range(800)]
    rows += [(5000, "1" * 4_000), (5001, "1 2-" * 3_000), (5002, "a." * 2_000 + "@"), (5003, "+1 " + "(2)" * 4_000), (5004, "x@y" + ".z" * 4_000)]
    for df, source in ((docs, texts), (spark.createDataFrame(rows, "doc_id long, text string"), rows)):
        found = pii.find_pii(df).collect()
        assert Counter((r.doc_id, r.base_sha256, ",".join(s for s in r.spans.split(",") if not s.startswith("id:"))) for r in found) == Counter((i, sha(s), s) for i, s in ((i, base_spans(t)) for i, t in source))
    assert pii.find_pii(none).count() == 0 and pii.redact(none).count() == 0


def test_pii_long_runs(spark):
    """Time in proportion to the text, where naive matching takes its square."""
    rows = [(0, "1" * 300_000), (1, "1 2-" * 80_000), (2, "a." * 150_000 + "@"), (3, "+1 " + "(2)" * 80_000), (4, "x@y" + ".z" * 150_000)]
    found = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: "", 1: "", 2: "", 3: "", 4: "email:0:300003"}


def test_pii_learns_contexts(spark):
    rows = [(i, f"you can mail me at: u{i}@example.com today, order no: {i}17") for i in range(8)] + [(20, "you may mail me at: handle77x now"), (21, "version no: 9x")]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[20].spans == "id:20:29" and found[20].n_learned == 1 and found[21].spans == "" and found[3].n_learned == 0


def test_redact(spark):
    rows = [(9, "a@b.c 1.2.3.4\n4111 1111 1111 1111 é x"), (9, "a@b.c 1.2.3.4\n4111 1111 1111 1111 é x"), (10, None), (11, "none"), (None, "😀 +44 20 7946 0958!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("x"))
    got = Counter((r.doc_id, r.text, r.kind) for r in pii.redact(df).collect())
    assert got == {(9, "<EMAIL> <IP>\n<CARD> é x", "x"): 2, (10, None, "x"): 1, (11, "none", "x"): 1, (None, "😀 <PHONE>!", "x"): 1}


# sharding


def test_sharding(docs, texts, none):
    rows = sharding.stratified_shards(docs, shards=8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots, mixture = defaultdict(list), defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        mixture[r.source][r.shard] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for counts in mixture.values():
        each = sum(counts.values()) / 8
        assert all(abs(counts[s] - each) <= 2 for s in range(8))
    again = sharding.stratified_shards(docs.repartition(3), shards=8).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in rows) == Counter((r.doc_id, r.shard, r.slot) for r in again)
    assert sharding.stratified_shards(none).count() == 0
