"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame operations only.

The fixed patterns give the base spans. They are the seeds, together with words that have the shape of a credential (a run of 32 or
more hexadecimal digits with letters and numerals among them), which are no spans by themselves. A lexical pattern is the two words
(runs without white space, in lower case) before the word in which a seed begins; one that introduces fewer than three distinct seeds
is left out at once, and so is one whose seeds are under a tenth of all that it introduces (two common
words that now and then stand before a seed): what the others introduce is at most ten times the seeds, whatever the corpus. Patterns and the instances that they hold anywhere, seeds and words of any shape without
the punctuation around them, form a graph. A pattern's confidence is that of its distinct instances on average, shrunk where there are few. Seeds
have confidence one; any other instance has, within a pattern, what its shape says or what its *other* patterns say (four fifths of their average, shrunk
likewise), whichever is more: no pattern vouches for itself. Plain words, of letters alone, have none: they stand in many patterns because they are common, and are marked only where nearly all that a pattern introduces is personal. This is
repeated to a fixed point. A word is marked where pattern and instance together leave a doubt of at most ``1 - confidence``, the product of both their doubts.

Words are read where they lie, once to count what patterns introduce (after a slice of the rows) and once to follow them; only those that follow such a pattern travel, and only rows with findings get the positions of their
words, as running sums. Joins by pattern or instance are salted, as one of them may hold most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm._common import likely_in, materialize, text_of

KINDS = ("email", "ip", "card", "phone")
LEARNED, CREDENTIAL = 4, 5
#: Parts that a pattern or instance is dealt to in joins.
SALTS = 32
#: The contract's patterns. A start that the preceding character rules out is not tried (a match from there would have begun
#: earlier), and loops that nothing follows give nothing back; both leave matches as they are and bound the time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: The shape of a credential, a seed but no base span.
SECRET = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])"
#: The two words before the word that the end of a text would be in.
_BEFORE = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++[^\x20\x09-\x0D]*+$"
#: A word with the white space before it.
WORD = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    """Whether a match of a kind passes its check."""
    n = F.length(_digits(m))
    card = F.when(n.between(14, 19), _luhn(_digits(m))).otherwise(False)
    return F.when(kind == 1, m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")).when(kind == 2, card).when(kind == 3, n.between(10, 15)).when(kind == CREDENTIAL, m.rlike("[a-fA-F]") & m.rlike("[0-9]")).otherwise(True)


def _matches(text: Column, kind: int, pattern: str, present: Column) -> Column:
    """(kind, gap, m, before) for each match in order: the gap before it, the match, and the text back to the second match before it."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(m: Column, i: Column) -> Column:
        before = F.concat_ws("", F.get(found, i - 2), F.when(i > 0, F.get(gaps, i - 1)), F.get(found, i - 1), F.get(gaps, i))
        return F.struct(F.lit(kind).alias("kind"), F.char_length(F.get(gaps, i)).alias("gap"), m.alias("m"), before.alias("before"))

    return F.when(present, F.transform(found, one)).otherwise(F.array().cast("array<struct<kind:int,gap:int,m:string,before:string>>"))


def _context(first: Column, second: Column) -> Column:
    return F.xxhash64(F.lower(F.concat_ws(" ", first, second)))


def _seeds(rows: DataFrame) -> DataFrame:
    """row, kind, low, high (code points, end exclusive), context, instance (hashes) of each valid match, written."""
    text = F.col("__text")
    digit = text.rlike("[0-9]")
    kinds = [
        (0, EMAIL, F.contains(text, F.lit("@"))),
        (1, IP, digit & text.rlike(r"[0-9]\.[0-9]++\.[0-9]")),
        (2, CARD, digit & text.rlike(r"[0-9][0-9\x20-]{12}")),
        (3, PHONE, F.contains(text, F.lit("+")) & text.rlike(r"\+[0-9]")),
        (CREDENTIAL, SECRET, digit & text.rlike(SECRET)),
    ]
    marked = rows.select("row", F.posexplode(F.flatten(F.array(*[_matches(text, *k) for k in kinds]))).alias("pos", "s"))
    kind, m = F.col("s.kind"), F.col("s.m")
    words = [F.regexp_extract("s.before", _BEFORE, k) for k in (1, 2)]
    context = F.when(words[1] != "", _context(*words))
    narrow = marked.select("row", "pos", kind.alias("kind"), F.col("s.gap").alias("gap"), F.char_length(m).alias("size"), _valid(kind, m).alias("valid"), context.alias("context"), F.xxhash64(m).alias("instance"))
    before = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum(F.col("gap") + F.col("size")).over(before), F.lit(0)) + F.col("gap")
    placed = materialize(narrow, "matches").withColumn("low", low).withColumn("high", F.col("low") + F.col("size"))
    return materialize(placed.where("valid").select("row", "kind", "low", "high", "context", "instance"), "seeds")


def _cut(rows: DataFrame) -> DataFrame:
    """row, w: the words of each text."""
    return rows.select("row", F.filter(F.split("__text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("w"))


def _before(i: Column) -> Column:
    """The context of the word at ``i`` of ``w``, null for the first two."""
    return F.when(i >= 2, _context(F.get("w", i - 2), F.get("w", i - 1)))


def _words(rows: DataFrame) -> DataFrame:
    """row, pos, context, word of each word that two others precede."""
    words = F.transform("w", lambda x, i: F.struct(_before(i).alias("context"), x.alias("word")))
    return _cut(rows).select("row", F.posexplode(words).alias("pos", "s")).select("row", "pos", "s.*").where("context is not null")


def _met(rows: DataFrame) -> DataFrame:
    """The context of each word that two others precede."""
    return _cut(rows).select(F.explode(F.transform("w", lambda x, i: _before(i))).alias("context")).where("context is not null")


def _selective(rows: DataFrame, told: DataFrame) -> DataFrame:
    """The contexts (context), written, of enough distinct seeds and with enough seeds among all words that they introduce.

    ``told`` has a row for each context and instance, with the times that they meet. Counts are folded where the words lie. The
    words of one row in ``SLICE`` are counted first: a context of which those alone are too many for its seeds is out, whatever the other
    rows hold, so the whole count, which decides on all others, meets at most about ``SLICE / LEAST_SHARE`` words a seed.
    """
    left = told.groupBy("context").agg(F.count("*").alias("n"), F.sum("times").alias("seen")).where(F.col("n") >= LEAST_SEEDS).select("context", "seen")
    left = materialize(left, "seeded")
    for part in (rows.where(F.pmod(F.xxhash64("row"), F.lit(SLICE)) == 0), rows):
        counts = likely_in(_met(part), "context", left).groupBy("context").agg(F.count("*").alias("all"))
        counted = left.join(counts, "context", "left").where(F.col("seen") >= LEAST_SHARE * F.coalesce("all", F.lit(0)))
        left = materialize(counted.select("context", "seen"), "contexts")
    return left.select("context")


def _following(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """row, pos, context, instance of each word that may follow one of the contexts; null where the word is all punctuation.

    These are no condition here: Spark would put it before the filter, and bare all words of the corpus.
    """
    bare = F.regexp_replace("word", _EDGES, "")
    cut = likely_in(_words(rows), "context", contexts).select("row", "pos", "context", bare.alias("bare"))
    return cut.select("row", "pos", "context", F.when(F.col("bare") != "", F.xxhash64("bare")).alias("instance"), _shape(F.col("bare")).alias("shape"))


def _shape(bare: Column) -> Column:
    """How much a word's form alone speaks for an identifier: letters and numerals mixed, or many numerals that are no date, do by
    themselves; numerals, or signs within the word, do in a pattern that is trusted; plain words do not."""
    letters, digits = bare.rlike(r"\p{L}"), F.length(F.regexp_replace(bare, "[^0-9]", ""))
    date = bare.rlike(r"^([0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4})$")
    strong = (letters & (digits > 0) & (F.length(bare) >= 5)) | ((digits >= 7) & ~date)
    return F.when(strong, 0.85).when((digits > 0) | bare.rlike(r"[_@/:#]|-.*-"), 0.3).otherwise(0.0)


#: Punctuation around a word, which is no part of an instance.
_EDGES = r"^[^\p{L}\p{N}]++|(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$"


def _salted(rows: DataFrame, salt: Column, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``keys`` (one row for each value of ``key``), inner, no value of the key in one task."""
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    spread = keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(spread, [key, "__salt"]).drop("__salt")


def _placed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, pos) as ``wanted``, with low and high of the word without the punctuation around it."""
    cut = likely_in(rows, "row", wanted.select("row").distinct()).select("row", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("p"))
    own = F.ltrim("word", F.lit(" \t\n\x0b\x0c\r"))
    left, right = F.char_length(F.regexp_extract(own, r"^[^\p{L}\p{N}]*+", 0)), F.char_length(F.regexp_extract(own, r"(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$", 0))
    words = cut.select("row", F.posexplode("p").alias("pos", "word")).select("row", "pos", F.char_length("word").alias("size"), F.char_length(own).alias("own"), left.alias("left"), right.alias("right"))
    upto = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = words.withColumn("end", F.sum("size").over(upto)).join(wanted.select("row", "pos").distinct(), ["row", "pos"], "left_semi")
    return ends.select("row", "pos", (F.col("end") - F.col("own") + F.col("left")).alias("low"), (F.col("end") - F.col("right")).alias("high"))


def _apart(placed: DataFrame, base: DataFrame) -> DataFrame:
    """The (row, pos) of the words that share no character with a base span."""
    near = base.join(placed.select("row").distinct(), "row", "left_semi")
    events = placed.select("row", "pos", "low", "high").unionByName(near.select("row", F.lit(-1).alias("pos"), "low", "high"))
    word, earlier = F.col("pos") >= 0, (Window.unboundedPreceding, -1)
    # what begins with or before a word, and, from the end, what begins after it
    reached = F.max(F.when(~word, F.col("high"))).over(Window.partitionBy("row").orderBy("low", "pos").rowsBetween(*earlier))
    coming = F.min(F.when(~word, F.col("low"))).over(Window.partitionBy("row").orderBy(F.desc("low"), F.desc("pos")).rowsBetween(*earlier))
    told = events.withColumn("reached", reached).withColumn("coming", coming)
    return told.where(word & F.coalesce(F.col("reached") <= F.col("low"), F.lit(True)) & F.coalesce(F.col("coming") >= F.col("high"), F.lit(True))).select("row", "pos")


def marked_links(found: DataFrame, confidence: float = 0.85, rounds: int = 8, tolerance: float = 0.01) -> DataFrame:
    """The (context, instance) that are personal data, from rows (context, instance, seed, shape). Seeds are; those that are no base span, credentials, get their span by this.

    Confidences only rise from round to round and are bounded; rounds end when none moves by more than ``tolerance``, or after ``rounds``.
    """
    edges = found.groupBy("context", "instance").agg(F.max("seed").alias("seed"), F.max("shape").alias("shape"))
    edges = materialize(edges.withColumn("own", F.when(F.col("seed"), 1.0).otherwise(F.col("shape"))), "graph")
    for _ in range(rounds):
        patterns = edges.groupBy("context").agg((F.sum("own") / (F.count("*") + 1)).alias("pattern"))
        held = materialize(_salted(edges.drop("pattern", "was"), F.col("instance"), patterns, "context"), "graph")
        sums = held.groupBy("instance").agg(F.sum("pattern").alias("all"), F.count("*").alias("n"))
        others = F.when(F.col("shape") > 0, 0.8 * (F.col("all") - F.col("pattern")) / F.col("n")).otherwise(0.0)
        told = _salted(held, F.col("context"), sums, "instance")
        edges = materialize(told.select("context", "instance", "seed", "shape", "pattern", F.col("own").alias("was"), F.when(F.col("seed"), 1.0).otherwise(F.greatest("shape", others)).alias("own")), "graph")
        if not (edges.agg(F.max(F.col("own") - F.col("was")).alias("d")).first()["d"] or 0) > tolerance:
            break
    doubt = (1 - F.col("pattern")) * (1 - F.col("own"))
    return edges.where(doubt <= 1 - confidence).select("context", "instance")


#: Distinct seeds that a pattern must introduce, and the share of seeds among all words that it introduces.
LEAST_SEEDS, LEAST_SHARE = 3, 0.1
#: One row in so many is counted before all are; a size of work, it changes no result.
SLICE = 64


def _spans(rows: DataFrame) -> DataFrame:
    """row, kind, low, high of each base span and each learned word, from a written table (row, __text)."""
    seeds = _seeds(rows)
    base = seeds.where(F.col("kind") < LEARNED)
    told = seeds.where("context is not null").groupBy("context", "instance").agg(F.count("*").alias("times"))
    contexts = _selective(rows, told)
    met = materialize(_salted(_following(rows, contexts), F.col("row"), contexts, "context"), "met").where("instance is not null")
    with_base = materialize(met.join(base.select("row").distinct(), "row", "left_semi").select("row", "pos"), "beside")
    apart = materialize(_apart(materialize(_placed(rows, with_base), "placed"), base), "apart")
    free = met.join(with_base, ["row", "pos"], "left_anti").unionByName(met.join(apart, ["row", "pos"], "left_semi"))
    told = told.select("context", "instance", F.lit(True).alias("seed"), F.lit(1.0).alias("shape"))
    edges = _salted(told, F.col("instance"), contexts, "context").unionByName(free.select("context", "instance", F.lit(False).alias("seed"), "shape"))
    links = marked_links(edges).withColumn("__link", F.xxhash64("context", "instance"))
    held = free.withColumn("__link", F.xxhash64("context", "instance")).withColumnsRenamed({"context": "__context", "instance": "__instance"})
    same = (F.col("context") == F.col("__context")) & (F.col("instance") == F.col("__instance"))
    found = materialize(_salted(held, F.col("row"), links, "__link").where(same).select("row", "pos"), "learned")
    columns = ["row", "kind", "low", "high"]
    return base.select(*columns).unionByName(_placed(rows, found).withColumn("kind", F.lit(LEARNED)).select(*columns))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learned, n_spans for each row of ``docs``.

    A null text counts as empty and has no spans. Null ids and rows that repeat give a row each; an empty table none.
    Learned words (kind ``id``) never overlap a base span. Very long runs of digits or letters take time in proportion.
    """
    texts = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("__text")), "rows")
    spans = texts.select("row", "doc_id").join(_spans(texts), "row", "left")
    of = F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("low", "kind", "high"))))
    names = F.array(*[F.lit(k) for k in (*KINDS, "id")])
    rows = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), of.alias("s"), *[F.count_if(F.col("kind") == k).alias(f"n_{n}") for k, n in enumerate(KINDS)], F.count_if(F.col("kind") == LEARNED).alias("n_learned"))

    def written(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x.kind), x.low.cast("string"), x.high.cast("string"))), ",")

    base = F.filter("s", lambda x: x.kind < LEARNED)
    return rows.select("doc_id", *[f"n_{n}" for n in KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("s")).alias("spans"), "n_learned", F.size("s").cast("long").alias("n_spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; spans that overlap become one, named by the first.

    Null texts stay null; repeated rows and columns of any name stay as they are.
    """
    inner = [f"c{i}" for i in range(len(docs.columns))]  # no name of the rows can meet one of the plan's
    text_in = inner[docs.columns.index(text_col)]
    numbered = materialize(docs.toDF(*inner).withColumn("row", F.monotonically_increasing_id()), "rows")
    spans = _spans(numbered.select("row", text_of(text_in).alias("__text")))  # the texts lie there once, however many columns do
    order = Window.partitionBy("row").orderBy("low", "kind")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("__new", F.when(F.col("low") < reached, 0).otherwise(1))
    islands = marked.withColumn("__island", F.sum("__new").over(order)).groupBy("row", "__island").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min_by("kind", F.struct("low", "kind")).alias("kind"))
    by_row = islands.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("low", "high", "kind"))).alias("__s"))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in (*KINDS, "id")])
    text, s = F.col(text_in), F.col("__s")

    def piece(x: Column, i: Column) -> Column:
        at = F.coalesce(F.get(s, i - 1).high, F.lit(0))
        return F.concat(F.substr(text, (at + 1).cast("int"), (x.low - at).cast("int")), F.get(names, x.kind))

    rest = F.substr(text, (F.element_at(s, -1).high + 1).cast("int"))
    clean = F.when(s.isNull(), text).otherwise(F.concat(F.array_join(F.transform(s, piece), ""), rest))
    joined = numbered.join(by_row, "row", "left")
    return joined.select(*[clean.alias(c) if c == text_in else c for c in inner]).toDF(*docs.columns)
