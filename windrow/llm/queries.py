"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import chat, decompose, exact_dedup, kd_search, lexical_search, packing, phrases, pii, piece_codec, quality, sharding, simhash, substring_dedup
from windrow.llm._common import reachable


def tokenizer_file(name: str) -> str:
    """The default place of a public vocabulary; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON n.t = g.t
"""


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digest_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), size=2048, separator=0)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    formatted = chat.format_conversations(turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))))
    return chat.read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '~', ''), '<', ''), '[', ''))
             + length(role) + length(role) - length(replace(replace(replace(replace(role, '~', ''), '<', ''), '[', ''), chr(10), '')) + 13 AS written FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(written)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"), distance=4)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.stratified_shards(table(spark, sf_dir, "documents"), shards=8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
o AS (SELECT row, doc_id, unnest(regexp_extract_all(t, '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM d),
p AS (SELECT row, doc_id, term, count(*) AS tf FROM o GROUP BY ALL),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM p GROUP BY row),
c AS (SELECT count(*) AS n, sum(n)::BIGINT AS l FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, c.n),
s AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n.n * c.n) // c.l))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (row), c GROUP BY ALL HAVING score > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=10, longest=3, covered=50, keep=2000)


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, len(w) AS size, k, i, w FROM p, generate_series(1, 3) AS t(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(i)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY 1, 2, 3),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 10),
x AS (SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail FROM c, generate_series(1, 2) AS t(cut) WHERE cut < k),
s AS (SELECT x.*, l.a AS l, r.a AS r, ((1000000 * x.a::HUGEINT * x.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.head AND l.k = x.cut JOIN f r ON r.lang = x.lang AND r.phrase = x.tail AND r.k = x.k - x.cut),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
m AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE k = 3) GROUP BY 1, 2),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
z AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b
      WHERE k = 3 OR NOT EXISTS (SELECT 1 FROM m WHERE m.lang = b.lang AND m.phrase = b.phrase AND 100 * m.a >= 50 * b.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""


def op13_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = decompose.decompose(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), size=1024, separator=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket", "batch_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_top_k": op2_top_k,
    "op3_quality": op3_quality,
    "op4_piece_codec": op4_piece_codec,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_sharding": op10_sharding,
    "op11_lexical_search": op11_lexical_search,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_binary_packing": op13_binary_packing,
}
ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op2_top_k": OP2_SQL, "op7_chat_formatting": OP7_SQL, "op11_lexical_search": OP11_SQL, "op12_phrase_collocations": OP12_SQL}
