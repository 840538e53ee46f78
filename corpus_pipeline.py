"""From raw documents to packed sequences: the five stages, each over all rows that its predecessor kept.

1. quality: documents above the perplexity threshold of their language go.
2. exact_dedup: of equal texts (white space aside) the one with the smallest id stays.
3. near_dedup: of each group that pairs with a Jaccard similarity of five-word shingles of at least 0.8 connect, one document stays;
   linked fingerprints (op8) and MinHash bands propose the pairs.
4. pii: personal data is replaced by its kind.
5. packing: token pieces with their sequences and offsets.

All stages but the last return the columns they got. Null texts count as empty and leave with the first stage, as they
have no perplexity; null ids and repeated rows are handled as the operators say; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import exact_dedup, near_copies, packing, pii, quality
from windrow.llm._common import materialize
from windrow.llm.queries import table, tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop_near_copies(docs, similarity=0.8, words=5)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), size=2048, separator=0)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]

#: Perplexities, fingerprints and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
