"""Every stage of the pipeline, and every operator on documents, over rows whose extra columns have the names that plans like to use."""

from __future__ import annotations

import corpus_pipeline
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from windrow.llm import decompose, exact_dedup, lexical_search, packing, phrases, pii, piece_codec, quality, sharding, simhash, substring_dedup
from windrow.llm.queries import tokenizer_file

NAMES = ["__gone", "__s", "__sha", "__rk", "__id", "__row", "__text", "__stays", "__island", "c0", "c1", "row", "rk", "class", "root", "digest", "keep_id", "bundle", "at", "key", "low", "kind", "n", "shard", "node", "lang_"]
OPERATORS = {
    "exact_dedup": exact_dedup.exact_dedup,
    "simhash": simhash.near_dedup,
    "pii": pii.find_pii,
    "substring_dedup": substring_dedup.remove_repeats,
    "quality": lambda d: quality.classify(d, d.sparkSession.read.parquet(f"{DATA}/labels.parquet")),
    "packing": lambda d: packing.pack(d, tokenizer_file("word_bpe_49k.json"), size=2048, separator=0),
    "sharding": sharding.stratified_shards,
    "piece_codec": lambda d: piece_codec.digest_documents(d, tokenizer_file("piece_bpe_32k.model")),
    "decompose": lambda d: decompose.decompose(d, tokenizer_file("byte_bpe_50k.json")),
    "lexical_search": lambda d: lexical_search.top_documents(d, d.sparkSession.read.parquet(f"{DATA}/benchmark.parquet")),
    "phrases": phrases.collocations,
}


@pytest.fixture(scope="module")
def plain(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = docs.limit(1).select(F.lit(-5).cast(docs.schema["doc_id"].dataType).alias("doc_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields[1:]])
    return docs.unionByName(odd)


@pytest.fixture(scope="module")
def clashing(plain):
    return plain.select(*[F.lit(k % 3).alias(n) for k, n in enumerate(NAMES)], *plain.columns)


def rows(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage(spark, plain, clashing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, clashing, DATA)
    assert out.columns == clashing.columns
    assert all(out.where(F.col(n) != k % 3).isEmpty() for k, n in list(enumerate(NAMES))[:3])
    assert rows(out, plain.columns) == rows(stage(spark, plain, DATA), plain.columns)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator(plain, clashing, name):
    got, want = OPERATORS[name](clashing), OPERATORS[name](plain)
    keys = [c for c in want.columns if c not in ("sequence_id", "offset")]
    assert got.columns == want.columns and rows(got, keys) == rows(want, keys)
