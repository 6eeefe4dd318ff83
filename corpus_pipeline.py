"""The corpus pipeline: documents to token shards, in five stages.

1. language ID: documents without a language go (null text, or no letter in it); without any lang to learn from only these go
2. n-gram Jaccard join: of each class of near copies the document with the smallest doc_id stays (of its texts the one with the smallest hash)
3. benchmark decontamination: documents that hold a window of a benchmark item go
4. mixing: documents are left out or repeated until every source has its share of words
5. token output: the documents are written as Re-Pair compressed token shards and listed with their positions

Every stage takes (spark, docs, sf_dir) and works on all rows of docs; columns beyond those of documents are kept.
Nulls, empty and very long texts, repeated rows and empty tables are handled as the operators say. In stage 2
rows without words stay, and a row is dropped for its own text, never because its doc_id occurs again or is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import decontaminate, language_id, mixing, ngram_join, token_store
from matchlake.llm.encoders import vocabulary_path
from matchlake.llm.queries import BYTE_BPE, BYTE_BPE_IDS
from matchlake.llm.scratch import prepare, stored
from matchlake.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, learned from the lang column where it is not null."""
    prepare(spark)
    model = language_id.train(docs)
    if model is None:
        return docs.filter(language_id.has_letter())
    taken = {"lang_pred", "score", "ambiguous"}
    inner = docs.select(*[F.col(f"`{c}`").alias(f"given#{c}" if c in taken else c) for c in docs.columns])
    kept = language_id.predict(inner, model).filter(F.col("lang_pred") != language_id.UND)
    return kept.select(*[F.col(f"`given#{c}`" if c in taken else f"`{c}`").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five words, similarity 0.8."""
    prepare(spark)
    return ngram_join.without_near_copies(docs, n=5, percent=80)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    prepare(spark)
    return mixing.repeat(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, n_symbols of every document in the token shards."""
    prepare(spark)
    folder = scratch_path(spark, "llm-pipeline-tokens")
    token_store.write_tokens(docs, folder, vocabulary_path(BYTE_BPE), 0, BYTE_BPE_IDS)
    return token_store.read_documents(spark, folder)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", remove_benchmarks),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: language models, knapsacks and token ids have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
