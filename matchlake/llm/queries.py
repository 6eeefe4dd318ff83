"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (backoff_lm, chat_format, decontaminate, exact_dedup, language_id, mixing, ngram_join, packing, pivot_clusters, token_counts,
               token_store, warc, whitening)
from .encoders import vocabulary_path
from .scratch import read, stored

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE, BYTE_BPE_IDS = "byte_bpe_50k.json", 50257
PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm-tokens")
    token_store.write_tokens(read(spark, sf_dir, "documents"), folder, vocabulary_path(BYTE_BPE), 0, BYTE_BPE_IDS)
    return token_store.read_documents(spark, folder)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(read(spark, sf_dir, "documents"), n=3, percent=90)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", language_id.held_out("doc_id").alias("held_out"))
    model = language_id.train(documents.filter("not held_out"))
    return language_id.predict(documents.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.col("n_hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        decontaminate.digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


CONTROL = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(f"SELECT -1L AS conv_id, i AS turn, r AS role, '{CONTROL}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(i, r)")
    written = stored(chat_format.conversations(chat_format.format_turns(given.unionAll(planted))), "chats")
    turns = chat_format.parse(F.col("formatted"))
    said = F.concat(*[F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))])
    learned = F.transform(F.filter("segments", lambda s: s["learn"]), lambda s: chat_format.unescape(s["text"]))
    return written.withColumn("turns", turns).withColumn("loss", F.array_join(learned, "")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op7_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = language_id.held_out("doc_id", 5, 1)
    chunks = backoff_lm.encode(documents.withColumn("training", ~held))
    model = backoff_lm.learn(chunks.filter("training"))
    scored = backoff_lm.read_through(chunks, model)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm-warc")
    index = warc.write_archives(read(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), vocabulary_path(PIECES))


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.with_inertia(*pivot_clusters.cluster(read(spark, sf_dir, "embeddings")))


def op12_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = packing.pack_sequences(read(spark, sf_dir, "documents"), vocabulary_path(WORD_BPE), end_id=2)
    return packing.pieces(stored(sequences, "sequences"))


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_token_store, op2_ngram_jaccard_join, op3_language_id, op4_decontaminate, op5_mix_sources, op6_chat_format,
    op7_backoff_lm, op8_exact_dedup, op9_warc, op10_token_counts, op11_pivot_clusters,
    op12_block_whitening, op13_bin_slack_packing)}
