"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import blob_ledger, chat, chroma, decontaminate, jaccard_join, language_hd, mixing, pii_crf, url_markov, warc
from tallyforge.llm.storage import new_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page."""
    return url_markov.judged(_table(spark, sf_dir, "pages"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans of every document."""
    return pii_crf.found(_table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document, through a new ledger."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = blob_ledger.extend_ledger(docs, None, new_path(spark, "ledger"))
    found = blob_ledger.by_path(docs, ledger, "doc_id")
    base = F.filter("findings", lambda f: f["kind"].isin(*blob_ledger.BASE))
    listed: Callable[[Column], Column] = lambda fs: F.array_join(F.transform(fs, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    count: Callable[[str], Column] = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in blob_ledger.BASE]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))


def op4_mix_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mixing.mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation and of conversation -1."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turned = chat.canonical(chat.message_records(rows.unionByName(more)), "payload")
    return chat.digests(chat.formatted(turned))


def op6_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, match_id, offset, votes, overlap, ber, matched, relation of the vectors whose ids are divisible by 20, against the recordings of all: the best of each, all alignments of classes that match, and the class of each id."""
    media = chroma.rendered(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return chroma.related(chroma.fingerprints(media, "id", "audio"), F.col("id") % 20 == 0)


def op7_language_hd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    return language_hd.identified(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from the archives."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, n_links of every document."""
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_url_markov, op2_pii_crf, op3_secret_ledger, op4_mix_systematic, op5_chat_fingerprint, op6_chroma, op7_language_hd, op8_decontaminate, op9_warc_index, op10_jaccard_join)}
