"""The registered queries of this package: thin, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import (
    chat_repair, decontam, filter_audit, fingerprint, language_mixture, mixing, ngram_join, prefix_trie, secret_scan,
    suffix_dedup, toxicity, url_filter, warc,
)
from gridloom.llm.common import store
from gridloom.sources.tables import table

URL_RULES = url_filter.parse_rules([
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")])


def op1_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return fingerprint.edit_chain(docs, fingerprint.fit_ranks(docs))


def op2_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.labelled_samples(docs)))
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op5_chat_repair(spark: SparkSession, sf: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf, "conversations"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    archives = store(warc.write_archives(warc.plan_records(table(spark, sf, "pages"))), "warc")
    return warc.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language_mixture.predict(docs.select("doc_id", "text"), language_mixture.learn(docs))
    return found.select("doc_id", language_mixture.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprint": op1_fingerprint,
    "op2_ngram_join": op2_ngram_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_chat_repair": op5_chat_repair,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_language_mixture": op12_language_mixture,
    "op13_prefix_trie": op13_prefix_trie,
}
