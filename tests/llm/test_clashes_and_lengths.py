"""Extra columns with clashing names, and very long texts."""

from pyspark.sql import functions as F

from gridloom.llm import chat_repair, fingerprint, ngram_join, suffix_dedup, url_filter, warc
from gridloom.llm.common import store
from gridloom.llm.queries import URL_RULES

CLASHING = ["bucket", "place", "hi", "lo", "spans", "size", "kept", "digest", "payload", "refers_to", "copies", "node", "held", "component_id"]


def clashing(frame):
    return frame.withColumns({c: F.lit(f"mine {c}") for c in CLASHING})


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_other_columns_change_nothing(spark):
    long = "some repeated passage of words that goes on for a while " * 20
    docs = spark.createDataFrame([(1, long, "a"), (2, "x " + long, "b"), (3, "short", None), (None, None, "c")],
                                 "doc_id long, text string, source string")
    ranks = fingerprint.fit_ranks(docs)
    for run in (lambda d: fingerprint.edit_chain(d, ranks), lambda d: suffix_dedup.remove_repeats(d),
                lambda d: ngram_join.near_duplicates(d)):
        assert rows_of(run(clashing(docs))) == rows_of(run(docs))
    assert rows_of(fingerprint.fit_ranks(clashing(docs))) == rows_of(ranks) if hasattr(ranks, "collect") else True
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://h/").alias("url"), F.col("text").alias("html"))

    def read(frame):
        archives = store(warc.write_archives(warc.plan_records(frame)), "clash")
        return rows_of(warc.read_archives(archives).select("page_id", "payload_digest", "record_type", "refers_to", "error"))

    assert read(clashing(pages)) == read(pages)


def test_very_long_turns_and_urls(spark):
    text = "word " * 400_000
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "user", "again"), (1, 2, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    found = chat_repair.repair(clashing(turns)).collect()
    assert sum(len(r["rendered"] or "") for r in found) >= 2 * len(text)
    path = "/en/" + "segment/" * 100_000
    pages = spark.createDataFrame([(1, "http://www.Example.net" + path + "?q"), (2, "http://" + "a." * 50_000 + "net/x")],
                                  "page_id long, url string")
    judged = {r["page_id"]: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert judged[1]["rule"] == "example.net/en/" and judged[1]["verdict"] == "allow" and judged[1]["path"] == path
    assert judged[2]["rule"] == "net/" and judged[2]["verdict"] == "block"
