"""Corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

Each stage works on all that its predecessor kept:

1. ``toxicity`` drops the documents that the classifier rejects (score 0.5 or
   more); the classifier is fitted on the labelled rows of its input.
2. ``near_duplicates`` keeps one document of each group of near copies, that
   with the smallest id.
3. ``decontamination`` cuts benchmark passages out of the texts and drops
   documents that consist mostly of them.
4. ``secrets`` replaces secrets by a mark.
5. ``mixing`` mixes the sources to their target weights: one row per taken
   copy, with its output shard and place.

Clean documents pass the first four stages unchanged.  Where a text changes,
``n_chars`` follows it.  Null texts count as empty; they, and texts without
words, are kept by every filtering stage and are never copies of each other.
Texts of any length are treated whole.  Of tied rows (one id, one text) the
join keeps one.  Extra columns are carried through the first four stages under
their names, whatever a stage calls its own.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontam, mixing, ngram_join, secret_scan, toxicity
from gridloom.llm.common import collect_driver_garbage, store
from gridloom.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC = 0.5
WORK = "_chars_before"


def _with_length(docs: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``change``; rows whose text changed get its new length."""
    changed = change(docs.withColumn(WORK, F.length("text")))
    length = F.length("text")
    return changed.withColumn("n_chars", F.when(length != F.col(WORK), length.cast("long"))
                              .otherwise(F.col("n_chars"))).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model, TOXIC)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return _with_length(docs, lambda d: decontam.remove_contamination(d, items))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ratios = secret_scan.train(secret_scan.labelled_samples(docs))
    return _with_length(docs, lambda d: secret_scan.redact(d, ratios))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def _fresh(stage: Stage) -> Stage:
    """The stage, begun without what earlier ones left in the driver."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        collect_driver_garbage(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _fresh(toxicity_stage)),
    ("near_duplicates", _fresh(near_duplicates_stage)),
    ("decontamination", _fresh(decontamination_stage)),
    ("secrets", _fresh(secrets_stage)),
    ("mixing", _fresh(mixing_stage)),
]

#: Trained models and graph components have no SQL form; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
