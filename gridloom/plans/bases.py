"""Inputs of the grouping and manifest queries, derived by Spark from the
driver tables (their size grows with the tables).

Base table B (survey samples) from ``customer``:
  bldgid = c_custkey
  county = 'C' + zero-filled (c_custkey // 10) to five
  puma   = by (c_custkey // 60) % 3:
           0 -> 'A' + (c_custkey // 5), 1 -> 'B' + (c_custkey // 20),
           2 -> 'D' + ((c_custkey + 5) // 20)
  weight = decimal(c_acctbal + 1000)
Zones: 'Z' + (county_no // 3) % 2, null where county_no % 11 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.codes import zfill
from gridloom.sources.tables import table


def idiv(col: Column, d: int) -> Column:
    return F.floor(col / F.lit(d)).cast("long")


def samples_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    k = F.col("c_custkey")
    branch = F.pmod(idiv(k, 60), F.lit(3))
    puma = (F.when(branch == 0, F.concat(F.lit("A"), idiv(k, 5).cast("string")))
            .when(branch == 1, F.concat(F.lit("B"), idiv(k, 20).cast("string")))
            .otherwise(F.concat(F.lit("D"), idiv(k + 5, 20).cast("string"))))
    return c.select(
        k.alias("bldgid"),
        F.concat(F.lit("C"), zfill(idiv(k, 10).cast("string"), 5)).alias("county"),
        puma.alias("puma"),
        (F.col("c_acctbal") + 1000).cast("decimal(18,2)").alias("weight"),
    )


def county_zone(county: Column) -> Column:
    """Zone of a B county code."""
    no = F.substring(county, 2, 1 << 20).cast("long")
    return (F.when(F.pmod(no, F.lit(11)) == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("Z"), F.pmod(idiv(no, 3), F.lit(2)).cast("string"))))


def documents_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object listing built from ``documents``: (key, size, doc_id).

    en: ``timeseries/upgrade=<u>/state=<st>/<source>_<id>.csv``
    fr: ``annual/full/<st>_upgrade<u>_agg_<id>.csv`` (state, upgrade in the name)
    de: ``annual/basic/upgrade<u>_<id>.csv``         (no state anywhere)
    other: ``timeseries/upgrade=<u>/state=<st>/<source>_<id>.parquet``
    with u = doc_id % 3 and st from doc_id % 4 over (AL, CA, TX, NY).
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    u = F.pmod(F.col("doc_id"), F.lit(3)).cast("string")
    st = F.element_at(F.array(*[F.lit(s) for s in ("AL", "CA", "TX", "NY")]),
                      (F.pmod(F.col("doc_id"), F.lit(4)) + 1).cast("int"))
    ts = F.concat(F.lit("timeseries/upgrade="), u, F.lit("/state="), st, F.lit("/"),
                  F.col("source"), F.lit("_"), F.col("doc_id").cast("string"))
    key = (F.when(F.col("lang") == "en", F.concat(ts, F.lit(".csv")))
           .when(F.col("lang") == "fr", F.concat(F.lit("annual/full/"), st, F.lit("_upgrade"), u, F.lit("_agg_"),
                                                      F.col("doc_id").cast("string"), F.lit(".csv")))
           .when(F.col("lang") == "de", F.concat(F.lit("annual/basic/upgrade"), u, F.lit("_"),
                                                      F.col("doc_id").cast("string"), F.lit(".csv")))
           .otherwise(F.concat(ts, F.lit(".parquet"))))
    return d.select(key.alias("key"), F.col("n_chars").alias("size"), "doc_id")
