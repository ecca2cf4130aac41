"""Census reference inputs of the county-group job, passed in as files
(the job never fetches them itself)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.codes import FIPS_TO_STATE, STATE_TO_FIPS, gisjoin_county, gisjoin_puma, lookup
from gridloom.sources.files import read_all_string


def read_county_reference(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """National county list (all text): kept for the 50 states + DC;
    adds ``county_fips5``, ``state`` and the sample-table ``county`` code.
    Output: county_fips5, county, state, county_name."""
    ref = read_all_string(spark, path, sep)
    ref = ref.where(F.col("STATEFP").isin(list(STATE_TO_FIPS.values())))
    return ref.select(
        F.concat(F.col("STATEFP"), F.col("COUNTYFP")).alias("county_fips5"),
        gisjoin_county("STATEFP", "COUNTYFP").alias("county"),
        lookup(FIPS_TO_STATE, F.col("STATEFP")).alias("state"),
        F.col("COUNTYNAME").alias("county_name"),
    )


def read_tract_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Tract -> area relationship (all text): one row per tract with
    ``county_fips5`` and the area code in sample-table form ``puma``."""
    t = read_all_string(spark, path, ",")
    return t.select(F.concat(F.col("STATEFP"), F.col("COUNTYFP")).alias("county_fips5"),
                    gisjoin_puma("STATEFP", "PUMA5CE").alias("puma"))
