"""gridloom: building-energy load-profile analytics as Spark DataFrame plans.

Subpackages
-----------
functions  column-level expressions: code parsing, padding, hour-ending
           time, column classification by name.
sources    readers: partitioned Parquet, header-aware CSV trees, all-string
           lookup files, object manifests.
operators  DataFrame-to-DataFrame operators: melt, rollups, lookups,
           ranking, county grouping, manifest selection, diagnostics.
sinks      writers: sorted single CSV, quoted CSV, partitioned Parquet.
streaming  Structured Streaming form of the hour-ending rollup.
plans      the registered queries over the driver tables and their SQL
           oracles.
"""

__version__ = "0.1.0"
