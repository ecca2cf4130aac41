"""Wide -> long reshape of end-use tables (melt).

The column list is classified on the driver (schema only), the allow-list
is applied to that list *before* the unpivot (a filter on the label column
would stay above Spark's Expand and waste the work), and the unpivot itself
is one ``Expand`` inside whole-stage codegen.  Labels are literals attached
to each value column, so no per-row string work is done.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gridloom.functions.columns import (
    ELECTRICITY_PREFIX, EXCLUDED_SUBSTRING, OUTPUT_PREFIX, classify_wide,
    end_use_label, q,
)


def normalise_allow_list(end_uses: Iterable[str] | None) -> set[str] | None:
    """Trimmed, lower-cased allow-list; empty or None means 'keep all'."""
    if end_uses is None:
        return None
    cleaned = {e.strip().lower() for e in end_uses if e and e.strip()}
    return cleaned or None


def melt_end_uses(df: DataFrame,
                  end_uses: Iterable[str] | None = None,
                  label: Callable[[str], str] = end_use_label,
                  value_prefix: str = ELECTRICITY_PREFIX,
                  drop_prefix: str | None = OUTPUT_PREFIX,
                  exclude_substring: str | None = EXCLUDED_SUBSTRING,
                  value_columns: Sequence[str] | None = None,
                  id_columns: Sequence[str] | None = None,
                  var_name: str = "end_use",
                  value_name: str = "kWh") -> DataFrame:
    """Melt the end-use columns of a wide table into (``end_use``, ``kWh``).

    * value columns: names starting with ``value_prefix`` (or the explicit
      ``value_columns``), minus names containing ``exclude_substring``;
    * other columns starting with ``drop_prefix`` are dropped;
    * every remaining column is an id column (or ``id_columns`` if given);
    * ``end_use`` is ``label(name)``; the allow-list compares it trimmed and
      case-insensitively; nulls in the values are kept.

    With no value column left the result is an empty frame with the id
    columns plus ``end_use`` and ``kWh``.
    """
    layout = classify_wide(df.columns, value_prefix=value_prefix, drop_prefix=drop_prefix,
                           exclude_substring=exclude_substring, value_columns=value_columns)
    ids = list(id_columns) if id_columns is not None else layout.ids
    allow = normalise_allow_list(end_uses)
    pairs = [(c, label(c)) for c in layout.values]
    if allow is not None:
        pairs = [(c, lab) for c, lab in pairs if lab.lower() in allow]

    seen: dict[str, str] = {}
    for c, lab in pairs:
        if lab in seen:
            warnings.warn(f"columns {seen[lab]!r} and {c!r} share end use {lab!r}; "
                          "their values are summed once aggregated", stacklevel=2)
        seen.setdefault(lab, c)

    if not pairs:
        fields = [df.schema[c] for c in ids] + [
            StructField(var_name, StringType(), True),
            StructField(value_name, DoubleType(), True),
        ]
        return df.sparkSession.createDataFrame([], StructType(fields))

    id_cols = [F.col(q(c)) for c in ids]
    value_cols = [F.col(q(c)).cast("double").alias(f"v{i}") for i, (c, _) in enumerate(pairs)]
    wide = df.select(*id_cols, *value_cols)
    long = wide.unpivot([F.col(q(c)) for c in ids], [F.col(f"v{i}") for i in range(len(pairs))],
                        "_slot", value_name)
    labels = F.create_map(*[x for i, (_, lab) in enumerate(pairs) for x in (F.lit(f"v{i}"), F.lit(lab))])
    return long.select(*[F.col(q(c)) for c in ids],
                       F.element_at(labels, F.col("_slot")).alias(var_name),
                       F.col(value_name))
