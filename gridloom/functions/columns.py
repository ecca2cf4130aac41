"""Column classification by name.

The end-use tables have a dynamic schema: what a column *is* follows from
its name.  Everything here runs on the driver over the schema (a list of
names), never over rows, and produces plain column lists that the
operators turn into one declarative plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DoubleType, FloatType,
    IntegerType, LongType, NumericType, ShortType, StringType, StructType,
    TimestampNTZType, TimestampType,
)

# Naming conventions of the published end-use tables.
ELECTRICITY_PREFIX = "out.electricity."
OUTPUT_PREFIX = "out."
EXCLUDED_SUBSTRING = "savings"
ENERGY_MARKER = "kwh"
POPULATION_MEASURES = ("models_used", "units_represented", "floor_area_represented")
BUILDING_TYPE_COLUMNS = ("in.geometry_building_type_recs", "in.comstock_building_type")
NULL_TOKENS = ("", "NA", "N/A", "NaN", "nan", "None", "null", "NULL", "#N/A", "<NA>", "-NaN", "-nan")


def q(name: str) -> str:
    """Backtick-quote a column name (names with dots are common here)."""
    return "`" + name.replace("`", "``") + "`"


def end_use_label(name: str) -> str:
    """Label of a wide end-use column: the third dot-separated part of a name
    with four or more, any other name as it is."""
    third = name.split(".", 3)[2:]
    return third[0] if len(third) == 2 else name


def measure_types(columns: Iterable[str]) -> dict[str, str]:
    """Types that the names of measures tell: energy, outputs and population
    measures are numbers."""
    return {c: "double" for c in columns
            if c.startswith(OUTPUT_PREFIX) or ENERGY_MARKER in c.lower() or c in POPULATION_MEASURES}


def token_after(sep: str) -> Callable[[str], str]:
    """Label rule: the text after the first ``sep`` (whole name if absent)."""
    def rule(name: str) -> str:
        return name.split(sep, 1)[1] if sep in name else name
    return rule


@dataclass(frozen=True)
class WideLayout:
    """Role of every column of a wide end-use table."""

    ids: list[str]
    values: list[str]
    dropped: list[str] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)


def classify_wide(columns: Sequence[str], value_prefix: str = ELECTRICITY_PREFIX,
                  drop_prefix: str | None = OUTPUT_PREFIX,
                  exclude_substring: str | None = EXCLUDED_SUBSTRING,
                  value_columns: Sequence[str] | None = None) -> WideLayout:
    """Split column names into id / value / dropped / excluded.

    value: starts with ``value_prefix`` (or is listed in ``value_columns``);
    dropped: starts with ``drop_prefix`` but is not a value column;
    excluded: a value column whose lower-cased name contains
    ``exclude_substring`` (neither melted nor kept);
    id: everything else, in input order.
    """
    if value_columns is not None:
        wanted = set(value_columns)
        is_value = lambda c: c in wanted
    else:
        is_value = lambda c: c.startswith(value_prefix)
    values, dropped, excluded, ids = [], [], [], []
    for c in columns:
        if is_value(c):
            if exclude_substring and exclude_substring.lower() in c.lower():
                excluded.append(c)
            else:
                values.append(c)
        elif drop_prefix and c.startswith(drop_prefix):
            dropped.append(c)
        else:
            ids.append(c)
    return WideLayout(ids=ids, values=values, dropped=dropped, excluded=excluded)


def first_match(columns: Iterable[str], tests: Iterable[Callable[[str], bool]]) -> str | None:
    """The first column that passes a test; an earlier test outranks a later
    one, whatever the column order."""
    cols = list(columns)
    return next((c for test in tests for c in cols if test(c)), None)


def find_timestamp_column(columns: Iterable[str], candidates: Sequence[str] = ("timestamp",)) -> str | None:
    """The column named like a candidate, in any case."""
    return first_match(columns, [lambda c, want=want.lower(): c.lower() == want for want in candidates])


def find_building_type_column(columns: Iterable[str],
                              preferred: Sequence[str] = BUILDING_TYPE_COLUMNS,
                              marker: str = "building_type") -> str | None:
    """The column with a preferred name, or else any that mentions ``marker``."""
    return first_match(columns, [*(lambda c, want=want: c == want for want in preferred), lambda c: marker in c.lower()])


def resolve_column(columns: Iterable[str], candidates: Sequence[str], what: str = "column") -> str:
    """The column with one of the candidate names; an error lists them if
    there is none."""
    found = first_match(columns, [lambda c, want=want: c == want for want in candidates])
    if found is None:
        raise KeyError(f"missing required {what}: one of {list(candidates)}")
    return found


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise one error listing every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"Missing expected columns: {missing}")


@dataclass(frozen=True)
class MeasureRules:
    """Which columns are summed and which are averaged over time.

    energy: lower-cased name contains ``energy_marker`` -> sum.
    population: named in ``population`` -> mean over time, sum over types.
    Group keys are never measures.
    """

    energy_marker: str | None = ENERGY_MARKER
    population: tuple[str, ...] = POPULATION_MEASURES
    extra_energy: tuple[str, ...] = ()

    def split(self, columns: Iterable[str], keys: Iterable[str]) -> tuple[list[str], list[str]]:
        keyset = set(keys)
        energy, pop = [], []
        for c in columns:
            if c in keyset:
                continue
            marked = bool(self.energy_marker) and self.energy_marker.lower() in c.lower()
            if marked or c in self.extra_energy:
                energy.append(c)
            elif c in self.population:
                pop.append(c)
        return energy, pop


def is_text(dtype: DataType) -> bool:
    return isinstance(dtype, StringType)


def default_group_keys(schema: StructType, ts_col: str | None,
                       extra: Sequence[str] = ("upgrade",)) -> list[str]:
    """The key fields in schema order: every text field, and those that go by
    the timestamp's name or one of ``extra`` whatever their type."""
    by_name = {ts_col, *extra}
    return [f.name for f in schema.fields if is_text(f.dataType) or f.name in by_name]


# Sink type normalisation: the types an extract table accepts.
_SINK_TYPES = {
    ByteType: IntegerType(), ShortType: IntegerType(), IntegerType: IntegerType(),
    LongType: LongType(), FloatType: DoubleType(), DoubleType: DoubleType(),
    BooleanType: BooleanType(), StringType: StringType(), DateType: DateType(),
    TimestampType: TimestampType(), TimestampNTZType: TimestampNTZType(),
}


def sink_type(dtype: DataType) -> DataType | None:
    """Target type for a column, or None for 'render as text'."""
    for src, dst in _SINK_TYPES.items():
        if isinstance(dtype, src):
            return dst
    if isinstance(dtype, NumericType):  # decimals
        return None
    return None
