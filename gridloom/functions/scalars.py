"""Small scalar expressions used across operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.columns import NULL_TOKENS

# Binary size units, base 1024.
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def _as(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_bytes(col: Column | str) -> Column:
    """Human-readable size of a byte count: the value in the first unit
    where it is below 1024 (PB beyond), one decimal, right-aligned in six
    characters, a space, the unit.

    The decimal is rounded half-to-even on the exact value.  Units are
    powers of two, so the value is ``b / 2**(10k)`` exactly and the rounding
    is done in integer arithmetic (shift and mask): no floating-point
    formatting, identical on every executor, correct for any ``bigint``.
    """
    b = _as(col).cast("long")
    expr = None
    for k, unit in enumerate(BYTE_UNITS):
        bits = 10 * k
        mask = (1 << bits) - 1
        whole = F.shiftright(b, bits)
        t = b.bitwiseAND(F.lit(mask)) * 10
        tenth = F.shiftright(t, bits)
        rest2 = t.bitwiseAND(F.lit(mask)) * 2
        tenths = whole * 10 + tenth
        half = 1 << bits  # twice the remainder compared with the divisor
        up = (rest2 > half) | ((rest2 == half) & (F.pmod(tenths, F.lit(2)) == 1)) if bits else F.lit(False)
        total = tenths + F.when(up, F.lit(1)).otherwise(F.lit(0))
        text = F.concat(F.floor(total / 10).cast("long").cast("string"), F.lit("."),
                        F.pmod(total, F.lit(10)).cast("string"))
        padded = F.when(F.length(text) < 6, F.lpad(text, 6, " ")).otherwise(text)
        piece = F.concat(padded, F.lit(" " + unit))
        if k == len(BYTE_UNITS) - 1:
            expr = expr.otherwise(piece)
        else:
            cond = b < F.lit(1 << (10 * (k + 1)))
            expr = F.when(cond, piece) if expr is None else expr.when(cond, piece)
    return expr


def rstrip_chars(col: Column | str, chars: str) -> Column:
    """Python ``str.rstrip(chars)``: drop every trailing char in ``chars``."""
    return F.expr(f"trim(TRAILING '{chars}' FROM {_sql(col)})")


def _sql(col: Column | str) -> str:
    if isinstance(col, str):
        return "`" + col.replace("`", "``") + "`"
    raise TypeError("pass a column name")


def null_tokens_to_null(col: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Map the missing-value spellings of text files to null."""
    c = _as(col)
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def is_all_digits(col: Column | str) -> Column:
    return _as(col).rlike("^[0-9]+$")


def numeric_then_lexical(col: Column | str) -> list[Column]:
    """Sort keys: all-digit values first in numeric order, then the rest
    in text order."""
    c = _as(col)
    digits = is_all_digits(c)
    return [
        F.when(digits, F.lit(0)).otherwise(F.lit(1)),
        F.when(digits, c.cast("decimal(38,0)")),
        c,
    ]


def last_token_label(col: Column | str, marker: str, sep: str = "_", other: str = "i") -> Column:
    """Label of a group name: if it contains ``marker`` the last
    ``sep``-separated token, else ``other`` (a null name gives ``other``)."""
    c = _as(col)
    return (
        F.when(F.coalesce(c.contains(marker), F.lit(False)), F.element_at(F.split(c, _re_escape(sep)), -1))
        .otherwise(F.lit(other))
    )


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def exact_sum(col: Column | str, scale: int | None) -> Column:
    """Sum that does not depend on the order rows arrive in.

    ``scale`` declares how many decimals the column carries: every value is
    then an integer count of ``10**-scale`` units, the counts are summed as
    ``bigint`` (exact, on the fast long path, an overflow fails the query
    under ANSI rules) and the total is scaled back to double once.  So every
    partitioning gives the same bits, and equals a decimal sum cast to double.
    A value with more decimals than declared fails the query; nothing is
    rounded away.  Without a ``scale`` the values are summed as doubles.

    NaN counts as missing.  The sum of an all-missing group is 0.0 (not
    null), as the series tools expect.
    """
    c = not_nan(_as(col).cast("double"))
    if scale is None:
        s = F.sum(c)
    else:
        unit = float(10 ** scale)
        counts = F.rint(c * unit)
        # two roundings of a double (the value and the product) are allowed for
        off = F.abs(c * unit - counts) > F.abs(counts) * 1e-15 + 1e-9
        text = F.concat(F.lit("value "), c.cast("string"), F.lit(f" has more than {scale} decimals"))
        s = F.sum(F.when(off, F.raise_error(text)).otherwise(counts.cast("long"))) / F.lit(unit)
    return F.coalesce(s, F.lit(0.0))


def not_nan(col: Column) -> Column:
    """A floating column with NaN as null (a missing measure)."""
    return F.when(~F.isnan(col), col)


def plain_path(path: Column) -> Column:
    """A path of ``_metadata.file_path``, which is URL-encoded, as listings
    spell it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
