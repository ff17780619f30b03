"""Small column helpers shared by the models.

All helpers return built-in Spark expressions, so they stay inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exact integer arithmetic in decimals: dividing two decimal(20,0) values keeps
# 18 fractional digits, so a later round(…, 2) never rounds twice.
_EXACT_INT = T.DecimalType(20, 0)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_ratio(num: str | Column, den: str | Column, digits: int,
                factor: int = 1) -> Column:
    """``round(num * factor / nullif(den, 0), digits)`` on integer counts, exactly.

    Counts are turned into decimals before dividing (the reference does the
    division in arbitrary-precision numeric); a zero or NULL denominator gives
    NULL instead of an error.
    """
    n = col_(num)
    if factor != 1:
        n = n * F.lit(factor)
    n = n.cast(_EXACT_INT)
    d = F.nullif(col_(den).cast(_EXACT_INT), F.lit(0).cast(_EXACT_INT))
    return F.round(n / d, digits)


def exact_mean(values: str | Column, digits: int) -> Column:
    """Aggregate: mean of an integer column, rounded half away from zero."""
    v = col_(values)
    return exact_ratio(F.sum(v), F.count(v), digits)


def pair_only(x: Column, other: Column) -> Column:
    """``x`` where ``other`` is also present: aggregates then see complete pairs only."""
    return F.when(other.isNotNull(), x)


def safe_corr(y: str | Column, x: str | Column) -> Column:
    """Aggregate: Pearson correlation with NULL (not an error) for zero variance.

    Built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when a column is
    constant; the reference's database returns NULL there. Only rows where
    both values are present take part, like ``corr``. The form
    ``covar / sqrt(var_x * var_y)`` is the one-pass, partial-aggregate friendly
    definition and returns exactly 1 for an exact linear relation.
    """
    yv = col_(y).cast("double")
    xv = col_(x).cast("double")
    xs = pair_only(xv, yv)
    ys = pair_only(yv, xv)
    varies = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    r = F.try_divide(F.covar_pop(xs, ys), F.sqrt(F.var_pop(xs) * F.var_pop(ys)))
    return F.when(varies, r)


def t_statistic(r: str | Column, n: str | Column) -> Column:
    """``r * sqrt((n - 2) / nullif(1 - r^2, 0))``; NULL when |r| = 1."""
    rc = col_(r)
    denom = F.nullif(F.lit(1.0) - F.pow(rc, 2), F.lit(0.0))
    return rc * F.sqrt((col_(n) - F.lit(2)).cast("double") / denom)


def to_decimal_round(c: str | Column, digits: int) -> Column:
    """Round a double the way the reference does: cast to numeric first, then round."""
    return F.round(col_(c).cast(T.DecimalType(38, 18)), digits)


def days_between(end: str | Column, start: str | Column) -> Column:
    """``date - date`` as a whole number of days; NULL if either side is NULL."""
    return F.datediff(col_(end), col_(start))


def banded(value: Column, bands: Sequence[tuple[float, str]], missing: str) -> Column:
    """Label of the last of ``bands`` (lower bound, label; rising, the first open below) whose
    bound the value reaches; ``missing`` for NULL."""
    rows = [(low, F.struct(F.lit(float(low)).alias("low"), F.lit(label).alias("label")))
            for low, label in bands]
    reached = F.greatest(rows[0][1], *[F.when(value >= low, band) for low, band in rows[1:]])
    return F.when(value.isNull(), F.lit(missing)).otherwise(reached["label"])


def recency_status(days: str | Column, bands: Sequence[tuple[int, str]], never: str,
                   otherwise: str) -> Column:
    """Classify by whole days since the last activity (NULL: ``never``).

    ``bands`` hold the last day that a label covers; ``otherwise`` follows the
    last of them.
    """
    lows = [float("-inf"), *[limit + 1 for limit, _ in bands]]
    labels = [*[label for _, label in bands], otherwise]
    return banded(col_(days), list(zip(lows, labels)), never)


def flag01(c: str | Column) -> Column:
    """Boolean to 0/1 integer (NULL counts as 0)."""
    return F.when(col_(c), F.lit(1)).otherwise(F.lit(0))


def desc_pg(c: str | Column) -> Column:
    """Descending with NULLs first, the reference database's default for DESC."""
    return col_(c).desc_nulls_first()


def asc_pg(c: str | Column) -> Column:
    """Ascending with NULLs last, the reference database's default for ASC."""
    return col_(c).asc_nulls_last()


# Unit labels of a human-readable relation size.
SIZE_UNITS = ("kB", "MB", "GB", "TB", "PB")


def pretty_size(nbytes: str | Column) -> Column:
    """Human-readable byte count with the usual database rule.

    Below 10 kB the value is printed in bytes. Otherwise the value is shifted
    into the next unit while it is 20 units or more, keeping one extra bit so
    the last step rounds half up.
    """
    b = col_(nbytes).cast("long")
    expr = F.when(b < F.lit(10 * 1024), F.concat(b.cast("string"), F.lit(" bytes")))
    shifted = F.shiftright(b, 9)
    for i, unit in enumerate(SIZE_UNITS):
        half = F.shiftright(shifted + F.lit(1), 1)
        is_last = i == len(SIZE_UNITS) - 1
        cond = F.lit(True) if is_last else (shifted < F.lit(20 * 1024 - 1))
        expr = expr.when(cond, F.concat(half.cast("string"), F.lit(" " + unit)))
        shifted = F.shiftright(shifted, 10)
    return expr
