"""Small column-level helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (comparison hygiene at the output edge)."""
    cols = [F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def safe_div(num: Column, den: Column) -> Column:
    """NULL instead of an error (ANSI mode) when the denominator is 0 or NULL."""
    return F.try_divide(num, den)


def ratio_pct_half_up(active: Column, total: Column, digits: int = 1) -> Column:
    """``round(100 * active / total, digits)`` computed exactly on integers.

    Half-up rounding of the exact rational, so the result does not depend on
    binary floating-point noise (both inputs are counts).
    """
    scale = 10 ** digits
    a, t = active.cast("long"), total.cast("long")
    num = F.floor((F.lit(2 * 100 * scale) * a + t) / (F.lit(2) * t))
    return F.when(t > 0, num / F.lit(float(scale)))


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row result (a fitted mean, a coefficient,
    a global count) to every row as uncorrelated scalar subqueries: no join;
    Spark merges the subqueries into one aggregate and runs it once."""
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def top_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """Preview: the first ``n`` rows in an explicit order (a top-n sort)."""
    return df.orderBy(*order).limit(n)
