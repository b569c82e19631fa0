"""Types of text columns found in one pass, and a quarantine for what doesn't fit.

``column_profile`` counts, per column, the cells that read as each type: one
global aggregate of conditional counts, so one row a task is shuffled. Types
form a lattice (long below double, date below timestamp, text above all);
``choose_types`` takes the type that most cells fit, the narrowest of equals, if
no more than a share of them would be lost. A number with a plus or leading
zeros is a code (a phone number, a card id) and stays text.
``typed_with_rejects`` casts, and sets aside the rows with a cell that doesn't
fit, with the reason; every row is in exactly one of its two results.

Blank and null cells are NULL of any type; a column of nothing else is text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# narrowest first
TYPES = ("boolean", "long", "double", "date", "timestamp")
CODE = r"^(\+|-?0[0-9])"
LONG = r"^-?[0-9]{1,18}$"
DOUBLE = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
MALFORMED = "_malformed"


def _cell(name: str) -> Column:
    return F.nullif(F.trim(F.col(f"`{name}`").cast("string")), F.lit(""))


def _tests(cell: Column) -> dict[str, Column]:
    number = ~cell.rlike(CODE)
    return {"boolean": F.lower(cell).isin("true", "false"),
            "long": number & cell.rlike(LONG),
            "double": number & cell.rlike(DOUBLE),
            "date": cell.rlike(DATE) & cell.try_cast("date").isNotNull(),
            "timestamp": cell.rlike(TIMESTAMP) & cell.try_cast("timestamp").isNotNull()}


def column_profile(raw: DataFrame) -> DataFrame:
    """``(column, n_rows, n_blank, n_boolean, n_long, n_double, n_date,
    n_timestamp)``, a row for each column of ``raw`` (all read as text)."""
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, name in enumerate(raw.columns):
        cell = _cell(name)
        aggs += [F.count(cell).alias(f"_{i}_filled"), *[F.count_if(t).alias(f"_{i}_{k}") for k, t in _tests(cell).items()]]
        rows.append(F.struct(F.lit(name).alias("column"), F.col("_rows").alias("n_rows"),
                             (F.col("_rows") - F.col(f"_{i}_filled")).alias("n_blank"),
                             *[F.col(f"_{i}_{k}").alias(f"n_{k}") for k in TYPES]))
    return raw.agg(*aggs).select(F.inline(F.array(*rows)))


def chosen(max_reject_share: float = 0.0) -> Column:
    """The type of a row of ``column_profile``: that of most cells, the narrowest
    of equals, if at most this share of the filled cells doesn't fit it."""
    filled = F.col("n_rows") - F.col("n_blank")
    best = F.greatest(*[F.col(f"n_{k}") for k in TYPES])
    fits = (filled > 0) & (filled - best <= F.floor(F.lit(max_reject_share) * filled))
    pick = F.coalesce(*[F.when(F.col(f"n_{k}") == best, F.lit(k)) for k in TYPES])
    return F.when(fits, pick).otherwise(F.lit("string"))


def choose_types(profile: DataFrame, max_reject_share: float = 0.0,
                 known: Mapping[str, str] | None = None) -> dict[str, str]:
    """Type by column. ``known`` gives types by name pattern (``*_gbp``), which
    text can't tell: money as decimals, identifiers of digits as text. The first
    pattern that fits counts. One row a column reaches the driver."""
    found = {r["column"]: r["type"] for r in profile.select("column", chosen(max_reject_share).alias("type")).collect()}
    for name in found:
        found[name] = next((t for p, t in (known or {}).items() if fnmatchcase(name, p)), found[name])
    return found


@dataclass
class Typed:
    rows: DataFrame         # the rows that fit, cast
    rejects: DataFrame      # the others as text, with ``_rejected``: the columns that don't fit
    types: dict[str, str]


def typed_with_rejects(raw: DataFrame, types: Mapping[str, str], malformed: str | None = None) -> Typed:
    """``raw`` cast to ``types``. A row goes to the rejects if a filled cell of it
    fits the type's form or cast no more, or if ``malformed`` (a column with the
    whole line of a row that has too few or many cells) is set."""
    names = [c for c in raw.columns if c != malformed]
    bad, cast = [], []
    for name in names:
        kind, cell = types[name], _cell(name)
        if kind == "string":
            cast.append(F.col(f"`{name}`"))
            continue
        value = cell.try_cast(kind)
        fits = _tests(cell).get(kind, F.lit(True)) & value.isNotNull()
        bad.append(F.when(cell.isNotNull() & ~fits, F.lit(name)))
        cast.append(value.alias(name))
    if malformed:
        bad.append(F.when(F.col(malformed).isNotNull(), F.lit(malformed)))
    if not bad:
        return Typed(raw.select(*cast), raw.withColumn("_rejected", F.array().cast("array<string>")).where(F.lit(False)), dict(types))
    judged = raw.withColumn("_rejected", F.array_compact(F.array(*bad)))
    return Typed(judged.where(F.size("_rejected") == 0).select(*cast), judged.where(F.size("_rejected") > 0), dict(types))


def reject_counts(typed: Typed) -> DataFrame:
    """``(column, n_rejected)`` for each column that rejected a row."""
    return (typed.rejects.select(F.explode("_rejected").alias("column"))
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_rejected")))


def read_csv_inferred(spark: SparkSession, path: str, max_reject_share: float = 0.0,
                      known: Mapping[str, str] | None = None) -> Typed:
    """A CSV of unknown types: the header gives names, all cells are read as text
    and typed as above. Lines with too few or many cells are rejects; they don't
    count for the types."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*header.columns, MALFORMED]])
    raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", MALFORMED).csv(path))
    whole = raw.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    return typed_with_rejects(raw, choose_types(column_profile(whole), max_reject_share, known), MALFORMED)
