"""Join of values with a table of half-open bands ``[lo, hi)`` of any length,
which may overlap, without a nested loop.

Distinct values and band ends are sorted together by range partitions and
numbered in two levels (within partitions, then offsets), which gives each value
its position: the number of ends not above it. A band covers a run of positions,
cut into dyadic cells (at most two a level); a position lies in one cell a level.
So a position and a band meet in at most one cell, and an equi-join on cells finds
each pair once. Only distinct positions are joined with cells, never rows.

Rows meet the result by their value, hot values map-side, and by their position,
which is salted by its number of rows: a value or band with a third of all rows is
spread over tasks.

Null and NaN values are in no band; bands with a null or NaN end, or with
``lo >= hi``, hold nothing; repeated bands and rows are all kept.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.joins import DEFAULT_HOT_ROWS, hot_split_join
from meridian.session import checkpointed

SALT_ROWS = 1_000_000        # rows of a position that one task takes


def _number(x: Column) -> Column:
    """As a double without a negative zero; NULL for NaN."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x + F.lit(0.0))


def positions(values: DataFrame, ends: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(_x, _n, _pos, _end)`` for each distinct value and end (columns ``_x``):
    rows of ``values`` that hold it, ends not above it, and which of the two it is."""
    spark = values.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = values.where(F.col("_x").isNotNull()).groupBy("_x").agg(F.count(F.lit(1)).alias("_n")).withColumn("_end", F.lit(0))
    e = ends.where(F.col("_x").isNotNull()).distinct().select("_x", F.lit(0).cast("long").alias("_n"), F.lit(1).alias("_end"))
    # an end comes before the values that equal it
    both = checkpointed(v.unionByName(e).repartitionByRange(parts, "_x", F.desc("_end")).withColumn("_pid", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in both.groupBy("_pid").agg(F.sum("_end")).collect())
    before = accumulate([0, *(n for _, n in sizes)])
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_pid int, _off long")
    so_far = Window.partitionBy("_pid").orderBy("_x", F.desc("_end")).rowsBetween(Window.unboundedPreceding, 0)
    return (both.withColumn("_pos", F.sum("_end").over(so_far)).join(F.broadcast(offsets), "_pid")
            .select("_x", "_n", (F.col("_pos") + F.col("_off")).alias("_pos"), "_end"))


def _cells(levels: int) -> Column:
    """The dyadic cells of the positions ``[_a, _b)``."""
    a, b = "shiftright(_a + shiftleft(1L, k) - 1, k)", "shiftright(_b, k)"
    return F.expr(f"""
        flatten(transform(sequence(0, {levels}), k -> CASE WHEN {a} < {b} THEN filter(array(
            CASE WHEN {a} % 2 = 1 THEN named_struct('_level', k, '_cell', {a}) END,
            CASE WHEN {b} % 2 = 1 THEN named_struct('_level', k, '_cell', {b} - 1) END), c -> c IS NOT NULL)
            ELSE array() END))""")


def match_bands(df: DataFrame, bands: DataFrame, x: str, lo: str = "lo", hi: str = "hi",
                hot_rows: int = DEFAULT_HOT_ROWS, salt_rows: int = SALT_ROWS,
                num_partitions: int | None = None) -> DataFrame:
    """A row for each row of ``df`` and band that holds its ``x``: the columns of
    ``df``, then those of ``bands``, which are named otherwise."""
    clash = sorted(set(df.columns) & set(bands.columns))
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    rows = df.select(F.struct("*").alias("_row"), _number(F.col(x)).alias("_x"))
    held = (bands.select(F.struct("*").alias("_band"), _number(F.col(lo)).alias("_lo"), _number(F.col(hi)).alias("_hi"))
            .where(F.col("_lo") < F.col("_hi")))
    placed = checkpointed(positions(rows, held.select(F.explode(F.array("_lo", "_hi")).alias("_x")), num_partitions))
    ends = placed.where(F.col("_end") == 1)
    n_ends = ends.count()
    levels = max(1, n_ends.bit_length())
    at_lo = ends.select(F.col("_x").alias("_lo"), F.col("_pos").alias("_a"))
    at_hi = ends.select(F.col("_x").alias("_hi"), F.col("_pos").alias("_b"))
    cells = held.join(at_lo, "_lo").join(at_hi, "_hi").select("_band", F.inline(_cells(levels)))
    # between the first end and the last; others are in no band
    values = placed.where((F.col("_end") == 0) & (F.col("_pos") > 0) & (F.col("_pos") < F.lit(n_ends)))
    of = (values.groupBy("_pos").agg(F.sum("_n").alias("_rows"))
          .select("_pos", F.ceil(F.col("_rows") / F.lit(salt_rows)).alias("_salts")))
    grid = of.select("_pos", "_salts", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level"))
    grid = grid.withColumn("_cell", F.expr("shiftright(_pos, _level)"))
    hits = (grid.join(cells, ["_level", "_cell"])
            .select("_pos", "_band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt")))
    spread = hot_split_join(rows, values.join(of, "_pos").select("_x", "_pos", "_salts", "_n"), ["_x"], "_n", hot_rows=hot_rows)
    spread = spread.withColumn("_salt", F.floor(F.rand(1_729) * F.col("_salts")))
    return spread.join(hits, ["_pos", "_salt"]).select("_row.*", "_band.*")
