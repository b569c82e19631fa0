"""Global dense rank without a single-task window.

``DENSE_RANK() OVER (ORDER BY x)`` with no partition moves every row to one
task. Instead: distinct values (map-side de-duplication), range-partition and
sort them, number rows inside each partition, materialise (partition ids and
positions are only stable once written), then add the running total of the
preceding partitions' sizes. Only one count per partition reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.session import checkpointed


@dataclass
class Ranked:
    df: DataFrame       # distinct values with a 1-based dense rank
    n_values: int       # number of distinct values
    n_rows: int         # number of non-null input rows


def dense_rank_values(df: DataFrame, col: str, rank_col: str = "rank",
                      num_partitions: int | None = None,
                      count_col: str | None = None) -> Ranked:
    """Dense rank of the distinct values of ``col``; with ``count_col`` each
    value also carries how many rows of ``df`` hold it."""
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # map-side de-duplication first: a value held by a third of the rows
    # collapses before the shuffle
    vals = checkpointed(
        df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
        .repartitionByRange(n_parts, col).sortWithinPartitions(col)
        .select(col, "_cnt", F.spark_partition_id().alias("_pid"),
                F.monotonically_increasing_id().alias("_mid")))
    per_part = vals.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.sum("_cnt").alias("rows")).collect()
    sizes = {r["_pid"]: r["n"] for r in per_part}
    n_rows = sum(int(r["rows"]) for r in per_part)
    pids = sorted(sizes)
    starts = [0, *accumulate(sizes[p] for p in pids)][:-1]
    total = sum(sizes.values())
    extra = [F.col("_cnt").alias(count_col)] if count_col else []
    if not pids:
        return Ranked(vals.select(col, F.lit(None).cast("long").alias(rank_col), *extra).limit(0), 0, 0)
    offsets = spark.createDataFrame(list(zip(pids, starts)), "_pid int, _off long")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    ranked = (vals.join(F.broadcast(offsets), "_pid")
              .select(col, (F.col("_off") + pos + 1).alias(rank_col), *extra))
    return Ranked(ranked, total, n_rows)
