"""Skew-aware equi-join.

Keys that carry a large share of the rows (a placeholder phone shared by a
third of all records, the hub of a giant component) would put all their
rows into one shuffle partition. ``hot_split_join`` joins those rows
map-side against a broadcast of the (few) hot dimension rows and sends only
the remaining cold rows through the shuffle.

How hot keys are found:

* with ``weight`` (a per-key row count already present on a materialised
  ``dim``) they are read off ``dim`` exactly;
* otherwise they are estimated from a seeded sample of ``big`` (a key with
  ``hot_rows`` rows shows up about ``hot_rows * fraction`` times), which reads
  ``big`` once more: callers pass a materialised ``big``. The estimate only
  decides the routing; every row is joined either way, so a missed borderline
  key just stays on the shuffled path.

The hot set is materialised (so a recomputed task sees the same set) and
bounded: above ``max_broadcast_keys`` the hottest keys up to that number are
split, the others stay on the shuffled path, where AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.session import checkpointed

DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_KEYS = 200_000
DEFAULT_SAMPLE_ROWS = 200_000
DEFAULT_SAMPLE_FRACTION = 0.001
SAMPLE_SEED = 20141


def _hot_keys(big: DataFrame, dim: DataFrame, on: list[str], weight: str | None, hot_rows: int,
              big_rows: int | None, limit: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    if weight is not None:
        found = dim.where(F.col(weight) > hot_rows).select(*on, F.col(weight).alias("_n"))
    else:
        frac = min(1.0, DEFAULT_SAMPLE_ROWS / big_rows) if big_rows else DEFAULT_SAMPLE_FRACTION
        floor = max(2.0, 0.5 * hot_rows * frac)
        found = (big.select(*on).sample(fraction=frac, seed=SAMPLE_SEED)
                 .groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= floor))
    return found.orderBy(F.desc("_n"), *on).limit(limit).select(*on)


def hot_split_join(big: DataFrame, dim: DataFrame, on: Sequence[str], weight: str | None = None,
                   hot_rows: int = DEFAULT_HOT_ROWS,
                   max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
                   how: str = "inner", big_rows: int | None = None) -> DataFrame:
    """Join ``big`` to ``dim`` (one row per key) on ``on``; ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    ``weight``, when given, is a column of ``dim`` holding how many ``big``
    rows carry the key; it is dropped from the result. When the row count of
    ``big`` is known (``big_rows``) and no key can exceed ``hot_rows``, no
    detection runs at all.
    """
    on = list(on)
    dim_cols = dim.drop(weight) if weight else dim
    if hot_rows is None or (big_rows is not None and big_rows <= hot_rows):
        return big.join(dim_cols, on, how)
    # materialise the (small) hot set first: the count and every task,
    # including recomputed ones, then see exactly the same keys
    hot = checkpointed(_hot_keys(big, dim, on, weight, hot_rows, big_rows, max_broadcast_keys))
    if hot.isEmpty():
        return big.join(dim_cols, on, how)
    hot_keys = F.broadcast(hot)
    hot_dim = dim_cols.join(hot_keys, on, "left_semi")          # <= n_hot rows
    big_hot = big.join(hot_keys, on, "left_semi")
    big_cold = big.join(hot_keys, on, "left_anti")
    hot_part = big_hot.join(F.broadcast(hot_dim), on, how)
    cold_part = big_cold.join(dim_cols.join(hot_keys, on, "left_anti"), on, how)
    return hot_part.unionByName(cold_part)
