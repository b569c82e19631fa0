"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata dimensions are quantised to a few bits each. A row's place
on the Hilbert curve through the cells is its sort key; the sorted rows are
cut into runs of equal length. Rows that are close in all dimensions share a
shard, so the files' minima and maxima prune filters on any of them.

Law ``rows``: the shards' row counts differ by one at most.

Defined results: null metadata fall into cell 0; a null text has size 1; ties
on the curve are ordered by id, size and checksum, and rows equal in these are
interchangeable; repeated rows are rows of their own; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.common import attach_scalars
from meridian.llm.common import ship, staged, utf8

SHARDS = 16
BITS = 5


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """The place on the Hilbert curve of a cell given by ``bits``-bit
    coordinates (Skilling, "Programming the Hilbert curve", 2004): turn each
    level's subcube into standard position, Gray-code the axes, then take the
    axes' bits in turn."""
    n = len(cells)

    def bit(q: Column) -> Column:
        return F.element_at(F.array(*[F.lit(1 << k) for k in range(bits)]), q + 1)

    def axis(x: Column, i: Column) -> Column:
        return F.element_at(x, i + 1)

    def turn(x: Column, step: Column) -> Column:
        q = bit(F.lit(bits - 1) - F.floor(step / n).cast("int"))
        i = F.pmod(step, F.lit(n))
        first, own = axis(x, F.lit(0)), axis(x, i)
        flip = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(q - 1)
        new_first = first.bitwiseXOR(F.when(flip, q - 1).otherwise(swap))
        new_own = own.bitwiseXOR(F.when(flip, F.lit(0)).otherwise(swap))
        return F.transform(x, lambda v, k: F.when(k == 0, new_first).when(k == i, new_own).otherwise(v))

    def gray(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.aggregate(
            F.slice(x, F.lit(1), k), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def untwist(x: Column) -> Column:
        t = F.aggregate(F.sequence(F.lit(1), F.lit(bits - 1)), F.lit(0), lambda a, q: a.bitwiseXOR(
            F.when(axis(x, F.lit(n - 1)).bitwiseAND(bit(q)) != 0, bit(q) - 1).otherwise(0)))
        return F.transform(x, lambda v: v.bitwiseXOR(t))

    def interleave(x: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(n * bits - 1)), F.lit(0).cast("long"), lambda h, s: h * 2 + F.when(
            axis(x, F.pmod(s, F.lit(n))).bitwiseAND(bit(F.lit(bits - 1) - F.floor(s / n).cast("int"))) != 0, 1).otherwise(0))

    x = F.array(*[c.cast("int") for c in cells])
    if bits > 1:
        x = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), x, turn)
    for step in (gray, untwist, interleave) if bits > 1 else (gray, interleave):
        x = F.element_at(F.transform(F.array(x), step), 1)  # names a value once for its many uses
    return x


def text_cell(col: Column, bits: int = BITS) -> Column:
    """A cell for a name: a few bits of its MD5, 0 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(col.cast("string")), 1, 4), 16, 10).cast("int")
                      .bitwiseAND((1 << bits) - 1), F.lit(0))


def log_cell(col: Column, bits: int = BITS) -> Column:
    """A cell for a size: the number of its binary digits less one."""
    return F.least(F.length(F.bin(col)) - 1, F.lit((1 << bits) - 1))


def range_cell(col: Column, low: Column, high: Column, bits: int = BITS) -> Column:
    """A cell for an integer: the top bits of its distance from the least."""
    shift = F.greatest(F.lit(0), F.length(F.bin(high - low)) - bits)
    return F.coalesce(F.call_function("shiftright", col - low, shift), F.lit(0))


def cut_runs(df: DataFrame, order: Sequence[str], shards: int = SHARDS) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: rows in ``order``, cut into
    ``shards`` runs whose lengths differ by one at most. Rows are sorted in
    range partitions; only a count per partition reaches the driver."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_pos")), "runs")
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(sizes)
    before = [0, *accumulate(sizes[p] for p in parts)]
    total = before[-1]
    offsets = spark.createDataFrame([*zip(parts, before)], "_part int, _before long")
    rank, n = "(_before + _pos)", max(total, 1)
    shard = f"({rank} * {shards} div {n})"
    start = f"(({shard} * {total} + {shards - 1}) div {shards})"
    return (ranged.join(F.broadcast(offsets), "_part")
            .select(*df.columns, F.expr(f"cast({shard} as int)").alias("shard"), F.expr(f"{rank} - {start}").alias("slot")))


def hilbert_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   names: Sequence[str] = ("source", "lang"), carry: Sequence[str] = (),
                   shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row: ``_id``, ``size``, ``text_crc32``, ``curve`` (place on the
    Hilbert curve through id, size and ``names``), ``shard``, ``slot`` and the
    columns of ``carry``."""
    size = F.length(utf8(text)).cast("long") + 1
    rows = docs.select(F.col(doc_id).alias("_id"), size.alias("size"), F.crc32(utf8(text)).alias("text_crc32"),
                       *[text_cell(F.col(c), bits).alias(f"_cell_{i}") for i, c in enumerate(names)],
                       *[F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)])
    ends = docs.agg(F.min(doc_id).alias("_low"), F.max(doc_id).alias("_high"))
    cells = [range_cell(F.col("_id"), F.col("_low"), F.col("_high"), bits), log_cell(F.col("size"), bits),
             *[F.col(f"_cell_{i}") for i in range(len(names))]]
    keyed = attach_scalars(rows, ends).select(
        "_id", "size", "text_crc32", hilbert_index(cells, bits).alias("curve"),
        *[f"_carry_{i}" for i in range(len(carry))])
    out = cut_runs(keyed, ["curve", "_id", "size", "text_crc32"], shards)
    return out.select("_id", "size", "text_crc32", "curve", "shard", "slot",
                      *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)])


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the whole rows of ``docs``, one folder per shard, in curve order."""
    sharded = hilbert_shards(docs, carry=docs.columns, **options)
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("shard", "slot", "curve", *docs.columns).write.partitionBy("shard").parquet(path))


ship(__name__)
