"""Structured Streaming form of the interval pre-aggregation (Q21).

A raw wait-time log arrives continuously; it is reduced to one row per
(zone, arm, 5-minute event-time window) before any analysis. The watermark
bounds the state kept for late events; finished windows are appended to a
Parquet sink that the batch switchback operators can read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def interval_preagg_stream(events: DataFrame, ts: str = "ts", keys=("zone", "assignment"),
                           value: str = "wait_time_min", interval: str = "5 minutes",
                           lateness: str = "15 minutes") -> DataFrame:
    """Streaming DataFrame: windowed mean and count per key; state for a
    window is dropped once the watermark passes its end."""
    # watermarks need a zone-aware TIMESTAMP (NTZ sources are cast)
    return (events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
            .groupBy(*keys, F.window(ts, interval).alias("w"))
            .agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n_events"))
            .select(*keys, F.col("w.start").alias("interval_start"),
                    F.col("w.end").alias("interval_end"), value, "n_events"))


def start_interval_preagg(spark: SparkSession, source_dir: str, schema: str, sink_dir: str,
                          checkpoint_dir: str, prepare=None, glob: str | None = None,
                          available_now: bool = False, **kw) -> StreamingQuery:
    """Read new Parquet files from ``source_dir``, pre-aggregate, append to
    ``sink_dir``. ``prepare`` maps the raw stream to (ts, keys..., value)
    columns. ``checkpoint_dir`` must be on shared storage so the query
    restarts where it stopped after a driver or executor failure."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.parquet(source_dir)
    events = prepare(raw) if prepare else raw
    out = interval_preagg_stream(events, **kw)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
