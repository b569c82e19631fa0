import os
import tempfile

from pyspark.sql import functions as F

from meridian.streaming.intervals import start_interval_preagg

SF = "/root/testdata/sf0.001"


def _prepare(raw):
    return raw.select(F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("Z"), (F.col("user_id") % 4).cast("string")).alias("zone"),
                      F.when(F.col("user_id") % 2 == 1, "Treatment").otherwise("Control").alias("assignment"),
                      F.col("value").alias("wait_time_min"))


def test_streaming_preagg_matches_batch(spark):
    if not os.path.isdir(SF):
        return
    work = tempfile.mkdtemp(prefix="meridian-stream-")
    schema = spark.read.parquet(f"{SF}/events.parquet").schema.simpleString()[7:-1].replace(":", " ")
    q = start_interval_preagg(spark, SF, schema, f"{work}/sink", f"{work}/ckpt", prepare=_prepare,
                              glob="events.parquet", available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(f"{work}/sink")
    batch = (_prepare(spark.read.parquet(f"{SF}/events.parquet"))
             .groupBy("zone", "assignment", F.window("ts", "5 minutes").alias("w"))
             .agg(F.count(F.lit(1)).alias("n")))
    # windows closed by the watermark are emitted; the last open ones may not be
    assert got.count() > 0
    assert got.agg(F.sum("n_events")).collect()[0][0] <= batch.agg(F.sum("n")).collect()[0][0]
    joined = got.join(batch.select("zone", "assignment", F.col("w.start").alias("interval_start"), "n"),
                      ["zone", "assignment", "interval_start"])
    assert joined.where(F.col("n") != F.col("n_events")).count() == 0
    assert joined.count() == got.count()


def test_late_event_behind_watermark_is_dropped(spark):
    import datetime as dt

    from meridian.streaming.intervals import interval_preagg_stream
    work = tempfile.mkdtemp(prefix="meridian-late-")
    src, sink, ckpt = f"{work}/src", f"{work}/sink", f"{work}/ckpt"
    schema = "ts timestamp, zone string, assignment string, wait_time_min double"
    t0 = dt.datetime(2024, 1, 1, 0, 0)

    def write(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{src}/{name}")

    def run():
        q = (interval_preagg_stream(spark.readStream.schema(schema).parquet(f"{src}/*"), lateness="5 minutes")
             .writeStream.format("parquet").outputMode("append").option("path", sink)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(300)

    # first batch: events at 00:01 and 00:02, then one at 00:30 moves the watermark to 00:25
    write([(t0 + dt.timedelta(minutes=1), "Z", "Control", 1.0),
           (t0 + dt.timedelta(minutes=2), "Z", "Control", 3.0),
           (t0 + dt.timedelta(minutes=30), "Z", "Control", 5.0)], "b1")
    run()
    # second batch: a late event for the closed 00:00 window, and one far ahead to close 00:30
    write([(t0 + dt.timedelta(minutes=3), "Z", "Control", 100.0),
           (t0 + dt.timedelta(minutes=60), "Z", "Control", 7.0)], "b2")
    run()
    out = {r.interval_start.minute: (r.n_events, r.wait_time_min)
           for r in spark.read.parquet(sink).collect()}
    assert out[0] == (2, 2.0)          # the late 00:03 event did not reopen the window
    assert out[30] == (1, 5.0)
