"""Readers and writers (scan and sink operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.sources import schemas

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV scan with a header and an explicit schema (a fixture name, a DDL
    string or a StructType); empty cells read as NULL."""
    if isinstance(schema, str) and schema in schemas.BY_NAME:
        schema = schemas.BY_NAME[schema]
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .csv(path))


def coerce_numeric(df: DataFrame, *cols: str) -> DataFrame:
    """Lenient numeric coercion: anything that is not a number becomes NULL."""
    for c in cols:
        df = df.withColumn(c, F.expr(f"try_cast(`{c}` AS DOUBLE)"))
    return df


def read_cohort_events(spark: SparkSession, path: str) -> DataFrame:
    """Cohort event scan: text offset coerced to double, bad values -> NULL."""
    return coerce_numeric(read_csv(spark, path, schemas.COHORT_EVENTS_RAW),
                          "churned_month_offset")


def read_cac_inputs(spark: SparkSession, spend_path: str, ramp_path: str) -> tuple[DataFrame, DataFrame]:
    """Two-table load: (marketing spend by month and side, host ramp panel)."""
    return read_csv(spark, spend_path, schemas.CAC_SPEND), read_csv(spark, ramp_path, schemas.HOST_RAMP)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register driver tables as temp views for SQL use."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header and no index column (distributed part files)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """CREATE TABLE ... AS sink; returns a scan of the stored table so later
    stages read the materialised result instead of recomputing it."""
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed_table(df: DataFrame, name: str, by: list[str], buckets: int,
                        mode: str = "overwrite") -> DataFrame:
    """Table sink bucketed and sorted by ``by``: later joins or aggregates on
    those keys between tables with the same bucketing read co-located data
    and skip the shuffle (e.g. the record -> customer map and the records)."""
    df.write.mode(mode).bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to a shared path and read it back (lineage cut
    that survives executor loss, unlike caching)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
