"""Table functions: rows out of one value, used next to ``FROM`` as
``LATERAL split_list(...)`` or with a literal list."""

from __future__ import annotations

from pyspark.sql import SparkSession

SPLIT_LIST = r"""
CREATE OR REPLACE TEMPORARY FUNCTION split_list(list STRING, separator STRING)
RETURNS TABLE (pos INT, item STRING)
RETURN SELECT pos, trim(part) FROM (
    SELECT posexplode(split(list, concat('\\Q', separator, '\\E'))) AS (pos, part)) WHERE trim(part) <> ''
"""


def register_tables_functions(spark: SparkSession) -> None:
    """``split_list(list, separator)``: the trimmed items of a list with their
    places, one row each; empty items and a null list give no rows."""
    spark.sql(SPLIT_LIST)
