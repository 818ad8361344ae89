"""Scoring requests (S13): any table of requests, not one row per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("region", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("publish_dt", T.StringType()),
])


def requests_to_df(spark: SparkSession, rows: DataFrame | list[dict] | list[tuple]) -> DataFrame:
    """Typed requests of a few rows (interactive input) or of any table, batch or stream.

    A table's columns are taken by name and cast (what doesn't cast is NULL); a
    missing one is NULL, others are dropped.
    """
    if isinstance(rows, DataFrame):
        return rows.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                             for f in REQUEST_SCHEMA])
    return spark.createDataFrame(rows, schema=REQUEST_SCHEMA)
