"""Category dimension: one multi-line JSON object per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORY_JSON_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("assignable", T.BooleanType()),
        ])),
    ]))),
])


def read_category_items(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``items[]`` element with its position (explode, G2)."""
    raw = spark.read.schema(CATEGORY_JSON_SCHEMA).option("multiLine", True).json(path)
    return raw.select(F.posexplode("items").alias("pos", "item"))


def read_categories(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """``(categoryId int, categoryTitle string)``; a non-numeric id becomes NULL."""
    items = read_category_items(spark, path)
    df = items.select(
        F.expr("try_cast(item.id AS INT)").alias("categoryId"),
        F.col("item.snippet.title").alias("categoryTitle"),
    )
    if region is not None:
        df = df.withColumn("region", F.lit(region))
    return df


def assignable_categories(spark: SparkSession, path: str,
                          region: str | None = None) -> DataFrame:
    """Title -> id for assignable categories (missing flag = not assignable).

    A duplicate title keeps the id that comes last in the file; the result is
    ordered by title, as the scoring form lists it.
    """
    items = read_category_items(spark, path)
    df = (items
          .where(F.coalesce(F.col("item.snippet.assignable"), F.lit(False)))
          .select("pos", F.col("item.snippet.title").alias("categoryTitle"),
                  F.expr("try_cast(item.id AS INT)").alias("categoryId"))
          .groupBy("categoryTitle")
          .agg(F.max_by("categoryId", "pos").alias("categoryId")))
    if region is not None:
        df = df.withColumn("region", F.lit(region))
    return df.orderBy("categoryTitle")
