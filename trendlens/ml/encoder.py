"""Feature vectors from label and term tables joined to the rows (M2, M3, M5-M8).

``StringIndexer`` and ``CountVectorizer`` hold their labels and vocabulary on the
driver and in the model.  Here both are tables: every label and term has its
number from a distributed ranking, rows find their numbers by join, and the
``(row, index, value)`` entries are gathered per row into a sparse vector.  The
layout is that of ``feature_pipeline``: terms first, then one block a column; an
unseen or NULL label and an unseen term have no entry.

A hot label (one channel, or one tag, with a third of all rows) is joined by
broadcast (``join_counted``), so it isn't shuffled into one task.  Entries of a
row are at most its columns and tags.  No Python runs on the rows: vectors are
written in the layout Spark stores them in and read back as vectors.

Only the sizes of the blocks (a number a column) come to the driver.  What the
model learns has the vector's width, as in any linear model of MLlib.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_counted
from ..operators.rank import cumulative_before
from ..session import new_scratch_path, remove_path
from .features import FeatureSpec, document_frequency, label_index


class JoinEncoder:
    """A fitted encoding whose tables lie under ``path``: ``labels`` (column, value, index, count)
    and ``terms`` (term, index, df, weight), with the blocks' sizes in ``meta``."""

    gathers = True

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        self.spec = FeatureSpec(**{**meta["spec"], "categorical": tuple(meta["spec"]["categorical"])})
        self.sizes, self.rows = meta["sizes"], meta["rows"]
        self.labels = spark.read.parquet(f"{path}/labels")
        self.terms = spark.read.parquet(f"{path}/terms") if self.spec.text else None

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    # ------------------------------------------------------------ fit, save

    @classmethod
    def fit(cls, spec: FeatureSpec, train: DataFrame, path: str | None = None) -> "JoinEncoder":
        """Number the labels of each categorical column and the terms of ``min_df`` documents.

        Labels rank by count, then value; terms by document frequency, then term.
        A term's weight is 1 (``count``) or its idf (``tfidf``).
        """
        if spec.text not in (None, "count", "tfidf"):
            raise ValueError(f"hashing needs no vocabulary; text is None, count or tfidf, not {spec.text}")
        spark = train.sparkSession
        path = path or new_scratch_path(spark, "encoder")
        sizes = {}
        if spec.text:
            docs = train.select(F.lit(0).alias("doc"), spec.tags_col)
            freq = document_frequency(docs, "doc", spec.tags_col, spec.min_df)
            if spec.vocab_size:
                freq = freq.orderBy(F.desc("df"), "term").limit(spec.vocab_size)
            ranked = cumulative_before(freq, [F.desc("df"), F.asc("term")], out="index")
            weight = F.col("idf") if spec.text == "tfidf" else F.lit(1.0)
            ranked.select("term", "index", "df", weight.alias("weight")).write.parquet(f"{path}/terms")
            sizes["terms"] = spark.read.parquet(f"{path}/terms").count()
        before = sum(sizes.values())
        schema = "column string, value string, index long, count long"
        spark.createDataFrame([], schema).write.parquet(f"{path}/labels")
        for c in spec.categorical:
            label_index(train, c).select(F.lit(c).alias("column"), "value", (F.col("idx") + F.lit(before)).alias("index"), "count") \
                .write.mode("append").parquet(f"{path}/labels")
            sizes[c] = spark.read.parquet(f"{path}/labels").where(F.col("column") == c).count()
            before += sizes[c]
        meta = json.dumps({"spec": asdict(spec), "sizes": sizes, "rows": train.count()})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/meta")
        return cls(spark, path)

    def save(self, path: str) -> None:
        """Copy the tables (overwrites)."""
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        if self.terms is not None:
            self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.spark.read.text(f"{self.path}/meta").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    # --------------------------------------------------------------- encode

    def entries(self, rows: DataFrame, id_col: str) -> DataFrame:
        """``(id_col, index, value)``: the non-zero slots of every row's vector."""
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in self.spec.categorical])
        out = None
        if self.spec.categorical:
            cells = rows.select(id_col, F.inline(pairs)).where(F.col("value").isNotNull())
            out = join_counted(cells, self.labels, ["column", "value"], "count", self.rows * len(self.spec.categorical)) \
                .select(id_col, "index", F.lit(1.0).alias("slot"))
        if self.terms is not None:
            tags = F.coalesce(F.col(self.spec.tags_col), F.array().cast("array<string>"))
            # A row's own counts are made in the row.
            each = F.transform(F.array_distinct(tags), lambda t: F.struct(
                t.alias("term"), F.size(F.filter(tags, lambda x: x == t)).cast("double").alias("tf")))
            found = join_counted(rows.select(id_col, F.inline(each)).where(F.col("term").isNotNull()), self.terms, ["term"], "df", self.rows)
            found = found.select(id_col, "index", (F.col("tf") * F.col("weight")).alias("slot"))
            out = found if out is None else out.unionByName(found)
        if out is None:
            return rows.select(id_col, F.lit(None).cast("long").alias("index"), F.lit(None).cast("double").alias("slot")).where("false")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``.  Rows are numbered in a written copy, so equal rows stay apart."""
        copy, vectors = (new_scratch_path(self.spark, name) for name in ("encoder-rows", "encoder-vectors"))
        df.withColumn("_tl_row", F.monotonically_increasing_id()).write.parquet(copy)
        schema = T.StructType([*df.schema.fields, T.StructField("_tl_row", T.LongType())])
        rows = self.spark.read.schema(schema).parquet(copy)
        slots = self.entries(rows, "_tl_row").groupBy("_tl_row").agg(F.array_sort(F.collect_list(F.struct("index", "slot"))).alias("s"))
        empty = F.array().cast("array<struct<index:bigint,slot:double>>")
        got = F.coalesce(F.col("s"), empty)
        # The layout of a sparse vector: type 0, size, indices, values.
        vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"),
                          F.transform(got, lambda e: e["index"].cast("int")).alias("indices"),
                          F.transform(got, lambda e: e["slot"]).alias("values"))
        out = rows.join(slots, "_tl_row", "left").select(*[F.col(f"`{c}`") for c in df.columns], vector.alias("features"))
        out.write.parquet(vectors)
        remove_path(self.spark, copy)
        return self.spark.read.schema(T.StructType([*[f for f in df.schema.fields], T.StructField("features", VectorUDT())])).parquet(vectors)
