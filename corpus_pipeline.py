"""Corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and reads again as the next one's
docs.  All but the last return the columns of documents; ``n_chars`` follows the text.

What a stage writes on its way is deleted when the next stage begins, unless that one's docs still read
it, so that the disk holds one stage's intermediates at a time; ``run`` also deletes each stage's result
when the next one's is written.

Defined results: null texts count as empty and go in the first stage (too few words); repeated
rows are rows of their own until the near-duplicate stage keeps one; an empty table stays empty;
further columns, whatever their names, are carried through all stages but the last.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.llm import lines, packing, pii, quality, simhash
from trendlens.llm.common import intermediates, small_batches, table, written
from trendlens.session import remove_path

# By application: what the result of its last stage is made from.
_made: dict[str, list[str]] = {}


def _release(spark: SparkSession, docs: DataFrame) -> None:
    """Delete the last stage's intermediates, unless ``docs`` reads them."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    files = docs.inputFiles() if paths else []
    for path in paths:
        if not any(path.rsplit("/", 1)[1] in f for f in files):
            remove_path(spark, path)


def _stage(work: Callable) -> Callable:
    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _release(spark, docs)
        small_batches(spark)
        with intermediates() as made:
            out = work(spark, docs, sf_dir)
        _made[spark.sparkContext.applicationId] = made
        return out
    return stage


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``doc_id``, ``text`` and ``lang`` as they are and plain names for the other columns, which
    can't clash with those of an operator; and the names in order."""
    own = ("doc_id", "text", "lang")
    names = [c if c in own else f"column{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def _named(rows: DataFrame, names: list[str], docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``rows`` with the names of ``docs``; with ``text`` as the text and its length, if it is given."""
    if text is None:
        return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
    # Computed on its own: beside a new "text", names in it could mean that one.
    rows = rows.withColumn("new_text", text)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return rows.select(*[new.get(c, F.col(n)).alias(c) for n, c in zip(names, docs.columns)])


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules (7) keep."""
    rows, names = _plain(docs)
    return _named(quality.judge(rows, names).filter("_q_kept"), names, docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group (2): of those with its smallest doc_id the first."""
    rows, names = _plain(docs)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    groups = simhash.near_duplicates(rows, keep=["row"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    kept = groups.groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return _named(rows.join(kept, "row", "left_semi"), names, docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines and sentences that an earlier one has (4)."""
    rows, names = _plain(docs)
    return _named(lines.dedup_units(rows, names), names, docs, F.col("_u_text"))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every span of personal data (1) replaced by its kind."""
    rows, names = _plain(docs)
    return _named(pii.with_spans(rows, keep=names), names, docs, pii.redacted())


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in windows (9), a row a piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Perplexity, SimHash links and sum-of-squares placement aren't expressible in SQL; the tests
# compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        with intermediates() as made:
            docs = written(kept, f"pipeline-{name}")
        for path in before:
            remove_path(spark, path)
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
