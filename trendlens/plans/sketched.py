"""Queries of the mergeable sketches.  Estimates have no oracle, but the exact numbers beside them
and "within the stated bound" do.

Bindings: region -> o_orderpriority (or l_returnflag), distinct value -> o_custkey, tags -> words of p_name.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sketches as K
from ..operators.topk import top_k
from ..sources.tables import read_table
from ..session import new_scratch_path
from .registry import register


def _stored(spark, df, name):
    """Written, so that what follows reads sketches and no rows."""
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@register("distinct_sketches", "A2 A3", """
SELECT 'region' AS kind, o_orderpriority AS region, count(DISTINCT o_custkey) AS exact, true AS within FROM orders GROUP BY ALL
UNION ALL SELECT 'total', NULL, count(DISTINCT o_custkey), true FROM orders
UNION ALL SELECT 'shared', a || ' and ' || b, (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = a
  INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = b)), true FROM (VALUES ('1-URGENT', '5-LOW'), ('2-HIGH', '3-MEDIUM')) t(a, b)
""")
def q_distinct_sketches(spark, sf_dir):
    """Customers by priority, in all, and shared by two priorities, from one pass of sketches."""
    orders = read_table(spark, sf_dir, "orders")
    stored = _stored(spark, K.distinct_sketches(orders, ["o_orderpriority"], "o_custkey"), "distinct")
    bound = F.lit(K.distinct_bound())
    each = K.distinct_estimate(stored).select(F.lit("region").alias("kind"), F.col("o_orderpriority").alias("region"), "estimate",
                                              (bound * F.col("estimate")).alias("slack"))
    total = K.distinct_estimate(K.merge_distinct(stored, [])).select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("region"), "estimate",
                                                                     (bound * F.col("estimate")).alias("slack"))
    got = each.unionByName(total)
    per = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("exact")).select(F.lit("region").alias("kind"), F.col("o_orderpriority").alias("region"), "exact")
    exact = per.unionByName(orders.agg(F.count_distinct("o_custkey").alias("exact")).select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("region"), "exact"))
    for a, b in (("1-URGENT", "5-LOW"), ("2-HIGH", "3-MEDIUM")):
        name = [F.lit("shared").alias("kind"), F.lit(f"{a} and {b}").alias("region")]
        got = got.unionByName(K.shared_estimate(stored, "o_orderpriority", a, b).select(*name, F.col("estimate"), (bound * F.col("both")).alias("slack")))
        both = orders.where(F.col("o_orderpriority").isin(a, b)).groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("in"))
        exact = exact.unionByName(both.agg(F.count_if(F.col("in") == 2).alias("exact")).select(*name, "exact"))
    exact = exact.withColumnRenamed("kind", "k").withColumnRenamed("region", "r")
    joined = got.join(exact, (F.col("kind") == F.col("k")) & F.col("region").eqNullSafe(F.col("r")))
    # a few values more or less are rounding
    return joined.select("kind", "region", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.col("slack") + 1).alias("within"))


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("percentiles_all_columns", "A11 P4", "\nUNION ALL\n".join(
    f"SELECT l_returnflag AS region, '{c}' AS \"column\", count({c}) AS n, round(quantile_cont({c}, 0.75), 6) AS percentile FROM lineitem GROUP BY l_returnflag"
    for c in _COLS))
def q_percentiles_all_columns(spark, sf_dir):
    """Exact thresholds of four columns in every region, in two passes over the rows."""
    li = read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "region")
    return K.exact_percentiles(li, _COLS, 0.75, ["region"]).select("region", "column", "n", F.round("percentile", 6).alias("percentile"))


@register("below_all_percentiles", "A11 P4", f"""
WITH t AS (SELECT {", ".join(f"quantile_cont({c}, 0.75) AS p_{c}" for c in _COLS)} FROM lineitem)
SELECT count(*) AS rows, round(sum(l_extendedprice), 2) AS price FROM lineitem, t WHERE {" AND ".join(f"{c} <= p_{c}" for c in _COLS)}
""")
def q_below_all_percentiles(spark, sf_dir):
    """Rows at or below the 75th percentile in all four columns: the thresholds of one sketch pass as a row of scalars."""
    li = read_table(spark, sf_dir, "lineitem")
    found = _stored(spark, K.exact_percentiles(li, _COLS, 0.75), "thresholds")
    for c in _COLS:
        li = li.where(F.col(c) <= found.where(F.col("column") == c).select("percentile").scalar())
    return li.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@register("quantile_sketch_bounds", "A11", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, min({c}) AS least, max({c}) AS most, true AS within FROM lineitem" for c in _COLS))
def q_quantile_sketch_bounds(spark, sf_dir):
    """The regions' sketches merged: the estimate's rank is within the stated bound of 0.75."""
    li = read_table(spark, sf_dir, "lineitem")
    stored = _stored(spark, K.quantile_sketches(li, _COLS, ["l_returnflag"]), "quantiles")
    merged = _stored(spark, K.quantile_estimate(K.merge_quantiles(stored), 0.75), "quantile-estimates")
    guess = {c: merged.where(F.col("column") == c).select("estimate").scalar() for c in _COLS}
    shares = li.agg(*[e.alias(f"{n}{i}") for i, c in enumerate(_COLS) for n, e in (
        ("b", F.count_if(F.col(c) < guess[c]) / F.count(c)), ("a", F.count_if(F.col(c) <= guess[c]) / F.count(c)))])
    bound = K.rank_bound()
    within = shares.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), ((F.col(f"b{i}") <= 0.75 + bound) & (F.col(f"a{i}") >= 0.75 - bound)).alias("within"))
                                             for i, c in enumerate(_COLS)])))
    return merged.drop("estimate").join(within, "column")


def _words(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select(F.col("p_brand").alias("region"), F.explode(F.split("p_name", " ")).alias("tag"))


@register("top_tags_sketched", "A16 T4", """
SELECT tag, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag ORDER BY count DESC, tag LIMIT 15
""")
def q_top_tags_sketched(spark, sf_dir):
    """The regions' counters combined; the capacity covers all tags, so counts are exact."""
    stored = _stored(spark, K.item_sketches(_words(spark, sf_dir), ["region"], "tag"), "items")
    every = K.frequent_items(K.merge_items(stored, []), [], "tag", K.CAPACITY)
    return top_k(every, ["tag"], 15)


@register("item_sketch_bounds", "A16", """
SELECT count(*) AS rows, true AS within, true AS none_missed FROM lineitem
""")
def q_item_sketch_bounds(spark, sf_dir):
    """Far more values than counters (suppliers, 48 of them kept): every count reported is within the
    bound of the true one, and no value above the bound twice over is missing."""
    li, capacity = read_table(spark, sf_dir, "lineitem"), 48
    # a skewed column: some suppliers stand for many
    skewed = li.select("l_returnflag", F.when(F.col("l_suppkey") % 3 == 0, F.lit(0)).when(F.col("l_suppkey") % 3 == 1, F.lit(1)).otherwise(F.col("l_suppkey")).alias("item"))
    stored = _stored(spark, K.item_sketches(skewed, ["l_returnflag"], "item", capacity), "items-bounded")
    merged = K.merge_items(stored, [], capacity)
    rows = merged.select("rows").scalar()
    got = K.frequent_items(merged, [], "item", capacity)
    true_counts = skewed.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    both = true_counts.join(got, "item", "full_outer")
    slack = F.lit(K.item_bound(capacity)) * rows
    return both.agg(rows.alias("rows"), F.min(F.coalesce(F.abs(F.col("count") - F.col("n")) <= slack, F.lit(True))).alias("within"),
                    (F.count_if(F.col("count").isNull() & (F.col("n") > 2 * slack)) == 0).alias("none_missed"))
