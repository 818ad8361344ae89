"""Batch EDA queries (S, P, F, G, J, A, O, X operators) on the driver tables.

Bindings (video record -> test table): title -> documents.text / part.p_name,
tags -> part.p_name words, view_count (denominator) -> l_discount,
comments_disabled -> l_returnflag = 'R', channel -> (c_custkey, c_name),
category dimension -> nation, publishedAt -> o_orderdate / events.ts.
Integral outputs are BIGINT and computed doubles are rounded to 6 places in
both the Spark query and its oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (decode_json, drop_blank, log1p, lower_all, ratio, split_pipe, text_length,
                                 time_part, word_count_single_space, word_count_whitespace)
from ..operators import clean, joins, profile, sampling, tags, topk
from ..session import new_scratch_path
from ..sources import categories, records
from ..sources.tables import read_table
from ..streaming import running
from .registry import register

R = 6  # digits kept for computed doubles


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


def _r(col, digits=R):
    return F.round(F.col(col), digits).alias(col)


def _clean_lineitem(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return clean.clean_records(li, "l_discount", F.col("l_returnflag") == "R")


LINEITEM_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


# ------------------------------------------------------------------ top tags
@register("top_tags", "G1 A16 O3 F4 F5", """
SELECT tag, count(*) AS count
FROM (SELECT trim(lower(unnest(string_split_regex(p_name, ' ')))) AS tag FROM part)
GROUP BY tag ORDER BY count DESC, tag ASC LIMIT 40
""")
def q_top_tags(spark, sf_dir):
    return tags.top_tags(_t(spark, sf_dir, "part"), k=40, col="p_name", sep_regex=" ")


@register("distinct_tags", "A3 F6", """
SELECT count(DISTINCT tag) AS distinct_tags
FROM (SELECT lower(unnest(string_split_regex(p_name, ' '))) AS tag FROM part)
""")
def q_distinct_tags(spark, sf_dir):
    return tags.distinct_tags(_t(spark, sf_dir, "part"), col="p_name", sep_regex=" ")


# ------------------------------------------------------------------ cleaning
@register("clean_records", "P1 S14", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag
FROM lineitem WHERE l_discount <> 0 AND (l_returnflag = 'R') = false
""")
def q_clean_records(spark, sf_dir):
    return _clean_lineitem(spark, sf_dir).select(*LINEITEM_COLS)


@register("cleaning_report", "P2 A1", """
SELECT count(*) FILTER (WHERE l_discount = 0) AS zero_rows,
       count(*) AS total_rows,
       count(*) FILTER (WHERE l_discount <> 0 AND (l_returnflag = 'R') = false) AS kept_rows
FROM lineitem
""")
def q_cleaning_report(spark, sf_dir):
    return clean.cleaning_report(_t(spark, sf_dir, "lineitem"), "l_discount",
                                 F.col("l_returnflag") == "R")


RATIO_SQL = """
SELECT l_orderkey, l_linenumber,
       round(l_tax / l_discount, 2) AS likes_ratio,
       round(l_tax / l_extendedprice, 10) AS dislikes_ratio,
       l_quantity / l_extendedprice AS comments_ratio
FROM lineitem WHERE l_discount <> 0 AND (l_returnflag = 'R') = false
"""


def _ratios(spark, sf_dir):
    return _clean_lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", *[c for c in LINEITEM_COLS[3:7]],
        ratio("l_tax", "l_discount", 2).alias("likes_ratio"),
        ratio("l_tax", "l_extendedprice", 10).alias("dislikes_ratio"),
        ratio("l_quantity", "l_extendedprice").alias("comments_ratio"))


@register("engagement_ratios", "F9", RATIO_SQL)
def q_engagement_ratios(spark, sf_dir):
    return _ratios(spark, sf_dir).select("l_orderkey", "l_linenumber", "likes_ratio",
                                         "dislikes_ratio", "comments_ratio")


# ------------------------------------------------------------ title features
@register("title_stats", "F1 F2", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS title_length,
       CAST(len(string_split(text, ' ')) AS BIGINT) AS word_count
FROM documents
""")
def q_title_stats(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", text_length("text").cast("long").alias("title_length"),
                    word_count_single_space("text").cast("long").alias("word_count"))


@register("describe_titles", "A10", """
WITH t AS (SELECT CAST(length(text) AS DOUBLE) AS title_length,
                  CAST(len(string_split(text, ' ')) AS DOUBLE) AS word_count FROM documents)
SELECT 'title_length' AS "column", count(title_length) AS n, round(avg(title_length), 6) AS mean,
       round(stddev_samp(title_length), 6) AS stddev, min(title_length) AS min, max(title_length) AS max FROM t
UNION ALL
SELECT 'word_count', count(word_count), round(avg(word_count), 6), round(stddev_samp(word_count), 6),
       min(word_count), max(word_count) FROM t
""")
def q_describe_titles(spark, sf_dir):
    d = q_title_stats(spark, sf_dir)
    out = profile.describe_numeric(d, ["title_length", "word_count"])
    return out.select("column", "n", _r("mean"), _r("stddev"), "min", "max")


# ------------------------------------------------------------ entity counts
@register("distinct_entities", "A1 A2", """
SELECT count(*) AS rows, count(DISTINCT l_partkey) AS distinct_keys FROM lineitem
""")
def q_distinct_entities(spark, sf_dir):
    return profile.distinct_count(_t(spark, sf_dir, "lineitem"), "l_partkey")


@register("repeated_entities", "A5 P3 O1", """
SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey HAVING count(*) > 1
ORDER BY count DESC, l_partkey
""")
def q_repeated_entities(spark, sf_dir):
    return profile.repeated_entities(_t(spark, sf_dir, "lineitem"), "l_partkey")


HIST_SQL = """
WITH x AS ({src}),
s AS (SELECT min(x) AS mn, max(x) AS mx FROM x),
b AS (SELECT LEAST(COALESCE(CAST(floor((x - mn) * {bins} / nullif(mx - mn, 0)) AS BIGINT), 0), {last}) AS bin
      FROM x, s),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin)
SELECT g.bin AS bin, round(mn + g.bin * (mx - mn) / {bins}, 6) AS lo,
       round(mn + (g.bin + 1) * (mx - mn) / {bins}, 6) AS hi,
       COALESCE(c.cnt, 0) AS count
FROM (SELECT range AS bin FROM range({bins})) g CROSS JOIN s LEFT JOIN c ON g.bin = c.bin
"""


def hist_sql(src: str, bins: int) -> str:
    return HIST_SQL.format(src=src, bins=bins, last=bins - 1)


def _hist(df, col, bins):
    return profile.histogram(df, col, bins).select("bin", _r("lo"), _r("hi"), "count")


@register("repeat_distribution", "A6 A12", hist_sql(
    "SELECT CAST(count(*) AS DOUBLE) AS x FROM lineitem GROUP BY l_partkey HAVING count(*) > 1", 16))
def q_repeat_distribution(spark, sf_dir):
    return _hist(q_repeated_entities(spark, sf_dir), "count", 16)


@register("counts_by_flag", "A4", """
SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus
""")
def q_counts_by_flag(spark, sf_dir):
    return profile.counts_by(_t(spark, sf_dir, "orders"), ["o_orderstatus"])


def _time_counts(spark, sf_dir, table, col, part):
    name = f"publish_{part}"
    g = profile.counts_by_time(_t(spark, sf_dir, table), col, part, out=name)
    return g.select(F.col(name).cast("long").alias(name), "count")


TIME_SQL = """
SELECT CAST({expr} AS BIGINT) AS publish_{part}, count(*) AS count FROM {table}
GROUP BY 1 ORDER BY 1
"""

for _part, _table, _col, _expr in [
        ("year", "orders", "o_orderdate", "year(o_orderdate)"),
        ("month", "orders", "o_orderdate", "month(o_orderdate)"),
        ("dayofweek", "events", "ts", "dayofweek(ts) + 1"),
        ("hour", "events", "ts", "hour(ts)")]:
    register(f"counts_by_{_part}", "A7 F7 O2",
             TIME_SQL.format(expr=_expr, part=_part, table=_table))(
        (lambda t, c, p: lambda spark, sf_dir: _time_counts(spark, sf_dir, t, c, p))(
            _table, _col, _part))


@register("top_entities", "A8 O3", """
SELECT c_custkey, c_name, count(*) AS count
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_custkey, c_name ORDER BY count DESC, c_custkey, c_name LIMIT 10
""")
def q_top_entities(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # orders are pre-aggregated per customer before the join: the join sees one
    # row per customer, not one per order.
    per_cust = o.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("count"))
    g = per_cust.join(c, "c_custkey").select("c_custkey", "c_name", "count")
    g = g.groupBy("c_custkey", "c_name").agg(F.sum("count").cast("long").alias("count"))
    return topk.top_k(g, ["c_custkey", "c_name"], 10)


@register("counts_by_category", "J1 A9 O1", """
SELECT n_name AS categoryTitle, count(*) AS count
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name ORDER BY count DESC, categoryTitle NULLS LAST
""")
def q_counts_by_category(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("categoryId"))
    dim = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("categoryId"),
                                             F.col("n_name").alias("categoryTitle"))
    j = joins.with_category(s, dim, "categoryId")
    g = j.groupBy("categoryTitle").agg(F.count(F.lit(1)).alias("count"))
    return topk.order_by_count_desc(g, ["categoryTitle"])


# --------------------------------------------------------------- percentile
@register("percentile_75", "A11", """
SELECT round(quantile_cont(l_extendedprice, 0.75), 6) AS percentile FROM lineitem
""")
def q_percentile_75(spark, sf_dir):
    p = profile.percentile(_t(spark, sf_dir, "lineitem"), "l_extendedprice", 0.75)
    return p.select(_r("percentile"))


@register("below_percentile", "P4 A11", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_extendedprice <= (SELECT quantile_cont(l_extendedprice, 0.75) FROM lineitem)
""")
def q_below_percentile(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    thr = profile.percentile(li, "l_extendedprice", 0.75).scalar()
    return clean.at_most_percentile(li, "l_extendedprice", thr).select(
        "l_orderkey", "l_linenumber", "l_extendedprice")


# ---------------------------------------------------------------- histograms
_HISTS = {
    # name: (table, spark column builder, SQL value expression, bins)
    "histogram_title_length": ("documents", lambda d: d.select(text_length("text").alias("v")),
                               "CAST(length(text) AS DOUBLE)", 50),
    "histogram_word_count": ("documents", lambda d: d.select(word_count_single_space("text").alias("v")),
                             "CAST(len(string_split(text, ' ')) AS DOUBLE)", 18),
    "histogram_extendedprice": ("lineitem", lambda d: d.select(F.col("l_extendedprice").alias("v")),
                                "l_extendedprice", 50),
    "histogram_quantity": ("lineitem", lambda d: d.select(F.col("l_quantity").alias("v")),
                           "l_quantity", 75),
}

for _name, (_table, _build, _expr, _bins) in _HISTS.items():
    register(_name, "A12", hist_sql(
        f"SELECT {_expr} AS x FROM {_table} WHERE {_expr} IS NOT NULL", _bins))(
        (lambda tb, bld, b: lambda spark, sf_dir: _hist(bld(_t(spark, sf_dir, tb)), "v", b))(
            _table, _build, _bins))


def _ratio_hist_sql(expr: str, bins: int) -> str:
    src = (f"SELECT {expr} AS x FROM lineitem WHERE l_discount <> 0 "
           f"AND (l_returnflag = 'R') = false AND {expr} IS NOT NULL")
    return hist_sql(src, bins)


@register("histogram_likes_ratio", "A12 F9", _ratio_hist_sql("round(l_tax / l_discount, 2)", 35))
def q_histogram_likes_ratio(spark, sf_dir):
    return _hist(_ratios(spark, sf_dir), "likes_ratio", 35)


@register("histogram_comments_ratio", "A12 F9",
          _ratio_hist_sql("l_quantity / l_extendedprice", 50))
def q_histogram_comments_ratio(spark, sf_dir):
    return _hist(_ratios(spark, sf_dir), "comments_ratio", 50)


@register("histogram_dislikes_ratio", "A12 F9",
          _ratio_hist_sql("round(l_tax / l_extendedprice, 10)", 30))
def q_histogram_dislikes_ratio(spark, sf_dir):
    return _hist(_ratios(spark, sf_dir), "dislikes_ratio", 30)


@register("histogram_comments_ratio_35", "A12 F9",
          _ratio_hist_sql("l_quantity / l_extendedprice", 35))
def q_histogram_comments_ratio_35(spark, sf_dir):
    return _hist(_ratios(spark, sf_dir), "comments_ratio", 35)


# Histograms of the rows at or below the 75th percentile of the same column.
_BELOW = {
    "extendedprice": ("l_extendedprice", "l_extendedprice", 50),
    "quantity": ("l_quantity", "l_quantity", 75),
    "dislikes_ratio": ("dislikes_ratio", "round(l_tax / l_extendedprice, 10)", 30),
    "comments_ratio": ("comments_ratio", "l_quantity / l_extendedprice", 50),
}
_CLEAN_SQL = "FROM lineitem WHERE l_discount <> 0 AND (l_returnflag = 'R') = false"


def _below(col, bins):
    def query(spark, sf_dir):
        rows = _ratios(spark, sf_dir)
        threshold = profile.percentile(rows, col, 0.75).scalar()
        return _hist(clean.at_most_percentile(rows, col, threshold), col, bins)
    return query


for _name, (_col, _expr, _bins) in _BELOW.items():
    register(f"histogram_below_p75_{_name}", "A12 P4 A11", hist_sql(
        f"SELECT e AS x FROM (SELECT {_expr} AS e {_CLEAN_SQL}) "
        f"WHERE e <= (SELECT quantile_cont(e, 0.75) FROM (SELECT {_expr} AS e {_CLEAN_SQL}))", _bins))(_below(_col, _bins))


# Binned kernel densities of the columns that the reports draw.
def density_sql(src: str, bins: int = 512, grid: int = 100) -> str:
    return f"""
WITH x AS ({src}),
s AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n,
             stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM x),
b AS (SELECT LEAST(COALESCE(CAST(floor((x - mn) * {bins} / nullif(mx - mn, 0)) AS BIGINT), 0), {bins - 1}) AS bin, count(*) AS cnt
      FROM x, s GROUP BY 1),
vc AS (SELECT mn + (bin + 0.5) * (mx - mn) / {bins} AS x, cnt FROM b, s),
g AS (SELECT range AS i FROM range({grid})),
k AS (SELECT g.i, mn + g.i * ((mx - mn) / {grid - 1}.0) AS gx,
             vc.cnt * exp(-0.5 * ((mn + g.i * ((mx - mn) / {grid - 1}.0) - vc.x) / h)
                                * ((mn + g.i * ((mx - mn) / {grid - 1}.0) - vc.x) / h)) AS c, n, h
      FROM vc CROSS JOIN g CROSS JOIN s)
SELECT i AS point, round(gx, 6) AS x,
       round(sum(c) * (1.0 / sqrt(2.0 * pi())) / (any_value(n) * any_value(h)), 6) AS density
FROM k GROUP BY i, gx"""


def _density(df, col):
    return profile.density(df, col, grid=100).select("point", _r("x"), _r("density"))


_DENSITIES = {
    "title_length": (lambda s, d: _t(s, d, "documents").select(text_length("text").alias("v")),
                     "SELECT CAST(length(text) AS DOUBLE) AS x FROM documents WHERE text IS NOT NULL"),
    "word_count": (lambda s, d: _t(s, d, "documents").select(word_count_single_space("text").alias("v")),
                   "SELECT CAST(len(string_split(text, ' ')) AS DOUBLE) AS x FROM documents WHERE text IS NOT NULL"),
    "likes_ratio": (lambda s, d: _ratios(s, d).select(F.col("likes_ratio").alias("v")),
                    f"SELECT round(l_tax / l_discount, 2) AS x {_CLEAN_SQL}"),
    "comments_ratio": (lambda s, d: _ratios(s, d).select(F.col("comments_ratio").alias("v")),
                       f"SELECT l_quantity / l_extendedprice AS x {_CLEAN_SQL}"),
    "extendedprice": (lambda s, d: _t(s, d, "lineitem").select(F.col("l_extendedprice").alias("v")),
                      "SELECT l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL"),
}

for _name, (_build, _src) in _DENSITIES.items():
    register(f"density_{_name}", "A13", density_sql(_src))(
        (lambda build: lambda spark, sf_dir: _density(build(spark, sf_dir), "v"))(_build))


@register("density_quantity", "A13", """
WITH x AS (SELECT CAST(l_quantity AS DOUBLE) AS x FROM lineitem WHERE l_quantity IS NOT NULL),
s AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n,
             stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM x),
vc AS (SELECT x, count(*) AS cnt FROM x GROUP BY x),
g AS (SELECT range AS i FROM range(100)),
k AS (SELECT g.i, mn + g.i * ((mx - mn) / 99.0) AS gx,
             vc.cnt * exp(-0.5 * ((mn + g.i * ((mx - mn) / 99.0) - vc.x) / h)
                                * ((mn + g.i * ((mx - mn) / 99.0) - vc.x) / h)) AS c, n, h
      FROM vc CROSS JOIN g CROSS JOIN s)
SELECT i AS point, round(gx, 6) AS x,
       round(sum(c) * (1.0 / sqrt(2.0 * pi())) / (any_value(n) * any_value(h)), 6) AS density
FROM k GROUP BY i, gx
""")
def q_density_quantity(spark, sf_dir):
    """Exact kernels: the column has 50 distinct values."""
    d = profile.density(_t(spark, sf_dir, "lineitem"), "l_quantity", grid=100, bins=None)
    return d.select("point", _r("x"), _r("density"))


# --------------------------------------------------------------- correlation
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "likes_ratio", "dislikes_ratio", "comments_ratio"]


def _corr_sql() -> str:
    src = RATIO_SQL.replace("SELECT l_orderkey, l_linenumber,",
                            "SELECT l_quantity, l_extendedprice, l_discount, l_tax,")
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM r"
             for a in CORR_COLS for b in CORR_COLS]
    return f"WITH r AS ({src})\n" + "\nUNION ALL\n".join(parts)


@register("correlation_matrix", "A14 P5", _corr_sql())
def q_correlation_matrix(spark, sf_dir):
    numeric = clean.select_numeric(_ratios(spark, sf_dir), CORR_COLS)
    return profile.correlation_matrix(numeric, CORR_COLS).select(
        "col_a", "col_b", _r("corr"))


PAIR_COLS = ["l_quantity", "l_extendedprice", "l_tax", "likes_ratio"]


def _pair_sql(bins: int = 10) -> str:
    cols = PAIR_COLS
    mins = ", ".join(f"min({c}) AS mn{i}, max({c}) AS mx{i}" for i, c in enumerate(cols))
    bexpr = [f"CASE WHEN {c} IS NOT NULL THEN LEAST(COALESCE(CAST(floor(({c} - mn{i}) * {bins} / nullif(mx{i} - mn{i}, 0)) AS BIGINT), 0), {bins - 1}) END"
             for i, c in enumerate(cols)]
    sel = ", ".join(f"{e} AS b{i}" for i, e in enumerate(bexpr))
    unions = "\nUNION ALL\n".join(
        f"SELECT '{cols[i]}' AS col_a, '{cols[j]}' AS col_b, b{i} AS bin_a, b{j} AS bin_b FROM b"
        for i in range(len(cols)) for j in range(i, len(cols)))
    return ("WITH x AS (SELECT l_quantity, l_extendedprice, l_tax, round(l_tax / nullif(l_discount, 0), 2) AS likes_ratio FROM lineitem),\n"
            f"s AS (SELECT {mins} FROM x),\n"
            f"b AS (SELECT {sel} FROM x, s),\n"
            f"p AS ({unions})\n"
            "SELECT col_a, col_b, bin_a, bin_b, count(*) AS count FROM p "
            "WHERE bin_a IS NOT NULL AND bin_b IS NOT NULL GROUP BY ALL")


@register("pairwise_density", "A15", _pair_sql())
def q_pairwise_density(spark, sf_dir):
    """The ratio is NULL where its denominator is zero: such rows count in the other pairs only."""
    li = _t(spark, sf_dir, "lineitem").withColumn("likes_ratio", ratio("l_tax", "l_discount", 2))
    return profile.pairwise_density(li, PAIR_COLS, bins=10)


# ------------------------------------------------------------- JSON decoding
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@register("decode_json", "S6 F12 F14", """
SELECT event_id, event_type, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_decode_json(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", "event_type",
                    decode_json("props", PROPS_SCHEMA).alias("data")).select(
        "event_id", "event_type", "data.k")


# ------------------------------------------- previews and column functions
@register("preview", "S14 O2", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 20
""")
def q_preview(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return topk.order_by_key(_t(spark, sf_dir, "lineitem").select(*cols), cols).limit(20)


@register("row_counts", "A1", """
SELECT 'orders' AS "table", count(*) AS rows FROM orders UNION ALL SELECT 'documents', count(*) FROM documents
""")
def q_row_counts(spark, sf_dir):
    o, d = (profile.row_count(_t(spark, sf_dir, n)).select(F.lit(n).alias("table"), "rows") for n in ("orders", "documents"))
    return o.unionByName(d)


@register("whitespace_words", "F3", r"""
SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS INTEGER) AS words FROM documents
""")
def q_whitespace_words(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", word_count_whitespace("text").alias("words"))


@register("tag_columns", "F4 F6 P8", """
SELECT p_partkey, lower(concat_ws('+', p_brand, p_type, p_name)) AS tags, CAST(3 AS INTEGER) AS n FROM part
""")
def q_tag_columns(spark, sf_dir):
    """Blank tags go, the others are lowered."""
    tags_ = F.concat_ws("|", "p_brand", F.lit(""), "p_type", F.lit("  "), "p_name")
    kept = drop_blank(lower_all(split_pipe(tags_)))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(kept, "+").alias("tags"), F.size(kept).alias("n"))


@register("model_columns", "F10 F11 P6 P7", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS label, CAST(l_linenumber AS VARCHAR) AS l_linenumber_str,
       round(ln(1 + l_quantity), 6) AS log_quantity FROM lineitem
""")
def q_model_columns(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    li = clean.as_categorical(clean.rename_target(li, "l_extendedprice"), ["l_linenumber"])
    return li.select("l_orderkey", "l_linenumber", "label", "l_linenumber_str", F.round(log1p("l_quantity"), R).alias("log_quantity"))


@register("ingest_times", "F13 S6", """
SELECT event_type, count(*) AS events, count(*) AS with_ingest_time FROM events GROUP BY event_type
""")
def q_ingest_times(spark, sf_dir):
    raw = _t(spark, sf_dir, "events").select("event_type", F.col("props").alias("value"))
    decoded = running.decode_events(raw, PROPS_SCHEMA, keep=["event_type"])
    return decoded.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count("ingestTime").alias("with_ingest_time"))


# ------------------------------------------------------------------- readers
PART_CSV = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                         T.StructField("p_brand", T.StringType()), T.StructField("p_retailprice", T.DoubleType())])
TEXT_CSV = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])


def _csv_copy(spark, df, schema, multiline):
    """Written as quoted CSV to the shared folder, and read by the record reader."""
    path = new_scratch_path(spark, "csv")
    df.select(*schema.names).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return records.read_records(spark, path, schema=schema, multiline=multiline).drop(records.CORRUPT_COLUMN)


@register("csv_round_trip", "S1 S2", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def q_csv_round_trip(spark, sf_dir):
    return _csv_copy(spark, _t(spark, sf_dir, "part"), PART_CSV, False)


@register("csv_texts", "S1 S2", "SELECT doc_id, lang, sha256(text) AS text_sha256 FROM documents")
def q_csv_texts(spark, sf_dir):
    """Texts with line breaks, quotes and commas survive the CSV reader."""
    got = _csv_copy(spark, _t(spark, sf_dir, "documents"), TEXT_CSV, True)
    return got.select("doc_id", "lang", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@register("csv_trailing_delimiter", "S1 S2", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def q_csv_trailing_delimiter(spark, sf_dir):
    """Every line ends in a delimiter: the empty column it makes is dropped, and no record is malformed."""
    path = new_scratch_path(spark, "csv")
    _t(spark, sf_dir, "part").select(*PART_CSV.names, F.lit("").alias("_c15")).write.option("header", True).option("emptyValue", "").csv(path)
    got = records.read_records(spark, path, schema=PART_CSV)
    return got.cache().where(F.col(records.CORRUPT_COLUMN).isNull()).drop(records.CORRUPT_COLUMN)


@register("landed_rejects", "S1 P2", """
WITH p AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'malformed' WHEN p_partkey % 11 = 0 THEN 'no p_name' END AS reason FROM part)
SELECT reason, count(*) AS observed, count(*) AS landed FROM (SELECT coalesce(reason, 'accepted') AS reason FROM p) GROUP BY reason
""")
def q_landed_rejects(spark, sf_dir):
    """Prices that aren't numbers and records without a name, counted on the way to their own folders."""
    path, out = new_scratch_path(spark, "csv"), new_scratch_path(spark, "landed")
    k = F.col("p_partkey")
    broken = _t(spark, sf_dir, "part").select("p_partkey", F.when(k % 11 != 0, F.col("p_name")).alias("p_name"), "p_brand",
                                              F.when(k % 7 == 0, F.lit("a lot")).otherwise(F.col("p_retailprice").cast("string")).alias("p_retailprice"))
    broken.write.option("header", True).csv(path)
    seen = records.land_with_rejects(records.read_records(spark, path, schema=PART_CSV), out, ["p_partkey", "p_name"])
    observed = F.create_map(*[x for name, n in seen.items() for x in (F.lit(name), F.lit(n))])
    landed = records.accepted(spark, out).select(F.lit("accepted").alias("reason")).unionByName(
        records.rejected(spark, out).select(F.col("reject_reason").alias("reason"))).groupBy("reason").agg(F.count(F.lit(1)).alias("landed"))
    return landed.select("reason", F.element_at(observed, F.col("reason")).cast("long").alias("observed"), "landed")


@register("region_landed_again", "S12", """
SELECT r_name AS region, count(*) AS rows, round(sum(CASE WHEN r_name = 'ASIA' THEN 2 ELSE 1 END * c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'ASIA' OR c_custkey % 2 = 0 GROUP BY r_name
""")
def q_region_landed_again(spark, sf_dir):
    """All regions landed, then one of them again with other rows: the others stay."""
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    c = _t(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        "c_custkey", "c_acctbal", F.col("r_name").alias("region"))
    path = new_scratch_path(spark, "regions")
    records.land_records(c, path)
    records.land_again(c.where("region = 'ASIA' and c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2), path)
    return spark.read.parquet(path).groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def _category_files(spark, sf_dir):
    """One nested JSON object for each region: path by region name.  Even keys are assignable."""
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    snippet = F.struct(F.col("n_name").alias("title"), (F.col("n_nationkey") % 2 == 0).alias("assignable"))
    item = F.struct(F.col("n_nationkey").alias("k"), F.struct(F.col("n_nationkey").cast("string").alias("id"), snippet.alias("snippet")).alias("v"))
    files = (n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name")
             .agg(F.sort_array(F.collect_list(item))["v"].alias("items")))
    root = new_scratch_path(spark, "categories")
    files.select("r_name", F.to_json(F.struct("items")).alias("value")).write.partitionBy("r_name").text(root)
    return {x.r_name: f"{root}/r_name={x.r_name}" for x in r.select("r_name").collect()}


@register("category_items", "S3 G2", """
SELECT n_nationkey AS "categoryId", n_name AS "categoryTitle", r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def q_category_items(spark, sf_dir):
    return reduce(DataFrame.unionByName, [categories.read_categories(spark, p, region=r)
                                          for r, p in sorted(_category_files(spark, sf_dir).items())])


@register("assignable_categories", "S4", """
SELECT n_name AS "categoryTitle", n_nationkey AS "categoryId", r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0
""")
def q_assignable_categories(spark, sf_dir):
    return reduce(DataFrame.unionByName, [categories.assignable_categories(spark, p, region=r)
                                          for r, p in sorted(_category_files(spark, sf_dir).items())])


# ------------------------------------------------------------------ sampling
KEY_FRACTION_SQL = ("CAST(('0x' || substr(md5('{seed}:' || COALESCE(CAST({key} AS VARCHAR), '')), 1, 8)) "
                    "AS BIGINT) / 4294967296.0")


@register("sample_by_key", "X2", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE {KEY_FRACTION_SQL.format(seed=42, key='o_orderkey')} < 0.1
""")
def q_sample_by_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return sampling.sample_by_key(o, "o_orderkey", 0.10, seed=42).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@register("split_by_key", "X4", f"""
SELECT o_orderkey, CASE WHEN {KEY_FRACTION_SQL.format(seed=101, key='o_orderkey')} < 0.7
                        THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def q_split_by_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.split_label(o, "o_orderkey", 0.7, seed=101)


@register("sample_fraction", "X1")
def q_sample_fraction(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_fraction(o, 0.10, seed=42)


@register("random_split", "X3")
def q_random_split(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    train, test = sampling.random_split(o, (0.7, 0.3), seed=101)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")))


@register("sample_properties", "X1", """
SELECT true AS inside, true AS once, true AS share_ok FROM (SELECT 1)
""")
def q_sample_properties(spark, sf_dir):
    """A 10 % sample holds input rows only, each once, and 10 % of them within six deviations."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    n = o.agg(F.count(F.lit(1))).scalar()
    got = sampling.sample_fraction(o, 0.10, seed=42).groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).alias("c"))
    seen = got.join(o.withColumn("there", F.lit(1)), ["o_orderkey", "o_totalprice"], "left")
    return seen.agg((F.count_if(F.col("there").isNull()) == 0).alias("inside"), (F.max("c") == 1).alias("once"),
                    (F.abs(F.sum("c") - 0.1 * n) <= 6 * F.sqrt(0.09 * n)).alias("share_ok"))


@register("random_split_properties", "X3", """
SELECT count(*) AS rows, true AS disjoint, true AS complete, true AS share_ok FROM orders
""")
def q_random_split_properties(spark, sf_dir):
    """Two halves that share no row, miss none, and are 70 % and 30 % within six deviations."""
    both = q_random_split(spark, sf_dir)
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    n = o.agg(F.count(F.lit(1))).scalar()
    per = both.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("split") == "train").alias("train"))
    joined = o.join(per, "o_orderkey", "left")
    return joined.agg(F.count(F.lit(1)).alias("rows"), (F.max("c") == 1).alias("disjoint"), (F.count_if(F.col("c").isNull()) == 0).alias("complete"),
                      (F.abs(F.sum("train") - 0.7 * n) <= 6 * F.sqrt(0.21 * n)).alias("share_ok"))
