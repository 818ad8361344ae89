"""URL filter: host and path rules first, then a character language-model ratio.

URLs that a rule allows or blocks train two variable-order Markov models over the characters of
host and path (order 3 down to 0, Witten-Bell smoothing: an order gives its unseen characters the
mass of its distinct continuations and hands it to the next shorter context).  A URL without a rule
gets the difference of the two log likelihoods, divided by its length, and is allowed at or above
a threshold.  The threshold is the best balanced accuracy on a fifth of the ruled URLs, by hash,
which the models haven't seen.  DataFrame functions only.

Models are tables of grams: each distinct gram is scored once, from its suffix upward, and the
scores are joined to the URLs' positions (frequent grams by a bounded broadcast).  Distinct URLs
are scored, with their row counts, so a URL that holds many rows is one row.  Scores are summed as
whole numbers of millionths, so no order of rows changes a verdict.

Defined results: null URLs and those without ``://`` have empty host and path, no rule, and are
judged like any other; without ruled URLs of both kinds every URL without a rule is allowed;
repeated rows each get a row; other columns are dropped, so names can't clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_hot, table, written

# Host and path prefix of each rule, and its verdict (fixed values of the contract).
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
ORDER = 3
SYMBOLS = 256  # the lowest order spreads over so many characters
UNIT = 1_000_000


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the ``ORDER + 1``-gram that ends at each character and at the end."""
    padded = F.concat(F.lit("\x02" * ORDER), F.col("url"), F.lit("\x03"))
    return urls.select(*keep, padded.alias("_p"), F.explode(F.sequence(F.lit(1), F.length("url") + 1)).alias("_i")) \
        .select(*keep, F.expr(f"substring(_p, _i, {ORDER + 1})").alias("gram"))


def gram_scores(train: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, score): log ratio of a gram's last character under the two models, in millionths.

    ``train(gram, a, r)`` counts grams of accepted and rejected URLs; ``wanted(gram)`` is distinct."""
    below = None
    for k in range(ORDER + 1):
        cut = F.expr(f"right(gram, {k + 1})")
        asked = wanted.select(cut.alias("gram")).distinct()
        counts = train.groupBy(cut.alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = counts.groupBy(F.expr(f"left(gram, {k})").alias("context")).agg(
            *(F.sum(c).alias(f"n{c}") for c in "ar"),
            *(F.sum((F.col(c) > 0).cast("long")).alias(f"t{c}") for c in "ar"))
        step = asked.join(counts, "gram", "left").withColumn("context", F.expr(f"left(gram, {k})")) \
            .join(context, "context", "left")
        if below is None:
            step = step.withColumns({f"p{c}": F.lit(1.0 / SYMBOLS) for c in "ar"})
        else:
            step = step.withColumn("suffix", F.expr(f"right(gram, {k})")).join(below, "suffix")
        p = [((F.coalesce(c, F.lit(0)) + F.coalesce(t, F.lit(0)) * q) / (F.coalesce(n, F.lit(0)) + F.coalesce(t, F.lit(0))))
             for c, t, n, q in ((F.col(c), F.col(f"t{c}"), F.col(f"n{c}"), F.col(f"p{c}")) for c in "ar")]
        p = [F.when(F.coalesce(F.col(f"n{c}"), F.lit(0)) > 0, x).otherwise(F.col(f"p{c}")) for c, x in zip("ar", p)]
        below = step.select(F.col("gram").alias("suffix"), p[0].alias("pa"), p[1].alias("pr"))
    return below.select(F.col("suffix").alias("gram"),
                        F.round((F.log("pa") - F.log("pr")) * UNIT).cast("long").alias("score"))


def threshold(held_out: DataFrame) -> DataFrame:
    """One row, ``cut``: the least mean score to allow, best by balanced accuracy.

    ``held_out(label, mean)``; means are binned to hundredths of a nat (within ten nats)."""
    bins = held_out.select("label", F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.col("mean") / (UNIT // 100)))).alias("bin")) \
        .groupBy("bin").agg(*(F.sum((F.col("label") == v).cast("long")).alias(c) for v, c in (("allow", "a"), ("block", "r"))))
    # At most 2,001 bins meet in this window.
    up, every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)) / F.greatest(F.sum(c).over(every), F.lit(1))
    best = bins.withColumn("good", (1 - share("a", up)) + share("r", up))
    return best.agg(F.coalesce(F.max_by(F.col("bin") * (UNIT // 100), F.struct("good", -F.abs("bin"))), F.lit(0)).alias("cut"))


def judge(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is null under a rule."""
    host, path = host_path(F.col("_u"))
    rows = pages.select("page_id", F.col(f"`{url}`").alias("_u")).select("page_id", host.alias("host"), path.alias("path")) \
        .withColumn("url", F.concat("host", "path"))
    verdicts = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair))
    urls = written(rows.groupBy("url", "host", "path").agg(F.count("*").alias("n"))
                   .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
                   .withColumn("label", F.try_element_at(verdicts, F.col("rule")))
                   .withColumn("held", F.pmod(F.xxhash64("url", F.lit("held")), F.lit(5)) == 0), "urls")
    total, allowed, blocked = urls.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("label") == "allow"),
                                       F.count_if(F.col("label") == "block")).first()
    ruled, other = urls.filter("label is not null"), urls.filter("label is null")
    if allowed and blocked:
        train = written(_grams(ruled.filter("not held"), "label").groupBy("gram").agg(
            *(F.sum((F.col("label") == v).cast("long")).alias(c) for v, c in (("allow", "a"), ("block", "r")))), "url-grams")
        spots = written(_grams(urls.filter("label is null or held"), "url", "label"), "url-spots")
        wanted = spots.groupBy("gram").agg(F.count("*").alias("n"))
        scores = written(gram_scores(train, wanted).join(wanted, "gram"), "url-scores")
        scored = join_hot(spots, scores, "gram", "n", spots.count()).groupBy("url", "label").agg(
            F.floor(F.sum("score") / F.count("*")).alias("mean"))
        scored = written(scored, "url-means")
        cut = threshold(scored.filter("label is not null"))
        other = other.join(scored.filter("label is null").select("url", "mean"), "url")
        verdict = F.when(F.col("mean") >= cut.scalar(), "allow").otherwise("block")
    else:
        other, verdict = other.withColumn("mean", F.lit(0).cast("long")), F.lit("allow")
    cols = ["url", "n", "rule"]
    judged = ruled.select(*cols, F.col("label").alias("verdict"), F.lit(None).cast("long").alias("mean")) \
        .unionByName(other.select(*cols, verdict.alias("verdict"), "mean"))
    return join_hot(rows, written(judged, "url-verdicts"), "url", "n", total).select(
        "page_id", "host", "path", "rule", "verdict", (F.col("mean") / UNIT).alias("score"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return judge(table(spark, sf_dir, "pages"))
