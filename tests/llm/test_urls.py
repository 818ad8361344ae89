import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from trendlens.llm import urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def rule(host, path):
    fits = [r for r in urls.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=len, default=None)


class Markov:
    """The model written out: Witten-Bell over shorter and shorter contexts."""

    def __init__(self, texts):
        self.next = defaultdict(Counter)
        for t in texts:
            p = "\x02" * urls.ORDER + t + "\x03"
            for i in range(urls.ORDER, len(p)):
                for k in range(urls.ORDER + 1):
                    self.next[k, p[i - k:i]][p[i]] += 1

    def p(self, context, c):
        lower = 1 / urls.SYMBOLS if not context else self.p(context[1:], c)
        seen = self.next.get((len(context), context))
        return (seen[c] + len(seen) * lower) / (sum(seen.values()) + len(seen)) if seen else lower


HARD = [None, "", "no scheme", "HTTP://A.COM", "x://B.example.com:80/en/?q", "http://www.Example.com/en/x#y", "http://a.net/es/x#y", "a://b://c/d",
        "http://É.net/fr/", "http://netx/es/", "http://x.net/esx", "://?a", "http://h?x/y", "http://example.com/en/" + "long/" * 2000]


def rows_of(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    hard = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(HARD + HARD[2:6])], "page_id long, url string")
    return pages.union(hard).withColumn("host", F.lit("clash")).withColumn("n", F.lit(1))


def test_rules_and_scores_equal_brute_force(spark):
    pages = rows_of(spark)
    given = pages.collect()
    got = urls.judge(pages).collect()
    assert len(got) == len(given)
    url = {r.page_id: r.url for r in given}
    distinct = {"".join(split(u)): split(u) for u in url.values()}
    held = {r.u for r in spark.createDataFrame([(u,) for u in distinct], "u string").filter(
        F.pmod(F.xxhash64("u", F.lit("held")), F.lit(5)) == 0).collect()}
    models = {}
    for verdict in ("allow", "block"):
        models[verdict] = Markov([u for u, hp in distinct.items() if (r := rule(*hp)) and urls.RULES[r] == verdict and u not in held])
    cuts = {"allow": [], "block": []}
    for r in got:
        host, path = split(url[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        if r.rule:
            assert r.verdict == urls.RULES[r.rule] and r.score is None
            continue
        p = "\x02" * urls.ORDER + host + path + "\x03"
        score = sum(math.log(models["allow"].p(p[i - 3:i], p[i])) - math.log(models["block"].p(p[i - 3:i], p[i])) for i in range(3, len(p))) / (len(p) - 3)
        assert abs(score - r.score) < 1e-4
        cuts[r.verdict].append(r.score)
    assert min(cuts["allow"]) >= max(cuts["block"])  # one threshold


def test_threshold_is_the_best(spark):
    held = spark.createDataFrame([("allow", 2_000_000), ("allow", 1_000_000), ("block", -500_000), ("block", 900_000), ("block", 1_200_000)], "label string, mean long")
    cut = urls.threshold(held).first().cut
    good = lambda c: sum(m >= c for lab, m in held.collect() if lab == "allow") / 2 + sum(m < c for lab, m in held.collect() if lab == "block") / 3
    assert good(cut) == max(good(c) for c in range(-2_000_000, 3_000_000, 10_000))


def test_empty_and_unruled(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in urls.judge(pages).collect()] == ["allow"] * 3
    assert urls.judge(pages.limit(0)).count() == 0
