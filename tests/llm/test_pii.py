import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from trendlens.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


HARD = ["a@b.c_d@e.f g", "é x.y@z.w.v!!1.2.3.4.5.6.7.8 999.1.1.1 00255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111", "9" * 9000,
        "a" * 9000 + "@b.co", "+1 (234) 567-8901 20 +", "++1234567890", "1.2.3.4" * 500, "x@y.z " * 500, "\u0001\n a@@b.c",
        "中+33 1 23 45 67 89中 4111111111111111中", "a%b@c.d-e.f-.g", "0.0.0.0000", "+1234567", "5500 0000 0000 0004 0"]


def test_base_spans_equal_brute_force(spark, documents, odd):
    docs = documents.select("text").union(odd.select("text")).union(spark.createDataFrame([(t,) for t in HARD], "text string"))
    rows = pii.with_spans(docs, keep=["text"]).select("text", pii._joined(F.col("_s_base")).alias("b"), pii._joined(F.col("_s_all")).alias("a")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert [x for x in r.b.split(",") if x] == base(r.text)
        assert set(base(r.text)) <= set(r.a.split(","))


def test_model_adds_spans_that_look_like_the_others(spark):
    texts = [f"call +1 (3{i:02d}) 555-50{i:02d} now" for i in range(60)] + ["phone (389) 555-5010 now", "version 1234567.89"]
    rows = pii.with_spans(spark.createDataFrame([(t,) for t in texts], "text string"), keep=["text"]).select("text", "_s_all", pii.redacted().alias("r")).collect()
    by = {r.text: r for r in rows}
    assert by["phone (389) 555-5010 now"].r == "phone <PHONE> now"
    assert by["version 1234567.89"]._s_all == []


def test_redaction_and_extra_columns(odd, spark):
    got = pii.with_spans(odd, keep=odd.columns)
    assert got.columns[:len(odd.columns)] == odd.columns
    r = got.select(pii.redacted().alias("r")).filter("r like 'mail %'").collect()
    assert [x.r for x in r] == ["mail <EMAIL> or <PHONE> from <IP> card <CARD>"]
    assert got.filter("text is null").select(pii.redacted().alias("r"), "_s_all").first() == (None, [])
    assert pii.with_spans(odd.limit(0)).count() == 0


def test_long_text_and_overlaps(spark):
    text = "word " * 100_000 + "1.2.3.4@example.com"
    row = pii.with_spans(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep=["text"]).select(
        pii._joined(F.col("_s_base")).alias("b"), pii.redacted().alias("r")).first()
    assert row.b.split(",") == base(text)
    assert row.r.endswith("word <EMAIL>")
    assert Counter(x.split(":")[0] for x in row.b.split(",")) == {"email": 1, "ip": 1}


def brute_em(rows, rounds):
    """The tied weights by plain loops: rows are (kind, votes, n)."""
    weights = pii.tied([[[0.0]] + [[-1.0, 0.0, 1.0] for _ in pii.LABELERS] for _ in pii.KINDS])
    for _ in range(rounds):
        new = [[[0.0]] + [[0.0] * 3 for _ in pii.LABELERS] for _ in pii.KINDS]
        for kind in range(len(pii.KINDS)):
            own = [(v, n, 1 / (1 + math.exp(-weights[kind][0][0] - sum(w[x] for w, x in zip(weights[kind][1:], v))))) for k, v, n in rows if k == kind]
            if not own:
                continue
            one, zero = sum(n * p for _, n, p in own), sum(n * (1 - p) for _, n, p in own)
            new[kind] = [[math.log((one + 1) / (zero + 1))]] + [
                [math.log((sum(n * p for v, n, p in own if v[j] == x) + 1) / (one + 3)) - math.log((sum(n * (1 - p) for v, n, p in own if v[j] == x) + 1) / (zero + 3))
                 for x in range(3)] for j in range(len(pii.LABELERS))]
        weights = pii.tied(new)
    return weights


def test_em_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([0, 2, 3]), tuple(rnd.choice([0, 1, 2, 2]) for _ in pii.LABELERS), rnd.randint(1, 50)) for _ in range(40)]
    pattern = spark.createDataFrame([(k, *v, n) for k, v, n in rows], ["kind", *pii.LABELERS, "n"])
    got, want = pii.estimate(pattern, 4), brute_em(rows, 4)
    assert all(abs(a - b) < 1e-9 for x, y in zip(got, want) for r, s in zip(x, y) for a, b in zip(r, s))
    # Votes keep their direction, and a failed checksum outweighs a vote or two.
    assert all(r[0] < 0 < r[2] for x in got for r in x[1:]) and all(x[1 + pii.LABELERS.index("checksum")][0] < -6 for x in got)


def test_planted_spans_and_decoys(spark):
    rnd = random.Random(7)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) between 300 and 3000").limit(200).collect()]
    d = lambda n, of="0123456789": "".join(rnd.choice(of) for _ in range(n))

    def failing():
        while luhn(x := "4" + d(15)):
            pass
        return x

    makes = {"spelt": lambda: f"joe{d(2)} at mail{d(1)} dot com", "paren": lambda: f"call ({d(3, '23456789')}) {d(3, '23456789')}-{d(4)}",
             "dash": lambda: f"{d(3, '23456789')}-{d(3, '23456789')}-{d(4)}", "failing": failing, "version": lambda: f"version 1{d(3)}.{d(3)}",
             "pages": lambda: f"page {d(4)} {d(4)}", "order": lambda: f"order {d(9)}", "date": lambda: f"2024-0{d(1, '123456789')}-1{d(1)}"}
    rows = []
    for name, make in makes.items():
        for _ in range(60):
            words, what = rnd.choice(texts).split(" "), make()
            at = rnd.randint(1, len(words) - 1)
            start = len(" ".join(words[:at])) + 1
            rows.append((len(rows), name, start, start + len(what), " ".join([*words[:at], what, *words[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, name string, a int, b int, text string")
    found = pii.with_spans(docs, keep=["name", "a", "b"])
    hit = found.withColumn("hit", F.exists(F.array_except("_s_all", "_s_base"), lambda s: (s["start"] < F.col("b")) & (s["end"] > F.col("a"))))
    share = {r.name: r.share for r in hit.groupBy("name").agg(F.avg(F.col("hit").cast("int")).alias("share")).collect()}
    assert min(share[x] for x in ("spelt", "paren", "dash")) >= 0.95
    assert max(share[x] for x in ("failing", "version", "pages", "order", "date")) <= 0.05


def test_cards_are_held_true_and_failing_numbers_false(documents, spark):
    docs = documents.select("text").union(spark.createDataFrame([(f"number {4532015112830360 + i} here",) for i in range(60)], "text string"))
    found = pii.found_spans(docs, "text", ["text"])
    model = pii.train(found)
    odds = lambda c: [(r.k, r.lo) for r in found.select(F.explode(c).alias("s")).select(F.col("s.k").alias("k"), model.log_odds(F.col("s")).alias("lo")).collect()]
    base_cards, failing = [x for k, x in odds("_base") if k == 2], [x for k, x in odds("_more") if k == 2]
    assert base_cards and failing and min(base_cards) > 0 > max(failing)
