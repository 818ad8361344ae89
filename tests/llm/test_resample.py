import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from trendlens.llm import resample

from .conftest import SMALL


def brute(docs, target, grams=1, buckets=10000, percent=10, least=20):
    """[(id, n_features, weight, score, rank)] by plain loops; equal ids rank in any order."""
    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]

    own = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, words, f in own:
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(able[:percent * len(able) // 100], 1)}
    return Counter((i, n, w, sc, rank.get(id(r))) for r in rows for i, _, n, w, sc in [r])


def got(docs, target, **parameters):
    return Counter(tuple(r) for r in resample.resample(docs, target, **parameters).select("id", "n_features", "weight", "score", "rank").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("parameters", [{}, {"grams": 2, "buckets": 997, "percent": 50}, {"percent": 100, "segments": 7}, {"percent": 0}])
def test_equal_brute_force(spark, documents, parameters):
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute(pairs(documents), [r.text for r in target.collect()], **{k: v for k, v in parameters.items() if k != "segments"})
    assert got(documents.repartition(5), target, **parameters) == want


def test_odd_rows(spark, odd, documents):
    target = spark.createDataFrame([(None,), ("",), ("the cat sat on the mat É é",)], "text string")
    found = got(odd, target, percent=100)
    # Rows of one id and text differ in their ranks only.
    want = brute(pairs(odd), [r.text for r in target.collect()], percent=100)
    assert found == want
    assert got(odd.limit(0), target) == Counter()
    none = target.limit(0)
    assert got(documents, none) == brute(pairs(documents), [])


def test_ties_and_hot_scores(spark):
    # One text under few distinct ids: long ties in score that cross the segments' borders.
    docs = spark.createDataFrame([(i % 3, "a " * 25) for i in range(500)], "doc_id long, text string")
    rows = resample.resample(docs, docs, percent=90, segments=16).collect()
    ranks = sorted(r.rank for r in rows if r.rank)
    assert ranks == list(range(1, 451))
    order = sorted((r for r in rows if r.rank), key=lambda r: r.rank)
    assert [(-r.score, r.id) for r in order] == sorted((-r.score, r.id) for r in rows)[:450]


def test_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x y", 7, "r", "s")], "score long, text string, weight int, rank string, segment string")
    row = resample.resample(docs, docs, doc_id="score", keep=["score", "weight", "rank", "segment"], least_words=1, percent=100).collect()[0]
    assert row.kept.asDict() == {"score": 1, "weight": 7, "rank": "r", "segment": "s"} and row.rank == 1 and row.n_features == 2


def test_sql(spark):
    """The SQL's CRC-32 against zlib's."""
    import duckdb
    con = duckdb.connect()
    words = " ".join(["hello", "É", "中文", "a1"] * 6)
    con.execute("create table documents as select 5::bigint doc_id, ? as text union all select 6, null", [words])
    con.execute("create table benchmark as select 1::bigint item_id, 'a1 a1' as text")
    want = brute([(5, words), (6, None)], ["a1 a1"])
    assert Counter(con.execute(resample.OP12_SQL).fetchall()) == want
