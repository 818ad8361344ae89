import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from trendlens.llm import common, suffixes


def brute(docs, length=200):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    times = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = Counter()
    for doc, t in rows:
        spans = suffixes._merged([(i, i + length) for i in range(len(t) - length + 1) if times[t[i:i + length]] > 1])
        kept = b"".join(t[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(t)]))
        out[doc, len(t), tuple(spans), hashlib.sha256(kept).hexdigest()] += 1
    return out


def check(docs, **parameters):
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), r.kept_sha256)
                  for r in suffixes.remove_repeats(docs, **parameters).collect())
    assert got == brute(docs)


def test_documents_equal_brute_force(documents):
    check(documents)


def planted(spark):
    rng = random.Random(3)
    own = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    p, base = own(400), "The quick brown fox jumps over the lazy dog and runs away from it. " * 9
    rows = [(1, None), (1, ""), (2, base), (2, base), (None, base), (3, own(300) + p[:210] + own(100)), (4, p + own(150)), (5, own(50) + p[100:330]),
            (6, "a" * 2000), (7, own(500)), (8, "中" * 300), (9, p[:199] + "!"), (None, own(300)), (10, "xy" * 400), (11, own(900))]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as spans")


def test_planted(spark, odd):
    docs = planted(spark)
    check(docs)
    check(docs, shard_bytes=500)
    check(docs, most=1)  # every key goes by its windows' digests
    check(odd)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_segments_across_chunks(monkeypatch):
    rng = random.Random(9)
    text = bytes(rng.randrange(256) for _ in range(5000))
    h, seg, a, b = suffixes.segments(text)
    assert a[0] == 0 and (a[1:] == b[:-1] - 199).all() and b[-1] == len(text)
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    h2, _, a2, _ = suffixes.segments(text)
    windows = lambda h, a: np.repeat(h, np.diff([*a, len(text) - 199]))
    assert (windows(h, a) == windows(h2, a2)).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=14).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=5))
def test_matching_statistics_equal_brute_force(parts):
    expected = []
    for a, p in enumerate(parts):
        own = []
        for i in range(len(p)):
            best = 0
            for b, q in enumerate(parts):
                for j in range(len(q)):
                    n = 0
                    while (a, i) != (b, j) and i + n < len(p) and j + n < len(q) and p[i + n] == q[j + n]:
                        n += 1
                    best = max(best, n)
            own.append(best)
        expected.append(own)
    assert [x.tolist() for x in suffixes.matching_statistics(parts)] == expected


def test_suffixes_sorted_in_few_rounds_and_short_matches_left_out(monkeypatch):
    rng = random.Random(5)
    base = bytes(rng.choice(b"abcdefgh ") for _ in range(300))
    parts = [base, b"x" + base[:250], base[40:] + b"y", bytes(rng.choice(b"abcdefgh ") for _ in range(260))]
    exact, sorts = suffixes.matching_statistics(parts), []
    sort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda x: sorts.append(len(x)) or sort(x))
    for length in (0, 60, 200, 290):
        got = suffixes.matching_statistics(parts, length)
        assert all((np.where(a >= length, a, 0) == np.where(b >= length, b, 0)).all() and (b <= a).all() for a, b in zip(exact, got))
    assert exact[0][0] == 250 and exact[0][40] == 260
    assert len(sorts) <= 4 * 4  # prefixes of 17, 51, 153 and 459 symbols; by twice of 7 it took 7 rounds


def test_python_gets_bounded_batches(spark, documents):
    """Rows of 20 kB: Spark's own batches would be of 40 MB."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    spark.conf.unset(common.BATCH_KEY)
    suffixes.remove_repeats(documents.limit(2))
    wide = spark.range(2000, numPartitions=1).selectExpr("repeat('text ', 4000) AS text")
    assert 1 << 20 < wide.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] < 1.1 * common.BATCH_BYTES
    spark.conf.set(common.BATCH_KEY, 1 << 16)
    common.small_batches(spark)
    assert int(spark.conf.get(common.BATCH_KEY)) == 1 << 16  # a bound of the session's own stays
    spark.conf.unset(common.BATCH_KEY)
