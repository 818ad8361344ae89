import hashlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from trendlens.llm import spotsigs


def check(docs, **parameters):
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.doc_id) for r in docs.select("doc_id", "text").collect())
    expected = Counter()
    for i, (_, _, text, doc) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][2]
        new = text[:len(text) - len(text) // 4] + following[:len(text) // 4]
        a, b, c = map(spotsigs.signatures, (text, new, following))
        expected[doc, len(text), hashlib.sha256(new.encode()).hexdigest(), spotsigs.fingerprint(a), spotsigs.fingerprint(b),
                 spotsigs.jaccard(a, b), spotsigs.jaccard(a, c)] += 1
    assert Counter(tuple(r)[:7] for r in spotsigs.fingerprints(docs, **parameters).collect()) == expected


@pytest.mark.parametrize("target", [1 << 23, 5000, 50])
def test_equal_brute_force(documents, odd, target):
    check(documents.select("doc_id", "text").union(odd.select("doc_id", "text")), target_chars=target)


def test_few_rows(odd):
    assert spotsigs.fingerprints(odd.limit(0)).count() == 0
    check(odd.limit(1))
    check(odd.filter("doc_id is null"))


def test_chains():
    found = spotsigs.signatures("The cat is in the big house")
    import zlib
    assert found == {zlib.crc32(x.encode()) for x in ("the cat big", "is big house", "in big house", "the big house")}
    assert spotsigs.signatures("") == frozenset() and len(spotsigs.signatures("word")) == 1
    assert spotsigs.jaccard(frozenset(), frozenset()) == 1.0 and spotsigs.jaccard(frozenset(), found) == 0.0


@given(st.frozensets(st.integers(0, 30)), st.frozensets(st.integers(0, 30)), st.sampled_from([0.3, 0.5, 0.8, 0.9]))
def test_pruning_loses_nothing(a, b, tau):
    exact = spotsigs.jaccard(a, b)
    assert spotsigs.jaccard(a, b, tau) == (exact if exact >= tau else spotsigs.jaccard(a, b, tau))
    assert exact >= tau or spotsigs.jaccard(a, b, tau) < tau


def test_copies_and_edits(documents):
    rows = spotsigs.fingerprints(documents).collect()
    by = {}
    for r in documents.collect():
        by.setdefault(r.text, set()).add(next(x.fingerprint for x in rows if x.doc_id == r.doc_id))
    assert all(len(v) == 1 for v in by.values())
    assert sum(r.near_edited for r in rows) / len(rows) > 0.45
    assert sum(r.near_next for r in rows) / len(rows) < 0.1
