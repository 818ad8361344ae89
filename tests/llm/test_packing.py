import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trendlens.llm import packing


def verify(rows, docs):
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r[5]].append(r)
        pieces[r[0]].append(r)
    for own in windows.values():
        own.sort(key=lambda r: r[6])
        at = 0
        for r in own:
            assert r[6] == at and r[2] > 0
            at += r[2]
        assert at == 1024 or at < 1024 and at & (at - 1) == 0
    for doc, ids in docs.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r[1]):
            assert r[1] == at and r[4] == len(ids)
            assert r[3] == zlib.crc32(np.array(ids[at:at + r[2]], "<u4").tobytes())
            at += r[2]
        assert at == len(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3000), max_size=60), st.integers(1, 30))
def test_every_id_once_and_no_padding(lengths, max_open):
    packer = packing.Packer(0, max_open=max_open)
    docs = {i: list(range(i, i + n)) for i, n in enumerate(lengths)}
    for i, ids in docs.items():
        packer.add(i, np.array(ids, np.uint32))
    packer.end()
    verify(packer.rows, docs)


def test_placement_takes_the_least_sum_of_squares():
    packer = packing.Packer(0, window=16)
    rng = np.random.default_rng(1)
    for i in range(200):
        before, s = packer.count.copy(), int(rng.integers(1, 16))
        best = None
        for h in range(0, 16 - s + 1):
            if h == 0 or before[h]:
                c = before.copy()
                c[h] -= h > 0
                c[h + s] += h + s < 16
                total = int((c[1:16] ** 2).sum())
                best = total if best is None else min(best, total)
        packer.add(i, np.zeros(s, np.uint32))
        assert int((packer.count[1:16] ** 2).sum()) == best


def test_only_the_emptiest_windows_are_cut_up():
    """What stands in a window at the end stays together, but for windows emptied into the gaps."""
    packer = packing.Packer(0)
    rng = np.random.default_rng(2)
    for i in range(3000):
        packer.add(i, np.zeros(int(rng.integers(1, 1024)), np.uint32))
    before = sorted((sorted((p[0], p[1]) for p in pieces) for level in reversed(packer.open) for pieces in level), key=str)
    fills = sorted(h for h, level in enumerate(packer.open) for _ in level)
    gaps, torn, k = sum(1024 - h for h in fills), 0, 0
    while k < len(fills) and torn < gaps - 1024:
        torn, gaps, k = torn + fills[k], gaps - (1024 - fills[k]), k + 1
    packer.end()
    where = defaultdict(set)
    for r in packer.rows:
        where[r[0], r[1]].add(r[5])
    apart = [w for w in before if not set.intersection(*(where[p] for p in w))]
    assert len(apart) <= k + 1 and packer.moved <= torn + 2 * 1024


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(1, 12))
def test_open_windows_stay_bounded(lengths, max_open):
    packer = packing.Packer(0, window=32, max_open=max_open)
    for i, n in enumerate(lengths):
        packer.add(i, np.zeros(n, np.uint32))
        levels = [sum(len(p[2]) for p in pieces) for level in packer.open for pieces in level]
        assert packer.n_open == len(levels) <= max_open
        assert levels == [h for h, c in enumerate(packer.count) for _ in range(c)]


def test_ids_are_those_of_the_tokenizer_file(documents):
    tokens = packing.tokens_of(packing.default_tokenizer())
    for x in [r.text for r in documents.collect()] + ["", "a <|endoftext|> b", "<|endoftext|>", "  \n\t x’é中 \u0000"]:
        assert tokens.ids(x).tolist() == tokens.full.encode(x, add_special_tokens=False).ids


def test_query_rows(spark, odd, documents):
    tokens = packing.tokens_of(packing.default_tokenizer())
    docs = {r.doc_id: [*tokens.ids(r.text).tolist(), 0] for r in documents.collect()}
    verify([tuple(r) for r in packing.pack(documents).collect()], docs)
    rows = packing.pack(odd).collect()
    assert sum(r.length for r in rows) == sum(len(tokens.ids(r.text or "")) + 1 for r in odd.collect())
    assert packing.pack(odd.limit(0)).count() == 0
