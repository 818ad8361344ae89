import numpy as np
import xxhash

from trendlens.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=3):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [low.get(find(i)) for i in range(len(rows))]


def check(docs, **parameters):
    got = sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs, **parameters).collect()), key=repr)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    assert got == sorted(((d, f, c) for (d, f), c in zip(rows, brute_components(rows))), key=repr)


def test_documents_equal_brute_force(documents):
    check(documents, leaf=4)


def test_odd_rows(odd):
    check(odd)
    check(odd, leaf=1, block=1)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_spark_hash_is_the_same(spark):
    h = spark.sql("select xxhash64('a bé c') h").first().h
    assert h & (1 << 64) - 1 == xxhash.xxh64_intdigest("a bé c".encode(), 42)


def test_search_is_exact_over_deep_trees_and_small_blocks(spark):
    rng = np.random.default_rng(5)
    fp = rng.integers(-1 << 63, 1 << 63, 300)
    near = [f ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for f in fp[:150].tolist()
            for a, b, c in [rng.choice(63, 3, replace=False)]]
    every = sorted({*fp.tolist(), *near, *(x ^ 1 for x in near)})
    nodes = spark.createDataFrame([(x,) for x in every], "fp long")
    rows = [(i, x & (1 << 64) - 1) for i, x in enumerate(every)]
    expected = brute_components(rows)
    for leaf, block in ((1024, 8192), (4, 8192), (16, 7)):
        links = simhash.links(nodes, len(every), leaf=leaf, block=block).collect()
        at = {x: i for i, x in enumerate(every)}
        low = list(range(len(every)))
        for _ in range(20):
            for u, v in links:
                low[at[u]] = low[at[v]] = min(low[at[u]], low[at[v]])
        assert low == expected


def test_large_group_gives_a_star(spark):
    base = 0x0123456789ABCDEF
    group = [base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(a)]
    u, v = simhash._forest(np.array(group), np.array(group), 3)
    assert len(u) == len(group) - 1 and set(v) == {min(group)}
