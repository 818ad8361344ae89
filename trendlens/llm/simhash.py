"""SimHash near-duplicates through vantage-point trees.

Fingerprints are 64-bit SimHashes of word shingles; two link at ``max_bits`` or fewer differing
bits.  Search is exact.  Two fingerprints that differ in ``max_bits`` bits at most differ in
``radius = max_bits // 2`` bits at most in one of their 32-bit halves, so there is one
vantage-point tree for each half, a metric space of its own in which balls are small:

* a tree is fitted on a bounded sample (``sample`` fingerprints, a documented parameter; it only
  shapes the tree): each node holds a vantage point and the median Hamming distance to it;
* every fingerprint has one home shard (leaf), and is a query in each shard that the triangle
  inequality can't rule out: left if ``d - radius <= median``, right if ``d + radius > median``;
* in a shard, queries meet homes block by block under the exact 64-bit distance; a block has
  ``block`` homes and queries at most (larger shards become a grid of blocks), and gives
  stars that connect what its links connect, never all pairs of a group.

The depth follows the number of fingerprints up to ``sample / 16`` shards (16.8 million fingerprints
with the defaults); beyond that shards grow with the data, in blocks of bounded size, and the work in a
shard with its square, so ``sample`` has to be raised with them.  Equal texts fall together before the
search: nodes are distinct fingerprints with their row counts.

Defined results: null and empty texts have fingerprint zero, linked like any other; null doc_ids
are kept and never become a component's id unless a component has no other; repeated rows each
get a row; other columns are dropped, so names can't clash; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, join_hot, table, written

SAMPLE = 262_144
LEAF = 1024
BLOCK = 8192


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode().lower().split()  # ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(begins[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())),
                    np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] = ()) -> DataFrame:
    """(doc_id, fp) of every row, and its ``keep`` columns (whole numbers)."""
    ids = ["doc_id", *keep]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ids), pa.array((fingerprint(x.as_py(), shingle) for x in batch.column("_text")), pa.int64())],
                [*ids, "fp"])

    return docs.select(*[F.col(c).cast("long").alias(c) for c in ids], F.col(f"`{text}`").alias("_text")) \
        .mapInArrow(run, ", ".join(f"{c} long" for c in [*ids, "fp"]))


class VantageTree:
    """A vantage-point tree over 32-bit values, as arrays: node i has children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.point = np.zeros((1 << depth) - 1, np.uint32)
        self.median = np.full((1 << depth) - 1, 32, np.int16)
        groups = [np.sort(sample.astype(np.uint32))]
        for level in range(depth):
            below = []
            for i, values in enumerate(groups):
                node = (1 << level) - 1 + i
                if not len(values):
                    below += [values, values]
                    continue
                self.point[node] = p = values[len(values) // 2]
                d = np.bitwise_count(values ^ p).astype(np.int16)
                self.median[node] = mu = np.median(d)
                below += [values[d <= mu], values[d > mu]]
            groups = below

    def homes(self, values: np.ndarray) -> np.ndarray:
        """The shard of each value."""
        node = np.zeros(len(values), np.int64)
        for _ in range(self.depth):
            right = np.bitwise_count(values ^ self.point[node]) > self.median[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)

    def shards(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) for each shard that a ball of ``radius`` around a value may touch."""
        row, node = np.arange(len(values)), np.zeros(len(values), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(values[row] ^ self.point[node]).astype(np.int16)
            left, right = d - radius <= self.median[node], d + radius > self.median[node]
            row = np.concatenate((row[left], row[right]))
            node = np.concatenate((2 * node[left] + 1, 2 * node[right] + 2))
        return row, node - ((1 << self.depth) - 1)


def _halves(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [(u >> np.uint64(32)).astype(np.uint32), (u & np.uint64(0xFFFFFFFF)).astype(np.uint32)]


def _forest(homes: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect two sets of fingerprints as the links between them do: each node that
    is linked, and the least of its component."""
    both = np.unique(np.concatenate((homes, queries)))
    h, q = np.searchsorted(both, homes), np.searchsorted(both, queries)
    parent = list(range(len(both)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    label = np.arange(len(both))
    hu, qu = homes.view(np.uint64), queries.view(np.uint64)
    for at in range(0, len(qu), 256):
        i, j = np.nonzero(np.bitwise_count(qu[at:at + 256, None] ^ hu[None, :]) <= max_bits)
        a, b = label[q[at + i]], label[h[j]]
        differ = a != b
        if not differ.any():
            continue
        for x, y in np.unique(np.stack((a[differ], b[differ]), 1), axis=0).tolist():
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
        label = np.array([find(x) for x in range(len(both))])
    joined = np.nonzero(label != np.arange(len(both)))[0]
    return both[joined], both[label[joined]]


def links(nodes: DataFrame, n: int, max_bits: int = 3, leaf: int = LEAF, sample: int = SAMPLE,
          block: int = BLOCK) -> DataFrame:
    """(u, v): fingerprints that connect like all pairs at ``max_bits`` or fewer differing bits.

    ``nodes(fp)`` holds ``n`` distinct fingerprints."""
    radius = max_bits // 2
    share = min(1.0, sample / max(n, 1))
    picked = nodes.select("fp").filter(F.pmod(F.xxhash64("fp", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))) \
        .limit(2 * sample).toArrow().column("fp").to_numpy()
    depth = max(0, math.ceil(math.log2(max(1, min(n / leaf, len(picked) / 16)))))
    trees = [VantageTree(v, depth) for v in _halves(picked)]

    def routed(fp: np.ndarray):
        """(shard, fp, home) of both trees."""
        for t, (tree, values) in enumerate(zip(trees, _halves(fp))):
            base = t << depth
            yield base + tree.homes(values), fp, True
            row, shard = tree.shards(values, radius)
            yield base + shard, fp[row], False

    def sizes(batches):
        for batch in batches:
            for shard, _, home in routed(batch.column("fp").to_numpy()):
                s, c = np.unique(shard, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.full(len(s), home)), pa.array(c)], ["shard", "home", "c"])

    # A row for each shard and side: at most 4 << depth, and depth is bounded by the sample.
    grid = np.ones((2 << depth, 2), np.int64)
    for shard, home, c in nodes.select("fp").mapInArrow(sizes, "shard long, home boolean, c long") \
            .groupBy("shard", "home").agg(F.sum("c")).toLocalIterator():
        grid[shard, int(home)] = -(-c // block)

    def emit(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 4096):
                for shard, fp, home in routed(batch.column("fp").to_numpy()[part:part + 4096]):
                    own, other = grid[shard, int(home)], grid[shard, 1 - int(home)]
                    mine = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % own
                    times = np.repeat(np.arange(len(shard)), other)
                    theirs = np.arange(len(times)) - np.repeat(np.cumsum(other) - other, other)
                    hb, qb = (mine[times], theirs) if home else (theirs, mine[times])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[times]), pa.array(hb), pa.array(qb), pa.array(fp[times]), pa.array(np.full(len(times), home))],
                        ["shard", "hb", "qb", "fp", "home"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, home = pdf["fp"].to_numpy(), pdf["home"].to_numpy()
        u, v = _forest(fp[home], fp[~home], max_bits)
        return pd.DataFrame({"u": u, "v": v})

    return nodes.select("fp").mapInArrow(emit, "shard long, hb long, qb long, fp long, home boolean") \
        .groupBy("shard", "hb", "qb").applyInPandas(meet, "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 3,
                    leaf: int = LEAF, sample: int = SAMPLE, block: int = BLOCK, keep: list[str] = ()) -> DataFrame:
    """(doc_id, ``keep``, fp, component_id, root) for every row: the smallest doc_id and the
    smallest fingerprint reachable over links."""
    rows = written(fingerprints(docs, text, shingle, keep), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    n, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    stars = components(links(nodes, n, max_bits, leaf, sample, block))
    root = nodes.join(stars, nodes["fp"] == stars["u"], "left").select("fp", "least", "n", F.coalesce("v", "fp").alias("root"))
    least = root.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    classes = written(join_hot(root.select("root", "fp", "n"), least, "root", "members", n)
                      .select("fp", "n", "component_id", "root"), "simhash-classes")
    return join_hot(rows, classes, "fp", "n", total).select("doc_id", *keep, "fp", "component_id", "root")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
