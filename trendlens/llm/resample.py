"""Importance resampling of documents towards a target distribution, ranked by regular sampling.

A text's features are the runs of 1 to ``grams`` consecutive words; a feature's bucket is the CRC-32 of
its bytes modulo ``buckets``.  With ``s`` of the ``S`` features of all documents and ``t`` of the ``T``
features of all target texts in a bucket, its gain is ``floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T +
buckets))))``.  A document's weight is the floored mean of its features' gains, looked up in one
array; its score adds Gumbel noise from a hash of its id, so that the highest scores are a draw
without replacement.  Of the N documents with at least ``least_words`` words ``floor(percent * N / 100)``
are drawn and ranked by score, then id.

Counts: each task counts into one array of ``buckets``, Spark adds them up.  Ranks come from parallel
sorting by regular sampling: scored rows are written as sorted runs; rows at regular places in the
runs are the samples (``SAMPLES`` and one a task at most, on the driver), and regular places in the
sorted samples split the order into segments; a row goes to its segment, which is sorted there; the
segments' counts, added up in order, give the number of rows ahead of each segment, and so exact ranks.
Rows go to segments by (score, id, row), so ties don't gather.  Segments wholly beyond the draw stay
where they are.

Defined results: null and empty texts have no features (weight 0) and are not drawn; a null id hashes
like an empty one and ranks after other ids at the same score; rows with equal ids rank in the order of
the written copy; no target text: T is 0; an empty table gives no rows; carried columns come back in
one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

GRAMS = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
SAMPLES = 1 << 18
SEGMENT_ROWS = 250_000
# Bytes of a word (A-Z as a-z); all others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


class Buckets(dict):
    """Bucket of each feature, kept for those seen lately."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.n
        return found


def features_of(text: bytes | None, buckets: Buckets, grams: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all features."""
    words = (text or b"").translate(WORD_BYTES).split()
    found = list(map(buckets.__getitem__, words))
    for n in range(2, grams + 1):
        found += [buckets[b" ".join(words[i:i + n])] for i in range(len(words) - n + 1)]
    return len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, text: str, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds."""
    def run(batches):
        seen, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(features_of(x.as_py(), seen, grams)[1], minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    tasks = texts.select(F.col(f"`{text}`").cast("binary").alias("t")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in tasks.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: str, key: str) -> int:
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, text: str, doc_id: str, keep: list[str], grams: int, seed: str) -> DataFrame:
    """(kept, id, words, n_features, weight, score, row), written as runs sorted by score and id."""
    kept = F.struct(*[F.col(f"`{k}`") for k in keep]) if keep else F.lit(None).cast("struct<none:int>")
    rows = docs.select(kept.alias("kept"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("t"))
    new = ["words", "n_features", "weight", "score"]

    def run(batches):
        seen = Buckets(len(gain))
        for batch in batches:
            ids = batch.column("id").cast(pa.string()).to_pylist()
            out = []
            for x, key in zip(batch.column("t"), ids):
                words, found = features_of(x.as_py(), seen, grams)
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                out.append((words, len(found), weight, weight + noise(seed, key or "")))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), batch.column("id"), *(pa.array([o[i] for o in out], pa.int64()) for i in range(4))],
                                             ["kept", "id", *new])

    schema = T.StructType([rows.schema["kept"], rows.schema["id"], *[T.StructField(c, T.LongType()) for c in new]])
    runs = rows.mapInArrow(run, schema).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("id"))
    return written(runs.withColumn("row", F.monotonically_increasing_id()), "resample")


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    """The order's keys: by score descending, id (null last), row."""
    score, ids, row = (batch.column(c).to_pylist() for c in ("score", "id", "row"))
    return [(-s, i is None, i, r) for s, i, r in zip(score, ids, row)]


def splitters(runs: DataFrame, total: int, segments: int, samples: int = SAMPLES) -> list[tuple]:
    """Keys that split the order into about equal segments, from rows at regular places of the runs."""
    stride = max(1, total // min(samples, 64 * segments))

    def run(batches):
        at = stride // 2
        for batch in batches:
            place = np.arange(at, batch.num_rows, stride)
            at += len(place) * stride - batch.num_rows
            yield batch.take(pa.array(place))

    found = runs.select("score", "id", "row").mapInArrow(run, runs.select("score", "id", "row").schema).toArrow()
    keys = sorted(k for b in found.to_batches() for k in _keys(b))
    return [keys[len(keys) * i // segments] for i in range(1, segments)] if keys else []


def ranked(rows: DataFrame, total: int, draw: int, segments: int | None = None) -> DataFrame:
    """The ``total`` rows with ``rank`` 1 to ``draw`` by score, id and row, null beyond."""
    if segments is None:
        segments = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SEGMENT_ROWS)
    cuts = splitters(rows, total, segments)
    first = np.array([c[0] for c in cuts], np.int64)

    def place(batches):
        for batch in batches:
            own = -batch.column("score").to_numpy()
            low, high = np.searchsorted(first, own, "left"), np.searchsorted(first, own, "right")
            tied = np.nonzero(low < high)[0]
            for i, key in zip(tied.tolist(), _keys(batch.take(pa.array(tied)))):
                low[i] = bisect_left(cuts, key, low[i], high[i])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.int32())], [*batch.schema.names, "segment"])

    dealt = rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("segment", T.IntegerType())]))
    counts = dict(dealt.groupBy("segment").count().collect())
    ahead = np.concatenate(([0], np.cumsum([counts.get(i, 0) for i in range(len(cuts) + 1)]))).tolist()
    last = max((i for i in range(len(cuts) + 1) if ahead[i] < draw), default=-1)

    def number(batches):
        now, at = -1, 0
        for batch in batches:
            rank = []
            for segment in batch.column("segment").to_pylist():
                now, at = (now, at + 1) if segment == now else (segment, ahead[segment] + 1)
                rank.append(at if at <= draw else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rank, pa.int64())], [*batch.schema.names[:-1], "rank"])

    beyond = dealt.filter(F.col("segment") > last).drop("segment").withColumn("rank", F.lit(None).cast("long"))
    if last < 0:
        return beyond
    own = dealt.filter(F.col("segment") <= last).repartitionById(last + 1, "segment").sortWithinPartitions(
        "segment", F.desc("score"), F.asc_nulls_last("id"), "row")
    return own.mapInArrow(number, beyond.schema).unionByName(beyond)


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", keep: list[str] = (),
             grams: int = GRAMS, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
             segments: int | None = None) -> DataFrame:
    """(kept struct of the ``keep`` columns, id, words, n_features, weight, score, row, rank) of every document."""
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    rows = scored(docs, gain, text, doc_id, list(keep), grams, seed)
    able = rows.filter(F.col("words") >= least_words)
    total = able.count()
    others = rows.filter(F.col("words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(able, total, percent * total // 100, segments).unionByName(others)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and ranks of the documents, drawn towards the benchmark's words."""
    done = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


# Two sums of features by bucket; CRC-32 from its table, which is made by eight shifts a byte.
OP12_SQL = f"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
  worded AS MATERIALIZED (SELECT src, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
    FROM (SELECT 's' AS src, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
  hexed AS (SELECT w, hex(w) AS h FROM (SELECT DISTINCT w FROM worded)),
  bucketed AS MATERIALIZED (SELECT w, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(len(h) // 2),
      lambda i: CAST((strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1 AS BIGINT))),
    lambda c, b: xor(tbl[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {BUCKETS} AS bucket FROM hexed, steps),
  sums AS (SELECT bucket, count(*) FILTER (src = 's') AS s, count(*) FILTER (src = 't') AS t FROM worded JOIN bucketed USING (w) GROUP BY bucket),
  whole AS (SELECT sum(s) AS s, sum(t) AS t FROM sums),
  gain AS (SELECT bucket, CAST(floor(1000 * ln((sums.t + 1)::DOUBLE * (whole.s + {BUCKETS})::DOUBLE
    / ((sums.s + 1)::DOUBLE * (whole.t + {BUCKETS})::DOUBLE))) AS BIGINT) AS g FROM sums, whole),
  weighed AS (SELECT id AS doc_id, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
    FROM worded JOIN bucketed USING (w) JOIN gain USING (bucket) WHERE src = 's' GROUP BY id),
  scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || doc_id)[:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM documents LEFT JOIN weighed USING (doc_id)),
  placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""
