"""Vector codes: product quantisation in integers, nearest entries by Orchard search.

A component x becomes ``floor(4096 * x)``; a vector is cut into ``parts`` equal consecutive parts, and
each part position has a codebook of ``entries`` entries, first the parts of the vectors with the
smallest ids.  A round assigns every part to the nearest entry of its codebook and replaces each
entry by the floored mean of its parts; an unused entry stays.  All sums are integers, so the result
doesn't depend on the partitioning.

Orchard search: every entry keeps the other entries in order of their distance from it.  A search
starts at some entry and walks its list; a nearer entry (of equally near ones the lower) becomes the
current one, and the walk goes on at the start of its list; an entry once measured is marked and not
measured again.  The walk ends where the listed distance is more than twice the current distance:
by the triangle inequality what follows is farther away.  ``search`` takes a step for all searches
that still go on at a time.

The vectors are written once as integers; a round is one pass over them that returns the sums and
counts of each task (``parts * entries`` rows), added up by Spark.  The driver and the tasks hold the
codebooks only.  Errors are summed by label before they are joined to the rows (see ``join_hot``).

Defined results: rows whose vector is null or holds null or non-finite components are dropped;
components beyond the bound that keeps a row's error within 62 bits (32,768 at 64 components) count as
that bound; a vector whose length isn't divisible is filled up with zeros; vectors of another length
than the first one's have null code and error; of repeated ids the smaller vector comes first; null
ids rank last; fewer vectors than ``entries`` make smaller codebooks; an empty table gives no rows;
null labels are summed together; only the named columns are read, so further ones can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, table, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 1 << 14  # searches that take their steps together


def integer_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str, parts: int) -> DataFrame:
    """(vec_id, label, v array<int>) of the usable rows, written; lengths are multiples of ``parts``."""
    x = F.col(f"`{vector}`")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    n = F.greatest(F.size(x), F.lit(1))
    most = F.pow(F.lit(2.0), F.floor((60 - F.log2(n.cast("double"))) / 2))
    ints = F.transform(x, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, -most), most)).cast("int"))
    filled = F.concat(ints, F.array_repeat(F.lit(0), F.pmod(-F.size(x), F.lit(parts))))
    return written(vectors.filter(x.isNotNull() & ~bad).select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), filled.alias("v")), "vectors")


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every entry the other entries in order of distance, and those squared distances."""
    between = ((book[:, None, :] - book[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(between, -1)
    order = np.argsort(between, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(between, order, axis=1)


def search(x: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every row of ``x`` and the squared distance, ties to the lower entry."""
    order, between = lists
    reach = (between + 3) // 4  # what the current squared distance has to be at least
    n, k = len(x), len(book)
    # A search starts at the entry whose components' sum is near the row's.
    by_sum = np.argsort(book.sum(1), kind="stable")
    at = by_sum[np.minimum(np.searchsorted(book.sum(1)[by_sum], x.sum(1)), k - 1)]
    best = ((x - book[at]) ** 2).sum(1)
    if k == 1:
        return at, best
    seen = np.zeros((n, k), bool)
    seen[np.arange(n), at] = True
    place = np.zeros(n, np.intp)
    going = np.arange(n)
    while len(going):
        here, p = at[going], place[going]
        inside = reach[here, p] <= best[going]
        going, here, p = going[inside], here[inside], p[inside]
        other = order[here, p]
        place[going] = p + 1
        new = ~seen[going, other]
        row, entry = going[new], other[new]
        seen[row, entry] = True
        d = ((x[row] - book[entry]) ** 2).sum(1)
        nearer = (d < best[row]) | ((d == best[row]) & (entry < at[row]))
        row = row[nearer]
        at[row], best[row], place[row] = entry[nearer], d[nearer], 0
        going = going[place[going] < k - 1]
    return at, best


def _blocks(column: pa.Array, dims: int):
    """(first row, usable rows of the block, their vectors as parts) of a column of vectors."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for begin in range(0, len(sizes), BLOCK):
        fits = np.nonzero(sizes[begin:begin + BLOCK] == dims)[0]
        at = (ends - sizes)[begin + fits]
        yield begin, fits, flat[at[:, None] + np.arange(dims)].astype(np.int64)


def _assign(x: np.ndarray, books: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part of every vector, and the squared distances."""
    parts, _, width = books.shape
    got = [search(x[:, p * width:(p + 1) * width], books[p], lists[p]) for p in range(parts)]
    return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)


def _sums(vectors: DataFrame, books: np.ndarray) -> list:
    """(part, entry, count, sums of the components) of the parts that each entry is nearest to."""
    parts, k, width = books.shape

    def run(batches):
        lists = [neighbour_lists(b) for b in books]
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            for _, _, x in _blocks(batch.column(0), parts * width):
                at, _ = _assign(x, books, lists)
                for p in range(parts):
                    count[p] += np.bincount(at[:, p], minlength=k)
                    np.add.at(total[p], at[:, p], x[:, p * width:(p + 1) * width])
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e], pa.int64()),
                                          pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    tasks = vectors.select("v").mapInArrow(run, "part int, entry int, n long, s array<long>")
    return tasks.groupBy("part", "entry").agg(F.sum("n"), F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(width)])).collect()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) of ``integer_vectors``; no entries if there is no vector."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    dims = len(first[0][0]) if first else 0
    start = np.array([r[0] for r in first if len(r[0]) == dims], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, dims // parts).swapaxes(0, 1))
    for _ in range(rounds if dims else 0):
        new = books.copy()
        for part, entry, n, s in _sums(vectors, books):
            new[part, entry] = [x // n for x in s]
        if np.array_equal(new, books):  # the further rounds would change nothing
            break
        books = new
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code array<int>, error long) of ``integer_vectors``."""
    parts, k, width = books.shape

    def run(batches):
        lists = [neighbour_lists(b) for b in books]
        for batch in batches:
            codes, errors = [None] * batch.num_rows, [None] * batch.num_rows
            for begin, fits, x in _blocks(batch.column("v"), parts * width):
                at, d = _assign(x, books, lists)
                for i, c, e in zip((begin + fits).tolist(), at.tolist(), d.sum(1).tolist()):
                    codes[i], errors[i] = c, e
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.list_(pa.int32())),
                                              pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<int>, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every usable row, and the codebooks."""
    ints = integer_vectors(vectors, vec_id, vector, label, parts)
    books = train(ints, parts, entries, rounds)
    coded = written(encode(ints, books).withColumn("_v_label", F.concat(
        F.col("label").isNull().cast("string"), F.coalesce(F.col("label").cast("string"), F.lit("")))), "vector-codes")
    by_label = written(coded.groupBy("_v_label").agg(F.count("*").alias("_v_n"), F.expr(
        "try_cast(sum(cast(error as decimal(38,0))) as bigint)").alias("label_error")), "vector-labels")
    total = by_label.agg(F.coalesce(F.sum("_v_n"), F.lit(0))).first()[0]
    return join_hot(coded, by_label, "_v_label", "_v_n", total).drop("_v_label", "_v_n"), books


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every embedding."""
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``op11_codes``: every part against every entry."""
    steps = [f"""
      kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      part AS MATERIALIZED (SELECT vec_id, p, i, v[p * (len(v) // {parts}) + i + 1] AS x
        FROM kept, range({parts}) t(p), range(len(v) // {parts}) u(i)),
      book0 AS MATERIALIZED (SELECT p, e, i, x AS c FROM part JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e
        FROM kept) USING (vec_id) WHERE e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT vec_id, p, min(d * {entries} + e) % {entries} AS e, min(d) AS d FROM (
        SELECT vec_id, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM part JOIN book{r} USING (p, i) GROUP BY ALL) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT p, e, i, coalesce(m, c) AS c FROM book{r} LEFT JOIN (
        SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM part JOIN near{r} USING (vec_id, p) GROUP BY ALL) USING (p, e, i))""")
    return "WITH " + ",\n".join(steps) + f""",
      coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
      FROM coded JOIN kept USING (vec_id)"""


OP11_SQL = _oracle()
