"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of up to ``chunk_chars`` code points is one piece.  A longer one is cut into chunks that
overlap; each chunk is pre-tokenised on its own task, and two neighbours are stitched at the first
position of their overlap where both have a pre-token boundary: the pattern only looks ahead, so
from a shared boundary on both scans agree.  Only boundaries after a character that isn't white
space are used, so a piece that ends there splits by itself as it does inside the text.  Where an
overlap holds no shared boundary (one pre-token longer than the overlap), the chunks stay together
in one piece.  Pieces are encoded on their own tasks and put together in order.

Defined results: null or empty text has no ids and decodes to no bytes; repeated rows each get a
row; ``keep`` columns are carried, all others are dropped, so names can't clash.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

CHUNK_CHARS = 32768
OVERLAP_CHARS = 1024
BATCH_BYTES = 4 << 20


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """The encoder of a rank file, once per Python worker."""
    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@functools.lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex
    return regex.compile(public_tokenizers.PATTERN)


def _slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES):
    """Parts of a batch with about ``limit`` bytes in ``column`` each (one row at least)."""
    col = batch.column(column)
    sizes = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4)
    begin = 0
    while begin < len(col):
        end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + limit, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _with_ids(part: pa.RecordBatch, keep: list[str], ids: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [*(part.column(k) for k in keep), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))],
        [*keep, "ids"])


def _encode_rows(rows: DataFrame, keep: list[str], text: str, ranks_path: str) -> DataFrame:
    def run(batches):
        enc = encoder(ranks_path)
        for batch in batches:
            for part in _slices(batch, text):
                yield _with_ids(part, keep, [np.array(enc.encode_ordinary(x), np.int32)
                                             for x in part.column(text).to_pylist()])

    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.select(*keep, text).mapInArrow(run, schema)


def chunks_of(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(_row, no, start, part): overlapping chunks of each text, starts in code points."""
    starts = F.sequence(F.lit(0), F.length("_text") - 1, F.lit(chunk))
    return long.select("_row", "_text", F.posexplode(starts).alias("no", "start")).select(
        "_row", "no", "start", F.expr(f"substring(_text, start + 1, {chunk + overlap})").alias("part"))


def _boundaries(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Pre-token starts of each chunk within its first and its last ``overlap`` code points."""
    def run(batches):
        find = _pattern().finditer
        for batch in batches:
            heads, tails = [], []
            for no, start, part in zip(batch.column("no").to_pylist(), batch.column("start").to_pylist(),
                                       batch.column("part").to_pylist()):
                cut = len(part) == chunk + overlap  # more text follows
                # What more text could still join lies in the last three code points.
                at = [m.start() for m in find(part)]
                at = [p for p in at if p and not part[p - 1].isspace() and not (cut and p >= len(part) - 3)]
                heads.append([start + p for p in at if no and p < overlap])
                tails.append([start + p for p in at if p >= chunk])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("no"),
                 pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                ["_row", "no", "head", "tail"])

    return chunks.mapInArrow(run, "_row long, no int, head array<int>, tail array<int>")


def cuts_of(bounds: DataFrame) -> DataFrame:
    """(_row, cuts): where neighbouring chunks resynchronise, ascending; 0 is always first."""
    before = F.lag("tail").over(Window.partitionBy("_row").orderBy("no"))
    stitched = bounds.withColumn("_before", before).select(
        "_row", F.array_min(F.array_intersect("head", "_before")).alias("cut"))
    return stitched.groupBy("_row").agg(
        F.sort_array(F.concat(F.array(F.lit(0)), F.collect_set("cut"))).alias("cuts"))


def encode(docs: DataFrame, keep: list[str], text: str = "text", ranks_path: str | None = None,
           chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``keep`` columns and ``ids array<int>`` for every row of ``docs``."""
    ranks_path = ranks_path or default_ranks()
    rows = docs.select(*[F.col(f"`{k}`") for k in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    short = _encode_rows(rows.filter(F.length("_text") <= chunk_chars), keep, "_text", ranks_path)
    long = written(rows.filter(F.length("_text") > chunk_chars)
                   .withColumn("_row", F.monotonically_increasing_id()), "bpe-long")
    chunks = chunks_of(long, chunk_chars, overlap_chars).repartition("_row", "no")
    cuts = cuts_of(_boundaries(chunks, chunk_chars, overlap_chars))
    pieces = (long.join(cuts, "_row")
              .select("_row", "_text", "cuts", F.posexplode("cuts").alias("no", "begin"))
              .select("_row", "no", F.expr(
                  "substring(_text, begin + 1, coalesce(try_element_at(cuts, no + 2), length(_text)) - begin)").alias("piece")))
    ids = _encode_rows(pieces.repartition("_row", "no"), ["_row", "no"], "piece", ranks_path)
    whole = ids.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("p")).select(
        "_row", F.flatten(F.col("p.ids")).alias("ids"))
    return short.unionByName(long.drop("_text").join(whole, "_row").drop("_row"))


def decode(tokens: DataFrame, keep: list[str], ids: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """``keep`` columns, the ids, and ``decoded binary``: the ids' bytes one after another."""
    ranks_path = ranks_path or default_ranks()

    def run(batches):
        enc = encoder(ranks_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                got = [enc.decode_bytes(x) if x else b"" for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), part.column(ids), pa.array(got, pa.binary())],
                    [*keep, ids, "decoded"])

    schema = T.StructType([tokens.schema[k] for k in keep] + [tokens.schema[ids], T.StructField("decoded", T.BinaryType())])
    return tokens.select(*keep, ids).mapInArrow(run, schema)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document's ids and of the bytes that they decode to."""
    ids = encode(table(spark, sf_dir, "documents"), ["doc_id"])
    return decode(ids, ["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
