"""SpotSigs document fingerprints: chains of content words that follow common words.

At each common word (anchor) a signature is the anchor and the next ``chain`` content words, other
anchors skipped; a text's fingerprint is the sorted set of its signatures' hashes, eight
hexadecimal digits each.  Where no anchor was among the last ``FAR`` words (lists, texts in other
languages), a word in four, by its hash, serves as one: a local choice that an edit elsewhere
doesn't change.  A text with words but no full chain has one signature, all its words.
Likeness is the Jaccard resemblance of two sets.

Sets fall into partitions by length such that sets at a resemblance of ``tau`` or more lie in one
or in neighbouring partitions; comparison stops as soon as lengths, or the elements that are left,
can't reach the wanted resemblance.

Defined results: null and empty texts have the empty fingerprint; two empty ones have likeness 1,
an empty and another 0.  The next document is the next by (doc_id, text), null doc_ids last, and
the first follows the last; a single document follows itself; repeated rows each get a row; an
empty table gives no rows; other columns are dropped, so names can't clash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Common words of English, German, French and Spanish that anchor signatures (a parameter).
ANCHORS = frozenset(
    "the a an and or but is are was were be been of to in on at by for from with as that this it he she they we you not "
    "der die das den dem des ein eine einer und oder ist sind war von zu im in mit auf für als nicht sich auch es "
    "le la les un une des du de et ou est sont dans sur par pour avec que qui ne pas au aux ce il elle "
    "el los las uno y o es son en con por para del al se su no lo como más".split())
CHAIN = 2
FAR = 12  # words without an anchor, after which a quarter of the words (by hash) stand in
WORD = re.compile(r"\w+")
TARGET_CHARS = 8 << 20
MOST_RANGES = 2000  # ranges are streamed: their number sets the parallelism, not the memory
PREFIX_TAU = 0.8


def signatures(text: str, anchors: frozenset = ANCHORS, chain: int = CHAIN) -> frozenset[int]:
    words = WORD.findall(text.lower())
    content = [w for w in words if w not in anchors]
    found, k, last, since = set(), 0, len(content) - chain, 0
    for w in words:
        if w in anchors:
            since = 0
        else:
            k += 1
            since += 1
            if since <= FAR or zlib.crc32(w.encode()) % 4:
                continue
        if k <= last:
            found.add(zlib.crc32(" ".join((w, *content[k:k + chain])).encode()))
    if not found and words:
        found.add(zlib.crc32(" ".join(words).encode()))
    return frozenset(found)


def fingerprint(found: frozenset[int]) -> str:
    return "".join(["%08x" % s for s in sorted(found)])


def length_partition(size: int, tau: float = PREFIX_TAU) -> int:
    """Sets whose sizes' ratio is ``tau`` or more differ by one at most."""
    return int(math.log(max(size, 1)) / -math.log(tau))


def jaccard(a: frozenset, b: frozenset, least: float = 0.0) -> float:
    """Resemblance of two sets; 0 as soon as it is certain to be below ``least``."""
    if len(a) > len(b):
        a, b = b, a
    if not b:
        return 1.0
    if least and (abs(length_partition(len(a), least) - length_partition(len(b), least)) > 1 or len(a) < least * len(b)):
        return 0.0
    if not least:
        both = len(a & b)
        return both / (len(a) + len(b) - both)
    need = math.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9)
    both, missed = 0, 0
    for s in a:
        if s in b:
            both += 1
        else:
            missed += 1
            if missed > len(a) - need:
                return 0.0
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def in_order(docs: DataFrame, text: str, target_chars: int) -> DataFrame:
    """(p, o, k, doc_id, text), each p sorted by (o, k, text) within one task: rows of a range of
    doc_ids (o = 0), then the row or rows that follow them (o = 1)."""
    x = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), x.alias("text")) \
        .withColumn("k", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(MOST_RANGES, math.ceil(chars / target_chars)))
    cuts = rows.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 100 * parts)).first()[0] or [] if parts > 1 else []
    cuts = sorted(set(cuts))
    p = F.lit(0)
    if cuts:
        # Ranges are (cut[i-1], cut[i]]: how many cuts lie below.
        bounds = F.array(*map(F.lit, cuts))
        p = F.size(F.filter(bounds, lambda c: c < F.col("k")))
    rows = rows.withColumn("p", p)
    heads = sorted((r["p"], r["k"]) for r in rows.groupBy("p").agg(F.min("k").alias("k")).collect())  # a row for each range
    before = {q: heads[i - 1][0] for i, (q, _) in enumerate(heads)}
    head = F.create_map(*(F.lit(v) for q, k in heads for v in (q, k))) if heads else F.lit(None)
    prior = F.create_map(*(F.lit(v) for q, b in before.items() for v in (q, b))) if heads else F.lit(None)
    own = F.struct(F.col("p").alias("p"), F.lit(0).alias("o"))
    if not heads:
        return rows.withColumn("o", F.lit(0)).select("p", "o", "k", "doc_id", "text")
    places = F.when(F.col("k") == head[F.col("p")], F.array(own, F.struct(prior[F.col("p")].alias("p"), F.lit(1).alias("o")))) \
        .otherwise(F.array(own))
    placed = rows.select("k", "doc_id", "text", F.explode(places).alias("at")).select("at.p", "at.o", "k", "doc_id", "text")
    return placed.repartition(len(heads), "p").sortWithinPartitions("p", "o", "k", "text")


def fingerprints(docs: DataFrame, text: str = "text", target_chars: int = TARGET_CHARS) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, with their likenesses."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "length_partition"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]

    def run(batches):
        out, size, held = [], 0, None

        def row(doc_id, x, own, following, theirs):
            new = edited(x, following)
            sigs = signatures(new)
            return (doc_id, len(x), hashlib.sha256(new.encode()).hexdigest(), fingerprint(own), fingerprint(sigs),
                    jaccard(own, sigs), jaccard(own, theirs), length_partition(len(own)))

        for batch in batches:
            for p, o, doc_id, x in zip(*(batch.column(c).to_pylist() for c in ("p", "o", "doc_id")), batch.column("text")):
                if held and held[0] != p:
                    held = None
                if o and not held:
                    continue  # only the first row after a range counts
                x = x.as_py()
                own = signatures(x)
                if held:
                    out.append(row(*held[1:], x, own))
                    size += len(held[2])
                held = None if o else (p, doc_id, x, own)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return in_order(docs, text, target_chars).select("p", "o", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, length_partition int")


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every document."""
    return fingerprints(table(spark, sf_dir, "documents"))
