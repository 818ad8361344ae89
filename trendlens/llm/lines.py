"""Substring dedup by hashing lines and the sentences in them.

A unit is a line, within a line a sentence (a sentence of fewer than ``least_unit`` words is
joined to what follows it in the line), and within a sentence a piece between content-defined cuts
(see ``cuts_of``), so a passage that is repeated inside other lines or from the middle of a sentence
to the middle of another is found too.  Units are normalised (lower case, single spaces), their
96-bit digests are grouped over all documents, the earliest occurrence in order of (doc_id, row,
place) stays, and the others go, if they are whole lines or stand in a run of repeated units of at
least ``min_words`` words, or ``PART_WORDS`` where it begins or ends inside a sentence (a shorter run
is likely to be chance).  Five characters count as a word at least, so sizes hold without blanks
too.  A text that is one line only is judged like a sentence.  Of a passage from mid-sentence to mid-sentence the words before its first cut and after
its last one stay.  Offsets of what was removed are those in the original text, in code points.

Each text is cut once: rows are numbered and written with the lengths, sizes and 96-bit digests of their
units, so repeated rows are rows of their own (the first keeps the text).  A digest that many documents
share is counted before it is shuffled, and its occurrences are found by a bounded broadcast (see
``join_hot``); no group is ever gathered.

Defined results: null and empty texts have no units and stay as they are; null doc_ids rank last;
blank units are never compared and go with a run around them; an empty table gives no rows;
carried columns have other names inside, so they can't clash there; the results' names begin with ``_u_``.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot, table, written

MIN_WORDS = 5
LEAST_UNIT = 4
PART_WORDS = 12  # what a run that begins or ends inside a sentence needs
REACH = 3  # a cut inside a sentence is the least hash among so many words on either side
WORD_CHARS = 5  # a word for the sizes, where blanks tell less
LINE = 1 << 40  # marks the size of a whole line
# [.!?]+[^\S\n]+|[。！？｡]+[^\S\n]*|\n+, so that re skips to a candidate
BREAK = re.compile(r"[.!?。！？｡\n](?:(?<=\n)\n*|(?<=[.!?])[.!?]*[^\S\n]+|(?<=[。！？｡])[。！？｡]*[^\S\n]*)")
# Thai to Tibetan, Myanmar, Khmer, Chinese and Japanese: scripts without blanks between words.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
_MULTIPLIER = 0x9E3779B97F4A7C15


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and blankness of the first code points; the others are their own and not blank."""
    low = [chr(c).lower() for c in range(0x3001)]
    return np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(low)], np.uint64), np.array([chr(c).isspace() for c in range(0x3001)])


@functools.cache
def _marks() -> np.ndarray:
    """Of the first code points: is it a mark that belongs to what stands before it?"""
    return np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x3001)])


def unspaced_starts(cp: np.ndarray) -> np.ndarray:
    """Where stretches of about three characters begin in scripts without blanks, by the character."""
    own = np.zeros(len(cp), bool)
    for a, b in UNSPACED:
        own |= (cp >= a) & (cp <= b)
    mark = _marks()
    return own & ((cp * np.uint32(0x9E3779B1) >> np.uint32(16)) % np.uint32(3) == 0) & ~(mark[np.minimum(cp, len(mark) - 1)] & (cp < len(mark)))


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, for texts of up to 2^bits."""
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        x = np.full(1 << bits, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x))
    return out[0], out[1]


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the words that ``split()`` gives; starts, ends and hashes (case apart) of the words,
    which are parted further in scripts without blanks."""
    low, blank = _tables()
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    most = cp.max(initial=0)
    if most < len(low):
        word, value = ~blank[cp], low[cp]
    else:
        small, at = cp < len(low), np.minimum(cp, len(low) - 1)
        word, value = ~(blank[at] & small), np.where(small, low[at], cp)
    framed = np.zeros(len(cp) + 2, bool)
    framed[1:-1] = word
    edge = np.nonzero(framed[1:] != framed[:-1])[0]
    split, end = edge[::2], edge[1::2]
    start = split
    if most >= UNSPACED[0][0]:
        start = np.union1d(split, np.nonzero(unspaced_starts(cp) & word)[0])
        end = np.minimum(np.append(start[1:], len(cp)), end[np.searchsorted(end, start, "right")])
    power, inverse = _powers(max(12, len(cp).bit_length()))
    total = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum(value * power[:len(cp)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return split, start, end, h ^ (h >> np.uint64(29))


def cuts_of(unit: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The words (number of the sentence and hash of each) after which content cuts a sentence: where
    the hash is the least among ``REACH`` words on either side in the sentence.  What stands further
    away has no say, so the copies of a passage are cut alike but for its first and last words."""
    n = len(h)
    cut = np.zeros(n, bool)
    if n > 2 * REACH + 1:
        # As many words stand before the next word as after the cut: no piece is shorter.
        mid = unit[REACH:n - REACH - 1]
        cut[REACH:n - REACH - 1] = (unit[:n - 2 * REACH - 1] == mid) & (unit[2 * REACH + 1:] == mid)
        for k in range(1, REACH + 1):
            less = h[k:] < h[:-k]
            cut[k:] &= less
            cut[:-k] &= ~less
    return np.nonzero(cut)[0]


def places_of(text: str, least_unit: int = LEAST_UNIT) -> list[tuple[int, int, int]]:
    """(start, end, size) of consecutive units that cover the text.  The size is in words, or in
    ``WORD_CHARS`` characters if those are more; it is negative where the sentence goes on in the next
    unit, and ``LINE`` more for a unit that is a line, if the text has others."""
    if not text:
        return []
    split, start, end, h = words_of(text)
    chars = np.concatenate(([0], np.cumsum(end - start)))

    def upto(ends) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(split, ends), chars[np.searchsorted(start, ends)]

    ends = [m.end() for m in BREAK.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    sentences, lines, words, size = [], [], 0, 0
    for e, w, c in zip(ends, *(x.tolist() for x in upto(ends))):
        line = e == len(text) or text[e - 1] == "\n"
        if line or w - words >= least_unit or c - size >= least_unit * WORD_CHARS:
            sentences.append(e)
            lines.append(line)
            words, size = w, c
    cuts = start[cuts_of(np.searchsorted(sentences, start, "right"), h) + 1]
    ends = np.sort(np.concatenate((sentences, cuts)))
    words, size = (np.diff(x, prepend=0) for x in upto(ends))
    size = np.maximum(np.maximum(words, size // WORD_CHARS), size > 0)
    if np.count_nonzero(size) > 1:
        line = np.zeros(len(ends) + 1, bool)
        line[np.searchsorted(ends, sentences) + 1] = lines
        line[0] = True
        size[line[1:] & line[:-1] & (size > 0)] += LINE
    size[np.searchsorted(ends, cuts)] *= -1
    ends = ends.tolist()
    return list(zip([0, *ends], ends, size.tolist()))


def units_of(text: str, least_unit: int = LEAST_UNIT) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised unit, size) of the units that ``places_of`` gives."""
    return [(a, b, " ".join(text[a:b].split()).lower(), n) for a, b, n in places_of(text, least_unit)]


def cut_units(rows: DataFrame, text: str, least_unit: int) -> DataFrame:
    """``rows`` with ``lengths`` and ``sizes`` of the units of the text, and ``d``: the digests of those with
    a word (hi and lo: 64 and 32 bits)."""
    digests = pa.struct([("hi", pa.int64()), ("lo", pa.int32())])

    def lists(each: list, kind: pa.DataType) -> pa.ListArray:
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in each])))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([v for x in each for v in x], kind))

    def run(batches):
        import xxhash
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                lengths, sizes, found, counts = [], [], [], [0]
                for x in part.column(text).to_pylist():
                    units = units_of(x or "", least_unit)
                    lengths.append([b - a for a, b, _, _ in units])
                    sizes.append([n for *_, n in units])
                    found += [digest(u) for _, _, u, n in units if n]
                    counts.append(len(found))
                raw = np.frombuffer(b"".join(found), [("hi", "<i8"), ("lo", "<i4"), ("rest", "<i4")])
                d = pa.StructArray.from_arrays([pa.array(raw["hi"]), pa.array(raw["lo"])], fields=list(digests))
                yield pa.RecordBatch.from_arrays([*part.columns, lists(lengths, pa.int32()), lists(sizes, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(counts, pa.int32()), d)], [*part.schema.names, "lengths", "sizes", "d"])

    d = T.ArrayType(T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.IntegerType())]))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("lengths", T.ArrayType(T.IntegerType())),
                                              T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("d", d)]))


def later_occurrences(cut: DataFrame, rank: str) -> DataFrame:
    """(row, gone): of every row the units, numbered among those with a word, that an earlier one equals.

    First the digests' ``hi`` alone are counted; only units whose ``hi`` is found twice or more are
    grouped by the whole digest."""
    counts = written(cut.select(F.explode("d.hi").alias("hi")).groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1"), "lines-hi")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    units = cut.select(F.col(rank).cast("long").alias("rank"), "row", F.posexplode("d").alias("u", "d")).select("d.hi", "d.lo", "rank", "row", "u")
    found = written(join_hot(units, counts, "hi", "n", total).drop("n"), "lines-found")
    first = F.min(F.struct(F.col("rank").isNull().alias("last"), "rank", "row", "u"))
    repeated = written(found.groupBy("hi", "lo").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1").select(
        "hi", "lo", "n", F.col("first.row").alias("first_row"), F.col("first.u").alias("first_u")), "lines-repeated")
    total = repeated.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return join_hot(found.select("hi", "lo", "row", "u"), repeated, ["hi", "lo"], "n", total) \
        .filter("row <> first_row or u <> first_u").groupBy("row").agg(F.collect_list("u").alias("gone"))


def dedup_units(docs: DataFrame, keep: list[str], text: str = "text", rank: str = "doc_id", min_words: int = MIN_WORDS,
                least_unit: int = LEAST_UNIT) -> DataFrame:
    """``keep`` columns, ``_u_text`` (what is left), ``_u_spans`` (start, end of what went, in the
    original text), ``_u_units`` and ``_u_removed`` (numbers of units) of every row."""
    columns = list(dict.fromkeys([*keep, rank, text]))
    inner = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in columns]).withColumn("row", F.monotonically_increasing_id())
    cut = written(cut_units(rows, inner[text], least_unit), "lines")
    gone = later_occurrences(cut, inner[rank])
    own, body = [inner[k] for k in keep], inner[text]

    def run(batches):
        names = [*keep, "_u_text", "_u_spans", "_u_units", "_u_removed"]
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                kept, spans, n, removed = [], [], [], []
                for x, lengths, sizes, gone in zip(*(part.column(c).to_pylist() for c in (body, "lengths", "sizes", "gone"))):
                    worded = [i for i, size in enumerate(sizes) if size]
                    ends = [0, *itertools.accumulate(lengths)]
                    out = runs(list(zip(ends, ends[1:], sizes)), {worded[u] for u in gone}, min_words) if gone else []
                    cut = [(ends[a], ends[b]) for a, b in out]
                    kept.append(without(x, cut) if cut else x)
                    spans.append([{"start": a, "end": b} for a, b in cut])
                    n.append(len(worded))
                    removed.append(sum(1 for a, b in out for size in sizes[a:b] if size))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in own), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names)

    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField(k, cut.schema[inner[k]].dataType) for k in keep] + [
        T.StructField("_u_text", T.StringType()), T.StructField("_u_spans", span), T.StructField("_u_units", T.LongType()), T.StructField("_u_removed", T.LongType())])
    return cut.drop("d").join(gone, "row", "left").select(*inner.values(), "lengths", "sizes", "gone").mapInArrow(run, schema)


def runs(units: list[tuple], gone: set[int], min_words: int, part_words: int = PART_WORDS) -> list[tuple[int, int]]:
    """Runs [a, b) of units that are in ``gone`` (blank ones may lie between) of enough size:
    ``part_words``, or ``min_words`` in the whole sentences of the run; else the whole lines in it."""
    out, i = [], 0
    while i < len(units):
        if i not in gone:
            i += 1
            continue
        end, j = i + 1, i + 1
        while j < len(units) and (j in gone or not units[j][-1]):
            if j in gone:
                end = j + 1
            j += 1
        a, b = i, end
        if sum(abs(u[-1]) % LINE for u in units[a:b]) < part_words:
            while a < b and a and units[a - 1][-1] < 0:
                a += 1
            while a < b and units[b - 1][-1] < 0:
                b -= 1
        if sum(abs(u[-1]) % LINE for u in units[a:b]) >= min_words:
            out.append((a, b))
        else:
            for k in range(a, b):
                if units[k][-1] >= LINE:
                    out.append((out.pop()[0] if out and out[-1][1] == k else k, k + 1))
        i = j
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return "".join([*parts, text[at:]])


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line and sentence dedup leaves of every document."""
    done = dedup_units(table(spark, sf_dir, "documents"), ["doc_id"])
    spans = F.array_join(F.transform("_u_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return done.select("doc_id", F.col("_u_units").alias("n_units"), F.col("_u_removed").alias("n_removed"), spans.alias("removed_spans"),
                       F.sha2(F.coalesce("_u_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
