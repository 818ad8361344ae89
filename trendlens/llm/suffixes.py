"""Suffix-array dedup: repeated byte strings found in run-compressed Burrows-Wheeler indexes.

Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else.

*Segments.*  A window (string of ``length`` bytes) is keyed by the least hash of the 32-byte strings
in it (the leftmost of equal ones), so equal windows have equal keys wherever they stand.
Consecutive windows whose least hash is at one place make a segment; each window lies in exactly
one segment, equal windows lie in different ones, and a text has a segment per 85 bytes or so.
Segments of equal key and content are counted; where a key has a single content, its windows are
repeated or not all alike, as in a BWT they would be one run.

*Index.*  Keys with several contents (where repeats begin and end, and around differences of near
copies) go to shards by key.  A shard's distinct segments get a suffix array, from it the
run-compressed BWT with the suffixes sampled at both ends of each run, and the longest common
prefixes of neighbours there.  Inside a run the common prefix with the neighbour is one less than
that of the text position before, so the samples give each position's matching statistic (longest
match elsewhere in the shard) in one stream over the text.  Windows whose statistic reaches
``length`` are marked.  As a segment stands for its windows once, a match is another place.

*Whole results.*  A key that has more contents than ``most`` is too large for a shard; its windows
are compared by 128-bit digests that Spark groups, which is exact too.  The texts themselves are
shuffled once, to their marked segments; only those with index work are written and joined again.
Copies of a text share a key (hash of the text), counted first; frequent ones never meet in a task.

Defined results: null and empty texts have no bytes and keep nothing; matches never cross
texts; repeated rows each get a row (they repeat each other); an empty table gives no rows;
other columns are dropped, so names can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, small_batches, table, written

LENGTH = 200
GRAM = 32  # a power of two
CHUNK = 1 << 20  # window starts worked on at once
PLACE_FREE = ~np.uint64((1 << 21) - 1)  # a place in a chunk has 21 bits
SHARD_BYTES = 1 << 20
MOST = 3_000
BYTES_PER_SEGMENT = 85  # (length - GRAM + 2) / 2 on text without long repeats
FULL, EDGE, SHOWN = 0, 1, 2


def _mixed(b: np.ndarray) -> np.ndarray:
    """Mixed hash of the GRAM bytes from each position."""
    h, base, width = b.astype(np.uint64) + np.uint64(1), 0x100000001B3, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), width * 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, content hash, start, end) of a text's segments; end includes the last window."""
    import xxhash
    keys, starts, ends = [], [], []
    all_bytes = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, CHUNK):
        mixed = _mixed(all_bytes[at:at + CHUNK + length - 1])
        # The place in the low bits: equal hashes go to the leftmost.
        low = mixed & PLACE_FREE | np.arange(len(mixed), dtype=np.uint64)
        span = length - GRAM + 1
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:-(span - width)], low[span - width:])
        first = np.concatenate(([0], np.nonzero(low[1:] != low[:-1])[0] + 1))
        size = np.diff(np.concatenate((first, [len(low)])))
        keys.append(mixed[(low[first] & ~PLACE_FREE).astype(np.int64)])
        starts.append(first + at)
        ends.append(first + size + at + length - 1)
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    start, end = np.concatenate(starts), np.concatenate(ends)
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(text[a:b]) for a, b in zip(start.tolist(), end.tolist())), np.uint64, len(start))
    return np.concatenate(keys).view(np.int64), content.view(np.int64), start, end


def _packed(t: np.ndarray) -> tuple[np.ndarray, int]:
    """The first symbols of each suffix in one number, as many as fit there, and how many that are."""
    base, width = max(2, int(t.max(initial=0)) + 1), 1
    while base ** (width + 1) < 1 << 63:
        width += 1
    packed = t.astype(np.int64)
    for k in range(1, width):
        packed *= base
        packed[:max(len(t) - k, 0)] += t[k:]
    return packed, width


def suffix_array(packed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes in order, and of each a number of symbols that it has in common with the one before: it has
    less than three times as many (none: less than ``width``).  By prefixes of ``width`` symbols (``packed``)
    and then of three times as many in each round, as three ranks below 2^21 fit in one number; in longer
    texts two, and all goes by twice.  The last value says which."""
    n = len(packed)
    times = 3 if n + 1 < 1 << 21 else 2
    sa = np.argsort(packed).astype(np.int32)
    first = packed[sa]
    head = np.concatenate(([True], first[1:] != first[:-1]))
    common = np.where(head, 0, width).astype(np.int32)
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0))
    done = width
    while True:
        alone = head & np.concatenate((head[1:], [True]))
        slot = np.nonzero(~alone)[0]
        if not len(slot):
            return sa, common, times
        at = sa[slot]
        both = rank[at].astype(np.int64)
        for k in range(1, times):
            both *= n + 1
            both += rank[np.minimum(at + k * done, n)]
            both += 1
        order = np.argsort(both)
        at, both = at[order], both[order]
        sa[slot] = at
        new = np.concatenate(([True], both[1:] != both[:-1]))
        done *= times
        common[slot[~new]] = done
        head[slot] = new
        rank[at] = np.maximum.accumulate(np.where(new, slot, 0))


def _common(packed: np.ndarray, width: int, t: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, ``left`` at most; they have ``least`` in common."""
    out, todo, n = least.astype(np.int64), np.arange(len(a)), len(t)
    while len(todo):
        x, y = a[todo] + out[todo], b[todo] + out[todo]
        more = (out[todo] < left[todo]) & (np.maximum(x, y) + width <= n)
        more &= packed[np.minimum(x, n - 1)] == packed[np.minimum(y, n - 1)]
        todo = todo[more]
        out[todo] += width
    todo = np.arange(len(a))
    for _ in range(width):
        x, y = a[todo] + out[todo], b[todo] + out[todo]
        more = (out[todo] < left[todo]) & (np.maximum(x, y) < n)
        more &= t[np.minimum(x, n - 1)] == t[np.minimum(y, n - 1)]
        todo = todo[more]
        out[todo] += 1
    return np.minimum(out, left)


def matching_statistics(parts: list[bytes], length: int = 0) -> list[np.ndarray]:
    """For each byte of each part the longest match that starts anywhere else in the parts, not
    longer than what is left of its part, from the run-compressed BWT of all parts.

    Matches of fewer than ``length`` bytes may be given as shorter than they are."""
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1  # a separator (0) stands before each part
    t = np.frombuffer(b"\x00" + b"\x00".join(parts), np.uint8).astype(np.int16) + np.int16(1)
    t[starts] = 0
    n = len(t)
    # Only symbols that occur, in their order, so that a number has more of them.
    occurs = np.bincount(t, minlength=1) > 0
    t = (np.cumsum(occurs) - 1).astype(np.int16)[t]
    packed, width = _packed(t)
    sa, common, times = suffix_array(packed, width)
    bwt = t[sa - 1]
    bwt[sa == 0] = -1  # nothing stands before the first
    change = bwt[1:] != bwt[:-1]
    left = np.repeat(starts + sizes + 1, sizes + 1) - np.arange(n)
    best = np.zeros(n, np.int64)
    slot = np.empty(n, np.int32)
    place = np.arange(n, dtype=np.int32)
    slot[sa] = place
    for step in (-1, 1):
        # Run ends next to another run; a part's separator begins a stream of its own.
        end = np.concatenate(([True], change) if step < 0 else (change, [True]))
        sampled = np.zeros(n, bool)
        sampled[sa[end]] = True
        sampled[starts] = True
        sample = np.nonzero(sampled)[0]
        near = slot[sample] + step
        other = sa[np.clip(near, 0, n - 1)]
        value = np.minimum(common[np.clip(np.maximum(slot[sample], near), 0, n - 1)].astype(np.int64), left[sample])
        # What may reach ``length``, there or at a byte that follows, which has one less.
        may = np.nonzero((np.maximum(times * value, width) >= length) & (left[sample] >= length))[0]
        value[may] = _common(packed, width, t, sample[may], other[may], left[sample[may]], value[may])
        value[(near < 0) | (near >= n)] = 0
        # From one sample to the next the statistic falls by one a byte.
        best = np.maximum(best, (value + sample)[np.cumsum(sampled) - 1] - place)
    return [best[s + 1:s + 1 + k] for s, k in zip(starts.tolist(), sizes.tolist())]


def spans_of(starts: np.ndarray, length: int) -> list[dict]:
    """Maximal covered runs of the windows at ``starts`` (ascending)."""
    if not len(starts):
        return []
    cut = np.nonzero(np.diff(starts) > length)[0]
    a = starts[np.concatenate(([0], cut + 1))]
    b = starts[np.concatenate((cut, [len(starts) - 1]))] + length
    return [{"start": int(x), "end": int(y)} for x, y in zip(a, b)]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<start:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """(h, seg, key): every segment of every text."""
    def run(batches):
        for batch in batches:
            held, n = [], 0
            for key, x in zip(batch.column("key").to_pylist(), _raw(batch.column("text"))):
                h, seg, _, _ = segments(x, length)
                if len(h):
                    held.append((h, seg, np.full(len(h), key)))
                    n += len(h)
                if n > 500_000:
                    yield _columns(held)
                    held, n = [], 0
            if held:
                yield _columns(held)

    def _columns(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["h", "seg", "key"])

    return texts.select("key", "text").mapInArrow(run, "h long, seg long, key long")


def _raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column's values."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).tolist()
    data = column.buffers()[2]
    data = memoryview(data) if data else b""
    return [bytes(data[a:b]) for a, b in zip(at, at[1:])]


def _lists(column: pa.Array, fields: list[str]) -> tuple[list[int], list[np.ndarray]]:
    """Offsets and the fields' values of a column of structs' lists (null lists are empty)."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return at.tolist(), [column.values.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _covered(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of intervals with ascending starts and ends."""
    if not len(start):
        return []
    new = np.nonzero(np.concatenate(([True], start[1:] > end[:-1])))[0]
    return list(zip(start[new].tolist(), end[np.concatenate((new[1:], [len(end)])) - 1].tolist()))


def _worked(joined: DataFrame, length: int) -> DataFrame:
    """Spans of repeated segments and pieces for the index, of each row with its marked segments;
    ``text`` stays where the index has to say more."""
    pair = lambda h, seg: h * np.int64(0x2545F4914F6CDD1D) ^ seg

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                yield work(batch.slice(begin, 512))

    def work(part):
        raws = _raw(part.column("text"))
        at, (mh, mseg, md, mkind) = _lists(part.column("marks"), ["h", "seg", "d", "kind"])
        marked = pair(mh, mseg)
        size, spans, done, waits = [], [], [], []
        counts, ph, pd_, pat, pown, pbytes = [], [], [], [], [], []
        for raw, m0, m1, leads in zip(raws, at, at[1:], part.column("leads").to_pylist()):
            covered, before, more = [], len(ph), False
            if m1 > m0:
                h, seg, a, b = segments(raw, length)
                own, kind = pair(h, seg), mkind[m0:m1]
                full = np.isin(own, marked[m0:m1][kind != EDGE])
                covered = _covered(a[full], b[full])
                asked = np.isin(own, marked[m0:m1][kind == EDGE])
                more = bool(asked.any())
                take = np.nonzero(asked)[0]
                if leads and (kind == SHOWN).any():
                    shown = np.nonzero(np.isin(own, marked[m0:m1][kind == SHOWN]))[0]
                    take = np.concatenate((take, shown[np.unique(own[shown], return_index=True)[1]]))  # one place each
                if len(take):
                    d = dict(zip(mh[m0:m1][kind != FULL].tolist(), md[m0:m1][kind != FULL].tolist()))
                    ph += h[take].tolist()
                    pd_ += [d[x] for x in h[take].tolist()]
                    pat += a[take].tolist()
                    pown += asked[take].tolist()
                    pbytes += [raw[x:y] for x, y in zip(a[take].tolist(), b[take].tolist())]
            counts.append(len(ph) - before)
            size.append(len(raw))
            spans.append(covered)
            waits.append(more)
            done.append(None if more else _digest(raw, covered))
        offsets = lambda n: pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32())
        pieces = pa.StructArray.from_arrays([pa.array(ph, pa.int64()), pa.array(pd_, pa.int64()), pa.array(pat, pa.int64()),
                                             pa.array(pown, pa.bool_()), pa.array(pbytes, pa.binary())], ["h", "d", "at", "own", "bytes"])
        ends = pa.StructArray.from_arrays([pa.array([s[k] for x in spans for s in x], pa.int64()) for k in (0, 1)], ["start", "end"])
        text = pa.array([raw if more else None for raw, more in zip(raws, waits)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("key"), text, pa.array(size, pa.int64()), pa.ListArray.from_arrays(offsets([len(x) for x in spans]), ends),
             pa.ListArray.from_arrays(offsets(counts), pieces), pa.array(done, pa.string())],
            ["doc_id", "key", "text", "n_bytes", "spans", "pieces", "kept_sha256"])

    none = F.array().cast("array<struct<h:long,seg:long,d:long,kind:int>>")
    return joined.select("doc_id", "key", "text", F.coalesce("marks", none).alias("marks"), "leads").mapInArrow(
        run, f"doc_id long, key long, text string, n_bytes long, spans {SPANS}, "
             "pieces array<struct<h:long,d:long,at:long,own:boolean,bytes:binary>>, kept_sha256 string")


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def _digest(raw: bytes, spans: list[tuple[int, int]]) -> str:
    return hashlib.sha256(_kept(raw, spans)).hexdigest()


def _indexed(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """(key, spans): what each shard's index marks of its texts' pieces."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["h", "bytes", "own", "key", "at"])
        stats = matching_statistics(pdf["bytes"].tolist(), length)
        keys, found = [], []
        for key, at, own, ms in zip(pdf["key"], pdf["at"], pdf["own"], stats):
            if own and len(hits := np.nonzero(ms >= length)[0]):
                keys.append(key)
                found.append(spans_of(hits + at, length))
        return pd.DataFrame({"key": pd.Series(keys, dtype="int64"), "spans": pd.Series(found, dtype=object)})

    return pieces.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard").applyInPandas(run, f"key long, spans {SPANS}")


def _by_window(pieces: DataFrame, length: int) -> DataFrame:
    """(key, spans) for keys with too many contents for a shard: windows grouped by digest."""
    def cut(batches):
        import xxhash
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for key, at, own, raw in zip(*(batch.column(c).to_pylist() for c in ("key", "at", "own", "bytes"))):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(raw[i:i + length]) for i in range(n)], pa.binary()), pa.array(np.full(n, key)),
                     pa.array(np.arange(at, at + n)), pa.array(np.full(n, own))], ["w", "key", "at", "own"])

    def join(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([spans_of(np.sort(np.array(x)), length) for x in batch.column("at").to_pylist()], SPAN_TYPE)],
                ["key", "spans"])

    windows = written(pieces.mapInArrow(cut, "w binary, key long, at long, own boolean"), "windows")
    repeated = windows.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1")
    total = windows.count()
    return join_hot(windows.filter("own"), repeated, "w", "n", total).groupBy("key").agg(F.collect_list("at").alias("at")) \
        .mapInArrow(join, f"key long, spans {SPANS}")


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                   most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, spans, kept_sha256) of every row: ``spans`` are the maximal removed byte
    ranges of the text, ``kept_sha256`` the digest of the bytes that stay."""
    small_batches(docs.sparkSession)
    x = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), x.alias("text")).withColumn("key", F.xxhash64("text"))
    rows, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    about = size // BYTES_PER_SEGMENT  # segments: only says which keys are joined by broadcast
    seen = written(_occurrences(texts, length), "segments")
    groups = seen.groupBy("h").agg(F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high")).filter("n > 1")
    shared = written(join_hot(seen, groups, "h", "n", about), "shared-segments")
    mixed = shared.filter("low <> high").select("h", "seg", "key")
    total = mixed.count()
    contents = mixed.groupBy("h", "seg").agg(F.count("*").alias("c"), F.min("key").alias("key"))
    several = contents.groupBy("h").agg(F.count("*").alias("d"))
    edges = join_hot(contents, several, "h", "d", total).select(
        "key", "h", "seg", "d", F.when(F.col("c") == 1, EDGE).otherwise(SHOWN).alias("kind"))
    again = join_hot(mixed, contents.filter("c > 1").select("h", "seg", "c"), ["h", "seg"], "c", total).select("key", "h", "seg")
    full = shared.filter("low = high").select("key", "h", "seg").unionByName(again).select(
        "key", "h", "seg", F.lit(0).cast("long").alias("d"), F.lit(FULL).alias("kind"))
    marks = edges.unionByName(full).groupBy("key").agg(F.collect_list(F.struct("h", "seg", "d", "kind")).alias("marks"))
    copies = texts.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("leader"))
    marks = written(marks.join(copies, "key"), "marks")
    joined = join_hot(texts, marks, "key", "n", rows, "left").withColumn("leads", F.col("doc_id").eqNullSafe(F.col("leader")))
    worked = written(_worked(joined, length), "repeats")
    pieces = worked.filter(F.size("pieces") > 0).select("key", F.explode("pieces").alias("p")).select("key", "p.*")
    size = pieces.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    found = _indexed(pieces.filter(F.col("d") <= most), max(1, -(-size // shard_bytes)), length) \
        .unionByName(_by_window(pieces.filter(F.col("d") > most), length))
    more = found.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("more"))

    def finish(batches):
        for batch in batches:
            out, kept = [], []
            for raw, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "more"))):
                spans = _merged([(s["start"], s["end"]) for s in [*a, *(b or ())]])
                out.append([{"start": s, "end": e} for s, e in spans])
                kept.append(_digest(raw.encode(), spans))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(out, SPAN_TYPE), pa.array(kept, pa.string())],
                                             ["doc_id", "n_bytes", "spans", "kept_sha256"])

    result = ["doc_id", "n_bytes", "spans", "kept_sha256"]
    # A text that waits for the index holds a segment of its own, so its key is one row.
    waiting = worked.filter("text is not null").select("key", "doc_id", "text", "n_bytes", "spans").join(more, "key", "left")
    return worked.filter("text is null").select(*result).unionByName(
        waiting.mapInArrow(finish, f"doc_id long, n_bytes long, spans {SPANS}, kept_sha256 string"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing every repeated 200-byte string leaves of every document."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
