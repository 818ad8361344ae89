"""Quality rules: text statistics and n-gram perplexity under a modified Kneser-Ney model.

The model is over the characters of whole texts (order 5; a run of white space is one blank), so
n-grams run on from word to word: tables of word n-grams would outgrow the corpus on open
vocabularies, while characters have few contexts and every text is judged alike.  No two characters
share a symbol: rarer scripts' code points are two symbols each.  Spark counts the n-grams of every
text for each language; lower orders hold continuation counts; each language's order has three
discounts from its own counts of counts.  Probabilities are interpolated from the lowest order up, as tables.
Where a count is 1, the text that is judged is all that speaks for the n-gram: it is left out and
scored as unseen, by its context's back-off weight, or else unheard-of texts would look familiar.

Every n-gram of every text has been counted, so the tables end in one log probability for each
(language, n-gram), back-off included.  For scoring they become sorted hash arrays: 64-bit hashes in
order and their values, as many as were counted.  An array holds ``HELD`` entries at most; a larger
model is dealt by hash into several arrays, each a pass over the texts, and a text's sums are added.

A language's band is the median of its documents' log perplexity per character and ``spread`` robust
deviations (the quartiles' distance over 1.349, ``least`` at least) on either side, so its width is the
language's own; documents outside are rejected, as are those that break the base rules.

Defined results: null and empty texts have no words and fail the base rules; null languages form
one group; repeated rows each get a row; an empty table gives no rows; carried columns keep their
names, which must not begin with ``_q_`` as the operator's own do.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot, table, written

ORDER = 5
BITS = 12  # a symbol's bits in a packed n-gram
LEAD = 3800  # code points from here on are two symbols
PIECE = 1 << 20  # characters worked on at once
COUNTS_HELD = 1 << 22  # distinct n-grams of a piece that a task holds before it merges them
HELD = 1 << 24  # entries of a hash array, 12 bytes each
BLANK = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_stats(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text and its words."""
    chars = len(text) - sum(map(text.count, BLANK))
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = np.zeros(len(words) + 3, bool)
        at = np.array([i for i, w in enumerate(windows) if times[w] > 1])
        for k in range(3):
            covered[at + k] = True
        repeated = int(covered.sum())
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def pieces(rows: Iterator[tuple]) -> Iterator[tuple[list, list[str]]]:
    """(key, words) rows as lists of keys and pieces of about ``PIECE`` characters together: four borders or
    the four characters before, then the text's characters, one border at its end."""
    keys, parts, size = [], [], 0
    for key, words in rows:
        if not words:
            continue
        text = b" ".join(words).decode("utf-8", "replace") + "\n"
        before = "\n" * (ORDER - 1)
        for at in range(0, len(text), PIECE):
            keys.append(key)
            parts.append(before + text[at:at + PIECE])
            before = text[at + PIECE - ORDER + 1:at + PIECE]
            size += len(parts[-1])
            if size >= PIECE:
                yield keys, parts
                keys, parts, size = [], [], 0
    if keys:
        yield keys, parts


def packed_grams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends in each character of each piece but for its first four, packed in 60
    bits, and the number of n-grams of each piece.  Symbol 0 is a text's border."""
    size = np.array([len(x) for x in parts])
    cp = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
    own = np.ones(len(cp), bool)
    begins = np.cumsum(size) - size
    for k in range(ORDER - 1):
        own[begins + k] = False
    piece = np.repeat(np.arange(len(size)), size)
    symbol = np.where(cp == 10, 0, cp + 1)
    wide = cp >= LEAD
    if wide.any():
        times = 1 + wide
        first = np.cumsum(times) - times
        symbol, own, piece = (np.repeat(x, times) for x in (symbol, own, piece))
        symbol[first[wide]] = LEAD + 1 + (cp[wide] >> BITS)
        symbol[first[wide] + 1] = cp[wide] & ((1 << BITS) - 1)
    gram = symbol.copy()
    for k in range(1, ORDER):
        gram[k:] |= symbol[:-k] << (BITS * k)
    return gram[own], np.bincount(piece[own], minlength=len(size))


def hashed(lang: np.ndarray | int, gram: np.ndarray) -> np.ndarray:
    """64-bit hashes of (language, n-gram)."""
    x = gram.astype(np.uint64) ^ (np.atleast_1d(lang).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lang_id(lang: str | None) -> int:
    return zlib.crc32((lang or "").encode())


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(gram)
    gram = gram[order]
    first = np.nonzero(np.concatenate(([True], gram[1:] != gram[:-1])))[0]
    return gram[first], np.add.reduceat(n[order], first)


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, c): counts of the highest order over all texts."""
    def run(batches):
        held: dict[int, list] = defaultdict(list)

        def rows():
            for batch in batches:
                for code, x in zip(batch.column("_lang").to_pylist(), batch.column("_text")):
                    yield lang_id(code), (x.as_py() or "").encode().split()

        def flush(least: int):
            """Merge what is held; give it out if it is still ``least`` or more."""
            for key, counts in held.items():
                held[key] = [merged(counts)]
            if sum(len(x[0][0]) for x in held.values()) >= least:
                for key, [(gram, n)] in held.items():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), key)), pa.array(gram), pa.array(n)], ["lang", "gram", "c"])
                held.clear()

        for keys, parts in pieces(rows()):
            gram, size = packed_grams(parts)
            code = np.repeat(np.array(keys), size)
            for key in set(keys):
                held[key].append(np.unique(gram[code == key], return_counts=True))
            if sum(len(g) for x in held.values() for g, _ in x) > COUNTS_HELD:
                yield from flush(COUNTS_HELD // 2)
        yield from flush(1)

    return docs.select(F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text")) \
        .mapInArrow(run, "lang long, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, n, d): each language's number of n-grams and its three discounts."""
    n = [F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]
    y = F.when((n[0] > 0) & (n[1] > 0), F.try_divide(n[0], n[0] + 2 * n[1])).otherwise(0.5)
    d = [F.least(F.greatest(i - (i + 1) * y * F.coalesce(F.try_divide(n[i], n[i - 1]), F.lit(1.0)), F.lit(0.1)), F.lit(i - 0.1)) for i in (1, 2, 3)]
    return counts.groupBy("lang").agg(F.count("*").alias("n"), F.array(*d).alias("d"))


def kneser_ney(grams: DataFrame) -> DataFrame:
    """(lang, gram, v): the interpolated log probability of every n-gram of the highest order, or
    the one it backs off to if it was counted once."""
    level = {ORDER: written(grams, "kn-counts")}
    for k in range(ORDER - 1, 0, -1):
        level[k] = written(level[k + 1].groupBy("lang", F.col("gram").bitwiseAND((1 << BITS * k) - 1).alias("gram")).agg(
            F.count("*").alias("c")), f"kn-counts-{k}")
    below = None
    for k in range(1, ORDER + 1):
        own = written(discounts(level[k]), "kn-discounts")
        total = own.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        rows = join_hot(level[k], own, "lang", "n", total).select(
            "lang", "gram", "c", F.shiftright("gram", BITS).alias("context"), F.get("d", F.least("c", F.lit(3)).cast("int") - 1).alias("cut"))
        rows = written(rows, f"kn-rows-{k}")
        context = rows.groupBy("lang", "context").agg(F.sum("c").alias("s"), (F.sum("cut") / F.sum("c")).alias("g"))
        rows = rows.join(context, ["lang", "context"])
        if below is None:
            rows = rows.withColumns({"p0": F.lit(1.0 / (1 << BITS)), "v0": F.log(F.lit(1.0 / (1 << BITS)))})
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND((1 << BITS * (k - 1)) - 1)).join(
                below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p0"), F.col("v").alias("v0")), ["lang", "suffix"])
        p = (F.col("c") - F.col("cut")) / F.col("s") + F.col("g") * F.col("p0")
        below = written(rows.select("lang", "gram", p.alias("p"), F.when(F.col("c") > 1, F.log(p)).otherwise(F.log("g") + F.col("v0")).alias("v")), f"kn-{k}")
    return below.select("lang", "gram", "v")


def hash_array(rows: DataFrame, part: int = 0, parts: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and values of a model, or of the part of it that has this remainder."""
    def run(batches):
        for b in batches:
            key = hashed(b.column("lang").to_numpy(), b.column("gram").to_numpy())
            own = key % np.uint64(parts) == part
            yield pa.RecordBatch.from_arrays([pa.array(key[own].view(np.int64)), pa.array(b.column("v").to_numpy()[own].astype(np.float32))], ["key", "v"])

    got = rows.mapInArrow(run, "key long, v float").toArrow()
    key, v = got.column("key").to_numpy().view(np.uint64), got.column("v").to_numpy()
    order = np.argsort(key)
    return key[order], v[order]


def log_sums(array: tuple, codes: list[int], words: list[list[bytes]]) -> np.ndarray:
    """For each text the sum of the log probabilities that the array holds of its n-grams."""
    keys, values = array
    out = np.zeros(len(words))
    if not len(keys):
        return out
    for rows, parts in pieces(enumerate(words)):
        gram, size = packed_grams(parts)
        code = np.repeat(np.array([codes[r] for r in rows]), size)
        found = np.zeros(len(gram))
        for key in set(code.tolist()):
            own = code == key
            uniq, back = np.unique(gram[own], return_inverse=True)
            h = hashed(key, uniq)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found[own] = np.where(keys[at] == h, values[at], 0.0)[back]
        out += np.bincount(np.repeat(np.array(rows), size), found, len(out))
    return out


def score(docs: DataFrame, keep: list[str], spread, stats: bool = True) -> DataFrame:
    """``keep`` columns, ``_q_logp``, the sum over the broadcast array, and ``_q_lang`` and the statistics if asked for."""
    names = [f"_q_{s}" for s in STATS] if stats else []
    keep = [*keep, "_q_lang"] if stats else keep

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = [x or "" for x in part.column("_q_text").to_pylist()]
                words = [x.encode().split() for x in texts]
                sums = log_sums(spread.value, [lang_id(x) for x in part.column("_q_lang").to_pylist()], words)
                columns = list(zip(*map(text_stats, texts, words))) if stats else []
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), *(pa.array(c, pa.int64()) for c in columns), pa.array(sums)], [*keep, *names, "_q_logp"])

    schema = T.StructType([docs.schema[k] for k in keep] + [T.StructField(n, T.LongType()) for n in names] + [T.StructField("_q_logp", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, keep: list[str], model: DataFrame, held: int) -> DataFrame:
    """``score`` under the whole model, one pass over the texts for each ``held`` of its entries."""
    sc = docs.sparkSession.sparkContext
    parts = max(1, -(-model.count() // held))
    if parts > 1:
        docs = written(docs.withColumn("_q_row", F.monotonically_increasing_id()), "quality-rows")
    done = []
    for i in range(parts):
        spread = sc.broadcast(hash_array(model, i, parts))
        done.append(written(score(docs, [*([] if i else keep), *(["_q_row"] if parts > 1 else [])], spread, not i), "quality"))
        spread.unpersist()
    if parts == 1:
        return done[0]
    sums = functools.reduce(DataFrame.unionByName, [x.select("_q_row", "_q_logp") for x in done]).groupBy("_q_row").agg(F.sum("_q_logp").alias("_q_logp"))
    return written(done[0].drop("_q_logp").join(sums, "_q_row").drop("_q_row"), "quality")


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", spread: float = 6.0,
          least: float = 0.005, held: int = HELD) -> DataFrame:
    """``keep`` columns, statistics, ``_q_logppl`` (null without words), the band ``_q_low`` and ``_q_high``,
    ``_q_base_failed`` and ``_q_kept`` of every row."""
    model = kneser_ney(count_grams(docs, text, lang))
    rows = docs.select(*[F.col(f"`{k}`") for k in keep], F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("_q_lang"), F.col(f"`{text}`").alias("_q_text"))
    rows = scored(rows, keep, model, held)
    per_char = F.when(F.col("_q_n_words") > 0, -F.col("_q_logp") / (F.col("_q_word_chars") + F.col("_q_n_words")))
    rows = rows.withColumn("_q_logppl", per_char).drop("_q_logp")
    q = F.percentile_approx("_q_logppl", [0.25, 0.5, 0.75], 10000)
    bands = rows.groupBy("_q_lang").agg(F.count("*").alias("_q_n"), q.alias("_q_q"))
    width = spread * F.greatest((F.col("_q_q")[2] - F.col("_q_q")[0]) / 1.349, F.lit(least))
    bands = written(bands.select("_q_lang", "_q_n", (F.col("_q_q")[1] - width).alias("_q_low"), (F.col("_q_q")[1] + width).alias("_q_high")), "bands")
    total = bands.agg(F.coalesce(F.sum("_q_n"), F.lit(0))).first()[0]
    failed = (F.col("_q_n_words") < 50) | (100 * F.col("_q_n_repeat_words") > 50 * F.col("_q_n_words"))
    inside = F.coalesce(F.col("_q_logppl").between(F.col("_q_low"), F.col("_q_high")), F.lit(False))
    return join_hot(rows, bands, "_q_lang", "_q_n", total).withColumn("_q_base_failed", failed) \
        .withColumn("_q_kept", ~F.col("_q_base_failed") & inside)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    judged = judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", *(F.col(f"_q_{s}").alias(s) for s in STATS), F.col("_q_base_failed").alias("base_failed"),
                         F.col("_q_kept").alias("kept"), F.round("_q_logppl", 6).alias("log_perplexity"))
