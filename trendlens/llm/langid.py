"""Language identification: known words first, then ever shorter character n-grams.

The model has log frequencies by language of words and of character n-grams (lengths 5 to 1, with
marks at the word's ends).  A word of the model scores each language by its log frequency; an
unseen word by the mean over its n-grams of the greatest length at which the model knows any.
A text's language has the greatest sum over its words plus the language's log prior.

Every labelled language is learned.  The classifier is fitted on a bounded sample of labelled rows
(``sample_docs`` by hash of the id, shared out evenly over the languages, ``LEAST_DOCS`` a language
at least; documented parameter).  Only (entry, language) pairs that occur are kept, as sparse rows:
``max_words`` and ``max_grams`` pairs over all languages, each language's most frequent ones down to
a rank that is the same for all, so what a small vocabulary doesn't need goes to the larger ones.
That bounds what is broadcast, apart from one number a language and order.  Every text is read and
scored whole.

Defined results: ``und`` with score 0 if the text is null or has no letter, or nothing was learned;
a text whose words share nothing with the model gets the most frequent language; ties go to the
first in order; a null doc_id is neither learned from nor held out; repeated rows each get a row;
other columns are dropped, so names can't clash.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SAMPLE_DOCS = 20_000
LEAST_DOCS = 20
MAX_WORDS = 400_000
MAX_GRAMS = 400_000
LONGEST = 5
HELD = 300_000  # unseen words a task remembers
SLICE = 65_536  # words summed at a time
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"\x02{word}\x03"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _most(counts: DataFrame, key: str, most: int) -> pa.Table:
    """(lang, key, c) down to the greatest rank within the languages that keeps ``most`` rows in all."""
    sizes = np.array([r[0] for r in counts.groupBy("lang").agg(F.count("*")).select("count(1)").collect()])
    low, high = 1, max(most, 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if np.minimum(sizes, middle).sum() <= most else (low, middle - 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), key))
    return counts.withColumn("_r", rank).filter(F.col("_r") <= low).select("lang", key, "c").toArrow()


class Model:
    """Log frequencies by language as sparse rows, found by word or n-gram.

    Row i holds ``value[start[i]:start[i + 1]]`` for the languages ``column[...]``: how far the log
    frequency lies above ``base[0]`` (words) or ``base[1]`` (n-grams), the smoothed log frequency of
    an entry that a language doesn't have.
    """

    def __init__(self, langs: list[str], docs: list[int], words: pa.Table | None = None, grams: pa.Table | None = None):
        self.langs = langs
        self.prior = np.log(np.array(docs, float) / max(1, sum(docs)))
        self.words, *w = self._rows(words, "word", langs)
        self.grams, *g = self._rows(grams, "gram", langs)
        self.grams = {k: v + len(self.words) for k, v in self.grams.items()}
        self.base = np.stack((w[0], g[0]))
        self.start = np.concatenate((w[1], w[1][-1] + g[1][1:]))
        self.column, self.value = np.concatenate((w[2], g[2])), np.concatenate((w[3], g[3]))

    @staticmethod
    def _rows(entries: pa.Table | None, key: str, langs: list[str]) -> tuple:
        if entries is None or not len(entries):
            return {}, np.zeros(len(langs)), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
        entries = entries.combine_chunks().sort_by([(key, "ascending"), ("lang", "ascending")])
        held = entries[key].combine_chunks().dictionary_encode()
        row, c = held.indices.to_numpy(), entries["c"].to_numpy().astype(float)
        at = {x: i for i, x in enumerate(langs)}
        column = np.array([at[x] for x in entries["lang"].to_pylist()], np.int32)
        total = np.bincount(column, c, len(langs)) + 0.5 * len(held.dictionary)
        start = np.concatenate(([0], np.cumsum(np.bincount(row))))
        return ({k: i for i, k in enumerate(held.dictionary.to_pylist())}, np.log(0.5 / total), start, column,
                np.log((c + 0.5) / 0.5).astype(np.float32))

    def unseen(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows of words that the model doesn't have, the means over their longest known
        n-grams: whether any is known, row sizes, columns, values."""
        ids, owner, some = [], [], np.zeros(len(words))
        for i, word in enumerate(words):
            for n in range(min(LONGEST, len(word) + 2), 0, -1):
                found = [x for g in grams_of(word, n) if (x := self.grams.get(g)) is not None]
                if found:
                    ids += found
                    owner += [i] * len(found)
                    some[i] = len(found)
                    break
        at, times = spread(self.start, np.array(ids, np.int64))
        owner = np.repeat(np.array(owner, np.int64), times)
        cell, inverse = np.unique(owner * len(self.langs) + self.column[at], return_inverse=True)
        mean = np.bincount(inverse, self.value[at] / some[owner], len(cell))
        return some > 0, np.bincount(cell // len(self.langs), minlength=len(words)), cell % len(self.langs), mean


def spread(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of sparse ``rows``, one row after another, and how many each has."""
    times = start[rows + 1] - start[rows]
    ahead = np.cumsum(times) - times
    return np.repeat(start[rows] - ahead, times) + np.arange(times.sum()), times


class Rows:
    """The model's rows and, after them, those of the unseen words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        m = self.model
        self.known: dict[str, int] = dict(m.words)
        self.start, self.column, self.value = m.start, m.column, m.value
        # Which base a row lies above: words, n-grams, or none (nothing shared with the model).
        self.kind = np.repeat(np.array([0, 1], np.int8), [len(m.words), len(m.grams)])

    def learn(self, words: list[str]) -> None:
        some, sizes, column, value = self.model.unseen(words)
        self.known.update(zip(words, range(len(self.kind), len(self.kind) + len(words))))
        self.kind = np.concatenate((self.kind, np.where(some, 1, 2).astype(np.int8)))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(sizes)))
        self.column = np.concatenate((self.column, column.astype(np.int32)))
        self.value = np.concatenate((self.value, value.astype(np.float32)))

    def totals(self, lists: list[list[str]]) -> np.ndarray:
        """The languages' log scores of each list of words, one row a list."""
        m, n = len(lists), len(self.model.langs)
        rows = np.array([self.known[w] for own in lists for w in own], np.int64)
        owner = np.repeat(np.arange(m), [len(own) for own in lists])
        kind = self.kind[rows]
        out = np.tile(self.model.prior, (m, 1))
        for k in (0, 1):
            out += np.bincount(owner[kind == k], minlength=m)[:, None] * self.model.base[k]
        for begin in range(0, len(rows), SLICE):
            at, times = spread(self.start, rows[begin:begin + SLICE])
            cell = np.repeat(owner[begin:begin + SLICE], times) * n + self.column[at]
            out += np.bincount(cell, self.value[at], m * n).reshape(m, n)
        return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS,
          max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Fit on the labelled rows that aren't held out."""
    labelled = docs.select("doc_id", F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # A row a language: the model has a number for each on the driver and in every task anyway.
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    n = {r["lang"]: r["n"] for r in sizes.collect()}
    if not n:
        return Model([], [])
    langs = sorted(n)
    most = max(sample_docs / len(langs), LEAST_DOCS)
    shares = docs.sparkSession.createDataFrame([(x, int(min(1.0, most / n[x]) * (1 << 30))) for x in langs], "lang string, share long")
    sample = labelled.join(F.broadcast(shares), "lang").filter(
        F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) < F.col("share"))

    def count_words(batches):
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for code, x in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found[code].update(words_of(x.as_py()))
            rows = [(code, w, c) for code, held in found.items() for w, c in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[], [], []], (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "c"])

    def count_grams(batches):
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for code, w, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "word", "c"))):
                for k in range(1, LONGEST + 1):
                    for g in grams_of(w, k):
                        found[code][g] += c
            rows = [(code, g, c) for code, held in found.items() for g, c in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[], [], []], (pa.string(), pa.string(), pa.int64()))], ["lang", "gram", "c"])

    words = written(sample.select("lang", "text").mapInArrow(count_words, "lang string, word string, c long")
                    .groupBy("lang", "word").agg(F.sum("c").alias("c")), "langid-words")
    grams = words.mapInArrow(count_grams, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    grams = written(grams, "langid-grams")
    return Model(langs, [n[k] for k in langs], _most(words, "word", max_words), _most(grams, "gram", max_grams))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; nothing but the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        rows = Rows(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = [x or "" for x in part.column("_text").to_pylist()]
                lists = [words_of(x) for x in texts]
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
                if model.langs:
                    if len(rows.known) > len(model.words) + HELD:
                        rows.forget()
                    rows.learn(list(dict.fromkeys(w for own in lists for w in own if w not in rows.known)))
                    total = rows.totals(lists)
                    best = total.argmax(1)
                    likely = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                    for i, x in enumerate(texts):
                        if any(map(str.isalpha, x)):
                            pred[i], score[i] = model.langs[best[i]], likely[i]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs)).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                                             "lang_pred", F.round("score", 6).alias("score"))
