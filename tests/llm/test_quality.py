import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from trendlens.llm import quality


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if times[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def symbols(text):
    """A text's symbols: its words with one blank between, and a border."""
    out = []
    for x in map(ord, " ".join(re.findall(r"[^\x20\x09-\x0D]+", text))):
        out += [x + 1] if x < quality.LEAD else [quality.LEAD + 1 + x // 4096, x % 4096]
    return out + [0]


class KneserNey:
    """The model written out over tuples of symbols."""

    def __init__(self, texts, order=quality.ORDER):
        self.order = order
        top = Counter(g for x in texts for g in self.grams(x))
        self.c = {order: top}
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.s, self.g = {}, {}, {}
        for k, c in self.c.items():
            n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
            self.d[k] = [min(max(i - (i + 1) * y * (n[i] / n[i - 1] if n[i - 1] else 1), 0.1), i - 0.1) for i in (1, 2, 3)]
            self.s[k], self.g[k] = Counter(), defaultdict(float)
            for g, v in c.items():
                self.s[k][g[:-1]] += v
                self.g[k][g[:-1]] += self.d[k][min(v, 3) - 1]

    def grams(self, text):
        if not text.split():
            return []
        s = [0] * (self.order - 1) + symbols(text)
        return [tuple(s[i:i + self.order]) for i in range(len(s) - self.order + 1)]

    def p(self, g):
        if not g:
            return 1 / (1 << quality.BITS)
        k, v = len(g), self.c[len(g)].get(g, 0)
        if not self.s[k][g[:-1]]:
            return self.p(g[1:])
        cut = self.d[k][min(v, 3) - 1] if v else 0
        return (v - cut + self.g[k][g[:-1]] * self.p(g[1:])) / self.s[k][g[:-1]]

    def score(self, g):
        """An n-gram that was counted once is scored as unseen."""
        if not g or self.c[len(g)].get(g, 0) > 1:
            return self.p(g)
        total = self.s[len(g)][g[:-1]]
        return (self.g[len(g)][g[:-1]] / total if total else 1) * self.score(g[1:])

    def text(self, x):
        return sum(math.log(self.score(g)) for g in self.grams(x))


def check_against_brute_force(docs, **options):
    """Statistics and perplexity of every row, each language with its own model."""
    rows = docs.select("text", "lang").collect()
    model = {lang: KneserNey([r.text or "" for r in rows if (r.lang or "") == lang]) for lang in {r.lang or "" for r in rows}}
    got = quality.judge(docs, ["doc_id", "text"], **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[f"_q_{s}"] for s in quality.STATS) == brute_stats(r.text)
        assert r._q_base_failed == (r._q_n_words < 50 or 100 * r._q_n_repeat_words > 50 * r._q_n_words)
        if not r._q_n_words:
            assert r._q_logppl is None
            continue
        expected = -model[r._q_lang].text(r.text) / (r._q_word_chars + r._q_n_words)
        assert abs(expected - r._q_logppl) < 1e-4
    return got


def test_statistics_and_perplexity_equal_brute_force(documents):
    docs = documents.filter("lang = 'de'").union(documents.filter("lang = 'de'").limit(1)).withColumn("_n", F.lit(1))
    got = check_against_brute_force(docs)
    lp = sorted(r._q_logppl for r in got)
    q1, middle, q3 = (lp[math.ceil(q * len(lp)) - 1] for q in (0.25, 0.5, 0.75))
    width = 6 * max((q3 - q1) / 1.349, 0.005)
    for r in got:
        assert r._q_kept == (not r._q_base_failed and middle - width <= r._q_logppl <= middle + width)


def test_languages_scripts_and_parts_of_the_model(spark):
    """Each language has its own discounts; no code points share a symbol; dealing the model out changes nothing."""
    texts = ["The cat sat on the mat. The cat ran.", "the mat sat on a cat", "", None, "Die Katze saß auf der Matte.", "die Matte",
             "中文字符 和 文字 中文字符", "文字 中文", "\U0001F600 a \U0001F601 a", "a\x00b a\x00b"]
    langs = ["en", "en", "en", "en", "de", "de", "zh", "zh", None, None]
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string")
    whole = {r.doc_id: r for r in check_against_brute_force(docs)}
    parts = {r.doc_id: r for r in check_against_brute_force(docs, held=40)}
    assert whole.keys() == parts.keys()
    for i, r in whole.items():
        assert (r._q_logppl is None) == (parts[i]._q_logppl is None)
        assert r._q_logppl is None or abs(r._q_logppl - parts[i]._q_logppl) < 1e-6


def test_probabilities_sum_to_one():
    model = KneserNey(["abba abba abc", "cab"], order=3)
    a, b, c = (ord(x) + 1 for x in "abc")
    for context in [(0, 0), (a, b), (c, c)]:
        assert abs(sum(model.p((*context, x)) for x in range(1 << quality.BITS)) - 1) < 1e-9


def test_packed_grams_run_over_words_and_pieces(monkeypatch):
    texts = ["ab é中 \U0001F600" * 3, "x", "", "long " * 30]
    words = [x.encode().split() for x in texts]
    unpack = lambda g: tuple(int(g) >> 12 * k & 4095 for k in range(4, -1, -1))
    expected = [KneserNey([x]).grams(x) for x in texts]
    for size in (1 << 20, 7, 5):
        monkeypatch.setattr(quality, "PIECE", size)
        got = [[] for _ in texts]
        for keys, parts in quality.pieces(enumerate(words)):
            gram, n = quality.packed_grams(parts)
            for key, own in zip(keys, np.split(gram, np.cumsum(n)[:-1])):
                got[key] += [unpack(g) for g in own]
        assert got == expected


def test_junk_goes_and_clean_texts_stay(spark, documents):
    rng = np.random.default_rng(2)
    junk = spark.createDataFrame([(-1, " ".join("".join(chr(33 + x) for x in rng.integers(0, 90, 9)) for _ in range(200)), "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(documents.select("doc_id", "text", "lang").union(junk), ["doc_id"]).collect()}
    assert not got[-1]._q_kept and not got[-1]._q_base_failed
    rest = [r for i, r in got.items() if i >= 0 and not r._q_base_failed]
    assert sum(r._q_kept for r in rest) >= 0.97 * len(rest)


def test_graded_junk(spark):
    """Random words among real ones and words of all languages go, clean texts stay; shuffled words stand out."""
    rnd = random.Random(7)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.where("length(text) between 400 and 8000").collect() if r.text]
    every = [w for r in rows for w in r.text.split()[:50]]
    noise = lambda of: "".join(rnd.choice(of) for _ in range(rnd.randint(3, 9)))
    letters, consonants = "abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"
    some = lambda t, share, of: " ".join(noise(of) if rnd.random() < share else w for w in t.split(" "))
    makes = {"tenth": lambda t: some(t, 0.1, consonants), "quarter": lambda t: some(t, 0.25, letters), "half": lambda t: some(t, 0.5, letters),
             "mixed": lambda t: " ".join(rnd.choice(every) for _ in t.split()), "shuffled": lambda t: " ".join(rnd.sample(t.split(), len(t.split())))}
    planted = [(10 ** 6 + i, make(r.text), r.lang, name) for i, (name, make, r) in enumerate(
        (name, make, rnd.choice(rows)) for name, make in makes.items() for _ in range(15))]
    both = docs.withColumn("kind", F.lit("clean")).union(spark.createDataFrame(planted, "doc_id long, text string, lang string, kind string"))
    judged = quality.judge(both, ["kind"]).filter("not _q_base_failed")
    off = (2 * F.col("_q_logppl") - F.col("_q_low") - F.col("_q_high")) / (F.col("_q_high") - F.col("_q_low"))   # 1 at the band's end
    got = judged.groupBy("kind").agg(F.avg(F.col("_q_kept").cast("int")).alias("share"), F.median(off).alias("off"))
    got = {r.kind: r for r in got.collect()}
    kept = {k: r.share for k, r in got.items()}
    assert kept["clean"] >= 0.97 and abs(got["clean"].off) < 0.1 and got["shuffled"].off > 0.3   # the order of words counts
    assert kept["half"] == 0 and kept["quarter"] <= 0.1 and kept["mixed"] <= 0.1 and kept["tenth"] <= 0.7


def test_odd_rows(odd):
    got = quality.judge(odd, odd.columns)
    assert got.columns[0] == "_q_lang" and set(odd.columns) <= set(got.columns)
    rows = got.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert tuple(r[f"_q_{s}"] for s in quality.STATS) == brute_stats(r.text)
        assert r._q_n_words or (r._q_base_failed and not r._q_kept and r._q_logppl is None)
    assert quality.judge(odd.limit(0), ["doc_id"]).count() == 0


def test_hash_arrays_are_sorted_and_whole(spark):
    rows = spark.range(5000).selectExpr("id % 7 lang", "id gram", "-1.0D v")
    both = [quality.hash_array(rows, i, 3) for i in range(3)]
    assert all((np.diff(key.astype(object)) > 0).all() and (v == -1).all() for key, v in both)
    assert sum(len(key) for key, _ in both) == 5000 == len(quality.hash_array(rows)[0])
