import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trendlens.llm import langid


def test_held_out_accuracy_and_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.op6_langid(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_never_used(documents):
    """Changing the held-out rows' labels, and every source, changes nothing."""
    other = documents.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = (sorted(langid.predict(documents, langid.train(d)).collect()) for d in (documents, other))
    assert a == b


def test_words_first_then_shorter_grams():
    words = [{"lang": "a", "word": "foo", "c": 8}, {"lang": "b", "word": "bar", "c": 9}]
    grams = [{"lang": "a", "gram": "ba", "c": 5}, {"lang": "b", "gram": "z", "c": 5}, {"lang": "a", "gram": "z", "c": 1}]
    m = langid.Model(["a", "b"], [1, 1], pa.Table.from_pylist(words), pa.Table.from_pylist(grams))
    total = [8 + 1, 9 + 1]

    def row(base, sizes_columns_values):
        out = np.array(base)
        out[sizes_columns_values[1]] += sizes_columns_values[2]
        return out

    own = slice(m.start[m.words["foo"]], m.start[m.words["foo"] + 1])
    assert np.allclose(row(m.base[0], (1, m.column[own], m.value[own])), [np.log(8.5 / total[0]), np.log(0.5 / total[1])])

    def gram(g):
        own = slice(m.start[m.grams[g]], m.start[m.grams[g] + 1])
        return row(m.base[1], (1, m.column[own], m.value[own]))

    some, sizes, column, value = m.unseen(["baz", "zzz", "q"])
    ends = np.cumsum(sizes)
    assert some.tolist() == [True, True, False] and sizes[2] == 0
    assert np.allclose(row(m.base[1], (1, column[:ends[0]], value[:ends[0]])), gram("ba"))  # the longer one, not "z"
    assert np.allclose(row(m.base[1], (1, column[ends[0]:ends[1]], value[ends[0]:ends[1]])), gram("z"))


def brute(train: list[tuple], texts: list[str], rank: int | None = None) -> list[tuple]:
    """The method with dense dictionaries: (language, score) of each text."""
    langs = sorted({lang for lang, _ in train})
    docs = Counter(lang for lang, _ in train)
    tables = []
    for grams in (False, True):
        c = {x: Counter() for x in langs}
        for lang, text in train:
            for w in langid.words_of(text):
                c[lang].update([g for n in range(1, 6) for g in langid.grams_of(w, n)] if grams else [w])
        c = {x: dict(sorted(c[x].items(), key=lambda e: (-e[1], e[0]))[:rank]) for x in langs}
        entries = {e for x in langs for e in c[x]}
        total = {x: sum(c[x].values()) + 0.5 * len(entries) for x in langs}
        tables.append({e: [math.log((c[x].get(e, 0) + 0.5) / total[x]) for x in langs] for e in entries})
    out = []
    for text in texts:
        if not any(map(str.isalpha, text)):
            out.append(("und", 0.0))
            continue
        sums = [math.log(docs[x] / len(train)) for x in langs]
        for w in langid.words_of(text):
            rows = [tables[0][w]] if w in tables[0] else next(
                (found for n in range(min(5, len(w) + 2), 0, -1)
                 if (found := [tables[1][g] for g in langid.grams_of(w, n) if g in tables[1]])), [])
            sums = [s + sum(r[i] for r in rows) / max(1, len(rows)) for i, s in enumerate(sums)]
        best = max(range(len(langs)), key=lambda i: (sums[i], -i))
        out.append((langs[best], 1 / sum(math.exp(s - sums[best]) for s in sums)))
    return out


def test_equals_brute_force(documents):
    rows = documents.select("doc_id", "lang", "text").collect()
    train = [(r.lang, r.text) for r in rows if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    texts = [r.text or "" for r in rows]
    for rank in (None, 40):
        most = 10**7 if rank is None else rank * len({lang for lang, _ in train})
        model = langid.train(documents, sample_docs=10**7, max_words=most, max_grams=most)
        got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(documents, model).collect()}
        want = brute(train, texts, rank)
        assert [got[r.doc_id][0] for r in rows] == [w[0] for w in want]
        assert np.allclose([got[r.doc_id][1] for r in rows], [w[1] for w in want], atol=1e-3)


def test_every_language_is_learned(spark):
    """Hundreds of languages, each with words of its own; small vocabularies leave room to the larger."""
    def name(i):
        return chr(97 + i // 26) + chr(97 + i % 26)

    rows = [(i, f"l{i % 400:03}", f"x{name(i % 400)}q x{name(i % 400)}z" if i % 400 else " ".join(f"u{name(j)}v" for j in range(500)))
            for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs, max_words=399 * 2 + 300, max_grams=10**6)
    assert len(model.langs) == 400
    assert len(model.words) == 399 * 2 + 300
    assert all(r.lang_pred == rows[r.doc_id][1] for r in langid.predict(docs, model).collect())


def test_odd_rows(odd, documents, spark):
    model = langid.train(documents)
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in langid.predict(odd, model).collect()}
    assert langid.predict(odd, model).count() == odd.count()
    assert (0, "und", False) in got and (1, "und", False) in got and (2, "und", False) in got
    cjk = langid.predict(spark.createDataFrame([(1, "中文 字符"), (2, "²³ 12 _"), (3, "ª")], "doc_id long, text string"), model).collect()
    assert [r.lang_pred == "und" for r in sorted(cjk)] == [False, True, False]
    assert langid.predict(odd.limit(0), model).count() == 0
    nothing = langid.train(odd.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
