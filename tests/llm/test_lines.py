import random

from trendlens.llm import lines


def brute(rows, min_words=lines.MIN_WORDS):
    """Rows in rank order; (removed spans, text left) of each."""
    seen, out = set(), []
    for _, text in rows:
        units = lines.units_of(text or "")
        gone = set()
        for i, (_, _, norm, words) in enumerate(units):
            if words and norm in seen:
                gone.add(i)
            seen.add(norm)
        cut = [(units[a][0], units[b - 1][1]) for a, b in lines.runs(units, gone, min_words)]
        out.append((tuple(cut), lines.without(text, cut) if cut else text))
    return out


def check(docs):
    rows = sorted(((r.doc_id is None, r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0], r[1] or 0))
    got = [(r.doc_id, tuple((s.start, s.end) for s in r._u_spans), r._u_text) for r in lines.dedup_units(docs, ["doc_id"]).collect()]
    assert sorted(got, key=repr) == sorted(((d, *x) for (_, d, _), x in zip(rows, brute([r[1:] for r in rows]))), key=repr)


def test_documents_equal_brute_force(documents):
    check(documents)


def test_units_cover_the_text():
    text = "A b. C d e f! g h i j\n\n  \nK. l m n o? p"
    units = lines.units_of(text)
    assert "".join(text[a:b] for a, b, _, _ in units) == text
    assert [u[2] for u in units] == ["a b. c d e f!", "g h i j", "", "k. l m n o?", "p"]
    assert lines.units_of("") == []


def test_repeats_inside_and_across_texts(spark):
    passage = "One two three four five six. Seven eight nine ten eleven twelve."
    rows = [(2, f"Own words stand here first. {passage} And others stand after it."), (1, passage), (5, "Short line."), (6, "Short line."), (7, "a\n\n" + passage.upper())]
    got = {r.doc_id: r for r in lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"]).collect()}
    assert got[1]._u_text == passage and not got[1]._u_spans
    assert got[2]._u_text == "Own words stand here first. And others stand after it."
    assert [got[2].text[s.start:s.end] for s in got[2]._u_spans] == [passage + " "]
    assert got[5]._u_text == got[6]._u_text == "Short line."
    assert got[7]._u_text == "a\n\n"


def test_odd_rows(odd):
    got = lines.dedup_units(odd, odd.columns)
    assert got.count() == odd.count() and got.columns[:len(odd.columns)] == odd.columns
    copies = [r._u_text for r in got.filter("text like 'the cat%'").collect()]
    assert sum(bool(t) for t in copies) == 1  # the first row, of four alike
    assert {(r.text, r._u_text) for r in got.filter("trim(coalesce(text, '')) = ''").collect()} >= {(None, None), ("", "")}
    assert lines.dedup_units(odd.limit(0), ["doc_id"]).count() == 0


def test_passages_from_mid_sentence_to_mid_sentence(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(5000)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows, passages = [], {}
    for i in range(40):
        # The passage lies inside one sentence of each text, or crosses the ends of sentences.
        passage = prose(60) if i % 2 else f"{prose(20)}. {prose(20).title()}. {prose(20)}"
        passages[1000 + i] = passage
        rows += [(i, f"{prose(30)} {passage.lower()} {prose(30)}."), (1000 + i, f"{prose(25)} {passage} {prose(25)}.")]
    got = lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"]).collect()
    share = []
    for r in got:
        if r.doc_id < 1000:
            assert r._u_text == r.text
            continue
        at = r.text.index(passages[r.doc_id])
        assert all(at <= s.start and s.end <= at + len(passages[r.doc_id]) + 1 for s in r._u_spans)
        share.append(sum(s.end - s.start for s in r._u_spans) / len(passages[r.doc_id]))
    assert min(share) > 0.4 and sum(share) / len(share) > 0.7


def test_short_runs_inside_sentences_stay(spark):
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ale", "ine", "orm", "ust", "ake")]
    common = " ".join(words[:9])
    rows = [(0, f"{' '.join(words[10:22])} {common} {' '.join(words[30:39])}."), (1, f"other people say that {common} and then go on in their own way.")]
    got = {r.doc_id: r._u_text for r in lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got == dict(rows)
    assert lines.runs([(0, 9, "", 5), (9, 20, "", -6), (20, 30, "", 8)], {0, 1}, 5) == [(0, 1)]
    assert lines.runs([(0, 9, "", -4), (9, 20, "", -6), (20, 30, "", 8)], {1}, 5) == []
    assert lines.runs([(0, 9, "", -4), (9, 20, "", -6), (20, 30, "", -6), (30, 40, "", 4)], {1, 2}, 5) == [(1, 3)]


def test_short_lines_go_whatever_their_length(spark):
    rows = [(1, "les.\nOwn words of the first text."), (2, "Other words of the second one.\nles.\nAnd more.\n"), (3, "les.\n \nles.\nThird text goes on. les.")]
    got = {r.doc_id: r._u_text for r in lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got == {1: rows[0][1], 2: "Other words of the second one.\nAnd more.\n", 3: " \nThird text goes on. les."}


def test_scripts_without_blanks_and_unbroken_lines(spark):
    draw = random.Random(5)
    han = lambda n: "".join(chr(draw.randint(0x4E00, 0x9FA0)) for _ in range(n))
    thai = lambda n: "".join(chr(draw.choice([*range(0xE01, 0xE31), 0xE48, 0xE34])) for _ in range(n))
    whole, code, middle, siam = han(40) + "。", "a1b2" * 30, han(120), thai(150)
    rows = [(1, whole), (2, whole), (3, code), (4, code), (5, han(30) + middle + han(30)), (6, han(30) + middle + han(30)),
            (7, f"{han(30)}。{whole}{han(30)}。"), (8, thai(40) + siam + thai(40)), (9, thai(40) + siam + thai(40))]
    got = {r.doc_id: r._u_text for r in lines.dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    text = dict(rows)
    assert [got[i] == text[i] for i in (1, 3, 5, 8)] == [True] * 4 and got[2] == got[4] == ""
    assert got[7] == text[7].replace(whole, "")
    for i, part in ((6, middle), (9, siam)):
        assert len(text[i]) - len(part) <= len(got[i]) < len(text[i]) - 0.5 * len(part)
        assert got[i][:20] == text[i][:20] and got[i][-20:] == text[i][-20:]
