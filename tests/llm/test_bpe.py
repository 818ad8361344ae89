import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from trendlens.llm import bpe


def expected(rows):
    enc = bpe.encoder(bpe.default_ranks())
    return sorted(((r.doc_id, tuple(enc.encode_ordinary(r.text or ""))) for r in rows), key=repr)


def test_small_chunks_give_the_same_ids_and_bytes(odd, documents):
    docs = odd.select("doc_id", "text").union(documents.select("doc_id", "text"))
    ids = bpe.encode(docs, ["doc_id"], chunk_chars=64, overlap_chars=16)
    back = bpe.decode(ids, ["doc_id"]).collect()
    assert sorted(((r.doc_id, tuple(r.ids)) for r in back), key=repr) == expected(docs.collect())
    texts = sorted((r.text or "").encode() for r in docs.collect())
    assert sorted(bytes(r.decoded) for r in back) == texts


def test_empty_table_and_digests(spark, odd):
    assert bpe.encode(odd.limit(0), ["doc_id"]).count() == 0
    rows = {r.doc_id: r for r in bpe.op3_bpe(spark, "/root/testdata/sf0.001").collect()}
    enc = bpe.encoder(bpe.default_ranks())
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect():
        ids = enc.encode_ordinary(d.text)
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 1'rel\n\t.é中 s"), max_size=120), st.integers(8, 30), st.integers(4, 12))
def test_stitched_cuts_are_boundaries_of_the_whole(text, chunk, overlap):
    """The rule of the two Spark steps, on one text."""
    find = bpe._pattern().finditer
    whole = {m.start() for m in find(text)}
    tail = None
    for start in range(0, max(len(text), 1), chunk):
        part = text[start:start + chunk + overlap]
        cut = len(part) == chunk + overlap
        at = [m.start() for m in find(part)]
        at = [p for p in at if p and not part[p - 1].isspace() and not (cut and p >= len(part) - 3)]
        if tail is not None:
            both = set(tail) & {start + p for p in at if p < overlap}
            if both:
                assert min(both) in whole
        tail = [start + p for p in at if p >= chunk]
