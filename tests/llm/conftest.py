import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing further columns."""
    long = "".join(f"Zeile {i} the of and {i * 7919 % 1000} wort\n" for i in range(4000))
    texts = [None, "", "  \n ", "a", "the cat sat on the mat. " * 30, "the cat sat on the mat. " * 30, long,
             "mail joe.doe@example.com or +1 (389) 555-5010 from 10.1.2.3 card 4111 1111 1111 1111", "x" * 5000, "中文 字符 é" * 40]
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, "s", 7, "fp", True, 1) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (2, "another text under the same id", "de", "s", 1, "fp", False, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, kept boolean, k int")
