"""Golden micro-cases for the column functions (FIXTURES.md section 5)."""

import datetime as dt

from pyspark.sql import functions as F

from trendlens.functions import columns as C
from trendlens.operators import clean, tags


def test_word_count_single_space(spark):
    df = spark.createDataFrame([("a  b ",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(C.word_count_single_space("t")).collect()]
    assert got == [4, 1, None]


def test_word_count_whitespace(spark):
    df = spark.createDataFrame([("  a \t b  ",), ("",), ("one",)], "t string")
    got = [r[0] for r in df.select(C.word_count_whitespace("t")).collect()]
    assert got == [2, 0, 1]


def test_explode_tags(spark):
    df = spark.createDataFrame([(1, "A|b| c"), (2, ""), (3, None), (4, "x||y")],
                               "id int, tags string")
    got = sorted((r.id, r.tag) for r in tags.explode_tags(df, keep=["id"]).collect())
    assert got == [(1, " c"), (1, "A"), (1, "b"), (2, ""), (4, ""), (4, "x"), (4, "y")]


def test_flag_typed_boolean(spark):
    df = spark.createDataFrame([(1, 10, True), (2, 10, False), (3, 10, None), (4, 0, False)],
                               "id int, view_count long, comments_disabled boolean")
    kept = [r.id for r in clean.clean_records(df).collect()]
    assert kept == [2]


def test_hour_and_day_of_week_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 8, 9, 4, 31, 41),)], "ts timestamp_ntz")
    r = df.select(C.time_part("ts", "hour").alias("h"),
                  C.time_part("ts", "dayofweek").alias("d")).first()
    assert (r.h, r.d) == (4, 1)  # 2020-08-09 is a Sunday


def test_hour_of_zoned_timestamp_follows_session_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    df = spark.sql("SELECT TIMESTAMP '2020-08-12 04:31:41Z' AS ts")
    assert df.select(C.time_part("ts", "hour")).first()[0] == 4


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(5, 0), (1, 3)], "a long, b long")
    got = [r[0] for r in df.select(C.ratio("a", "b", 2)).collect()]
    assert got == [None, 0.33]


def test_lower_all_null_array(spark):
    df = spark.createDataFrame([(None,), (["Hip Hop", "NONE"],)], "t array<string>")
    got = [r[0] for r in df.select(C.lower_all("t")).collect()]
    assert got == [[], ["hip hop", "none"]]


def test_drop_blank(spark):
    df = spark.createDataFrame([(["a", " ", "", "b"],)], "t array<string>")
    assert df.select(C.drop_blank("t")).first()[0] == ["a", "b"]


def test_parse_publish_time_bad_is_null(spark):
    df = spark.createDataFrame([("2021-03-04 05:06:07",), ("not a date",)], "s string")
    got = [r[0] for r in df.select(C.parse_publish_time("s")).collect()]
    assert got[0] is not None and got[1] is None


def test_decode_json_fixture(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("b", T.BooleanType())])
    rows = [('{"a":"x","n":1,"b":true}',), ('{"a":"x","n":"1"}',), ('{"a":"x","n":3000000000}',),
            ("garbage",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    got = [r[0] for r in df.select(C.decode_json("j", schema).alias("d")).collect()]
    assert tuple(got[0]) == ("x", 1, True)
    assert got[1].a == "x" and got[1].n is None
    assert got[2].a == "x" and got[2].n is None
    assert tuple(got[3]) == (None, None, None)
    assert got[4] is None


def test_top_tags_trim_lower_and_tiebreak(spark):
    df = spark.createDataFrame([("Music| music |Funny",), ("funny|zz|aa",)], "tags string")
    got = [(r.tag, r["count"]) for r in tags.top_tags(df, k=3).collect()]
    assert got == [("funny", 2), ("music", 2), ("aa", 1)]


def test_time_part_null(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp")
    assert df.select(C.time_part("ts", "year")).first()[0] is None
    assert F is not None
