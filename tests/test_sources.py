"""Readers: CSV records (H2, S1, S2), category JSON (S3, S4), requests."""

import json
import os

from trendlens.sources import (assignable_categories, drop_phantom, read_categories,
                               read_records, requests_to_df)

HEADER = ("video_id,title,publishedAt,channelId,channelTitle,categoryId,trending_date,tags,"
          "view_count,likes,dislikes,comment_count,thumbnail_link,comments_disabled,"
          "ratings_disabled,\n")


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_records_quotes_and_phantom(spark, tmp_dir):
    body = ('v1,"He said ""hi"", ok",2020-08-12T04:31:41Z,c1,Chan,10,20.13.08,a|b,100,5,1,2,'
            'http://x,False,False,\n'
            'v2,plain,2020-08-09T00:00:00Z,c2,Other,24,20.13.08,,0,0,0,0,http://y,True,False,\n')
    p = _write(os.path.join(tmp_dir, "CA.csv"), HEADER + body)
    df = read_records(spark, p, region="CA")
    assert "_c15" not in df.columns and "region" in df.columns
    rows = sorted(df.collect(), key=lambda r: r.video_id)
    assert rows[0].title == 'He said "hi", ok'
    assert rows[0].categoryId == 10 and rows[0].view_count == 100
    assert rows[0].comments_disabled is False and rows[1].comments_disabled is True
    assert rows[0].publishedAt.hour == 4


def test_drop_phantom_noop(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert drop_phantom(df).columns == ["a"]


CATS = {"items": [
    {"id": "10", "snippet": {"title": "Music", "assignable": True}},
    {"id": "1", "snippet": {"title": "Film", "assignable": True}},
    {"id": "2", "snippet": {"title": "Autos", "assignable": False}},
    {"id": "3", "snippet": {"title": "Shows"}},
    {"id": "30", "snippet": {"title": "Music", "assignable": True}},
    {"id": "x9", "snippet": {"title": "Odd", "assignable": True}},
    {"id": "44", "snippet": {"title": "Unused", "assignable": True}},
]}


def test_read_categories(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "cat.json"), json.dumps(CATS, indent=2))
    rows = read_categories(spark, p).collect()
    assert len(rows) == 7
    assert {(r.categoryId, r.categoryTitle) for r in rows} >= {(10, "Music"), (None, "Odd")}


def test_assignable_categories(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "cat.json"), json.dumps(CATS, indent=2))
    got = [(r.categoryTitle, r.categoryId) for r in assignable_categories(spark, p).collect()]
    # not assignable and missing flag are dropped; duplicate title keeps the last id
    assert got == [("Film", 1), ("Music", 30), ("Odd", None), ("Unused", 44)]


def test_category_join_keeps_unmatched(spark, tmp_dir):
    from trendlens.operators.joins import with_category
    p = _write(os.path.join(tmp_dir, "cat.json"), json.dumps(CATS, indent=2))
    dim = read_categories(spark, p).where("categoryId IS NOT NULL").dropDuplicates(["categoryId"])
    facts = spark.createDataFrame([(1,), (99,), (None,)], "categoryId int")
    got = sorted((r.categoryId or -1, r.categoryTitle or "") for r in with_category(facts, dim).collect())
    assert got == [(-1, ""), (1, "Film"), (99, "")]


def test_requests_to_df(spark):
    df = requests_to_df(spark, [(1, "CA", "Chan", "A title", "x|y", "Music", "2021-01-02 03:04:05")])
    assert df.count() == 1 and df.schema["request_id"].dataType.typeName() == "long"


def test_read_all_regions_and_land(spark, tmp_dir):
    from trendlens.sources.records import land_records, read_all_regions
    row = ('v{i},t{i},2020-08-12T04:31:41Z,c,Chan,10,20.13.08,a|b,100,5,1,2,http://x,False,False,\n')
    paths = {}
    for i, region in enumerate(["CA", "GB", "US"]):
        paths[region] = _write(os.path.join(tmp_dir, f"{region}.csv"), HEADER + row.format(i=i) * (i + 1))
    df = read_all_regions(spark, paths)
    assert {(r.region, r["count"]) for r in df.groupBy("region").count().collect()} == \
        {("CA", 1), ("GB", 2), ("US", 3)}
    out = os.path.join(tmp_dir, "landed")
    land_records(df.drop("_corrupt_record"), out)
    assert {d for d in os.listdir(out) if d.startswith("region=")} == \
        {"region=CA", "region=GB", "region=US"}
    back = spark.read.parquet(out).where("region = 'US'")
    assert back.count() == 3


def test_one_region_landed_again(spark, tmp_dir):
    from trendlens.sources import records as R
    rows = spark.createDataFrame([("a", 1, "US"), ("b", 2, "CA"), ("c", 3, "GB")], "video_id string, n int, region string")
    path = os.path.join(tmp_dir, "landed")
    R.land_records(rows, path)
    R.land_again(spark.createDataFrame([("x", 9, "CA"), ("y", 8, "FR")], rows.schema), path)
    R.land_again(rows.limit(0), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("video_id", "n", "region").collect()} == {("a", 1, "US"), ("x", 9, "CA"), ("c", 3, "GB"), ("y", 8, "FR")}


def test_rejects_are_landed_and_counted_in_one_pass(spark, tmp_dir):
    from pyspark.sql import types as T
    from trendlens.sources import records as R
    schema = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("likes", T.LongType())])
    path, out = os.path.join(tmp_dir, "in.csv"), os.path.join(tmp_dir, "out")
    with open(path, "w") as f:
        f.write("video_id,likes,\na,1,\nb,many,\n,3,\nc,4,\n")
    df = R.read_records(spark, path, region="US", schema=schema)
    seen = R.land_with_rejects(df, out, ["video_id"])
    assert seen == {"records": 4, "accepted": 2, "malformed": 1, "no video_id": 1}
    assert {(r.video_id, r.likes, r.region) for r in R.accepted(spark, out).collect()} == {("a", 1, "US"), ("c", 4, "US")}
    assert {(r.video_id, r.likes, r.reject_reason) for r in R.rejected(spark, out).collect()} == {("b", None, "malformed"), (None, 3, "no video_id")}
    assert R.rejected(spark, out).where("reject_reason = 'malformed'").first()[R.CORRUPT_COLUMN].startswith("b,many")
