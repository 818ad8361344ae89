"""Stream = batch, and restart from the checkpoint."""

import os

from pyspark.sql import functions as F

from trendlens.plans import streams
from trendlens.streaming import running as S

from .conftest import SF_SMALL


def _batch_counts(df, key):
    return {r[0]: r[1] for r in df.groupBy(key).count().collect()}


def _split_events(spark, tmp_dir, parts=3):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(tmp_dir, "src")
    for i in range(parts):
        ev.where(F.col("event_id") % parts == i).write.parquet(os.path.join(src, f"p{i}"))
    return ev, src


def test_stream_equals_batch_three_files(spark, tmp_dir):
    ev, src = _split_events(spark, tmp_dir)
    stream = S.read_file_stream(spark, src + "/*", "*.parquet", ev.schema, max_files_per_trigger=1)
    counts = S.running_counts_by_category(stream, "event_type", keys=[])
    name = S.unique_name("t_by_type")
    q = S.drain(S.start_running_query(counts, name, available_now=True,
                                      checkpoint=os.path.join(tmp_dir, "chk")))
    assert len(q.recentProgress) >= 3
    got = {r.event_type: r["count"] for r in S.snapshot(spark, name, os.path.join(tmp_dir, "chk")).collect()}
    assert got == _batch_counts(ev, "event_type")


def test_stream_restart_from_checkpoint(spark, tmp_dir):
    ev, src = _split_events(spark, tmp_dir, parts=2)
    chk = os.path.join(tmp_dir, "chk")
    stream = lambda: S.read_file_stream(spark, src + "/*", "*.parquet", ev.schema)
    tagged = lambda s: s.withColumn("tags", F.concat_ws("|", "event_type", F.lit("x")))
    n1 = S.unique_name("t_tag")
    S.drain(S.start_running_query(S.running_counts_by_tag(tagged(stream()), keys=[]), n1,
                                  available_now=True, checkpoint=chk))
    # new data arrives; the restarted query only reads the new file and keeps its state
    ev.write.parquet(os.path.join(src, "p9"))
    n2 = S.unique_name("t_tag")
    S.drain(S.start_running_query(S.running_counts_by_tag(tagged(stream()), keys=[]), n2,
                                  available_now=True, checkpoint=chk))
    got = {r.tag: r["count"] for r in S.snapshot(spark, n2, chk).collect()}
    assert got["x"] == 2 * ev.count()


def test_kafka_options_subscribe_to_every_region():
    assert S.kafka_options("h:9092", ["US", "CA"]) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "youtube_US,youtube_CA", "startingOffsets": "latest"}


def test_decode_events_bytes(spark):
    raw = spark.createDataFrame(
        [(bytearray(b'{"video_id":"v","tags":"a|b","view_count":5,"comments_disabled":false}'), "US"),
         (bytearray(b"garbage"), "CA")], "value binary, region string")
    dec = {r.region: r for r in S.decode_events(raw).collect()}
    assert dec["US"].video_id == "v" and dec["US"].view_count == 5
    assert dec["US"].comments_disabled is False and dec["US"].ingestTime is not None
    assert dec["CA"].video_id is None


def test_running_top_k_and_memory_sink(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = lambda: S.read_file_stream(spark, SF_SMALL, "events.parquet", ev.schema)
    counts = lambda: S.running_counts_by_category(stream(), "event_type", keys=[])
    name, table = S.unique_name("t_top"), S.unique_name("t_mem")
    S.drain(S.start_running_query(counts(), name, available_now=True))
    S.drain(S.start_running_query(counts(), table, available_now=True, sink="memory"))
    want = sorted(_batch_counts(ev, "event_type").items(), key=lambda kv: (-kv[1], kv[0]))
    top = S.running_top_k(S.snapshot(spark, name), "event_type", 2)
    assert [(r.event_type, r["count"]) for r in top.collect()] == want[:2]
    assert {(r.event_type, r["count"]) for r in spark.table(table).collect()} == set(want)


def test_top_k_within_keys(spark):
    counts = spark.createDataFrame([("US", "a", 3), ("US", "b", 3), ("US", "c", 9), ("CA", "z", 1)], "region string, tag string, count long")
    got = [(r.region, r.tag, r["rank"]) for r in S.running_top_k(counts, "tag", 2, ["region"]).orderBy("region", "rank").collect()]
    assert got == [("CA", "z", 1), ("US", "c", 1), ("US", "a", 2)]
    many = spark.range(4000).select(F.when(F.col("id") % 3 > 0, "US").alias("region"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("tag"),
                                    (F.col("id") % 50).alias("count"))
    k = S.MOST_PER_KEY + 100
    want = []
    for region in (None, "US"):
        rows = sorted(((r["count"], r.tag) for r in many.collect() if r.region == region), key=lambda x: (-x[0], x[1]))[:k]
        want += [(region, tag, n, i) for i, (n, tag) in enumerate(rows, 1)]
    assert {tuple(r) for r in S.running_top_k(many, "tag", k, ["region"]).collect()} == set(want) and len(want) == 1334 - 234 + 1100


def test_stop_all_stops_a_running_query(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    counts = S.running_counts_by_category(S.read_file_stream(spark, SF_SMALL, "events.parquet", ev.schema), "event_type", keys=[])
    q = S.start_running_query(counts, S.unique_name("t_stop"), trigger="1 second", checkpoint=os.path.join(tmp_dir, "chk"))
    assert q.isActive
    q.processAllAvailable()
    assert S.stop_all(spark) >= 1 and not q.isActive and S.stop_all(spark) == 0


def test_region_fan_out_from_topic_folders(spark, tmp_dir):
    """One stream for all regions; counts per (region, category) and tag."""
    import json
    payloads = {
        "US": [("Music", "a|b"), ("Music", "a"), ("Gaming", "x")],
        "CA": [("Music", "a|a"), (None, "")],
        "GB": [("Sports", "b")],
    }
    root = os.path.join(tmp_dir, "topics")
    for region, rows in payloads.items():
        d = os.path.join(root, f"youtube_{region}")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.txt"), "w") as f:
            for cat, tags in rows:
                f.write(json.dumps({"categoryTitle": cat, "tags": tags, "view_count": 1}) + "\n")
    raw = S.read_file_stream(spark, root + "/*", "*.txt", None, fmt="text", region_from_dir=True)
    events = S.decode_events(raw)
    by_cat, by_tag = S.unique_name("t_cat"), S.unique_name("t_tag")
    S.drain(S.start_running_query(S.running_counts_by_category(events), by_cat, available_now=True,
                                  checkpoint=os.path.join(tmp_dir, "c1")))
    S.drain(S.start_running_query(S.running_counts_by_tag(events), by_tag, available_now=True,
                                  checkpoint=os.path.join(tmp_dir, "c2")))
    cats = {(r.region, r.categoryTitle): r["count"] for r in S.snapshot(spark, by_cat, os.path.join(tmp_dir, "c1")).collect()}
    assert cats == {("US", "Music"): 2, ("US", "Gaming"): 1, ("CA", "Music"): 1,
                    ("CA", None): 1, ("GB", "Sports"): 1}
    state = S.snapshot(spark, by_tag, os.path.join(tmp_dir, "c2"))
    tags = {(r.region, r.tag): r["count"] for r in state.collect()}
    assert tags[("US", "a")] == 2 and tags[("CA", "a")] == 2 and tags[("CA", "")] == 1
    top = [(r.region, r.tag) for r in S.running_top_k(state, "tag", 1, keys=["region"]).orderBy("region").collect()]
    assert top == [("CA", "a"), ("GB", "b"), ("US", "a")]


def test_scores_of_arriving_requests_are_appended_once(spark, tmp_dir):
    """M15 on a stream: a restart from the checkpoint scores what is new, and nothing twice."""
    import json

    from trendlens.ml import models as M
    from trendlens.ml.features import FeatureSpec
    from trendlens.sources.requests import REQUEST_SCHEMA, requests_to_df
    rows = [(i, "US" if i % 2 else "CA", f"ch{i % 3}", f"title {i % 5}", "a|b", 1 + i % 2, f"2024-0{1 + i % 3}-05 10:00:00", 100 + i, 10 + i % 7, 3, i % 11, False) for i in range(120)]
    recs = spark.createDataFrame(rows, "video_id long, region string, channelTitle string, title string, tags string, categoryId int, publishedAt string, "
                                 "view_count long, likes long, dislikes long, comment_count long, comments_disabled boolean").withColumn("publishedAt", F.to_timestamp("publishedAt"))
    fitted = M.train_job(recs, spec=FeatureSpec(text=None, categorical=("publish_month_str",)))
    dim = spark.createDataFrame([("US", 1, "Music"), ("US", 2, "Games"), ("CA", 1, "Music"), ("CA", 2, "Games")], "region string, categoryId int, categoryTitle string")
    source, out, chk = (os.path.join(tmp_dir, x) for x in ("in", "out", "chk"))
    os.makedirs(source)

    def arrive(name, requests):
        with open(os.path.join(source, name), "w") as f:
            f.write("\n".join(requests) + "\n")

    def request(i, **other):
        return json.dumps({"request_id": i, "region": "US", "channel_title": "ch1", "title": "t", "tags": "a", "category_name": "Music", "publish_dt": "2024-02-05 10:00:00", **other})

    def run():
        raw = S.read_file_stream(spark, source, "*.txt", None, fmt="text", max_files_per_trigger=1)
        requests = requests_to_df(spark, S.decode_events(raw, REQUEST_SCHEMA, keep=[]))
        assert requests.isStreaming
        S.drain(S.start_append(M.score_stream(requests, fitted, dim), S.unique_name("t_scores"), out, available_now=True, checkpoint=chk))
        return spark.read.parquet(out).collect()

    arrive("1.txt", [request(1), request(2, region="CA"), request(3, category_name="No such")])
    arrive("2.txt", [request(4, publish_dt="yesterday"), request(5, region="MOON"), "garbage"])
    first = run()
    assert sorted(r.request_id or 0 for r in first) == [0, 1, 2, 3, 4, 5]
    assert run() == first or sorted(map(str, run())) == sorted(map(str, first))
    arrive("3.txt", [request(6), request(6)])
    again = run()
    assert sorted(r.request_id or 0 for r in again) == [0, 1, 2, 3, 4, 5, 6, 6]
    by_id = {r.request_id: r for r in again}
    assert by_id[1].error is None and by_id[1].pred_likes_ratio is not None and by_id[2].error is None
    assert by_id[3].error.startswith("unknown category") and by_id[4].error == "bad publish_dt" and by_id[3].pred_likes_ratio is None
    # the same rows as the batch job's
    table = requests_to_df(spark, [(1, "US", "ch1", "t", "a", "Music", "2024-02-05 10:00:00"), (2, "CA", "ch1", "t", "a", "Music", "2024-02-05 10:00:00")])
    batch = {r.request_id: r for r in M.score(table, fitted, dim).collect()}
    assert all(batch[i].pred_likes_ratio == by_id[i].pred_likes_ratio for i in (1, 2))


def test_changes_between_two_looks(spark, tmp_dir):
    ev = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "event_type string, n int")
    source, chk = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "chk")
    run = lambda: S.drain(S.start_running_query(S.running_counts_by_category(S.read_file_stream(spark, source, "part-*", ev.schema), "event_type", keys=[]),
                                                S.unique_name("t_changes"), available_now=True, checkpoint=chk))
    ev.where("n = 1").coalesce(1).write.mode("append").parquet(source)
    run()
    ev.where("n = 2").coalesce(1).write.mode("append").parquet(source)
    run()
    got = {(r.event_type, r.batch_id, r["count"]) for r in S.changes(spark, "", 1, checkpoint=chk).collect()}
    assert got == {("a", 1, 2)}
    assert {(r.event_type, r.batch_id) for r in S.changes(spark, "", 0, 0, checkpoint=chk).collect()} == {("a", 0), ("b", 0)}


def _folder_tables(spark, tmp_dir):
    """documents and events of eight rows each, as folders of two part files."""
    docs = spark.createDataFrame([(i, "en" if i < 5 else None, f"s{i % 4}") for i in range(8)], "doc_id long, lang string, source string")
    docs.repartition(2).write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    events = spark.createDataFrame([(i, f"t{i % 3}", '{"k": 1}') for i in range(8)], "event_id long, event_type string, props string")
    events.repartition(2).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    return docs, events


def test_running_counts_of_tables_that_are_folders(spark, tmp_dir):
    docs, events = _folder_tables(spark, tmp_dir)
    got = streams.q_running_counts_by_region(spark, tmp_dir).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in docs.groupBy("lang", "source").count().collect()} and len(got) == 7
    assert {tuple(r) for r in streams.q_running_counts_by_type(spark, tmp_dir).collect()} == set(_batch_counts(events, "event_type").items())


def test_running_top_k_by_region_of_a_folder(spark, tmp_dir):
    _folder_tables(spark, tmp_dir)
    got = {tuple(r) for r in streams.q_running_top_k_by_region(spark, tmp_dir).collect()}
    assert got == {("en", "s0", 2, 1), ("en", "s1", 1, 2), ("en", "s2", 1, 3), (None, "s1", 1, 1), (None, "s2", 1, 2), (None, "s3", 1, 3)}
