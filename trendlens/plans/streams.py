"""Streaming queries over the driver tables replayed as file streams.

Each call drains a table with an ``availableNow`` trigger into a uniquely named
running aggregate and returns the counters in its state.  Tags of an event:
``event_type|k`` (k from the JSON props), split on the pipe like video tags.
For the per-region counts, documents are the events, ``lang`` is the region and
``source`` the category.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.topk import order_by_count_desc
from ..session import new_scratch_path
from ..sources.tables import read_table
from ..streaming import running as S
from .registry import register


def _events_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    ev = S.read_table_stream(spark, sf_dir, "events", schema)
    return ev.withColumn("tags", F.concat_ws("|", "event_type",
                                             F.get_json_object("props", "$.k")))


def _run(spark, df, prefix):
    name = S.unique_name(prefix)
    S.drain(S.start_running_query(df, name, available_now=True))
    return S.snapshot(spark, name)


@register("running_counts_by_type", "T1 S5 S7 S8", """
SELECT event_type, count(*) AS count FROM events GROUP BY event_type
""")
def q_running_counts_by_type(spark, sf_dir):
    counts = S.running_counts_by_category(_events_stream(spark, sf_dir), "event_type", keys=[])
    return order_by_count_desc(_run(spark, counts, "running_by_type"), ["event_type"])


@register("running_counts_by_tag", "T2 G1 S7 S8", """
SELECT tag, count(*) AS count
FROM (SELECT unnest(string_split(concat_ws('|', event_type, json_extract_string(props, '$.k')), '|')) AS tag
      FROM events)
GROUP BY tag
""")
def q_running_counts_by_tag(spark, sf_dir):
    counts = S.running_counts_by_tag(_events_stream(spark, sf_dir), "tags", keys=[])
    return order_by_count_desc(_run(spark, counts, "running_by_tag"), ["tag"])


@register("running_top_k", "T4 O3", """
SELECT tag, count(*) AS count
FROM (SELECT unnest(string_split(concat_ws('|', event_type, json_extract_string(props, '$.k')), '|')) AS tag
      FROM events)
GROUP BY tag ORDER BY count DESC, tag LIMIT 10
""")
def q_running_top_k(spark, sf_dir):
    counts = S.running_counts_by_tag(_events_stream(spark, sf_dir), "tags", keys=[])
    return S.running_top_k(_run(spark, counts, "running_top_k"), "tag", 10)


def _by_region(spark, sf_dir, prefix):
    schema = read_table(spark, sf_dir, "documents").schema
    docs = S.read_table_stream(spark, sf_dir, "documents", schema)
    events = docs.select(F.col("lang").alias("region"), F.col("source").alias("categoryTitle"))
    return _run(spark, S.running_counts_by_category(events), prefix)


@register("running_counts_by_region", "T1 T3 S12", """
SELECT lang AS region, source AS "categoryTitle", count(*) AS count FROM documents GROUP BY ALL
""")
def q_running_counts_by_region(spark, sf_dir):
    return _by_region(spark, sf_dir, "running_by_region")


@register("running_top_k_by_region", "T3 T4", """
SELECT region, "categoryTitle", count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY count DESC, "categoryTitle") AS INTEGER) AS rank
  FROM (SELECT lang AS region, source AS "categoryTitle", count(*) AS count FROM documents GROUP BY ALL))
WHERE rank <= 3
""")
def q_running_top_k_by_region(spark, sf_dir):
    return S.running_top_k(_by_region(spark, sf_dir, "running_top_by_region"), "categoryTitle", 3, keys=["region"])


@register("stopped_streams", "S7 S8 S9", """
SELECT event_type, count(*) AS count, true AS stopped FROM events GROUP BY event_type
""")
def q_stopped_streams(spark, sf_dir):
    """A query on a timer that has seen everything, stopped with all others: its counters stay readable."""
    counts = S.running_counts_by_category(_events_stream(spark, sf_dir), "event_type", keys=[])
    name = S.unique_name("stopped")
    query = S.start_running_query(counts, name, trigger="1 second")
    query.processAllAvailable()
    stopped = S.stop_all(spark) >= 1 and not query.isActive
    return S.snapshot(spark, name).select("event_type", "count", F.lit(stopped).alias("stopped"))


@register("counters_changed", "S8 T1", """
SELECT event_type, CAST(1 AS BIGINT) AS batch_id, count(*) AS count FROM events
WHERE event_type IN (SELECT event_type FROM events WHERE event_id % 3 = 0 AND event_type <> (SELECT min(event_type) FROM events)) GROUP BY event_type
UNION ALL SELECT event_type, 0, count(*) FROM events WHERE event_id % 3 <> 0 OR event_type = (SELECT min(event_type) FROM events) GROUP BY event_type
""")
def q_counters_changed(spark, sf_dir):
    """Events in two micro-batches, the second without the first type: each batch's change log
    holds the counters that it moved and no others."""
    events = read_table(spark, sf_dir, "events")
    second = (F.col("event_id") % 3 == 0) & (F.col("event_type") != events.agg(F.min("event_type")).scalar())
    path = new_scratch_path(spark, "arriving")
    for part in (~second, second):
        events.where(part).coalesce(1).write.mode("append").parquet(path)
    stream = S.read_file_stream(spark, path, "part-*", events.schema, max_files_per_trigger=1)
    name = S.unique_name("changed")
    S.drain(S.start_running_query(S.running_counts_by_category(stream, "event_type", keys=[]), name, available_now=True))
    return S.changes(spark, name, 0)
