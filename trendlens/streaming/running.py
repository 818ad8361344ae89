"""Running counts over an unbounded stream of trending-video events.

One stream carries every region (a ``region`` column derived from the topic),
instead of one copy of the job per region.  The aggregates are ordinary
``groupBy().count()`` on a streaming DataFrame: Spark keeps one counter per key
in the state store (use the RocksDB provider when keys are many) and shuffles
by key, so state is spread over tasks.

A running aggregate has no sink of its own: it runs in update mode into ``noop``
and its result is its state, which ``snapshot`` reads from the checkpoint as a
distributed DataFrame (the counters of the last committed batch).  Nothing is
gathered on the driver, however many keys there are.  ``sink="memory"`` (complete
mode) remains for an interactive look at a bounded key set.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import decode_json, split_pipe
from ..operators.rank import cumulative_before
from ..session import ensure_checkpoint_dir, scratch_path

# Payload of one event (15 nullable fields) and the topics' prefix: fixed values of the input.
EVENT_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("channelId", T.StringType()),
    T.StructField("channelTitle", T.StringType()),
    T.StructField("categoryTitle", T.StringType()),
    T.StructField("trending_date", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("dislikes", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("thumbnail_link", T.StringType()),
    T.StructField("comments_disabled", T.BooleanType()),
    T.StructField("ratings_disabled", T.BooleanType()),
])

TOPIC_PREFIX = "youtube_"


# ------------------------------------------------------------------ sources

def kafka_options(servers: str, regions: list[str], starting_offsets: str = "latest",
                  topic_prefix: str = TOPIC_PREFIX) -> dict[str, str]:
    """Options of one subscription to every region's topic."""
    return {"kafka.bootstrap.servers": servers,
            "subscribe": ",".join(f"{topic_prefix}{r}" for r in regions),
            "startingOffsets": starting_offsets}


def read_kafka_events(spark: SparkSession, servers: str, regions: list[str],
                      starting_offsets: str = "latest",
                      topic_prefix: str = TOPIC_PREFIX) -> DataFrame:
    """One Kafka subscription for all regions; ``region`` from the topic.

    Needs the spark-sql-kafka connector on the classpath.
    """
    options = kafka_options(servers, regions, starting_offsets, topic_prefix)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.withColumn("region", F.regexp_replace("topic", f"^{topic_prefix}", ""))


def read_file_stream(spark: SparkSession, directory: str, file_glob: str,
                     schema: T.StructType | None, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None,
                     region_from_dir: bool = False) -> DataFrame:
    """A file source (Parquet, or ``text`` with one JSON payload per line)
    standing in for the broker.

    With ``region_from_dir`` the files live under ``<directory>/<topic>/`` and
    ``region`` is taken from the topic folder name, as from a Kafka topic.
    """
    r = spark.readStream.format(fmt).option("pathGlobFilter", file_glob)
    if schema is not None:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(directory)
    if region_from_dir:
        topic = F.regexp_extract(F.input_file_name(), r"/([^/]+)/[^/]+$", 1)
        df = df.withColumn("region", F.regexp_replace(topic, f"^{TOPIC_PREFIX}", ""))
    return df


def read_table_stream(spark: SparkSession, base_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of a table ``<dir>/<name>.parquet``, one file or a folder of part files, as a stream.

    The path is a glob, since a file source takes a plain path for a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{base_dir.rstrip('/')}/{name}.parque[t]")


def decode_events(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA,
                  value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Bytes -> string -> struct -> columns, plus the ingest time.

    A payload that does not parse, or a field of the wrong type, gives NULLs
    rather than failing the stream.
    """
    keep = [c for c in (keep if keep is not None else ["region"]) if c in raw.columns]
    return (raw.select(*keep, decode_json(value_col, schema).alias("data"))
            .select(*keep, "data.*")
            .withColumn("ingestTime", F.current_timestamp()))


# --------------------------------------------------------------- aggregates

def _keys(df: DataFrame, keys: list[str] | None) -> list[str]:
    if keys is not None:
        return keys
    return ["region"] if "region" in df.columns else []


def running_counts(df: DataFrame, key: Column | str, name: str,
                   keys: list[str] | None = None) -> DataFrame:
    """Unbounded running count per (region, key)."""
    k = F.col(key) if isinstance(key, str) else key
    ks = _keys(df, keys)
    return df.groupBy(*ks, k.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def running_counts_by_category(events: DataFrame, col: str = "categoryTitle",
                               keys: list[str] | None = None) -> DataFrame:
    """T1."""
    return running_counts(events, col, col, keys)


def running_counts_by_tag(events: DataFrame, col: str = "tags",
                          keys: list[str] | None = None) -> DataFrame:
    """Raw pipe-split tags (no trim, no lower-case), as the stream counts them."""
    ks = _keys(events, keys)
    exploded = events.select(*ks, F.explode(split_pipe(col)).alias("tag"))
    return running_counts(exploded, "tag", "tag", ks)


# Spark keeps only the first k rows of a group on each task up to this k.
MOST_PER_KEY = 1000


def running_top_k(counts: DataFrame, key: str, k: int,
                  keys: list[str] | None = None) -> DataFrame:
    """T4: top k of a snapshot of running counts, within each of ``keys`` if given.

    Without ``keys`` per-task heaps of k rows are merged; with keys each task
    passes on its first k of each group, for k up to ``MOST_PER_KEY``.  Beyond that
    all rows are ranked in one distributed order, so no group meets in one task.
    """
    order = [F.col("count").desc(), F.col(key).asc()]
    if not keys:
        return counts.orderBy(*order).limit(k)
    if k > MOST_PER_KEY:
        ranked = cumulative_before(counts, [*[F.asc_nulls_first(c) for c in keys], *order], out="_tl_ahead")
        own = [f"_tl_k{i}" for i in range(len(keys))]
        starts = ranked.groupBy(*[F.col(c).alias(o) for c, o in zip(keys, own)]).agg(F.min("_tl_ahead").alias("_tl_start"))
        both = ranked.join(starts, [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(keys, own)])
        return both.withColumn("rank", (F.col("_tl_ahead") - F.col("_tl_start") + 1).cast("int")) \
            .where(F.col("rank") <= k).select(*counts.columns, "rank")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


# -------------------------------------------------------------------- sinks

def checkpoint_of(spark: SparkSession, name: str) -> str:
    """Where a named running query keeps its progress and state."""
    return scratch_path(spark, "streams", name, "checkpoint")


def start_running_query(df: DataFrame, name: str, trigger: str | None = "30 seconds",
                        available_now: bool = False, sink: str = "state",
                        checkpoint: str | None = None) -> StreamingQuery:
    """Start a running aggregate; ``snapshot`` reads its counters.

    ``sink='state'``: update mode; the result is the query's state.
    ``sink='memory'``: complete mode into an in-memory table ``name`` on the driver.
    """
    chk = checkpoint or checkpoint_of(df.sparkSession, name)
    if sink == "state":
        w = df.writeStream.outputMode("update").format("noop").queryName(name)
    elif sink == "memory":
        w = df.writeStream.outputMode("complete").format("memory").queryName(name)
    else:
        raise ValueError(f"unknown sink {sink}")
    w = w.option("checkpointLocation", chk)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def start_append(df: DataFrame, name: str, path: str, trigger: str | None = "30 seconds",
                 available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Append the rows of a stream without aggregates to Parquet files under ``path``.

    The file sink commits a micro-batch's files as one entry of its log, which
    readers of ``path`` follow, and the checkpoint holds the micro-batch's input;
    so after a failure or restart each row is there exactly once.
    """
    w = df.writeStream.outputMode("append").format("parquet").queryName(name).option(
        "checkpointLocation", checkpoint or checkpoint_of(df.sparkSession, name))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(path)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Block until an ``availableNow`` query has consumed everything."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query


def snapshot(spark: SparkSession, name: str, checkpoint: str | None = None) -> DataFrame:
    """The counters of a running query after its last committed batch, one row a key."""
    state = spark.read.format("statestore").load(checkpoint or checkpoint_of(spark, name))
    return state.select("key.*", F.col("value.count").alias("count"))


def changes(spark: SparkSession, name: str, first_batch: int, last_batch: int | None = None,
            checkpoint: str | None = None) -> DataFrame:
    """S8 between two looks: ``(keys, batch_id, count)`` of the counters that micro-batches
    ``first_batch`` to ``last_batch`` (default: the last) changed, as they were after each.

    Reads the state store's change log of those batches, not the whole state: a
    dashboard that looks every 10 s reads what moved since.  The log of a batch is
    there as long as Spark keeps its version (``spark.sql.streaming.minBatchesToRetain``).
    """
    r = spark.read.format("statestore").option("readChangeFeed", True).option("changeStartBatchId", first_batch)
    if last_batch is not None:
        r = r.option("changeEndBatchId", last_batch)
    feed = r.load(checkpoint or checkpoint_of(spark, name)).where("change_type <> 'delete'")
    return feed.select("key.*", F.col("batch_id").cast("long").alias("batch_id"), F.col("value.count").alias("count"))


def stop_all(spark: SparkSession) -> int:
    """Stop every active streaming query; returns how many were stopped."""
    active = list(spark.streams.active)
    for q in active:
        q.stop()
    return len(active)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


__all__ = ["EVENT_SCHEMA", "kafka_options", "read_kafka_events", "read_file_stream", "read_table_stream", "decode_events",
           "running_counts", "running_counts_by_category", "running_counts_by_tag",
           "running_top_k", "checkpoint_of", "start_running_query", "start_append", "drain", "snapshot", "changes", "stop_all",
           "unique_name", "ensure_checkpoint_dir"]
