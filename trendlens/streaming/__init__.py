"""Structured Streaming: event decode and running counts."""

from .running import (EVENT_SCHEMA, read_kafka_events, read_file_stream, decode_events,
                      running_counts, running_counts_by_category, running_counts_by_tag,
                      running_top_k, start_running_query, snapshot, stop_all, drain)

__all__ = ["EVENT_SCHEMA", "read_kafka_events", "read_file_stream", "decode_events",
           "running_counts", "running_counts_by_category", "running_counts_by_tag",
           "running_top_k", "start_running_query", "snapshot", "stop_all", "drain"]
