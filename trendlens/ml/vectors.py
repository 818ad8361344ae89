"""Vector access for long-format output, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_entries(col) -> Column:
    """``array<struct<index int, value double>>`` of the non-zero entries; NULL stays NULL.

    The vector type is unwrapped to its storage struct (type 0 = sparse with
    indices and values, type 1 = dense with values only).
    """
    v = F.unwrap_udt(F.col(col) if isinstance(col, str) else col)
    sparse = F.zip_with(v["indices"], v["values"], lambda i, x: F.struct(i.alias("index"), x.alias("value")))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("index"), x.alias("value")))
    return F.filter(F.when(v["type"] == 0, sparse).otherwise(dense), lambda e: e["value"] != 0)
