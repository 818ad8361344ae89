"""Global order statistics without a single-task window.

``cumulative_before`` gives each row the total weight of all rows ahead of it
in a global order.  It is the building block for frequency-ranked label
indexes.  A window with ORDER BY but no PARTITION BY would pull every row into
one task; instead:

1. range-partition and sort (distributed, sampled boundaries),
2. checkpoint to the shared folder so partition ids are fixed,
3. per-partition totals (one row per partition) -> running offsets,
4. a running sum over each stored partition as it streams by (no shuffle),
5. add the broadcast offsets (one row per partition: a proven bound).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

PID = "_tl_pid"


def cumulative_before(df: DataFrame, order: list[Column], weight: str | None = None,
                      out: str = "cum_before", partitions: int | None = None,
                      total_out: str | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 per row if None) over rows strictly ahead.

    ``order`` must be a total order (add a tie-break column) for the result to
    be deterministic.  ``total_out`` also adds the total weight of all rows
    (from the per-partition totals, no extra pass over the data).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    w = F.col(weight) if weight else F.lit(1).cast("long")
    staged = df.withColumn("_tl_w", w)
    ranged = (staged.repartitionByRange(partitions, *order) if partitions
              else staged.repartitionByRange(*order))
    ordered = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = ordered.withColumn(PID, F.spark_partition_id())

    totals = tagged.groupBy(PID).agg(F.sum("_tl_w").alias("_tl_tot"))
    before_parts = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(PID, F.coalesce(F.sum("_tl_tot").over(before_parts),
                                            F.lit(0)).alias("_tl_off"),
                            F.sum("_tl_tot").over(Window.partitionBy()).alias("_tl_all"))

    schema = T.StructType(tagged.schema.fields + [T.StructField("_tl_local", T.LongType())])

    def running(batches):
        seen = 0   # weight of the partition's rows so far; its rows are in order
        for batch in batches:
            w = batch.column("_tl_w").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seen + np.cumsum(w) - w, pa.int64())],
                                             [*batch.schema.names, "_tl_local"])
            seen += int(w.sum())

    with_local = tagged.mapInArrow(running, schema)
    res = (with_local.join(F.broadcast(offsets), PID)   # one row per partition: bounded
           .withColumn(out, (F.col("_tl_off") + F.col("_tl_local")).cast("long")))
    if total_out:
        res = res.withColumn(total_out, F.col("_tl_all").cast("long"))
    return res.drop(PID, "_tl_w", "_tl_off", "_tl_local", "_tl_all")
