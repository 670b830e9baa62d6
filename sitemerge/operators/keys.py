"""KEY-ID: dense surrogate ids for new rows, without a single-partition step.

A global ``row_number()`` over the whole set moves every row into one task
(``Exchange SinglePartition``).  Instead:

1. range-partition the rows by the id order and sort each partition;
2. record partition index and position (``spark_partition_id``,
   ``monotonically_increasing_id``, whose lower 33 bits are the record number
   inside the partition) and write that once (parquet under the checkpoint
   folder), so the sampled range bounds cannot change between the passes;
3. count rows per partition (one small row per partition to the driver) and
   turn the counts into starting offsets;
4. id = start + offset of the partition + position inside it + 1, with the
   offsets as one literal (as many numbers as partitions), so that the result is a
   projection of the written rows and need not be written again.

Rows are compared by their first order column, and by the others only where that one
ties.  A table's first column is its site, so nearly all rows tie; ``leading`` puts one
number that follows the order of site and source key before it.

The result equals ``start + row_number() OVER (ORDER BY order_cols)`` when the
order is total (it is: new rows are distinct over all ordered columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_LOW33 = (1 << 33) - 1


def max_id(state: DataFrame, id_col: str) -> int:
    """Largest id in use (0 for an empty table); one number to the driver."""
    row = state.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def leading(df: DataFrame, order_cols: list[str]) -> list[Column]:
    """One number that never falls in the order of the first two columns, NULLs first;
    nothing where these are not whole numbers."""
    head = order_cols[:2]
    if len(head) < 2 or not all(isinstance(df.schema[c].dataType, T.IntegralType) for c in head):
        return []
    site, key = (F.col(c).cast("long") for c in head)
    far, half = F.lit(1 << 15), F.lit((1 << 46) - 1)
    within = F.when(key.isNull(), -half - 1).otherwise(F.greatest(F.least(key, half), -half))
    return [F.when(site > far, F.lit((1 << 63) - 1)).when(site < -far, F.lit(-(1 << 63)))
            .otherwise(site * F.lit(1 << 47) + within)]


def assign_ids(
    df: DataFrame,
    id_col: str,
    order_cols: list[str],
    start: int = 0,
    dtype: T.DataType = T.IntegerType(),
    partitions: int | None = None,
) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c.asc_nulls_first() for c in [*leading(df, order_cols), *map(F.col, order_cols)]]
    staged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    )
    staged = materialize(staged, f"ids-{id_col}")
    counts = sorted(
        (r["_pid"], r["count"]) for r in staged.groupBy("_pid").count().collect()
    )
    offsets, running = {}, start
    for pid, cnt in counts:
        offsets[pid] = running
        running += cnt
    every = ",".join(str(offsets.get(pid, 0)) for pid in range(max(offsets, default=0) + 1))
    off = F.get(F.split(F.lit(every), ",").cast("array<bigint>"), F.col("_pid"))
    return staged.withColumn(id_col, (off + F.col("_pos") + 1).cast(dtype)).drop("_pid", "_pos")
