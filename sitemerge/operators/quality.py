"""Data-quality checks: the table constraints of the ODS, as Spark jobs.

The source database enforces primary keys, foreign keys, text widths and
number ranges on write; parquet enforces none of them, so these checks run on
new rows or whole states.  Each is one scan plus, where needed, one
aggregation or anti-join: no result is collected, so they run at any size.

* ``check_pk``     keys with a NULL part or occurring more than once;
* ``check_fk``     non-null references without a parent row (``left_anti``);
* ``check_length`` text longer than its declared width;
* ``check_range``  values a narrowing cast would reject or round;
* ``key_clashes``  the same source key in both sites;
* ``ambiguous``    lookup keys matching more than one reference row;
* ``dropped``      source rows an inner lookup loses.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.targets import Table
from .joins import GROWS
from .joins import dropped  # noqa: F401  (re-exported: Q-DROP)


def check_pk(df: DataFrame, cols: list[str]) -> DataFrame:
    """Primary-key violations: one row per offending key with its count and
    ``problem`` ('null' when a key part is NULL, else 'duplicate')."""
    any_null = reduce(or_, [F.col(c).isNull() for c in cols])
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(any_null | (F.col("n") > 1))
        .withColumn("problem", F.when(any_null, F.lit("null")).otherwise(F.lit("duplicate")))
    )


def check_fk(child: DataFrame, cols: list[str], parent: DataFrame, parent_cols: list[str]) -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    refs = child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)])
    cond = [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(cols)]
    return refs.join(keys.hint(GROWS), cond, "left_anti")


def _width_cols(table: Table) -> list[tuple[str, int]]:
    return [(c.name, c.width) for c in table.cols if c.width]


def check_length(df: DataFrame, table: Table) -> DataFrame:
    """Per width-limited column: the longest value and how many exceed the
    width (one pass, one partial aggregation)."""
    cols = _width_cols(table)
    aggs = []
    for name, width in cols:
        length = F.length(F.col(name))
        aggs += [
            F.max(length).alias(f"{name}__max"),
            F.sum(F.when(length > width, 1).otherwise(0)).alias(f"{name}__over"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.lit(width).alias("width"),
            F.col(f"{name}__max").cast("int").alias("max_length"),
            F.coalesce(F.col(f"{name}__over"), F.lit(0)).cast("long").alias("over_width"),
        )
        for name, width in cols
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_range(df: DataFrame, source: str, items: list[tuple[str, T.DataType]]) -> DataFrame:
    """For each (column, target type): values in total, values the cast
    rejects (out of range) and values it changes (rounded)."""
    aggs = []
    for name, dtype in items:
        col = F.col(name)
        cast = col.try_cast(dtype)
        aggs += [
            F.count(col).alias(f"{name}__n"),
            F.sum(F.when(col.isNotNull() & cast.isNull(), 1).otherwise(0)).alias(f"{name}__out"),
            F.sum(F.when(cast.isNotNull() & (cast != col), 1).otherwise(0)).alias(f"{name}__rnd"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(source).alias("source"),
            F.lit(name).alias("column_name"),
            F.lit(dtype.simpleString()).alias("target_type"),
            F.col(f"{name}__n").cast("long").alias("n_values"),
            F.coalesce(F.col(f"{name}__out"), F.lit(0)).cast("long").alias("out_of_range"),
            F.coalesce(F.col(f"{name}__rnd"), F.lit(0)).cast("long").alias("rounded"),
        )
        for name, dtype in items
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def key_clashes(a: DataFrame, a_key: Column, b: DataFrame, b_key: Column) -> DataFrame:
    """Distinct source keys present in both sites (they match each other's
    rows, as the loads compare the key without the site)."""
    left = a.select(a_key.alias("orig_key")).where(F.col("orig_key").isNotNull()).distinct()
    right = b.select(b_key.alias("orig_key")).distinct()
    return left.join(right.hint(GROWS), "orig_key", "left_semi")


def ambiguous(ref: DataFrame, key_cols: list[str], id_col: str) -> DataFrame:
    """Lookup keys with more than one reference row: one row per key with
    the number of matches and the smallest and largest id."""
    return (
        ref.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in key_cols]))
        .groupBy(*key_cols)
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.min(id_col).alias("min_id"),
            F.max(id_col).alias("max_id"),
        )
        .where(F.col("matches") > 1)
    )
