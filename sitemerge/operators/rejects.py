"""Rejects: rows whose values a target column can't hold, told apart with their reasons.

The source database fails a whole statement on a text beyond its declared width or a
number beyond its type; parquet stores the text, and Spark's cast ends the job.  Here such
rows are kept from the target and reported, and all others are loaded:

* ``width:<column>``  a text of more code points than the column is declared with;
* ``range:<column>``  a value that the cast to the column's stored type has no result for.

Rounding is no reason: the loads round by design, and ``check_range`` counts it.
Judging is a projection of each row by itself, so it needs no shuffle and a row's verdict
does not depend on others.  A NULL fits every column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.targets import Table


def reasons(values: Mapping[str, Column], table: Table) -> Column:
    """Why ``values`` (target column -> value) don't fit; an empty array if they do."""
    found = []
    for name, value in values.items():
        col = table.col(name)
        held = value.try_cast(col.stored)
        found.append(F.when(value.isNotNull() & held.isNull(), F.lit(f"range:{name}")))
        if col.width:
            found.append(F.when(F.length(held) > col.width, F.lit(f"width:{name}")))
    return F.array_compact(F.array(*found))


def judged(rows: DataFrame, values: Mapping[str, Column], table: Table) -> DataFrame:
    """The rows with their reasons as ``_why``."""
    return rows.withColumn("_why", reasons(values, table))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("_why") == 0).drop("_why")


def refused(rows: DataFrame, table: Table, statement: str, key: list[Column]) -> DataFrame:
    """The report of the rows that don't fit; ``row_text`` is the whole row as JSON."""
    whole = F.to_json(F.struct(*(c for c in rows.columns if c != "_why")))
    text = F.concat_ws("|", *(F.coalesce(k.cast("string"), F.lit("NULL")) for k in key))
    return rows.where(F.size("_why") > 0).select(
        F.lit(table.name).alias("table_name"), F.lit(statement).alias("statement"), text.alias("key_text"),
        F.array_sort("_why").alias("reasons"), whole.alias("row_text"))


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows; how many of them fit and how many don't is known once they are written."""
    seen = Observation(name)
    fits = F.size("_why") == 0
    return rows.observe(seen, F.count(F.when(fits, 1)).alias("accepted"),
                        F.count(F.when(~fits, 1)).alias("rejected")), seen
