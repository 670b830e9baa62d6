"""Joins of rows with repeated keys to a table of one row per key, heavy keys split.

``JOIN`` on a key brings all rows of a key into one task.  A few keys may hold a large
share of the rows (order ids that serve as line keys).  ``heavy_keys`` finds them by
a sketch: one pass over the key columns, combined in every task, a bounded result.
``join_one_per_key`` spreads the rows of heavy keys over salts by a hash of their
identity and gives the few matching rows of the other side once per salt.  The
sketch only steers the spread; the join's result does not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import GROWS

MOST = 64  # heavy keys at most; a key with a larger share than 1/64 of the rows is among them
TRACKED = 10_000  # keys the sketch follows


def heavy_keys(rows: DataFrame, keys: list[Column], share: float) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows with a key."""
    told = rows.select(F.xxhash64(*keys).alias("k"), *(k.isNotNull().alias(f"_{i}") for i, k in enumerate(keys)))
    told = told.where(" and ".join(f"_{i}" for i in range(len(keys))))
    r = told.agg(F.count(F.lit(1)).alias("n"),
                 F.expr(f"approx_top_k(k, {MOST}, {TRACKED})").alias("top")).first()
    return sorted(t["item"] for t in r["top"] or [] if t["count"] > max(1, share * r["n"]))


def join_one_per_key(rows: DataFrame, one: DataFrame, on: list[tuple[str, str]], heavy: list[int],
                     spread: list[str], salts: int, hint: str = GROWS) -> DataFrame:
    """Left join of ``rows`` to ``one`` (one row per key) on the column pairs; rows of
    heavy keys are spread over ``salts`` tasks by the columns ``spread``."""
    pairs, one = [F.col(a) == F.col(b) for a, b in on], one.hint(hint)
    if not heavy:
        return rows.join(one, pairs, "left")
    left = F.xxhash64(*(F.col(a) for a, _ in on)).isin(heavy)
    right = F.xxhash64(*(F.col(b) for _, b in on)).isin(heavy)
    rows = rows.withColumn("_salt", F.when(left, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    one = one.withColumn("_at", F.explode(F.when(right, every).otherwise(F.array(F.lit(0).cast("long"))))).hint(hint)
    return rows.join(one, [*pairs, F.col("_salt") == F.col("_at")], "left").drop("_salt", "_at")
