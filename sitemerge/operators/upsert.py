"""U-core (update changed rows) and N-core (insert new rows).

U-core
------
``UPDATE tgt SET ... FROM src JOIN tgt ON key WHERE NOT (a1 = b1 AND ...)``:
every target row whose key matches a source row with different tracked
values takes that source row's values and ``last_update = load_ts``.  When
several differing source rows match one target row the database picks any of
them; here the pick is deterministic: the smallest tuple of new values,
NULLs first.

Keys may repeat on both sides (one order id carrying many lines), so pairing
source and target rows per key could emit all pairs of a large group.  The
plan avoids that:

1. group source rows by (key, comparison tuple) -> one *class* per distinct
   comparison tuple with its smallest value tuple (partial aggregation);
2. per key keep the two smallest classes by ``row_number``, which Spark limits
   to two per key in each map task before the shuffle, so the classes of a hot
   key never meet in one task; the source is read once;
3. join the target to that one-row-per-key summary: a target row whose own
   comparison tuple equals the smallest class takes the second one, every
   other row the first.  No row fans out and no pair is built.

The state is rewritten in one pass (left join on the key plus ``when``), as
plain parquet has no row-level UPDATE.

N-core
------
Each insert arm yields candidate rows (already anti-joined against the target
and mapped to the insert columns).  The arms are unioned, one ``distinct``
removes duplicates over all columns (``UNION`` semantics, NULLs equal), ids
are assigned after the current maximum, and only then are the values cast to
the target types (so rows that differ only before a narrowing cast stay two
rows, as with ``INSERT ... SELECT DISTINCT``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import null_default
from ..sources.targets import Table
from .keys import assign_ids, max_id
from .skew import heavy_keys, join_one_per_key


@dataclass(frozen=True)
class Track:
    """One ``SET target = value`` with its change test ``src_cmp = tgt_cmp``."""

    target: str
    value: Column
    src_cmp: Column
    tgt_cmp: Column


def track(target: str, value, kind: str, src_cmp=None, tgt_cmp=None) -> Track:
    """Tracked column with null-default comparison of the given family.

    ``src_cmp``/``tgt_cmp`` override either side of the comparison for the
    few places where the loads compare something other than
    ``ISNULL(value, d) = ISNULL(target, d)``."""
    v = F.col(value) if isinstance(value, str) else value
    return Track(
        target,
        v,
        null_default(v, kind) if src_cmp is None else src_cmp,
        null_default(target, kind) if tgt_cmp is None else tgt_cmp,
    )


@dataclass(frozen=True)
class UpdateSpec:
    name: str
    source: DataFrame  # staging rows after enrich joins and gates
    match: list  # [(source expression, target column)]
    tracks: list[Track]
    null_keys: bool = False  # the target holds many rows without a key
    repeats: bool = False  # the target may hold a key any number of times
    joined: bool = False  # the source is gated by tables that grow


def _struct(cols: list[Column], prefix: str) -> Column:
    return F.struct(*[c.alias(f"{prefix}{i}") for i, c in enumerate(cols)])


def update_summary(spec: UpdateSpec) -> DataFrame:
    """Per match key: smallest class ``_f`` and smallest other class ``_s``."""
    keys = [f"_k{i}" for i in range(len(spec.match))]
    src = spec.source.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(k) for (e, _), k in zip(spec.match, keys)],
        _struct([t.value for t in spec.tracks], "v").alias("_v"),
        _struct([t.src_cmp for t in spec.tracks], "c").alias("_c"),
    ).where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    classes = src.groupBy(*keys, "_c").agg(F.min("_v").alias("_v"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_v", "_c"))
    two = classes.withColumn("_rank", rank).where(F.col("_rank") <= 2)
    return two.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_rank") == r, F.struct("_v", "_c"))).alias(name)
        for r, name in ((1, "_f"), (2, "_s"))
    ])


def state_heavy_keys(state: DataFrame, spec: UpdateSpec) -> list[int]:
    """Hashes of the update's heavy keys in the state, found if its keys may repeat there."""
    if not spec.repeats:
        return []
    salts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return heavy_keys(state, [F.col(t) for _, t in spec.match], share=1 / (4 * salts))


def apply_update(state: DataFrame, spec: UpdateSpec, table: Table, load_ts: Column,
                 heavy: list[int] | None = None) -> DataFrame:
    """The target state after one update statement.

    Columns of ``state`` beyond the table's own are carried along; ``_hit``, if it
    is there, turns true where the statement changes the row.  ``heavy``: the update's
    heavy keys, where they are known from a scan of the state."""
    extra = [c for c in state.columns if c not in table.names]
    summary = update_summary(spec)
    keys = [f"_k{i}" for i in range(len(spec.match))]
    # rows without a key match nothing: they go round the join, which would
    # send them all to one task
    keyless = None
    if spec.null_keys:
        has_key = reduce(and_, [F.col(tcol).isNotNull() for _, tcol in spec.match])
        keyless = state.where(~has_key)
        state = state.where(has_key)
    on = [(tcol, k) for (_, tcol), k in zip(spec.match, keys)]
    salts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if spec.repeats:
        # types as the join compares them, so that both sides hash alike
        types = {f.name: f.dataType for f in state.schema}
        summary = summary.select(*(F.col(k).cast(types[t]).alias(k) for t, k in on), "_f", "_s")
    if heavy is None:
        heavy = state_heavy_keys(state, spec)
    joined = join_one_per_key(state, summary, on, heavy, [table.id_col or table.pk[0]], salts)
    n = len(spec.tracks)
    target_in_first = reduce(
        and_, [spec.tracks[i].tgt_cmp.eqNullSafe(F.col(f"_f._c.c{i}")) for i in range(n)]
    )
    chosen = F.when(target_in_first, F.col("_s")).otherwise(F.col("_f"))
    joined = joined.withColumn("_pick", chosen)
    hit = F.col("_pick").isNotNull()
    new_vals = {
        t.target: F.when(hit, F.col(f"_pick._v.v{i}").cast(table.col(t.target).stored)).otherwise(
            F.col(t.target)
        )
        for i, t in enumerate(spec.tracks)
    }
    out = []
    for c in table.cols:
        if c.name in new_vals:
            out.append(new_vals[c.name].alias(c.name))
        elif c.name == "last_update":
            out.append(F.when(hit, load_ts).otherwise(F.col(c.name)).alias(c.name))
        else:
            out.append(F.col(c.name))
    out += [(F.col(c) | hit).alias(c) if c == "_hit" else F.col(c) for c in extra]
    updated = joined.select(*out)
    return updated if keyless is None else updated.unionByName(keyless.select(*table.names, *extra))


def to_target(df: DataFrame, table: Table, columns: list[str] | None = None) -> DataFrame:
    """Cast to the target column types (the implicit cast of an insert)."""
    cols = columns or table.names
    return df.select([F.col(c).cast(table.col(c).stored).alias(c) for c in cols])


def union_distinct(arms: list[DataFrame]) -> DataFrame:
    """``arm1 UNION arm2 ...``: by column name, duplicates removed once."""
    return reduce(lambda a, b: a.unionByName(b), arms).distinct()


def new_with_ids(
    state: DataFrame,
    arms: list[DataFrame],
    table: Table,
    partitions: int | None = None,
    start: int | None = None,
    judge: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Distinct new rows of all arms, with ids after the current maximum.  ``judge``
    may take rows out before they get ids."""
    rows = union_distinct([a.select(*table.insert_cols) for a in arms])
    if judge is not None:
        rows = judge(rows)
    if table.id_col:
        if start is None:
            start = max_id(state, table.id_col)
        rows = assign_ids(
            rows,
            table.id_col,
            table.order_cols,
            start=start,
            dtype=table.col(table.id_col).stored,
            partitions=partitions,
        )
    return to_target(rows, table)


def insert(state: DataFrame, arms: list[DataFrame], table: Table) -> DataFrame:
    """The target state after one ``INSERT ... SELECT`` of all arms."""
    return state.unionByName(new_with_ids(state, arms, table))
