"""FLT-CHG by fingerprint: which state rows an update may change, found without their text.

``apply_update`` brings every tracked column of a state row to the join.  Most rows of a
run don't change, so a first pass joins hashes only:

1. per match key of the source, the smallest and largest fingerprint of its comparison
   values (a minimum and a maximum, combined in every task: a hot key is one row);
2. per state row, the fingerprint of its own, made where the row is scanned;
3. a state row is a suspect when one of the two differs from its own: some source row of
   its key differs from it.

The shuffle of this pass carries keys and 64-bit numbers.  ``apply_update`` then runs on
the suspects and the source rows of their keys, and compares the values in full, so an
equal pair with unequal fingerprints costs time and no result.  Unequal values with equal
fingerprints would be missed: a chance of 2**-64 for each changed row.

Several updates of one load: their suspects are found on the state before the first.  A
row that none of them suspects is changed by none, as the first to change it would meet
the values the row had then.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.targets import Table
from .joins import HASHED, gate
from .skew import join_one_per_key
from .upsert import UpdateSpec, state_heavy_keys


def _column(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _common_types(spec: UpdateSpec, state: DataFrame) -> list[T.DataType]:
    """For each tracked column a type that holds the values of both sides unchanged."""
    names = [f"c{i}" for i in range(len(spec.tracks))]
    a = spec.source.select(*(t.src_cmp.alias(n) for t, n in zip(spec.tracks, names)))
    b = state.select(*(t.tgt_cmp.alias(n) for t, n in zip(spec.tracks, names)))
    texts = [n for n in names if T.StringType in (type(a.schema[n].dataType), type(b.schema[n].dataType))]
    for n in texts:
        a, b = (df.withColumn(n, F.col(n).cast("string")) for df in (a, b))
    return [a.union(b).schema[n].dataType for n in names]


def _fingerprint(values: list[Column], types: list[T.DataType]) -> Column:
    """The hash passes NULLs over, so whether a value is one is hashed beside it."""
    same = [v.cast(t) for v, t in zip(values, types)]
    return F.xxhash64(*same, *(v.isNull() for v in same))


def suspects(state: DataFrame, spec: UpdateSpec, keep: list[str], table: Table,
             heavy: list[int] | None = None) -> DataFrame:
    """The columns ``keep`` of the state rows that ``spec`` may change; ``heavy``: its
    heavy keys in the state, if they are known."""
    types = _common_types(spec, state)
    kinds = {f.name: f.dataType for f in state.schema}
    on = [(t, f"_k{i}") for i, (_, t) in enumerate(spec.match)]
    present = " and ".join(f"{k} is not null" for _, k in on)
    source = spec.source.select(
        *(_column(e).cast(kinds[t]).alias(k) for (e, t), (_, k) in zip(spec.match, on)),
        _fingerprint([t.src_cmp for t in spec.tracks], types).alias("_h"))
    told = source.where(present).groupBy(*(k for _, k in on)).agg(F.min("_h").alias("_lo"), F.max("_h").alias("_hi"))
    own = state.select(*dict.fromkeys([*keep, *(t for t, _ in on)]),
                       _fingerprint([t.tgt_cmp for t in spec.tracks], types).alias("_own"))
    own = own.where(" and ".join(f"{t} is not null" for t, _ in on))
    salts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if heavy is None:
        heavy = state_heavy_keys(state, spec)
    joined = join_one_per_key(own, told, on, heavy, [table.id_col or table.pk[0]], salts, HASHED)
    return joined.where("_lo <> _own or _hi <> _own").select(*keep)


def all_suspects(state: DataFrame, specs: list[UpdateSpec], table: Table, extra: list[str],
                 heavy: list[list[int]] | None = None) -> DataFrame:
    """Primary key, match columns and ``extra`` of the rows that any update may change.

    A row that two updates suspect is there twice."""
    keep = list(dict.fromkeys([*table.pk, *(t for s in specs for _, t in s.match), *extra]))
    known = heavy or [None] * len(specs)
    return reduce(lambda a, b: a.unionByName(b), [suspects(state, s, keep, table, h) for s, h in zip(specs, known)])


def narrowed(spec: UpdateSpec, found: DataFrame) -> UpdateSpec:
    """The update with the source rows of the suspects' keys only."""
    return replace(spec, source=gate(spec.source, found, spec.match, hashed=True))
