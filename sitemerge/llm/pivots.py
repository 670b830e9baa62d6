"""Embedding near-dedup with a pivot-permutation index.

A vector is described by its ``prefix`` nearest reference points in order.
Reference points are spread over a bounded sample of the vectors by farthest-first
choice; their number follows the square root of the table.  Each vector is
posted to the lists of its reference points (per label).  Vectors that share at
least ``min_shared`` reference points are candidates and are verified by cosine in
double precision.

A list is cut into blocks of about ``block_rows`` by hash, and every pair of blocks
is one task's group, so no list meets in one task.  A pair found in several
lists counts in that of its smallest shared reference point.  A group returns
counts of links per vector and one edge per linked vector, never all pairs.
Equal vectors are one entry with a multiplicity.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have a null label or id link with nothing; vectors of different
length never meet; rows equal in id, label and vector count once and each get
the result; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import _matrix, unit_rows, usable
from .common import cut
from .components import components

SAMPLE = 4096  # vectors that reference points are chosen from, at most


@dataclass(frozen=True)
class PivotParams:
    prefix: int = 8  # reference points that describe a vector
    min_shared: int = 2
    block_rows: int = 1024
    least_pivots: int = 32
    most_pivots: int = 1024


def choose_pivots(units: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each point is the one least like those chosen before."""
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        at = int(np.argmin(nearest))
        chosen.append(at)
        nearest = np.maximum(nearest, units @ units[at])
    return units[chosen]


def permutation_prefix(units: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the ``prefix`` nearest reference points, nearest first."""
    near = units @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def _described(batches, pivots: dict[int, np.ndarray], prefix: int):
    for b in batches:
        for a in range(0, b.num_rows, 1024):
            part = b.slice(a, 1024)
            dims = np.array([len(v) for v in part.column("v")], dtype=np.int64)
            out: list = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = unit_rows(_matrix(part.column("v").take(pa.array(at))))
                for i, row in zip(at, permutation_prefix(x, pivots[int(dim)], prefix).tolist()):
                    out[i] = row
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(dims, pa.int32()), pa.array(out, pa.list_(pa.int32()))],
                names=[*part.schema.names, "dim", "perm"])


def linked(left: np.ndarray, right: np.ndarray, perm_left: np.ndarray, perm_right: np.ndarray,
           pivot: int, threshold: float, min_shared: int) -> np.ndarray:
    """Boolean matrix of the links that the list of ``pivot`` answers for."""
    width = int(max(perm_left.max(), perm_right.max())) + 1
    hot = []
    for perm in (perm_left, perm_right):
        m = np.zeros((len(perm), width), dtype=np.float32)
        m[np.arange(len(perm))[:, None], perm] = 1
        hot.append(m)
    shared = hot[0] @ hot[1].T >= min_shared
    if pivot:
        shared &= hot[0][:, :pivot] @ hot[1][:, :pivot].T == 0
    return shared & (left @ right.T >= threshold)


def _group(key, t: pa.Table, threshold: float, min_shared: int) -> pa.Table:
    pivot, i, j = (key[n].as_py() for n in (2, 3, 4))
    block = t["block"].to_numpy()
    ids, mult = t["rep"].to_numpy(), t["mult"].to_numpy()
    units = unit_rows(_matrix(t["v"]))
    perm = _matrix(t["perm"]).astype(np.int64)
    a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
    found = (np.zeros((len(a), len(b)), dtype=bool) if not len(a) or not len(b) else
             linked(units[a], units[b], perm[a], perm[b], pivot, threshold, min_shared))
    if i == j:
        np.fill_diagonal(found, False)
        n = np.zeros(len(ids), dtype=np.int64)
        n[a] = found @ mult[a]
    else:
        n = np.zeros(len(ids), dtype=np.int64)
        n[a], n[b] = found @ mult[b], mult[a] @ found
    # smallest id reachable inside the group: an edge per vector spans the links
    low = ids.copy()
    while len(a) and len(b):
        new = low.copy()
        big = np.iinfo(np.int64).max
        new[a] = np.minimum(new[a], np.where(found, low[b][None, :], big).min(axis=1))
        new[b] = np.minimum(new[b], np.where(found, new[a][:, None], big).min(axis=0))
        if (new == low).all():
            break
        low = new
    some = n > 0
    return pa.table({"u": pa.array(ids[some]), "v": pa.array(low[some]), "n": pa.array(n[some])})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, params: PivotParams | None = None,
                    id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    p = params or PivotParams()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("v"))
    ok = usable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # adding 0.0 makes -0.0 and 0.0 equal, so equal vectors hash alike
    good = rows.where(ok).withColumn("v", F.transform("v", lambda x: x.cast("double") + F.lit(0.0)))
    classes = cut(good.distinct().groupBy("label", "v").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult")), "vector-classes")

    total = classes.count()
    count = int(min(p.most_pivots, max(p.least_pivots, np.ceil(np.sqrt(total)))))
    sample = classes.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(SAMPLE).toArrow()
    by_dim: dict[int, list[int]] = {}
    for i, v in enumerate(sample["v"]):
        by_dim.setdefault(len(v), []).append(i)
    pivots = {d: choose_pivots(unit_rows(_matrix(sample["v"].take(pa.array(at)))), count)
              for d, at in by_dim.items()}
    # vectors of a length that the sample missed are few; their own first axis serves
    lengths = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect()]
    for d in lengths:
        pivots.setdefault(d, np.eye(1, d))

    schema = (f"label {classes.schema['label'].dataType.simpleString()}, v array<double>, rep long, "
              "mult long, dim int, perm array<int>")
    described = cut(classes.mapInArrow(lambda it: _described(it, pivots, p.prefix), schema), "permutations")
    posted = described.withColumn("pivot", F.explode("perm"))
    lists = cut(posted.groupBy("label", "dim", "pivot").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("blocks", F.ceil(F.col("n") / p.block_rows).cast("int")).drop("n")
                .withColumnsRenamed({"label": "_l", "dim": "_d", "pivot": "_p"}), "list-sizes")
    block = F.pmod(F.xxhash64("rep", "pivot"), F.col("blocks")).cast("int")
    dealt = posted.join(lists, [F.col("label") == F.col("_l"), F.col("dim") == F.col("_d"),
                                F.col("pivot") == F.col("_p")]).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = dealt.withColumn("other", other).select(
        "label", "dim", "pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "rep", "mult", "v", "perm")
    shared = min(p.min_shared, p.prefix)

    def group(key, t):
        few = min(shared, len(t["perm"][0]))
        return _group(key, t, threshold, few)

    found = cut(tiles.groupBy("label", "dim", "pivot", "i", "j").applyInArrow(group, "u long, v long, n long"),
                "vector-links")
    links = found.groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "_u")
    comps = components(found.select("u", "v")).withColumnsRenamed({"vertex": "_w"})
    by_class = classes.join(links, F.col("rep") == F.col("_u"), "left").join(
        comps, F.col("rep") == F.col("_w"), "left")
    by_class = cut(by_class.select(
        F.col("label").alias("_label"), F.xxhash64("v").alias("_h"), F.col("v").alias("_v"),
        (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")), "vector-results")
    keyed = rows.withColumn("_ok", ok).withColumn(
        "v", F.when(F.col("_ok"), F.transform("v", lambda x: x.cast("double") + F.lit(0.0))))
    same = ((F.col("label") == F.col("_label")) & (F.xxhash64("v") == F.col("_h")) & (F.col("v") == F.col("_v"))
            & F.col("_ok"))
    out = keyed.join(by_class, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
