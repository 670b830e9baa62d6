"""Approximate nearest neighbours with a robust-pruned directed graph per shard.

Vectors that are equal share one graph node (with their ``k + 1`` smallest ids,
all that any answer of ``k`` can use).  Nodes are dealt to shards of about
``shard_rows`` by a hash of the vector.  In a shard, matrix products propose the
``near`` nearest nodes of every node, and robust pruning keeps an edge only if no
kept neighbour is ``alpha`` times closer to its end, so edges stay diverse.  Free
places take the edges back, those of nodes that few lead to first, and every node
gets ``loose`` random edges in and out.  The index, one row per shard, is written
once.  Every block of queries then meets every shard's row, a beam search runs
in each shard, and the shards' answers are merged per query.  A block holds as many
queries as fit in ``query_values`` numbers, so that few copies of a shard's row are made.

Beam searches advance together, ``query_rows`` of them by one numpy step, and expand
``width`` nodes each; a beam is an array of whole numbers that hold similarity and node.

Defined results: vectors that are null, empty or zero or hold null or non-finite
components, and rows with a null id, take no part; vectors of different length
never meet; rows equal in id and vector count once; if a query id has several
vectors their answers are merged, each candidate with its best score; ties go to
the smaller id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


@dataclass(frozen=True)
class GraphParams:
    shard_rows: int = 4096  # expected nodes per shard
    query_rows: int = 128  # queries searched at once
    query_values: int = 1 << 21  # expected numbers in the vectors of a block of queries
    near: int = 48  # nearest nodes that pruning chooses a node's edges from
    degree: int = 24
    loose: int = 2  # random edges of a node
    beam: int = 48
    width: int = 4  # nodes of the beam expanded at once
    alpha: float = 1.2  # of distances
    entries: int = 32  # nodes every search starts from
    batch: int = 256  # nodes linked at once
    seed: int = 0


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and all finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of ``q`` with each row of ``x`` in double precision."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


NONE = -(1 << 63) | 1  # packed: no node, nothing to expand


def packed(sims: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Numbers in the order of the similarities: their bits above, below them the node
    number and a bit that is set once the node is expanded."""
    bits = np.ascontiguousarray(sims, dtype=np.float32).view(np.int32).astype(np.int64)
    return (np.where(bits < 0, bits ^ 0x7FFFFFFF, bits) << 32) | (nodes.astype(np.int64) << 1)


def unpacked(state: np.ndarray) -> np.ndarray:
    """Node numbers, -1 for none."""
    return np.where(state <= NONE, -1, (state & 0xFFFFFFFF) >> 1)


def beam_search(units: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                beam: int, width: int = 4) -> np.ndarray:
    """Per query the ``beam`` best nodes found, best first; -1 for none.

    ``edges``: (n, degree) node numbers, -1 for none.  A step expands the ``width``
    nearest nodes not yet expanded, until none of the beam is left."""
    n, q = len(units), len(queries)
    width = min(width, beam)
    ends = np.full((n + 1, edges.shape[1]), n, dtype=np.int64)  # n stands for "no node"
    ends[:n] = np.where(edges < 0, n, edges)
    seen = np.zeros(q * (n + 1), dtype=bool)
    seen.reshape(q, n + 1)[:, [n, *entries]] = True
    state = np.full((q, beam + len(entries)), NONE)
    state[:, beam:] = packed(queries @ units[entries].T, entries[None, :])
    state.partition(state.shape[1] - beam, axis=1)
    state, active = state[:, -beam:].copy(), np.arange(q)
    while len(active):
        now = state[active]
        best = np.where(now & 1, NONE, now)
        best.partition(beam - width, axis=1)
        best = best[:, -width:]
        some = best.max(axis=1) > NONE
        if not some.all():
            active, now, best = active[some], now[some], best[some]
            if not len(active):
                break
        now |= now >= np.maximum(best.min(axis=1, keepdims=True), NONE)
        near = ends.take(np.where(best > NONE, unpacked(best), n), axis=0).reshape(len(active), -1)
        near.sort(axis=1)
        cells = near + active[:, None] * (n + 1)
        fresh = ~seen.take(cells)
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        at = np.flatnonzero(fresh)
        seen[cells.take(at)] = True
        nodes = near.take(at)
        more = np.full(near.shape, NONE)
        more.reshape(-1)[at] = packed(np.vecdot(
            units.take(nodes, axis=0), queries.take(active.take(at // near.shape[1]), axis=0)), nodes)
        now = np.hstack([now, more])
        now.partition(now.shape[1] - beam, axis=1)
        state[active] = now[:, -beam:]
    state.sort(axis=1)
    return unpacked(state[:, ::-1])


def best_columns(sims: np.ndarray, count: int) -> np.ndarray:
    """Per row the columns of its ``count`` largest numbers, in any order.

    A row is cut into interleaved groups of 16; only groups whose maximum is among
    the ``count`` largest maxima can hold one."""
    rows, n = sims.shape
    if n <= 32 * count:
        return np.argpartition(-sims, min(count, n) - 1, axis=1)[:, :count]
    groups = -(-n // 16)
    wide = np.full((rows, 16 * groups), -np.inf, dtype=sims.dtype)
    wide[:, :n] = sims
    some = np.argpartition(-wide.reshape(rows, 16, groups).max(axis=1), count - 1, axis=1)[:, :count]
    cols = (some[:, :, None] + groups * np.arange(16)).reshape(rows, -1)
    at = np.argpartition(-np.take_along_axis(wide, cols, 1), count - 1, axis=1)[:, :count]
    return np.take_along_axis(cols, at, 1)


def robust_prune(units: np.ndarray, nodes: np.ndarray, cands: np.ndarray, degree: int,
                 alpha: float) -> np.ndarray:
    """For each node up to ``degree`` diverse neighbours out of its candidates (a row
    of distinct node numbers): the nearest candidate stays, and goes every one that
    is ``alpha`` times closer to it than to the node; repeat."""
    vectors = units[cands]
    dist = 2 - 2 * np.matmul(vectors, units[nodes][:, :, None])[:, :, 0]  # squared
    dist[cands == nodes[:, None]] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    c, dist = np.take_along_axis(cands, order, 1), np.take_along_axis(dist, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    between = alpha * alpha * np.maximum(2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0)
    out = np.full((len(nodes), degree), -1, dtype=np.int32)
    live, rows = np.isfinite(dist), np.arange(len(nodes))
    for i in range(degree):
        at = live.argmax(axis=1)  # the nearest left
        some = live[rows, at]
        if not some.any():
            break
        out[some, i] = c[rows, at][some]
        live &= between[rows, at] > dist
        live[rows, at] = False
    return out


def build_graph(units: np.ndarray, p: GraphParams) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entries) of one shard; ``units`` are unit vectors."""
    n = len(units)
    rng = np.random.Generator(np.random.PCG64([p.seed, n]))
    entries = np.union1d(rng.permutation(n)[:p.entries], [int(np.argmax(units @ units.mean(axis=0)))])
    wide = p.degree + p.degree // 2  # lists take edges back up to that
    edges = np.full((n, wide + p.loose), -1, dtype=np.int32)
    for a in range(0, n, p.batch):
        nodes = np.arange(a, min(n, a + p.batch))
        sims = units[nodes] @ units.T
        sims[np.arange(len(nodes)), nodes] = -np.inf
        edges[nodes, :p.degree] = robust_prune(units, nodes, best_columns(sims, p.near), p.degree, p.alpha)
    begins, cols = np.nonzero(edges >= 0)
    ends = edges[begins, cols].astype(np.int64)
    coming, held = np.bincount(ends, minlength=n), np.bincount(begins, minlength=n)
    back = ~np.isin(ends * n + begins, begins * n + ends)  # edges not there in both directions
    begins, ends = begins[back], ends[back]
    order = np.lexsort((coming[begins], ends))  # nodes that few others lead to come first
    begins, ends = begins[order], ends[order]
    slot = held[ends] + np.arange(len(ends)) - np.searchsorted(ends, ends)
    edges[ends[slot < wide], slot[slot < wide]] = begins[slot < wide]
    for i in range(p.loose):  # a random edge to every node: none is out of reach by its place
        edges[:, wide + i] = rng.permutation(n)
    return edges, entries


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long number lists as a matrix of doubles."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


INDEX = "dim int, shard int, ids array<array<long>>, vectors binary, edges binary, entries binary"


def build_index(vectors: DataFrame, k: int, p: GraphParams, id_col: str = "vec_id",
                vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """The written index, one row per shard, and the number of shards per length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = rows.where(usable(F.col("v")) & F.col("id").isNotNull()).distinct()
    w = Window.partitionBy("v").orderBy("id")
    nodes = cut(rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
                .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ann-nodes")
    shards = max(1, -(-nodes.count() // p.shard_rows))

    def build(key, t):
        t = t.take(pa.array(sorted(range(t.num_rows), key=lambda i: t["ids"][i].as_py())))
        x = _matrix(t["v"])
        edges, entries = build_graph(unit_rows(x).astype(np.float32), p)
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "ids": pa.array([t["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([x.tobytes()]), "edges": pa.array([edges.tobytes()]),
            "entries": pa.array([entries.astype(np.int64).tobytes()])})

    dealt = nodes.select(F.size("v").alias("dim"),
                         F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"), "v", "ids")
    return cut(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX), "ann-index"), shards


def search(index: DataFrame, shards: int, queries: DataFrame, k: int, p: GraphParams,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every query: query_id, rank, vec_id, score."""
    q = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    q = q.where(usable(F.col("v")) & F.col("id").isNotNull()).distinct()
    seen = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    blocks = max(1, -(-seen["n"] // max(p.query_rows, p.query_values // (seen["dim"] or 1))))
    block = F.pmod(F.xxhash64(F.lit(1), "id", "v"), F.lit(blocks)).cast("int")
    asked = (q.select(F.size("v").alias("dim"), block.alias("block"), F.struct("id", "v").alias("q"))
             .groupBy("dim", "block").agg(F.collect_list("q").alias("queries"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    pairs = asked.join(index, ["dim", "shard"])

    def answer(t):
        out: tuple[list, list, list] = ([], [], [])
        for r in range(t.num_rows):
            dim = t["dim"][r].as_py()
            ids = t["ids"][r].as_py()
            x = np.frombuffer(t["vectors"][r].as_py(), np.float64).reshape(-1, dim)
            edges = np.frombuffer(t["edges"][r].as_py(), np.int32).reshape(len(x), -1)
            entries = np.frombuffer(t["entries"][r].as_py(), np.int64)
            asked = t["queries"][r].values
            qs, qids = _matrix(asked.field("v")), asked.field("id").to_pylist()
            units, asking = unit_rows(x).astype(np.float32), unit_rows(qs).astype(np.float32)
            norms, asking_norms = np.sqrt((x * x).sum(axis=1)), np.sqrt((qs * qs).sum(axis=1))
            for a in range(0, len(qs), p.query_rows):
                some = slice(a, a + p.query_rows)
                found = beam_search(units, edges, entries, asking[some], min(p.beam, len(x)), p.width)
                scores = (x.take(found, axis=0) * qs[some][:, None, :]).sum(axis=2) / (
                    norms[found] * asking_norms[some][:, None])
                scores[found < 0] = -np.inf
                # nodes are in the order of their smallest ids; the query's own may be one of the first
                first = np.lexsort((found, -scores), axis=1)[:, :k + 1]
                found, scores = np.take_along_axis(found, first, 1).tolist(), np.take_along_axis(scores, first, 1).tolist()
                for qid, nodes, sims in zip(qids[some], found, scores):
                    best = sorted((-s, i) for s, node in zip(sims, nodes) if node >= 0 for i in ids[node] if i != qid)
                    for s, i in best[:k]:
                        out[0].append(qid)
                        out[1].append(i)
                        out[2].append(-s)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})

    found = pairs.groupBy("dim", "shard", "block").applyInArrow(
        answer, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, params: GraphParams | None = None,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    p = params or GraphParams()
    index, shards = build_index(vectors, k, p, id_col, vector_col)
    return search(index, shards, queries, k, p, id_col, vector_col)
