"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Documents of a source are dealt by hash to blocks of about ``block_words`` words,
64 to 16,384 per source; one aggregation gives the size of every block (sources x
blocks rows reach the driver; a mix has a weight, and so an entry, per source).  A source's target fixes how many of its blocks
are drawn: whole epochs take all blocks, the rest takes blocks of a seeded
permutation and, of the last one, documents in hash order up to the one nearest
to the target.  The draws of all sources are split among the output shards by
a binary tree: a node hands its left half a multivariate-hypergeometric sample
of its quotas, so every shard gets its exact number of blocks of each source.
Shards then draw disjoint runs of each source's permuted blocks, and rows are
shuffled within their shard by hash.

Hashes depend only on seed, id and text, so reruns agree.  A source holding a
third of all rows is spread over its blocks.

Defined results: a null text has size 0; documents of size 0 are never taken
partially (they go with their block); null is a source like any other, last in
order; rows equal in id and text are taken together; a source without words has
target 0; an empty table gives an empty mix; other columns are passed on (names
that start with ``_`` are the module's own).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    weights: tuple = (5, 2, 1)  # of the sources in order, repeating
    most: int = 3  # times its size that a source may be taken
    block_words: int = 1 << 24
    shard_words: int = 50_000_000
    blocks: int | None = None  # per source; by default from block_words
    shards: int | None = None  # by default from shard_words
    seed: int = 0

    def sized_for(self, words: int) -> Mix:
        """The same mix with the numbers of blocks and shards filled in."""
        blocks = min(16384, max(64, 1 << (max(1, words // self.block_words) - 1).bit_length()))
        shards = min(65536, max(32, -(-words // self.shard_words)))
        return replace(self, blocks=self.blocks or blocks, shards=self.shards or shards)


def text_size(text: Column) -> Column:
    """The number of words (runs of other than ASCII white space); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple, most: int) -> list[Fraction]:
    """Shares of the total by weight, none above ``most`` times its size; the
    excess is shared again by weight among the others."""
    left, open_ = Fraction(sum(sizes)), set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_:
        w = sum(weights[i % len(weights)] for i in open_)
        share = {i: left * weights[i % len(weights)] / w for i in open_}
        full = {i for i in open_ if share[i] > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        open_ -= full
    return out


def _rng(*path) -> np.random.Generator:
    digest = hashlib.sha256(repr(path).encode()).digest()
    return np.random.Generator(np.random.PCG64(int.from_bytes(digest[:16], "little")))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """quotas[source] -> out[shard, source], by the splitting tree."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def node(q, lo, hi):
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        total = int(q.sum())
        take = total * (mid - lo) // (hi - lo)
        left = (_rng(seed, "node", lo, hi).multivariate_hypergeometric(q, take, method="marginals")
                if total else q)
        node(left, lo, mid)
        node(q - left, mid, hi)

    node(np.asarray(quotas, dtype=np.int64), 0, shards)
    return out


def _hash(seed: int, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _block(h: Column, mix: Mix) -> Column:
    return F.pmod(F.shiftright(h, 32), F.lit(mix.blocks)).cast("int")


def plan(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> tuple[DataFrame, DataFrame, Mix]:
    """(sized, draws, mix): ``sized`` has doc_id, source, size, hash, block per document;
    ``draws`` has, per source and block, the source's size and target and an
    array of (shard, epoch, cutoff), cutoff being the last hash that is taken."""
    spark = docs.sparkSession
    h = _hash(mix.seed, id_col, text_col)
    sized = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        text_size(F.col(text_col)).alias("size"), h.alias("hash")), "sized")
    mix = mix.sized_for(int(sized.agg(F.sum("size")).first()[0] or 0))
    sized = sized.withColumn("block", _block(F.col("hash"), mix))
    rows = sized.groupBy("source", "block").agg(F.sum("size").alias("size")).collect()
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], {})[r["block"]] = r["size"]
    sources = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(by[s].values()) for s in sources]
    goals = targets(sizes, mix.weights, mix.most)

    drawn: list[list] = []  # per source: (epoch, block, words wanted of it or None)
    for s, size, goal in zip(sources, sizes, goals):
        names = sorted(by[s])
        epochs, rest = divmod(goal, size) if size else (0, Fraction(0))
        draws = []
        for e in range(int(epochs) + (rest > 0)):
            order = [names[i] for i in _rng(mix.seed, "order", s, e).permutation(len(names))]
            want = None if e < epochs else rest
            for b in order:
                if want is None or by[s][b] <= want:
                    draws.append((e, b, None))
                    want = want if want is None else want - by[s][b]
                else:
                    draws.append((e, b, want))
                    break
        drawn.append(draws)

    partial = [(s, b, float(want)) for s, draws in zip(sources, drawn)
               for _, b, want in draws if want is not None]
    cutoffs = _cutoffs(sized, partial)
    quotas = split_quotas(np.array([len(d) for d in drawn], dtype=np.int64), mix.shards, mix.seed)
    at = np.zeros(len(sources), dtype=np.int64)
    found: dict = {}
    for shard in range(mix.shards):
        for i, s in enumerate(sources):
            mixed = drawn[i][at[i]:at[i] + quotas[shard, i]]
            at[i] += quotas[shard, i]
            for e, b, want in mixed:
                if want is None or s in cutoffs:
                    found.setdefault((i, b), []).append((shard, e, None if want is None else cutoffs[s]))
    schema = T.StructType.fromDDL(
        "source string, block int, source_size long, target double, "
        "draws array<struct<shard:int,epoch:int,cutoff:long>>")
    table = [(s, b, sizes[i], float(goals[i]), found.get((i, b), []))
             for i, s in enumerate(sources) for b in sorted(by[s])]
    return sized, spark.createDataFrame(table, schema), mix


def _cutoffs(sized: DataFrame, partial: list) -> dict:
    """Per source, the last hash taken of its partial block; none: no entry."""
    if not partial:
        return {}
    from pyspark.sql import Window

    spark = sized.sparkSession
    wanted = spark.createDataFrame(partial, "s string, b int, want double")
    rows = sized.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    per_hash = rows.groupBy("source", "hash").agg(F.sum("size").alias("size"), F.max("want").alias("want"))
    w = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, 0)
    run = per_hash.withColumn("upto", F.sum("size").over(w))
    # a document goes while the middle of it lies before the target
    taken = run.where((F.col("size") > 0) & (F.col("upto") - F.col("size") / 2 <= F.col("want")))
    return {r["source"]: r["last"] for r in taken.groupBy("source").agg(F.max("hash").alias("last")).collect()}


def _drawn(draws: str, hash_col: str) -> Column:
    return F.filter(draws, lambda d: d["cutoff"].isNull() | (F.col(hash_col) <= d["cutoff"]))


def mix_plan(docs: DataFrame, mix: Mix | None = None, **cols) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target and
    ``draws``, the shards and epochs that take it."""
    sized, draws, _ = plan(docs, mix or Mix(), **cols)
    d = draws.withColumnRenamed("source", "_s").withColumnRenamed("block", "_b")
    joined = sized.join(d, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         F.transform(_drawn("draws", "hash"), lambda x: F.struct(x["shard"], x["epoch"])).alias("draws"))


def mix_rows(docs: DataFrame, mix: Mix | None = None, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, once per draw, with ``_shard`` and
    ``_epoch``; a shard's rows share a partition, shuffled by hash."""
    _, draws, mix = plan(docs, mix or Mix(), id_col, text_col, source_col)
    d = draws.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.col("draws").alias("_draws"))
    h = _hash(mix.seed, id_col, text_col)
    keyed = docs.withColumn("_hash", h).withColumn("_block", _block(F.col("_hash"), mix))
    joined = keyed.join(d, F.col(source_col).cast("string").eqNullSafe(F.col("_s"))
                        & (F.col("_block") == F.col("_b")))
    rows = joined.withColumn("_d", F.explode(_drawn("_draws", "_hash"))).select(
        *docs.columns, F.col("_d.shard").alias("_shard"), F.col("_d.epoch").alias("_epoch"), "_hash")
    order = F.xxhash64(F.lit(mix.seed), "_shard", "_epoch", "_hash")
    return rows.repartition(mix.shards, "_shard").sortWithinPartitions("_shard", order).drop("_hash")
