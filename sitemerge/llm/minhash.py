"""Near-dedup of documents by improved consistent weighted sampling.

Words are the runs of word characters of the lower-cased text; a document's shingles
are its runs of five words (all its words, if fewer).  A shingle weighs
its count in the document times the mean inverse document frequency of its
words.  Document frequencies are counted over all documents, in 2**18 hashed word
buckets, so the table every task needs has a fixed size (words that share a
bucket share a frequency).  Frequencies of whole shingles would need a shuffle of
every shingle, several times the input.

1. Documents with the same words are one class; its smallest id represents it.
2. Each representative gets ``bands`` x ``rows`` consistent weighted samples; the
   samples of a band, hashed, name a bucket.  Two documents agree in a sample with
   a probability equal to their weighted Jaccard similarity.
3. Every member of a bucket is verified against the bucket's smallest and largest
   ids.  Links make components.
4. Buckets that still hold several components are finished in tiles: members
   outside the bucket's largest component, in blocks, meet all members, in blocks,
   and a matrix product verifies a tile at once.  A tile returns an edge per linked
   document, not its pairs.  So any two documents that share a bucket are verified
   or are connected by verified links already; no bucket is capped.

Defined results: a document is a doc_id; rows with the same id share its class
(their texts' links are united).  Documents without words (null, empty, only
punctuation) and with a null id link with nothing; the class id is the smallest
doc_id of the class; an empty table gives an empty table; other columns are
ignored or passed on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, give_back, giving_back, long_list, text_slices
from .components import components

WORDS = re.compile(r"\w+")
BUCKET_BITS = 18  # word buckets of document frequencies
POOL_BITS = 14  # rows of random numbers that shingles are hashed to


@dataclass(frozen=True)
class MinHashParams:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 16
    rows: int = 4
    seed: int = 0
    outer_rows: int = 256  # documents of a tile: outside the largest component
    inner_rows: int = 1024  # and of the whole bucket

    @property
    def samples(self) -> int:
        return self.bands * self.rows


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str | None, known: _WordHash) -> np.ndarray:
    words = WORDS.findall((text or "").lower())
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def word_bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def idf_table(counts: np.ndarray, documents: int) -> np.ndarray:
    """Smoothed inverse document frequency of each word bucket, at least 1."""
    return (np.log((documents + 1) / (counts + 1)) + 1).astype(np.float32)


def counted_shingles(words: np.ndarray, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, counts, idf) of a document's word hashes."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0)
    k = min(k, len(words))
    n = len(words) - k + 1
    sums = np.concatenate([[0.0], np.cumsum(idf[word_bucket(words)], dtype=np.float64)])
    mean = (sums[k:] - sums[:-k]) / k
    with np.errstate(over="ignore"):
        h = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            h = (h ^ words[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    keys, first, count = np.unique(h, return_index=True, return_counts=True)
    # rounded, so that the order of a sum can't tell equal shingles apart
    return keys, count, np.round(mean[first], 4)


def weighted_shingles(words: np.ndarray, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, weights) of a document's word hashes."""
    keys, count, each = counted_shingles(words, idf, k)
    return keys, (count * each).astype(np.float32)


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Sum of minima over sum of maxima of two (sorted keys, weights)."""
    keys = np.concatenate([a[0], b[0]])
    if not len(keys):
        return 0.0
    order = np.argsort(keys, kind="stable")
    keys, w = keys[order], np.concatenate([a[1], b[1]]).astype(np.float64)[order]
    same = keys[1:] == keys[:-1]
    low = np.minimum(w[1:], w[:-1])[same].sum()
    return float(low / (w.sum() - low))


class Sampler:
    """Improved consistent weighted sampling with pooled random numbers.

    For sample k a shingle of weight w draws r, c ~ Gamma(2, 1) and b ~ U(0, 1), has
    t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r, and the smallest a wins;
    the sample is the winner and its t.  A shingle's hash picks its row in the pool of
    draws; of shingles in one row with equal weight the smaller hash wins."""

    def __init__(self, p: MinHashParams):
        rng = np.random.Generator(np.random.PCG64(p.seed))
        size = (1 << POOL_BITS, p.samples)
        r = rng.gamma(2.0, 1.0, size)
        self.r = r.astype(np.float32)
        self.inverse = (1 / r).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.beta = rng.random(size).astype(np.float32)
        self.p = p

    def bands(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The bucket names of one document, one per band (int64)."""
        p, n_samples = self.p, self.p.samples
        best = np.full(n_samples, np.inf, dtype=np.float32)
        who, step = np.zeros(n_samples, dtype=np.uint64), np.zeros(n_samples, dtype=np.int64)
        cols = np.arange(n_samples)
        log_w = np.log(weights)[:, None]
        for a in range(0, len(keys), 4096):  # bounded temporaries for long documents
            k = keys[a:a + 4096]
            row = (k >> np.uint64(64 - POOL_BITS)).astype(np.int64)
            t = np.floor(log_w[a:a + 4096] * self.inverse[row] + self.beta[row])
            ln_a = self.log_c[row] - self.r[row] * (t - self.beta[row] + 1)
            at = ln_a.argmin(axis=0)
            low = ln_a[at, cols]
            wins = low < best
            best[wins] = low[wins]
            who[wins] = k[at][wins]
            step[wins] = t[at, cols][wins].astype(np.int64)
        with np.errstate(over="ignore"):
            s = (who ^ (step.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))).reshape(p.bands, p.rows)
            h = np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0x165667B19E3779F9)
            for i in range(p.rows):
                h = (h ^ s[:, i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        return h.view(np.int64)


DOC, WORD = 0, 1


def _counted(batches):
    """(doc_id, text) -> a DOC row per document with the hash of its words, and at the
    end a WORD row per word bucket with the number of documents."""
    known, df = _WordHash(), np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    names = ["kind", "key", "h1", "h2", "n"]
    for batch in batches:
        for part in text_slices(batch, "text"):
            digests, sizes = [], []
            for text in part.column("text").to_pylist():
                words = word_hashes(text, known)
                df[np.unique(word_bucket(words))] += 1
                digests.append(xxhash.xxh3_128_digest(words.tobytes()))
                sizes.append(len(words))
            pair = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), DOC, dtype=np.int32)), part.column("doc_id"),
                 pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(sizes, pa.int64())], names=names)
    at = np.flatnonzero(df)
    empty = pa.array(np.zeros(len(at), dtype=np.int64))
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), WORD, dtype=np.int32)), pa.array(at),
                                      empty, empty, pa.array(df[at])], names=names)


def _sampled(batches, idf: np.ndarray, p: MinHashParams):
    known, sampler = _WordHash(), Sampler(p)
    for batch in batches:
        for part in text_slices(batch, "text"):
            out, sizes = [], []
            for text in part.column("text").to_pylist():
                keys, weights = weighted_shingles(word_hashes(text, known), idf, p.shingle)
                if len(keys):
                    out.append(sampler.bands(keys, weights))
                sizes.append(p.bands if len(keys) else 0)
            flat = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), long_list(flat, np.array(sizes))],
                                             names=["doc_id", "bands"])


def _verified(batches, idf: np.ndarray, p: MinHashParams):
    """(a, b, text_a, text_b) -> the pairs of at least the wanted similarity.
    Rows come sorted by b, so its shingles are made once for its run."""
    known, last = _WordHash(), (None, None)
    for batch in batches:
        for part in text_slices(batch, "text_a"):
            cols, keep = part.to_pydict(), []
            for b, ta, tb in zip(cols["b"], cols["text_a"], cols["text_b"]):
                if last[0] != (b, tb):
                    last = ((b, tb), weighted_shingles(word_hashes(tb, known), idf, p.shingle))
                a = weighted_shingles(word_hashes(ta, known), idf, p.shingle)
                keep.append(weighted_jaccard(a, last[1]) >= p.similarity)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(mask)


def _links(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, p: MinHashParams) -> DataFrame:
    a = texts.select(F.col("doc_id").alias("_a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("_b"), F.col("text").alias("text_b"))
    both = (pairs.join(a, F.col("a") == F.col("_a")).join(b, F.col("b") == F.col("_b"))
            .select("a", "b", "text_a", "text_b").sortWithinPartitions("b"))
    return both.mapInArrow(lambda it: giving_back(_verified(it, idf, p)), "a long, b long")


def _labelled(members: DataFrame, comps: DataFrame) -> DataFrame:
    return members.join(comps, F.col("doc_id") == F.col("vertex"), "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def _shares(parts: list[tuple], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sum of minima of the weights of documents ``rows`` with documents ``cols``.

    A weight is count x idf, so a minimum is a sum over levels 1, 2, ... of idf
    where both counts reach the level: a matrix product over (shingle, level)."""
    own, key, weight = [], [], []
    for d, (keys, counts, idf) in enumerate(parts):
        for level in range(1, int(counts.max(initial=0)) + 1):
            at = counts >= level
            with np.errstate(over="ignore"):
                key.append(keys[at] + np.uint64(level) * np.uint64(0xC2B2AE3D27D4EB4F))
            weight.append(idf[at])
            own.append(np.full(int(at.sum()), d))
    own, key, weight = np.concatenate(own), np.concatenate(key), np.concatenate(weight)
    names, where, held = np.unique(key, return_inverse=True, return_counts=True)
    keep = held[where] > 1  # a feature of one document is shared with none
    order = np.flatnonzero(keep)[np.argsort(where[keep], kind="stable")]
    own, weight = own[order], weight[order]
    _, where = np.unique(where[order], return_inverse=True)
    out = np.zeros((len(rows), len(cols)))
    width = 1024  # columns of the matrix at a time
    for first in range(0, int(where[-1]) + 1 if len(where) else 0, width):
        a, b = np.searchsorted(where, [first, first + width])
        m = np.zeros((len(parts), width))
        m[own[a:b], where[a:b] - first] = 1
        idf = np.zeros(width)
        idf[where[a:b] - first] = weight[a:b]
        out += (m[rows] * idf) @ m[cols].T
    return out


def _tile(t: pa.Table, idf: np.ndarray, p: MinHashParams) -> pa.Table:
    """(doc_id, outer, inner, text) -> an edge (a, b) per document linked in the tile."""
    known = _WordHash()
    ids, outer, inner = (t[c].to_numpy() for c in ("doc_id", "outer", "inner"))
    parts = [counted_shingles(word_hashes(x, known), idf, p.shingle) for x in t["text"].to_pylist()]
    sums = np.array([float((c * w).sum()) for _, c, w in parts])
    rows, cols = np.flatnonzero(outer), np.flatnonzero(inner)
    shared = _shares(parts, rows, cols)
    found = shared >= p.similarity * (sums[rows][:, None] + sums[cols][None, :] - shared)
    found &= ids[rows][:, None] != ids[cols][None, :]
    low, big = ids.copy(), np.iinfo(np.int64).max
    while found.any():  # the smallest id reachable in the tile
        new = low.copy()
        np.minimum.at(new, rows, np.where(found, low[cols][None, :], big).min(axis=1))
        np.minimum.at(new, cols, np.where(found, new[rows][:, None], big).min(axis=0))
        if (new == low).all():
            break
        low = new
    some = low != ids
    del parts, shared, found
    give_back()
    return pa.table({"a": pa.array(ids[some], pa.int64()), "b": pa.array(low[some], pa.int64())})


def _tiles(members: DataFrame, open_: DataFrame, texts: DataFrame, idf: np.ndarray,
           p: MinHashParams) -> DataFrame:
    """Links between components of the open buckets."""
    rows = members.join(open_, F.col("bucket") == F.col("_bucket")).withColumn(
        "outside", F.col("component") != F.col("main"))
    h = F.xxhash64("doc_id", "bucket")
    outers, inners = (F.ceil(F.col(c) / n).cast("int") for c, n in (("n_out", p.outer_rows), ("n", p.inner_rows)))
    # as a member: in its own inner block, for every outer block; as one outside
    # the largest component: in its own outer block, for every inner block
    rows = rows.withColumns({"oi": F.pmod(h, outers).cast("int"), "ii": F.pmod(h, inners).cast("int")})
    as_member = F.transform(F.sequence(F.lit(0), outers - 1), lambda o: F.struct(
        o.alias("o"), F.col("ii").alias("i"), F.lit(False).alias("outer"), F.lit(True).alias("inner")))
    as_outer = F.transform(F.sequence(F.lit(0), inners - 1), lambda i: F.struct(
        F.col("oi").alias("o"), i.alias("i"), F.lit(True).alias("outer"), F.lit(False).alias("inner")))
    at = F.explode(F.when(F.col("outside"), F.concat(as_member, as_outer)).otherwise(as_member))
    tile = rows.select("bucket", "doc_id", at.alias("e")).groupBy("bucket", "doc_id", "e.o", "e.i").agg(
        F.max("e.outer").alias("outer"), F.max("e.inner").alias("inner"))
    t = texts.select(F.col("doc_id").alias("_id"), "text")
    held = tile.join(t, F.col("doc_id") == F.col("_id")).drop("_id")
    return held.groupBy("bucket", "o", "i").applyInArrow(lambda x: _tile(x, idf, p), "a long, b long")


def link_buckets(members: DataFrame, texts: DataFrame, idf: np.ndarray, p: MinHashParams) -> DataFrame | None:
    """Components (vertex, component) of the documents of (bucket, doc_id)."""
    ends = cut(members.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
               .withColumnRenamed("bucket", "_bucket"), "bucket-ends")
    met = members.join(ends, F.col("bucket") == F.col("_bucket")).select(
        "doc_id", F.explode(F.array("low", "high")).alias("other"))
    pairs = met.where("doc_id != other").select(
        F.greatest("doc_id", "other").alias("a"), F.least("doc_id", "other").alias("b")).distinct()
    links = cut(_links(pairs, texts, idf, p), "text-links")
    comps = components(links, "a", "b")
    members = cut(_labelled(members, comps), "members")
    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    open_ = cut(parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"),
    ).where("parts > 1").select(F.col("bucket").alias("_bucket"), "n", F.col("most.component").alias("main"),
                                (F.col("n") - F.col("most.n")).alias("n_out")), "open-buckets")
    more = cut(_tiles(members, open_, texts, idf, p), "tile-links")
    if more.isEmpty():
        return comps
    return components(links.unionByName(more), "a", "b")


def near_duplicates(docs: DataFrame, params: MinHashParams | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), kept."""
    p = params or MinHashParams()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = cut(rows.mapInArrow(lambda it: giving_back(_counted(it)),
                                  "kind int, key long, h1 long, h2 long, n long"), "word-counts")
    frequent = counted.where(F.col("kind") == WORD).groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BUCKET_BITS)  # the table's size is fixed
    counts[frequent["key"].to_numpy()] = frequent["n"].to_numpy()
    ids = counted.where(F.col("kind") == DOC).select(F.col("key").alias("doc_id"), "h1", "h2", "n")
    documents = ids.count()
    idf = idf_table(counts, documents)

    some = ids.where("doc_id is not null and n > 0").drop("n")
    reps = cut(some.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "same-words")
    # an id with several texts links their classes
    exact = some.select("doc_id", F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).join(
        reps, (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2"))).select("doc_id", "rep")
    exact = cut(exact, "exact")

    sampled = rows.where("doc_id is not null").mapInArrow(
        lambda it: giving_back(_sampled(it, idf, p)), "doc_id long, bands array<long>")
    one = reps.select(F.col("rep").alias("_rep")).distinct()
    buckets = sampled.join(one, F.col("doc_id") == F.col("_rep"), "left_semi").select(
        F.explode("bands").alias("bucket"), "doc_id").distinct()
    buckets = cut(buckets, "buckets")
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("bucket").alias("_bucket"))
    members = cut(buckets.join(cut(shared, "shared-buckets"), F.col("bucket") == F.col("_bucket"))
                  .select("bucket", "doc_id"), "bucket-members")
    wanted = members.select(F.col("doc_id").alias("_want")).distinct()
    texts = cut(rows.join(wanted, F.col("doc_id") == F.col("_want"), "left_semi").distinct(), "candidates")
    comps = link_buckets(members, texts, idf, p)
    loose = exact.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    several = exact.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x != y")
    if not several.isEmpty():
        # texts of one id in several classes: components over all links anew
        more = loose if comps is None else loose.unionByName(
            comps.select(F.col("vertex").alias("a"), F.col("component").alias("b")))
        comps = components(more, "a", "b")
        found = exact.select("doc_id").distinct().join(comps, F.col("doc_id") == F.col("vertex"), "left").select(
            F.col("doc_id").alias("_id"), F.coalesce("component", "doc_id").alias("class_id"))
    elif comps is None:
        found = exact.select(F.col("doc_id").alias("_id"), F.col("rep").alias("class_id")).distinct()
    else:
        classes = cut(reps.join(comps, F.col("rep") == F.col("vertex"), "left").select(
            F.col("rep").alias("_rep"), F.coalesce("component", "rep").alias("class_id")), "classes")
        found = exact.distinct().join(classes, F.col("rep") == F.col("_rep")).select(
            F.col("doc_id").alias("_id"), "class_id")
    found = cut(found, "document-classes")
    out = ids.select("doc_id").join(found, F.col("doc_id") == F.col("_id"), "left")
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"),
                      F.col("doc_id").eqNullSafe(class_id).alias("kept"))
