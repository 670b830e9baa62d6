"""Line dedup: lines found in many documents, as keep bitmaps per document.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased, held as a 128-bit hash.  (key, document, positions) rows are
range-partitioned by key *and document* and sorted, so a key held by a third
of all documents spreads over many partitions.  Each partition is streamed
once: a key's first ``min_docs`` documents wait in a buffer, and when the last
of these arrives they and all that follow are emitted.  A key can only be cut by
a partition edge, so each partition also reports its first and last key (two
rows); their sums, twice as many rows as partitions, settle the cut keys.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped; a document is a row, but rows equal
in id and text count as one document and share a bitmap; a null id is an id
like any other; lines in bitmaps are numbered from 0; an empty table gives an
empty table; other columns are ignored or passed on (names that start with ``_`` are the module's own).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, giving_back, partitions, text_slices

LINE = "h1 long, h2 long, doc_id long, digest long, n_lines int, positions array<int>"
FOUND = "kind int, h1 long, h2 long, doc_id long, digest long, n_lines int, positions array<int>, n long"
DROP, PENDING, EDGE = 0, 1, 2


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # of bytes: ASCII white space and A-Z only


def _keys(batches, min_chars: int):
    """(doc_id, digest, text) -> a row per document and key."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                        ("digest", pa.int64()), ("n_lines", pa.int32()),
                        ("positions", pa.list_(pa.int32()))])
    for batch in batches:
        for part in text_slices(batch, "text"):
            hashes, ids, digests, counts, places = [], [], [], [], []
            cols = part.to_pydict()
            for doc, digest, text in zip(cols["doc_id"], cols["digest"], cols["text"]):
                lines = (text or "").encode().split(b"\n")
                at: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    key = line_key(line)
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        at.setdefault(key, []).append(i)
                hashes += map(xxhash.xxh3_128_digest, at)
                places += at.values()
                ids += [doc] * len(at)
                digests += [digest] * len(at)
                counts += [len(lines)] * len(at)
            pair = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
            yield pa.record_batch([
                pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(ids, pa.int64()),
                pa.array(digests, pa.int64()), pa.array(counts, pa.int32()),
                pa.array(places, pa.list_(pa.int32()))], schema=schema)


def _stream(batches, min_docs: int, keep_first: bool):
    """Sorted (key, document) rows of one partition -> FOUND rows.

    A row is one document of a key, as a key's rows of one document are merged
    before.  The buffer holds fewer than ``min_docs`` documents."""
    schema = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("doc_id", pa.int64()), ("digest", pa.int64()), ("n_lines", pa.int32()),
                        ("positions", pa.list_(pa.int32())), ("n", pa.int64())])
    out: list[tuple] = []
    key, n, first, buffer, leading, previous = None, 0, None, [], True, None

    def batch():
        made = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return made

    def edge():
        out.append((EDGE, *key, *first, n))

    for b in batches:
        for h1, h2, doc, digest, lines, places in zip(*(c.to_pylist() for c in b.columns)):
            if (h1, h2) != key:
                if key is not None and leading:
                    edge()
                    leading = False
                key, n, buffer, previous = (h1, h2), 0, [], None
            row = (doc, digest, lines, places)
            if (doc, digest) == previous:
                continue  # a repeated row: the same document again
            previous = (doc, digest)
            n += 1
            if n == 1:
                first = row
                if keep_first and not leading:
                    row = (doc, digest, lines, places[1:])
            if leading:
                out.append((PENDING, h1, h2, *row, None))
            elif n < min_docs:
                buffer.append(row)
            else:
                out += ((DROP, h1, h2, *r, None) for r in (*buffer, row))
                buffer = []
            if len(out) >= 4096:
                yield batch()
    if key is not None:
        out += ((PENDING, *key, *r, None) for r in buffer)
        edge()
        yield batch()


def _bitmaps(batches):
    """(doc_id, digest, n_lines, dropped) -> a compressed bitmap of kept lines."""
    for b in batches:
        cols = b.to_pydict()
        maps, gone = [], []
        for lines, dropped in zip(cols["n_lines"], cols["dropped"]):
            keep = np.ones(lines, dtype=bool)
            keep[[i for places in dropped for i in places]] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            gone.append(int(lines - keep.sum()))
        yield pa.record_batch([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["digest"], pa.int64()),
                               pa.array(cols["n_lines"], pa.int32()), pa.array(gone, pa.int32()),
                               pa.array(maps, pa.binary())],
                              names=["doc_id", "digest", "n_lines", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row (doc_id, digest, n_lines, n_dropped, keep) for every document that
    loses a line; ``keep`` is the zlib-compressed bitmap of kept lines, and
    ``digest`` is xxhash64 of the text.  Documents that keep all lines have no row.

    Keys in at least ``min_docs`` documents lose all their lines or, with
    ``keep_first``, all but the first (by doc_id, digest, position)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"),
                       text.alias("text"))
    order = ["h1", "h2", "doc_id", "digest"]
    keyed = (rows.mapInArrow(lambda it: giving_back(_keys(it, min_chars)), LINE)
             .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order))
    found = cut(keyed.mapInArrow(lambda it: giving_back(_stream(it, min_docs, keep_first)), FOUND), "lines")
    # two rows per partition at most: the keys that a partition edge may cut
    edges = found.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("doc_id", "digest", F.col("positions")[0].alias("at"))).alias("first"),
    ).where(F.col("n") >= min_docs)
    settled = found.where(F.col("kind") == PENDING).drop("n").join(F.broadcast(edges), ["h1", "h2"])
    places = F.col("positions")
    if keep_first:
        is_first = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
                    & (F.col("digest") == F.col("first.digest")))
        places = F.when(is_first, F.filter("positions", lambda p: p != F.col("first.at"))).otherwise(places)
    dropped = (found.where(F.col("kind") == DROP).select("doc_id", "digest", "n_lines", "positions")
               .unionByName(settled.select("doc_id", "digest", "n_lines", places.alias("positions")))
               .where(F.size("positions") > 0))
    return (dropped.groupBy("doc_id", "digest")
            .agg(F.max("n_lines").alias("n_lines"), F.collect_list("positions").alias("dropped"))
            .mapInArrow(lambda it: giving_back(_bitmaps(it)),
                        "doc_id long, digest long, n_lines int, n_dropped int, keep binary"))


def _apply(batches, text_at: str):
    for batch in batches:
        for part in text_slices(batch, text_at):
            texts, keeps = part.column(text_at).to_pylist(), part.column("_keep").to_pylist()
            kept, total, gone = [], [], []
            for text, keep in zip(texts, keeps):
                if keep is None:
                    kept.append(text or "")
                    total.append((text or "").count("\n") + 1)
                    gone.append(0)
                    continue
                lines = (text or "").split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                left = [line for line, bit in zip(lines, bits) if bit]
                kept.append("\n".join(left))
                total.append(len(lines))
                gone.append(len(lines) - len(left))
            cols = [part.column(i) for i, f in enumerate(part.schema) if f.name not in (text_at, "_keep")]
            names = [f.name for f in part.schema if f.name not in (text_at, "_keep")]
            yield pa.record_batch(
                [*cols, pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, text_at, "_n_lines", "_n_dropped"])


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with the kept text, and ``_n_lines`` and ``_n_dropped``."""
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    b = bitmaps.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("keep").alias("_keep"))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (digest == F.col("_digest"))
    joined = docs.join(b, on, "left").select(*docs.columns, "_keep")
    rest = [f for f in docs.schema if f.name != text_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest),
                        f"`{text_col}` string, _n_lines long, _n_dropped long"])
    return joined.mapInArrow(lambda it: giving_back(_apply(it, text_col)), schema)
