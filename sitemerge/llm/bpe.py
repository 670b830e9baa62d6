"""Byte-level BPE encoding and decoding.

Encoding looks a pre-token up in two tiers.  A minimal perfect hash over the
vocabulary (hash and displace: one displacement per bucket of keys, as many
slots as tokens) resolves pre-tokens that are a token as a whole; the slot's
token is compared byte by byte.  The others are merged with a heap of
neighbouring pairs over a linked list of their bytes, lowest rank first, the
leftmost first among equals: O(n log n) for a pre-token of n bytes.  A memo of
bounded size in front of both remembers pre-tokens already seen by a task.

Tasks are independent (no shuffle).  The vocabulary, a parameter, travels to
them with the function.

Defined results: a null text encodes like an empty one, to no ids; null id
lists decode to no bytes, ids outside the vocabulary (and null ids) to U+FFFD; row
order and repeated rows stay; an empty table gives an empty table; other
columns are passed on; input columns named like an output are replaced by it.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import giving_back, long_list, replacing, text_slices

MEMO_LIMIT = 150_000  # pre-tokens of a generation; a task remembers this one and the one before
MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def _mix(h, d):
    """Slot hash of key hash ``h`` under displacement ``d`` (uint64 arrays)."""
    x = (h ^ (d * np.uint64(ODD))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots.

    ``disp[bucket]`` is a displacement or, for buckets of one key, -1 - slot."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.keys: list[bytes] = [b""] * n
        self.disp = np.zeros(max(1, n // 4), dtype=np.int64)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=n)
        bucket = (hashes % np.uint64(len(self.disp))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(len(self.disp) + 1))
        free = np.ones(n, dtype=bool)
        sizes = np.diff(starts)
        with np.errstate(over="ignore"):
            for b in np.argsort(-sizes, kind="stable"):
                at = order[starts[b]:starts[b + 1]]
                if len(at) < 2:
                    break
                h, d0 = hashes[at], 0
                while True:
                    d = np.arange(d0, d0 + 64, dtype=np.uint64)
                    slots = (_mix(h[None, :], d[:, None]) % np.uint64(n)).astype(np.int64)
                    ok = free[slots].all(axis=1)
                    for i in np.flatnonzero(ok):
                        if len(set(slots[i].tolist())) == len(at):
                            break
                    else:
                        d0 += 64
                        if d0 > 1 << 24:
                            raise ValueError("keys repeat or their hashes collide")
                        continue
                    self.disp[b] = d0 + i
                    free[slots[i]] = False
                    for k, s in zip(at, slots[i]):
                        self.keys[s] = keys[k]
                    break
        spare = iter(np.flatnonzero(free).tolist())
        for b in np.flatnonzero(sizes == 1):
            s = next(spare)
            self.disp[b] = -1 - s
            self.keys[s] = keys[order[starts[b]]]

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The slot of each piece, or -1 where it is no key."""
        if not self.n or not pieces:
            return np.full(len(pieces), -1, dtype=np.int64)
        h = np.fromiter(map(xxhash.xxh64_intdigest, pieces), dtype=np.uint64, count=len(pieces))
        d = self.disp[(h % np.uint64(len(self.disp))).astype(np.int64)]
        with np.errstate(over="ignore"):
            hashed = (_mix(h, np.maximum(d, 0).astype(np.uint64)) % np.uint64(self.n)).astype(np.int64)
        slot = np.where(d < 0, -1 - d, hashed)
        keys = self.keys
        same = np.fromiter((keys[s] == p for s, p in zip(slot.tolist(), pieces)), dtype=bool,
                           count=len(pieces))
        return np.where(same, slot, -1)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging neighbours, lowest rank first."""
    n, get = len(piece), ranks.get
    # end[i]: where the part that starts at i ends, and so its successor starts;
    # -1 where none starts any more
    end = list(range(1, n + 1))
    prev = list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, j, e = heappop(heap)
        if end[i] != j or end[j] != e:
            continue
        end[j], end[i], prev[e] = -1, e, i
        if e < n and (r := get(piece[i:end[e]])) is not None:
            heappush(heap, (r, i, e, end[e]))
        h = prev[i]
        if h >= 0 and (r := get(piece[h:e])) is not None:
            heappush(heap, (r, h, i, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class _Memo(dict):
    """Pre-token -> row number, and the ids of each row; new ones queue in ``fresh``.

    ``older`` is the generation before, which ends when this one is full."""

    def __init__(self, older: _Memo | None = None):
        super().__init__()
        self.fresh: list[str] = []
        self.ids, self.starts = array("i"), array("q", [0])
        self.older = older
        if older is not None:
            older.older = None

    def __missing__(self, piece):
        i = self[piece] = len(self)
        self.fresh.append(piece)
        return i

    def settle(self, ids_of) -> None:
        """Find the ids of the fresh pieces, in the older generation first."""
        old = self.older if self.older is not None else {}
        unknown = iter(ids_of([p.encode() for p in self.fresh if p not in old]))
        for p in self.fresh:
            if p in old:
                i = old[p]
                self.ids += old.ids[old.starts[i]:old.starts[i + 1]]
            else:
                self.ids.extend(next(unknown))
            self.starts.append(len(self.ids))
        self.fresh = []


class Vocabulary:
    """Ranks, their perfect hash and the pre-token pattern; goes to the tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"not byte-level: no token for bytes {missing[:5]}")
        self.ranks, self.pattern = ranks, pattern
        self.table = PerfectHash(list(ranks))
        self.slot_rank = np.array([ranks[k] for k in self.table.keys], dtype=np.int32)

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        return cls(read_ranks(path), pattern)

    def ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        slots = self.table.find(pieces).tolist()
        return [[int(self.slot_rank[s])] if s >= 0 else merge_bytes(p, self.ranks)
                for s, p in zip(slots, pieces)]

    def encode_batches(self, batches, text: str, out: str):
        # White_Space, not the library's \s, which also takes U+001C to U+001F
        pattern = self.pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(
            r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
        split = regex.compile(pattern).findall
        memo = _Memo()
        for batch in batches:
            for part in text_slices(batch, text, 1 << 20):
                lens, rows = [], array("q")
                for t in part.column(text).to_pylist():
                    before = len(rows)
                    if t:
                        rows.extend(map(memo.__getitem__, split(t)))
                    lens.append(len(rows) - before)
                memo.settle(self.ids_of)
                edges, ids = np.array(memo.starts, dtype=np.int64), np.array(memo.ids, dtype=np.int32)
                at = np.array(rows, dtype=np.int64)
                size = edges[at + 1] - edges[at]
                ends = np.cumsum(size)
                token = np.arange(ends[-1] if len(ends) else 0) + np.repeat(edges[at] - (ends - size), size)
                row_ends = np.concatenate([[0], ends])[np.cumsum(lens)] if lens else ends
                per_row = np.diff(row_ends, prepend=0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, long_list(ids[token], per_row, pa.int32())],
                    names=[*part.schema.names, out])
                if len(memo) > MEMO_LIMIT:
                    memo = _Memo(memo)

    def decode_batches(self, batches, ids: str, out: str):
        unknown = "�".encode()
        tokens = [unknown] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        # few rows at a time bound the bytes held
        for batch in (b.slice(a, 256) for b in batches for a in range(0, b.num_rows, 256)):
            made = []
            for row in batch.column(ids):
                values = row.values
                if values is None or not len(values):
                    made.append(b"")
                    continue
                got = values.to_pylist() if values.null_count else values.to_numpy(zero_copy_only=False).tolist()
                try:
                    if values.null_count or min(got) < 0:
                        raise IndexError
                    made.append(b"".join(map(tokens.__getitem__, got)))
                except IndexError:
                    made.append(b"".join(tokens[i] if i is not None and 0 <= i < len(tokens) else unknown
                                         for i in got))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())],
                                             names=[*batch.schema.names, out])


def _with(df: DataFrame, column: str, kind: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"`{column}` {kind}"])


def encode(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of each text in column ``out`` (array<int>)."""
    df = replacing(df, text_col, out)
    return df.mapInArrow(lambda it: giving_back(vocabulary.encode_batches(it, text_col, out)),
                         _with(df, out, "array<int>"))


def decode(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each id list in column ``out`` (binary)."""
    df = replacing(df, ids_col, out)
    return df.mapInArrow(lambda it: giving_back(vocabulary.decode_batches(it, ids_col, out)),
                         _with(df, out, "binary"))


def round_trip(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids: str = "ids",
               out: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass: a task's ids are decoded by the worker
    that made them, so a task holds one Python worker instead of two."""
    if out == ids:
        raise ValueError("ids and decoded bytes need two names")
    df = replacing(df, text_col, ids, out)
    schema = f"{_with(df, ids, 'array<int>')}, `{out}` binary"
    return df.mapInArrow(
        lambda it: giving_back(vocabulary.decode_batches(
            vocabulary.encode_batches(it, text_col, ids), ids, out)), schema)


def ids_digest(ids: str) -> Column:
    """Lowercase hex sha-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")).cast("binary"), 256)
