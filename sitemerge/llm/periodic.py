"""Periodic run detection with a dictionary of basic factors.

A basic factor is a stretch of 2**k words.  Level k of the dictionary names the
factor at every position: level 0 names words, a factor of 2**(k+1) words is the
pair of its halves' names.  A factor that occurs once in its text gets no name
and drops out of all higher levels, so ordinary text leaves few positions after
some levels and the dictionary ends where no factor repeats.

1. Propose: at each level the successor of a factor is its next occurrence; gaps
   of at most twice the factor's length are kept.  Neighbouring positions with the
   same gap, and the progressions i, i + gap, i + 2 gap ... that their successors
   continue, are one proposal (position, period).  A run of smallest period q and at
   least 3 q words is always proposed: at the level with q <= 2**k < 2 q the
   successor of its first factor lies exactly q further on (a nearer one would
   give the run a smaller period).
2. Extend: both ends of a proposal move outwards while words a period apart are
   the same, by the largest named factors first (O(levels), all proposals at once).
3. Deduplicate: of the proposals that reach the same ends the smallest period
   stays, which is the smallest period of the run; too short ones go.

Tasks are independent (no shuffle); a task holds the words of about a megabyte
of texts, or of one longer text, at a time.

Defined results: a null or empty text has no runs and collapses to the empty
text; row order and repeated rows stay; an empty table gives an empty table;
other columns are passed on, and input columns named like an output are
replaced by it.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import giving_back, text_slices

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def factor_levels(ids: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4 ... words at every position, -1 where a
    factor occurs only once; ends with the last level that has a name."""
    levels, width = [], 1
    names = _named(ids.astype(np.int64), np.arange(len(ids)), len(ids))
    while (names >= 0).any():
        levels.append(names)
        at = np.flatnonzero(names[:-width] >= 0) if width < len(ids) else np.empty(0, dtype=np.int64)
        at = at[names[at + width] >= 0]
        pairs = names[at].astype(np.int64) * len(ids) + names[at + width]
        names = _named(pairs, at, len(ids))
        width *= 2
    return levels


def _named(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    names = np.full(n, -1, dtype=np.int32)
    if len(at):
        _, which, times = np.unique(values, return_inverse=True, return_counts=True)
        fresh = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
        names[at] = fresh[which]
    return names


def proposals(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (position, period) that the successors of all levels propose."""
    found = []
    for k, names in enumerate(levels):
        at = np.flatnonzero(names >= 0)
        at = at[np.argsort(names[at], kind="stable")]
        gap = np.diff(at)
        near = (names[at[1:]] == names[at[:-1]]) & (gap <= 2 << k)
        first, gap = at[:-1][near], gap[near]
        order = np.lexsort((first, gap))
        first, gap = first[order], gap[order]
        # a position that continues its neighbour's gap, or a progression's, proposes nothing new
        new = np.ones(len(first), dtype=bool)
        new[1:] = (np.diff(first) != 1) | (np.diff(gap) != 0)
        first, gap = first[new], gap[new]
        follows = np.isin(first * (2 << len(levels)) + gap, (first + gap) * (2 << len(levels)) + gap)
        found.append(np.stack([first[~follows], gap[~follows]]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    both = np.unique(np.concatenate(found, axis=1), axis=1)
    return both[0], both[1]


def extend(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends [start, end) of the widest stretch round each proposal that keeps its period."""
    n = len(levels[0]) if levels else 0
    right, left = at.copy(), at.copy()
    for k in reversed(range(len(levels))):
        names, width = levels[k], 1 << k
        a = np.minimum(right, n - 1)
        b = np.minimum(right + period, n - 1)
        right += np.where((right + period < n) & (names[a] >= 0) & (names[a] == names[b]), width, 0)
        a = np.maximum(left - width, 0)
        b = a + period
        left -= np.where((left >= width) & (names[a] >= 0) & (names[a] == names[np.minimum(b, n - 1)]), width, 0)
    return left, right + period


def runs_of(ids: np.ndarray, min_length: int = 24, min_times: int = 3) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs, by start, then period."""
    if min_times < 3:
        raise ValueError("runs shorter than three periods are not all proposed")
    levels = factor_levels(ids)
    at, period = proposals(levels)
    start, end = extend(levels, at, period)
    length = end - start
    long = length >= np.maximum(min_length, min_times * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _run_batches(batches, text: str, keep: list[str], min_length: int, min_times: int):
    for batch in batches:
        for part in text_slices(batch, text, 1 << 20):
            words, ids, base = [], [], 0
            for t in part.column(text):
                # bytes split at exactly the blanks [\x20\x09-\x0D]
                row = (t.as_py() or "").encode().split()
                # words of different texts get different names, so no factor repeats across texts
                name = defaultdict(count(base).__next__)
                ids.append(np.fromiter(map(name.__getitem__, row), dtype=np.int64, count=len(row)))
                base += len(name)
                words.append(row)
            edges = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            start, length, period = runs_of(np.concatenate(ids), min_length, min_times)
            repeat = np.zeros(edges[-1] + 1, dtype=np.int32)
            np.add.at(repeat, start + period, 1)
            np.add.at(repeat, start + length, -1)
            repeated = np.cumsum(repeat[:-1]) > 0
            cuts = np.searchsorted(start, edges)
            collapsed = []
            for i, row in enumerate(words):
                if cuts[i] < cuts[i + 1]:
                    gone = repeated[edges[i]:edges[i + 1]].tolist()
                    row = [w for w, g in zip(row, gone) if not g]
                collapsed.append(b" ".join(row))
            local = start - np.repeat(edges[:-1], np.diff(cuts))
            rows = pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)],
                                              names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows),
                 pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=[*keep, "runs", "collapsed"])


def find_runs(df: DataFrame, text_col: str = "text", min_length: int = 24, min_times: int = 3) -> DataFrame:
    """``df`` with ``runs``, all runs of its words by start, then period, and
    ``collapsed``, the text without the words that repeat a run's first period.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of
    smallest period q, of at least ``min_length`` and ``min_times * q`` words, that
    neither neighbour extends.  ``collapsed`` joins the kept words by one space."""
    keep = [c for c in df.columns if c not in ("runs", "collapsed")]
    if text_col not in keep:  # the text itself is replaced by an output
        raise ValueError(f"the text column may not be named {text_col}")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    schema = ", ".join([*fields, f"runs {RUN}", "collapsed string"])
    return df.select(*keep).mapInArrow(
        lambda it: giving_back(_run_batches(it, text_col, keep, min_length, min_times)), schema)
