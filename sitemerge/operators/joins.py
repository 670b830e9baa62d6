"""Key-matching joins of the loads, written so Catalyst plans them directly.

* ``new_rows``: source rows whose key is not in the target (``LEFT JOIN ... IS
  NULL`` in the loads).  Written as ``left_anti`` because Catalyst keeps the
  outer-join-plus-filter form as an outer join.  A NULL key never matches, so
  such a row counts as new.
* ``gate``: an inner join that supplies no column, only demands a match.  A
  ``left_semi`` gives the same rows without multiplying them.
* ``lookup``: resolve keys to columns of a reference (``left``), or drop rows
  without a match (``inner``, where a null-rejecting filter made the left join
  inner).  Several matches multiply the row, as in the loads.

Keys are given as ``(source expression, reference column)`` pairs; the source
side may be any expression (a cast, a concatenation): Catalyst still plans an
equi-join on it.  The reference keys are renamed to unique names so the condition
never needs aliases.

References that grow with the data are joined by sort and merge (``GROWS``): Catalyst
judges a broadcast by the compressed size of a few columns, and a key column of
millions of rows that fits its threshold on disk is hundreds of megabytes on the
driver.  Where a reference holds few narrow columns beside much wider rows (order and
product ids for order lines), ``hashed`` shuffles both sides alike but hashes each
partition of the reference (``HASHED``), so that neither side is sorted.  Lists that stay small beside the rows they are looked up for (shippers,
categories, territories; employees and suppliers, of which a few hold most rows) are
marked ``small`` and left to Catalyst.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_seq = count()

# (source Column | str, reference column name[, "null_safe"]): a key part
# marked null_safe matches NULL to NULL (<=>); all others use =.
Key = tuple


def _src_col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


GROWS = "merge"
HASHED = "shuffle_hash"


def _prepare(ref: DataFrame, on: list[Key], take: dict[str, str] | None = None, small: bool = False,
             hashed: bool = False):
    """Reference side with its key columns renamed to unique names, and the
    equi-join condition against the source expressions."""
    tag = next(_seq)
    rk = [f"_rk{tag}_{i}" for i in range(len(on))]
    cols = [F.col(k[1]).alias(n) for k, n in zip(on, rk)]
    if take:
        cols += [F.col(r).alias(out) for out, r in take.items()]
    cond = [
        _src_col(k[0]).eqNullSafe(F.col(n)) if len(k) > 2 and k[2] == "null_safe"
        else _src_col(k[0]) == F.col(n)
        for k, n in zip(on, rk)
    ]
    ref = ref.select(*cols)
    return ref if small else ref.hint(HASHED if hashed else GROWS), cond, rk


def new_rows(src: DataFrame, target: DataFrame | None, on: list[Key], hashed: bool = False) -> DataFrame:
    """Rows of ``src`` with no target row on the keys (J-ANTI)."""
    if target is None:
        return src
    r, cond, _ = _prepare(target, on, hashed=hashed)
    return src.join(r, cond, "left_anti")


def gate(src: DataFrame, ref: DataFrame, on: list[Key], small: bool = False, hashed: bool = False) -> DataFrame:
    """Rows of ``src`` with at least one reference row on the keys (J-GATE)."""
    r, cond, _ = _prepare(ref, on, small=small, hashed=hashed)
    return src.join(r, cond, "left_semi")


def lookup(
    src: DataFrame,
    ref: DataFrame,
    on: list[Key],
    take: dict[str, str],
    how: str = "left",
    lowest: bool = False,
    small: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Add ``take`` (output name -> reference column) by matching ``on`` (J-LKP).

    ``how='left'`` keeps unresolved rows with NULLs; ``how='inner'`` drops
    them.  Several matches give several rows, unless ``lowest``: then the
    reference is first reduced to the smallest value per key (a partial
    aggregation), so each source row gets at most one match."""
    r, cond, rk = _prepare(ref, on, take, small or lowest, hashed)
    if lowest:
        r = r.groupBy(*rk).agg(*[F.min(out).alias(out) for out in take])
        r = r if small else r.hint(HASHED if hashed else GROWS)
    return src.join(r, cond, how).drop(*rk)


def dropped(src: DataFrame, ref: DataFrame, on: list[Key]) -> DataFrame:
    """Rows an inner lookup loses (Q-DROP): ``src`` without a match in ``ref``."""
    r, cond, _ = _prepare(ref, on)
    return src.join(r, cond, "left_anti")
