"""Column expressions for change detection and value mapping.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  The rules they encode:

* null-default equality: ``coalesce(a, d) = coalesce(b, d)``, so NULL equals
  the sentinel ``d`` (not ``<=>``, where NULL equals only NULL);
* sentinels by family: ``''`` for text, ``1900-01-01 00:00:00`` for
  timestamps (what ``''`` converts to for a datetime), ``-1`` for prices and
  ``0`` for counts, rates and flags;
* ``CONCAT`` reads NULL as empty and never returns NULL (Spark's ``concat``
  would return NULL and ``concat_ws`` would drop the blank).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The sentinel that a NULL stands for in change detection.
TEXT_SENTINEL = ""
DATE_SENTINEL = "1900-01-01 00:00:00"
PRICE_SENTINEL = -1
COUNT_SENTINEL = 0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def typed_null(dtype: T.DataType | str) -> Column:
    """A NULL of a given type (an untyped NULL would make a ``void`` column)."""
    return F.lit(None).cast(dtype)


def sentinel(kind: str) -> Column:
    """Typed sentinel literal for a column family: text, date, price, count, flag."""
    if kind == "text":
        return F.lit(TEXT_SENTINEL)
    if kind == "date":
        return F.lit(DATE_SENTINEL).cast("timestamp_ntz")
    if kind == "price":
        return F.lit(PRICE_SENTINEL)
    if kind == "count":
        return F.lit(COUNT_SENTINEL)
    if kind == "flag":
        return F.lit(False)
    raise ValueError(kind)


def null_default(x, kind: str) -> Column:
    return F.coalesce(_c(x), sentinel(kind))


def null_default_eq(a, b, kind: str) -> Column:
    """``ISNULL(a, d) = ISNULL(b, d)`` with a typed sentinel ``d``."""
    return null_default(a, kind) == null_default(b, kind)


def changed(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any (source, target) comparison value differs.

    Both sides are expected to be NULL-free already (coalesced), so this is
    ``NOT (a1 = b1 AND a2 = b2 ...)`` written as a disjunction."""
    return reduce(or_, [~(s == t) for s, t in pairs])


def concat_null_empty(*parts) -> Column:
    """``CONCAT(a, ' ', b)`` as the loads mean it: NULL reads as empty text.

    Parts are columns or column names; pass literals as ``F.lit(...)``."""
    return F.concat(*[F.coalesce(_c(p), F.lit("")) for p in parts])


def discontinued_from_active(is_active) -> Column:
    """``CAST(CASE WHEN IsActive = 1 THEN 0 ELSE 1 END AS bit)``: NULL gives true."""
    return F.when(_c(is_active) == 1, F.lit(False)).otherwise(F.lit(True))


def termination_from_active(is_active, load_ts: Column) -> Column:
    """``CASE WHEN IsActive = 0 THEN getDate() END``: NULL otherwise."""
    return F.when(_c(is_active) == 0, load_ts)


def text_key(x, collation: str | None = None) -> Column:
    """A text value used as a join key.

    ``collation=None`` compares bytes exactly; a Spark collation name such as
    ``UTF8_LCASE_RTRIM`` gives the case- and trailing-blank-blind comparison of
    the source database's usual default."""
    col = _c(x)
    return col if collation is None else F.collate(col, collation)


def any_true(cols: list[Column]) -> Column:
    return reduce(or_, cols)
