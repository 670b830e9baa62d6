"""Quality reports kept beside a store and brought forward by what a run changed.

The full reports (:mod:`.checks`) group every state by its keys in each run.  Here the
counts they group by are kept, and a commit's changes are merged into them:

1. Two commit records name every table's folders, so the rows that changed between
   them lie in the folders that only one of them names: those of the later commit
   count +1, those of the earlier -1.  Rows that a run carried along while it rewrote
   their range cancel out; ranges that it left alone are not read.
2. Each such row gives one entry per *measure* it takes part in (a primary key, either
   end of a foreign key, an address lookup, a source key); one aggregation a measure nets
   them, with whole numbers as they are stored, and its result gets the keys' texts.
3. Kept counts lie in folders by interval of the key (as in the store, intervals of the
   first key column) and by ``bad``, whether the key violates its measure.  The intervals
   with an entry are rewritten, the others carried over by name; a record, written
   last, names the folders.

A report then reads only the ``bad`` folders, so it grows with what it reports.

Counts subtract, but the smallest and largest id of an address text do not: keys that
lost a row are looked up again in the whole address state (its text columns only).

Defined results: a key part may be null (a null primary key is reported; a null
reference or lookup text is none); keys are compared as text, byte by byte; the kept
counts of a commit are made once, and a broken refresh leaves the earlier ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..sources.store import Commit, Store, TableState, range_of
from ..sources.targets import TABLES, ForeignKey, Table
from .loads import ORDER

MOST_RANGES = 10_000  # intervals named in a scan's filter; beyond it all kept counts are read

KINDS = ("pk", "fk", "fan", "clash")

ROW = "measure string, key array<string>, a long, b long, lo long, hi long"
RECORD = "width long, bucket string, folder string"

LOOKUPS = [  # as in q_fan: name, condition, key columns of the address table
    ("full_address", None, ["full_address"]),
    ("full_address_site1", "site_id = 1", ["full_address"]),
    ("full_address_site2", "site_id = 2", ["full_address"]),
    ("full_address_country", None, ["full_address", "country"]),
]


@dataclass(frozen=True)
class Feed:
    """One way a table's rows enter a measure: under ``cols`` as the key, counted in
    ``side`` a or b; ``ids`` names the column whose smallest and largest value is kept."""

    measure: str
    cols: tuple[str, ...]
    side: str = "a"
    where: str | None = None
    nulls: bool = False  # whether a key with a null part counts
    ids: str | None = None

    @property
    def kind(self) -> str:
        return self.measure.split(":")[0]

    def kinds_of_key(self, rows: DataFrame) -> list[str]:
        """A type for each key column that tells apart what its text does."""
        return ["long" if isinstance(rows.schema[c].dataType, T.IntegralType) else "string" for c in self.cols]

    def entries(self, rows: DataFrame, sign: int, types: list[str]) -> DataFrame:
        """The key as columns of ``types``, what it adds to a and b, and the id."""
        tests = [] if self.nulls else [F.col(c).isNotNull() for c in self.cols]
        tests += [F.expr(self.where)] if self.where else []
        n, zero = F.lit(sign).cast("long"), F.lit(0).cast("long")
        return (rows.where(reduce(and_, tests)) if tests else rows).select(
            *(F.col(c).cast(t).alias(k) for c, t, k in zip(self.cols, types, key_names(len(types)))),
            *([F.col(self.ids).cast("long").alias("id")] if self.ids else []),
            (n if self.side == "a" else zero).alias("a"),
            (n if self.side == "b" else zero).alias("b"))


def key_names(n: int) -> list[str]:
    return [f"_k{i}" for i in range(n)]


def key_text(n: int) -> Column:
    return F.array(*(F.col(k).cast("string") for k in key_names(n)))


def netted(measure: str, feeds: list[tuple[Feed, DataFrame, int]]) -> DataFrame:
    """Net change per key of one measure: the feeds' rows count ``sign`` each."""
    told = [f.kinds_of_key(rows) for f, rows, _ in feeds]
    types = [t[0] if len(set(t)) == 1 else "string" for t in zip(*told)]
    rows, keys = union([f.entries(r, sign, types) for f, r, sign in feeds]), key_names(len(types))
    sums, none = (F.sum("a").alias("a"), F.sum("b").alias("b")), F.lit(None).cast("long")
    if "id" in rows.columns:
        held = F.when(F.col("a") > 0, F.col("id"))
        net = (rows.groupBy(*keys, "id").agg(*sums).where("a <> 0 or b <> 0")
               .groupBy(*keys).agg(*sums, F.min(held).alias("lo"), F.max(held).alias("hi"),
                                   F.max(F.col("id").isNotNull() & (F.col("a") < 0)).alias("lost")))
    else:
        net = rows.groupBy(*keys).agg(*sums).where("a <> 0 or b <> 0").select(
            "*", none.alias("lo"), none.alias("hi"), F.lit(False).alias("lost"))
    return net.select(F.lit(measure).alias("measure"), key_text(len(types)).alias("key"), "a", "b", "lo", "hi", "lost")


def fk_measure(child: str, fk: ForeignKey) -> str:
    return f"fk:{child}:{','.join(fk.cols)}:{fk.parent}"


def clash_tables() -> list[str]:
    return [n for n in ORDER if TABLES[n].orig_col and TABLES[n].site_col]


def feeds(name: str) -> list[Feed]:
    """Every measure that rows of the table ``name`` take part in."""
    table = TABLES[name]
    out = [Feed(f"pk:{name}", tuple(table.pk), nulls=True)]
    out += [Feed(fk_measure(name, fk), tuple(fk.cols)) for fk in table.fks]
    out += [Feed(fk_measure(child, fk), tuple(fk.parent_cols), side="b")
            for child in ORDER for fk in TABLES[child].fks if fk.parent == name]
    if name in clash_tables():
        out += [Feed(f"clash:{name}", (table.orig_col,), side, f"{table.site_col} = {site}")
                for site, side in ((1, "a"), (2, "b"))]
    if name == "address":
        out += [Feed(f"fan:{look}", tuple(cols), where=where, ids=table.id_col) for look, where, cols in LOOKUPS]
    return out


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), parts)


def violates() -> Column:
    """Whether a kept key violates its measure."""
    kind = F.substring_index("measure", ":", 1)
    a, b = F.col("a"), F.col("b")
    return (F.when(kind == "pk", (a > 1) | F.exists("key", lambda k: k.isNull()))
            .when(kind == "fan", a > 1)
            .when(kind == "fk", (a > 0) & (b == 0))
            .otherwise((a > 0) & (b > 0)))


def changed_pieces(old: TableState | None, new: TableState) -> list[tuple[int, TableState]]:
    """(sign, state) of the folders that only one of two states names."""
    before = set(old.pieces) if old else set()
    after = set(new.pieces)
    out = []
    if after - before:
        out.append((1, replace(new, pieces=tuple(sorted(after - before)))))
    if before - after:
        out.append((-1, replace(old, pieces=tuple(sorted(before - after)))))
    return out


class KeptChecks:
    """The counts of some kinds of measures; other kinds beside the same store are kept
    by themselves."""

    def __init__(self, store: Store, kinds: tuple[str, ...] = KINDS):
        self.store, self.spark, self.kinds = store, store.spark, kinds
        self.tag = "" if kinds == KINDS else "_" + "_".join(kinds)
        self.base = f"{store.root}/_kept{self.tag}"

    def feeds(self, name: str) -> list[Feed]:
        return [f for f in feeds(name) if f.kind in self.kinds]

    # ---- records

    def _record(self, most: int) -> tuple[int, int, list[tuple[str, str]]] | None:
        """(commit, interval width, [(interval, folder)]) of the latest counts up to a commit."""
        rows = self.store._get(f"{RECORD}, seq long", f"_kept_runs{self.tag}/seq=*")
        rows = [r for r in rows if r["seq"] <= most]
        if not rows:
            return None
        last = max(r["seq"] for r in rows)
        rows = [r for r in rows if r["seq"] == last]
        return last, rows[0]["width"], sorted((r["bucket"], r["folder"]) for r in rows if r["folder"])

    def _read(self, pieces: list[tuple[str, str]], bad: bool | None = None) -> DataFrame:
        folders: dict[str, list[str]] = {}
        for bucket, folder in pieces:
            folders.setdefault(folder, []).append(bucket)
        if not folders:
            return self.spark.createDataFrame([], f"{ROW}, bucket string, bad boolean")
        rows = (self.spark.read.schema(f"{ROW}, write string, bucket string, bad boolean")
                .option("basePath", self.base).parquet(*(f"{self.base}/write={f}" for f in sorted(folders))))
        here = reduce(or_, [(F.col("write") == f) & F.col("bucket").isin(b) for f, b in sorted(folders.items())])
        return rows.where(here if bad is None else here & (F.col("bad") == bad)).drop("write")

    # ---- refresh

    def _delta(self, old: dict[str, TableState], new: dict[str, TableState], width: int) -> DataFrame | None:
        """Net change per measure and key between two commits; None: no folder differs."""
        parts: dict[str, list[tuple[Feed, DataFrame, int]]] = {}
        for name in ORDER:
            some = self.feeds(name)
            for sign, state in changed_pieces(old.get(name), new[name]) if some and name in new else ():
                rows = self.store.read(state, TABLES[name])
                for f in some:
                    parts.setdefault(f.measure, []).append((f, rows, sign))
        if not parts:
            return None
        net = union([netted(measure, feeds) for measure, feeds in parts.items()])
        return net.withColumn("bucket", range_of(F.col("key")[0], F.lit(0), width))

    def _looked_up(self, keys: DataFrame, tables: dict[str, TableState]) -> DataFrame:
        """Smallest and largest id of some lookup keys, from the whole states."""
        parts = []
        for name in ORDER:
            if name in tables:
                rows = self.store.read(tables[name], TABLES[name])
                parts += [f.entries(rows, 1, ["string"] * len(f.cols)).select(
                    F.lit(f.measure).alias("measure"), key_text(len(f.cols)).alias("key"), "id")
                    for f in self.feeds(name) if f.ids]
        found = union(parts).join(keys.hint("merge"), ["measure", "key"], "left_semi")
        return found.groupBy("measure", "key").agg(F.min("id").alias("lo_now"), F.max("id").alias("hi_now"))

    def refresh(self, commit: Commit | None = None) -> int:
        """Bring the counts to a commit (the current one); the number of intervals written."""
        commit = commit or self.store.current()
        last = self._record(commit.seq)
        if last and last[0] == commit.seq:
            return 0
        old = self.store.commit_at(last[0]).tables if last else {}
        width = last[1] if last else max(
            1, -(-(max([t.max_id for t in commit.tables.values()], default=0) + 1) // self.store.target_ranges))
        pieces = last[2] if last else []
        delta = self._delta(old, commit.tables, width)
        touched: set[str] = set()
        if delta is not None and not last:  # nothing to merge with, and no key can lose a row
            pieces = self._written(delta)
            self.store._put([(width, b, f) for b, f in pieces] or [(width, None, None)], RECORD, f"_kept_runs{self.tag}/seq={commit.seq}")
            return len(pieces)
        if delta is not None:
            delta = materialize(delta, "kept-delta")
            rows = delta.select("bucket").distinct().limit(MOST_RANGES + 1).collect()
            touched = {r["bucket"] for r in rows} if len(rows) <= MOST_RANGES else {
                *(b for b, _ in pieces), *(r["bucket"] for r in delta.select("bucket").distinct().toLocalIterator())}
        if touched:
            pieces = [p for p in pieces if p[0] not in touched] + self._merged(
                delta, [p for p in pieces if p[0] in touched], commit.tables)
        self.store._put([(width, b, f) for b, f in pieces] or [(width, None, None)], RECORD, f"_kept_runs{self.tag}/seq={commit.seq}")
        return len(touched)

    def _merged(self, delta: DataFrame, pieces: list, tables: dict[str, TableState]) -> list[tuple[str, str]]:
        """Write the intervals of ``pieces`` with the delta merged in: [(interval, folder)]."""
        rows = delta  # a key is there once
        if pieces:
            before = self._read(pieces).drop("bad").withColumn("lost", F.lit(False))
            rows = before.unionByName(delta).groupBy("bucket", "measure", "key").agg(
                F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                F.max("lost").alias("lost"))
        rows = rows.where("a <> 0 or b <> 0")
        lost = delta.where("lost").select("measure", "key")
        if not lost.isEmpty():
            rows = rows.join(self._looked_up(lost, tables).hint("merge"), ["measure", "key"], "left")
            for end in ("lo", "hi"):
                rows = rows.withColumn(end, F.when(F.col("lost"), F.col(f"{end}_now")).otherwise(F.col(end)))
        return self._written(rows)

    def _written(self, rows: DataFrame) -> list[tuple[str, str]]:
        """Write whole intervals to a new folder: [(interval, folder)]."""
        tag = uuid.uuid4().hex[:16]
        path = f"{self.base}/write={tag}"
        (rows.withColumn("bad", violates()).select("measure", "key", "a", "b", "lo", "hi", "bucket", "bad")
         .hint("rebalance", "bucket").sortWithinPartitions("bucket", "bad", "measure")
         .write.mode("errorifexists").partitionBy("bucket", "bad").parquet(path))
        written = self.spark.read.schema(f"{ROW}, bucket string, bad boolean").parquet(path)
        return [(r["bucket"], tag) for r in written.select("bucket").distinct().collect()]

    # ---- reports

    def counts(self, bad: bool | None = None, commit: Commit | None = None) -> DataFrame:
        """The kept counts of a commit (the current one), or those that violate."""
        commit = commit or self.store.current()
        last = self._record(commit.seq)
        if last is None or last[0] != commit.seq:
            raise ValueError(f"no counts of commit {commit.seq}: refresh first")
        return self._read(last[2], bad)

    def _bad(self, kind: str) -> DataFrame:
        if kind not in self.kinds:
            raise ValueError(f"{kind} is not kept: {', '.join(self.kinds)}")
        rows = self.counts(bad=True).where(F.col("measure").startswith(f"{kind}:"))
        text = F.array_join("key", "|", "NULL")
        return rows.select("measure", F.substring_index("measure", ":", -1).alias("of"), text.alias("key_text"),
                           "key", "a", "b", "lo", "hi")

    def pk(self) -> DataFrame:
        """As ``q_pk`` on the states: table_name, key_text, problem, n."""
        null = F.exists("key", lambda k: k.isNull())
        return self._bad("pk").select(
            F.col("of").alias("table_name"), "key_text",
            F.when(null, F.lit("null")).otherwise(F.lit("duplicate")).alias("problem"), F.col("a").alias("n"))

    def fk(self) -> DataFrame:
        """As ``q_fk``: the orphans of every foreign key."""
        known = self.spark.createDataFrame(
            [(fk_measure(n, fk), n, ",".join(fk.cols), fk.parent) for n in ORDER for fk in TABLES[n].fks],
            "measure string, table_name string, fk_cols string, parent string")
        found = self._bad("fk").groupBy("measure").agg(F.sum("a").alias("orphans"))
        return known.join(found, "measure", "left").select(
            "table_name", "fk_cols", "parent", F.coalesce("orphans", F.lit(0)).cast("long").alias("orphans"))

    def fan(self) -> DataFrame:
        """As ``q_fan``: lookup, key_text, matches, min_id, max_id."""
        return self._bad("fan").select(F.col("of").alias("lookup"), "key_text", F.col("a").alias("matches"),
                                       F.col("lo").alias("min_id"), F.col("hi").alias("max_id"))

    def clash(self) -> DataFrame:
        """Per table with a source key and a site: source keys that rows of both sites hold."""
        known = self.spark.createDataFrame([(f"clash:{n}", n) for n in clash_tables()], "measure string, table_name string")
        found = self._bad("clash").groupBy("measure").agg(F.count(F.lit(1)).alias("clashes"))
        return known.join(found, "measure", "left").select(
            "table_name", F.coalesce("clashes", F.lit(0)).cast("long").alias("clashes"))


def state_clashes(state: DataFrame, table: Table) -> DataFrame:
    """The same for one state by a full scan: its clashing source keys."""
    key = F.col(table.orig_col).cast("string").alias("orig_key")
    sites = [state.where((F.col(table.site_col) == s) & F.col(table.orig_col).isNotNull()).select(key).distinct()
             for s in (1, 2)]
    return sites[0].join(sites[1].hint("merge"), "orig_key", "left_semi")
