"""Published ODS states: tables cut into key ranges, one commit record per run.

Layout under the root (any file system Spark reads)::

    <table>/write=<tag>/key_range=<r>/part-*.parquet     rows, never changed once written
    _runs/run=<id>/start/...                             what the run began with
    _runs/run=<id>/table=<name>/...                      a finished table of the run
    _commits/seq=<n>/...                                 the whole ODS after a run
    _rejects/run=<id>/table=<name>/rows, counts          what a run kept out, if it judges rows
    _kept, _kept_runs                                    key counts for the quality reports, if kept

A record row names, for one table, the folders that hold each of its ranges.  A
run writes only the ranges it changes; the record carries the others over by
name.  The commit is written last, as one file, so readers see the ODS before the
run or after it and nothing between: a broken run leaves finished tables in
``_runs``, which its restart takes up, and folders that no record names.

Ranges.  ``range_of`` maps a row to its range by the source key that the loads
match on: ``k<n>`` for the n-th interval of ``width`` keys (``width`` is set when the
table is first published and stays, so keys that keep growing open new ranges and
old ones stay as they are), ``h<n>`` by hash for keys that are no whole numbers and
``n<n>``, intervals of the surrogate id, for rows without a source key.  Both ends
of an equality on the source key fall into the same range.

One run at a time writes a store: a second writer of the same commit fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_shuffles
from .targets import Table, contract, empty_state

RANGES = 64  # intervals of a table's keys when it is first published
HASHED = 16  # ranges of keys that are no whole numbers
MOST_FOLDERS = 8  # folders of a range beyond which the next run that adds to it rewrites it

REPORT = "table_name string, statement string, key_text string, reasons array<string>, row_text string"

RECORD = ("table string, width long, max_id long, contract string, "
          "pieces array<struct<key_range: string, folder: string, rows: long>>")


class StateError(RuntimeError):
    """A published state that can't be used: another schema, or another run's."""


def range_of(key: Column, id_col: Column, width: int) -> Column:
    """The range of a source key; of the surrogate id where the key is null."""
    whole = key.cast("string").try_cast("long")
    return (F.when(key.isNull(), F.concat(F.lit("n"), F.floor(id_col / F.lit(width)).cast("string")))
            .when(whole.isNotNull(), F.concat(F.lit("k"), F.floor(whole / F.lit(width)).cast("string")))
            .otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64(key.cast("string")), F.lit(HASHED)).cast("string"))))


def key_column(table: Table) -> str:
    return table.orig_col or table.pk[0]


@dataclass(frozen=True)
class TableState:
    """Where the rows of one table are."""

    name: str
    width: int
    max_id: int
    pieces: tuple[tuple[str, str, int], ...] = ()  # (key_range, folder, rows)
    contract: str = ""

    @property
    def rows(self) -> int:
        return sum(n for *_, n in self.pieces)

    @property
    def ranges(self) -> set[str]:
        return {r for r, *_ in self.pieces}

    def row(self) -> tuple:
        return (self.name, self.width, self.max_id, self.contract, [list(p) for p in self.pieces])

    @classmethod
    def of(cls, row) -> TableState:
        return cls(row["table"], row["width"], row["max_id"],
                   tuple(sorted((p["key_range"], p["folder"], p["rows"]) for p in row["pieces"])), row["contract"])


@dataclass(frozen=True)
class Commit:
    seq: int
    run: str
    load_ts: str
    tables: dict[str, TableState] = field(default_factory=dict)


def _commit(seq: int, rows: list) -> Commit:
    return Commit(seq, rows[0]["run"], rows[0]["load_ts"], {r["table"]: TableState.of(r) for r in rows})


class Store:
    def __init__(self, spark: SparkSession, root: str, ranges: int = RANGES):
        self.spark, self.root, self.target_ranges = spark, root.rstrip("/"), ranges
        drop_shuffles(spark)
        self._whole: dict[tuple, DataFrame] = {}  # listed once: files of a state never change

    # ---- records

    def _put(self, rows: list[tuple], schema: str, path: str) -> None:
        """One small file; fails where the folder is already written."""
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").json(f"{self.root}/{path}")

    def _get(self, schema: str, path: str) -> list:
        try:
            return self.spark.read.schema(schema).option("basePath", self.root).json(f"{self.root}/{path}").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def current(self) -> Commit | None:
        """The last committed ODS."""
        rows = self._get(f"{RECORD}, run string, load_ts string, seq long", "_commits/seq=*")
        if not rows:
            return None
        last = max(r["seq"] for r in rows)
        return _commit(last, [r for r in rows if r["seq"] == last])

    def commit_at(self, seq: int) -> Commit:
        """The ODS after an earlier run."""
        rows = self._get(f"{RECORD}, run string, load_ts string", f"_commits/seq={seq}")
        if not rows:
            raise StateError(f"no commit {seq}")
        return _commit(seq, rows)

    def begin(self, run: str, load_ts: str, options: str) -> tuple[Commit | None, dict[str, TableState], str]:
        """(the commit the run builds on, its finished tables, its load stamp).

        A run that began earlier and did not commit goes on with the stamp it had;
        options that differ, or a commit that came between, are errors."""
        now = self.current()
        base = now.seq if now else 0
        began = self._get("base long, load_ts string, options string", f"_runs/run={run}/start")
        if not began:
            self._put([(base, load_ts, options)], "base long, load_ts string, options string", f"_runs/run={run}/start")
            return now, {}, load_ts
        if began[0]["base"] != base:
            raise StateError(f"run {run} began on commit {began[0]['base']}, but commit {base} is current")
        if began[0]["options"] != options:
            raise StateError(f"run {run} began with options {began[0]['options']}, not {options}")
        done = self._get(RECORD, f"_runs/run={run}/table=*")
        return now, {r["table"]: TableState.of(r) for r in done}, began[0]["load_ts"]

    def finished(self, run: str, state: TableState) -> None:
        self._put([state.row()], RECORD, f"_runs/run={run}/table={state.name}")

    def commit(self, base: Commit | None, run: str, load_ts: str, tables: dict[str, TableState]) -> Commit:
        seq = (base.seq if base else 0) + 1
        self._put([(*t.row(), run, load_ts) for t in tables.values()], f"{RECORD}, run string, load_ts string",
                  f"_commits/seq={seq}")
        return Commit(seq, run, load_ts, dict(tables))

    # ---- rejects

    def put_rejects(self, run: str, name: str, report: DataFrame, counts: list[tuple]) -> None:
        """What the run kept out of a table; a restart of the run writes it anew.
        ``counts``: (statement, accepted, rejected)."""
        at = f"{self.root}/_rejects/run={run}/table={name}"
        report.write.mode("overwrite").parquet(f"{at}/rows")
        frame = self.spark.createDataFrame(counts, "statement string, accepted long, rejected long")
        frame.coalesce(1).write.mode("overwrite").json(f"{at}/counts")

    def rejects(self, run: str) -> DataFrame:
        """The rows that a run kept out, with reasons."""
        return self._rejected(run, "rows", REPORT)

    def reject_counts(self, run: str) -> DataFrame:
        """Per table and insert: rows that fit and rows that don't."""
        return self._rejected(run, "counts", "table string, statement string, accepted long, rejected long")

    def _rejected(self, run: str, what: str, schema: str) -> DataFrame:
        at = f"{self.root}/_rejects/run={run}"
        read = self.spark.read.schema(schema).option("basePath", at)
        try:
            return (read.parquet if what == "rows" else read.json)(f"{at}/table=*/{what}").drop(
                *(["table"] if what == "rows" else []))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # a run that did not judge

    # ---- rows

    def read(self, state: TableState | None, table: Table, ranges: set[str] | None = None) -> DataFrame:
        """The table's rows and their ``key_range``; of some ranges only, if given.

        The filter is on the folders' partition columns, so the files of other ranges
        are no input of the scan."""
        if state is not None and state.contract != contract(table):
            raise StateError(f"published state of {table.name} differs from its declaration: "
                             + "; ".join(_differences(json.loads(state.contract), json.loads(contract(table)))))
        if ranges is None and (state, table) in self._whole:
            return self._whole[state, table]
        folders: dict[str, set[str]] = {}
        for key_range, folder, _ in state.pieces if state else ():
            if ranges is None or key_range in ranges:
                folders.setdefault(folder, set()).add(key_range)
        if not folders:
            return empty_state(self.spark, table).withColumn("key_range", F.lit(None).cast("string"))
        base = f"{self.root}/{table.name}"
        schema = T.StructType([*table.schema.fields, T.StructField("write", T.StringType()),
                               T.StructField("key_range", T.StringType())])
        rows = (self.spark.read.schema(schema).option("basePath", base)
                .parquet(*(f"{base}/write={f}" for f in sorted(folders))))
        here = F.lit(False)
        for folder, some in sorted(folders.items()):
            here = here | ((F.col("write") == folder) & F.col("key_range").isin(sorted(some)))
        rows = rows.where(here).drop("write")
        if ranges is None:
            self._whole[state, table] = rows
        return rows

    def with_range(self, df: DataFrame, table: Table, width: int) -> DataFrame:
        key = F.col(key_column(table))
        return df.withColumn("key_range", range_of(key, F.col(table.id_col) if table.id_col else key, width))

    def write(self, df: DataFrame, table: Table) -> tuple[str, list]:
        """Write rows with their ``key_range`` to a new folder: (its tag, rows and
        largest id per range, from the written files)."""
        tag = uuid.uuid4().hex[:16]
        path = f"{self.root}/{table.name}/write={tag}"
        # AQE splits a large range over several tasks and merges small ones
        df.select(*table.names, "key_range").hint("rebalance", "key_range").write.mode(
            "errorifexists").partitionBy("key_range").parquet(path)
        schema = T.StructType([*table.schema.fields, T.StructField("key_range", T.StringType())])
        largest = F.max(table.id_col) if table.id_col else F.lit(0)
        return tag, (self.spark.read.schema(schema).parquet(path).groupBy("key_range").agg(
            F.count(F.lit(1)).alias("n"), largest.cast("long").alias("id")).collect())

    def first_width(self, df: DataFrame, table: Table) -> int:
        """Interval width that cuts the keys present into about ``ranges`` intervals."""
        whole = F.col(key_column(table)).cast("string").try_cast("long")
        r = df.agg(F.max(whole).alias("k"), F.max(table.id_col or table.pk[0]).alias("i")).first()
        return max(1, -(-(max(r["k"] or 0, r["i"] or 0) + 1) // self.target_ranges))

    def publish(self, table: Table, old: TableState | None, changed: DataFrame | None, new: DataFrame,
                whole: DataFrame | None = None) -> TableState:
        """The state after replacing the rows of ``old`` that ``changed`` holds (by
        primary key, under their ``key_range``) and adding ``new``.  ``whole``, if given,
        holds all rows of the ranges of ``changed`` with the changed ones in place, so
        that none is looked for in ``old``.

        Ranges with a changed row are rewritten; ranges that only grow get one more
        folder; without a changed or new row nothing is written."""
        hit = set()
        if old is not None and changed is not None:
            hit = {r["key_range"] for r in changed.select("key_range").distinct().collect()}
        touched = set(hit)
        no_new = new.isEmpty()
        if old is None or not old.pieces:
            width = self.first_width(new, table) if old is None else old.width
            old = TableState(table.name, width, old.max_id if old else 0, (), contract(table))
        if not touched and no_new:
            return old
        parts = []
        if not no_new:
            new = self.with_range(new.select(*table.names), table, old.width)
            parts.append(new)
            held: dict[str, int] = {}
            for key_range, *_ in old.pieces:
                held[key_range] = held.get(key_range, 0) + 1
            full = {r for r, n in held.items() if n >= MOST_FOLDERS}
            if full:
                touched |= {r["key_range"] for r in
                            new.where(F.col("key_range").isin(sorted(full))).select("key_range").distinct().collect()}
        if touched:
            at_hand = hit if whole is not None else set()
            if at_hand:
                parts.append(whole.where(F.col("key_range").isin(sorted(at_hand))).select(*table.names, "key_range"))
            before = self.read(old, table, touched - at_hand)
            if changed is not None and not at_hand:
                before = before.join(changed.select(*table.pk).hint("merge"), list(table.pk), "left_anti")
                parts.append(changed.select(*table.names, "key_range"))
            parts.append(before.select(*table.names, "key_range"))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        tag, counts = self.write(rows, table)
        pieces = [p for p in old.pieces if p[0] not in touched]
        pieces += [(r["key_range"], tag, r["n"]) for r in counts]
        return replace(old, pieces=tuple(sorted(pieces)),
                       max_id=max([old.max_id, *(r["id"] or 0 for r in counts)]))


def _differences(stored: dict, declared: dict) -> list[str]:
    out = [f"primary key {stored['pk']} is now {declared['pk']}"] if stored["pk"] != declared["pk"] else []
    was, now = ({c["name"]: c for c in x["columns"]} for x in (stored, declared))
    for name in [*was, *(n for n in now if n not in was)]:
        a, b = was.get(name), now.get(name)
        if a != b:
            say = lambda c: "absent" if c is None else c["type"] + (f" width {c['width']}" if c["width"] else "")
            out.append(f"{name}: stored {say(a)}, declared {say(b)}")
    return out or ["order of columns"]
