"""U-core against a brute-force reading of UPDATE ... FROM ... JOIN.

Brute force: for each target row, every source row with the same key whose
values differ (null-default comparison) is a candidate; the smallest tuple
of new values (NULLs first) wins.  The Spark plan never builds those pairs."""

import random

from pyspark.sql import functions as F

from sitemerge.operators.upsert import UpdateSpec, apply_update, track, update_summary
from sitemerge.sources.targets import Col, Table, INT, STR, TS

def TS0():
    return F.lit("2024-11-24 00:00:00").cast("timestamp_ntz")

T2 = Table("t2", (Col("id", INT), Col("k", INT), Col("a", STR), Col("b", INT), Col("last_update", TS)),
           ("id",), id_col="id", orig_col="k")


def _key(v):
    # NULLs first, then by value
    return tuple((x is not None, x) for x in v)


def brute(tgt, src):
    out = {}
    for tid, k, a, b, lu in tgt:
        cands = [(sa, sb) for sk, sa, sb in src if sk is not None and sk == k
                 and ((sa or "") != (a or "") or (sb or 0) != (b or 0))]
        if cands:
            na, nb = min(cands, key=_key)
            out[tid] = (na, nb, "upd")
        else:
            out[tid] = (a, b, lu)
    return out


def test_multi_match_matches_brute_force(spark):
    rnd = random.Random(7)
    vals_a = [None, "", "x", "y"]
    vals_b = [None, 0, 1, 2]
    for trial in range(4):
        tgt = [(i, rnd.choice([None, 1, 2, 3]), rnd.choice(vals_a), rnd.choice(vals_b), None)
               for i in range(1, 40)]
        src = [(rnd.choice([None, 1, 2, 3, 4]), rnd.choice(vals_a), rnd.choice(vals_b))
               for _ in range(60)]
        tdf = spark.createDataFrame(tgt, T2.schema)
        sdf = spark.createDataFrame(src, "k int, a string, b int")
        spec = UpdateSpec("t", sdf, [("k", "k")], [track("a", "a", "text"), track("b", "b", "count")])
        got = {r["id"]: (r["a"], r["b"], "upd" if r["last_update"] is not None else None)
               for r in apply_update(tdf, spec, T2, TS0()).collect()}
        assert got == brute(tgt, src), f"trial {trial}"


def test_multi_match_smallest_differing_tuple(spark):
    # one target row, three source rows of which one equals it
    tdf = spark.createDataFrame([(1, 9, "b", 1, None)], T2.schema)
    sdf = spark.createDataFrame([(9, "b", 1), (9, "c", 0), (9, None, 5)], "k int, a string, b int")
    spec = UpdateSpec("t", sdf, [("k", "k")], [track("a", "a", "text"), track("b", "b", "count")])
    row = apply_update(tdf, spec, T2, TS0()).first()
    assert (row["a"], row["b"]) == (None, 5)


def test_no_pairs_in_plan(spark):
    tdf = spark.createDataFrame([(1, 9, "b", 1, None)], T2.schema)
    sdf = spark.createDataFrame([(9, "b", 1)], "k int, a string, b int")
    spec = UpdateSpec("t", sdf, [("k", "k")], [track("a", "a", "text")])
    plan = apply_update(tdf, spec, T2, TS0())._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_summary_reads_the_source_once_and_limits_before_the_shuffle(spark):
    sdf = spark.range(100).selectExpr("cast(id % 3 as int) k", "cast(id as string) a")
    spec = UpdateSpec("t", sdf, [("k", "k")], [track("a", "a", "text")])
    plan = update_summary(spec)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Range") == 1 and "Join" not in plan
    assert "Partial" in next(line for line in plan.splitlines()[::-1] if "WindowGroupLimit" in line)
