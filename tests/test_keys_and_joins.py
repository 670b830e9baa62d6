"""KEY-ID and the key-matching joins."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitemerge.sources.targets import TABLES
from sitemerge.operators.joins import gate, lookup, new_rows
from sitemerge.operators.keys import assign_ids


def test_assign_ids_equals_global_row_number(spark):
    rnd = random.Random(3)
    rows = list({(rnd.randint(0, 50), rnd.choice([None, "a", "b", "c"]), rnd.randint(0, 5))
                 for _ in range(400)})
    df = spark.createDataFrame(rows, "x int, y string, z int")
    order = ["x", "y", "z"]
    got = assign_ids(df, "id", order, start=100, partitions=7)
    ref = df.withColumn("rid", 100 + F.row_number().over(
        Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    joined = got.join(ref, [got[c].eqNullSafe(ref[c]) for c in order], "full_outer")
    assert joined.where(~F.col("id").eqNullSafe(F.col("rid"))).count() == 0
    assert got.count() == len(rows)
    assert got.agg(F.min("id"), F.max("id")).first() == (101, 100 + len(rows))


def test_assign_ids_has_no_single_partition_exchange(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = assign_ids(df, "nid", ["v", "id"], partitions=4)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "SinglePartition" not in plan


def test_ids_are_a_projection_of_the_written_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = assign_ids(df, "nid", ["v", "id"], partitions=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert sorted(r[0] for r in got.select("nid").collect()) == list(range(1, 1001))
    none = assign_ids(df.where("v > 9"), "nid", ["v", "id"], partitions=4)
    assert none.columns == got.columns and none.count() == 0


def test_null_key_is_always_new(spark):
    src = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "k int, v string")
    tgt = spark.createDataFrame([(None,), (1,)], "k int")
    new = new_rows(src, tgt, [("k", "k")]).distinct()
    assert sorted(new.collect(), key=str) == sorted([(None, "a")], key=str)


def test_anti_join_is_left_anti(spark):
    src = spark.createDataFrame([(1,)], "k int")
    tgt = spark.createDataFrame([(1,)], "k int")
    plan = new_rows(src, tgt, [("k", "k")])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_gate_does_not_multiply(spark):
    src = spark.createDataFrame([(1, "x")], "k int, v string")
    ref = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert gate(src, ref, [("k", "k")]).count() == 1


def test_lookup_fans_out_and_inner_drops(spark):
    src = spark.createDataFrame([(1,), (2,)], "k int")
    ref = spark.createDataFrame([(1, 10), (1, 11)], "k int, id int")
    left = lookup(src, ref, [("k", "k")], {"rid": "id"})
    assert sorted((r["k"], r["rid"]) for r in left.collect()) == sorted(
        [(1, 10), (1, 11), (2, None)], key=str)
    assert lookup(src, ref, [("k", "k")], {"rid": "id"}, how="inner").count() == 2


def test_order_of_new_ids_holds_every_inserted_column():
    for table in TABLES.values():
        assert sorted(table.order_cols) == sorted(table.insert_cols), table.name
