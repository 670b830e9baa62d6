"""Heavy state keys: found, split over tasks, same result."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitemerge.operators.skew import heavy_keys, join_one_per_key
from sitemerge.operators.upsert import UpdateSpec, apply_update, track
from sitemerge.sources.targets import TABLES


@pytest.fixture
def no_broadcast(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def half_on_one_key(spark, n=40_000):
    """Order lines, half of them on key 7, keys 100.. once each; some without a key."""
    t = TABLES["order_detail"]
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 999 == 0, None).otherwise(F.col("id") + 100)
    given = {"ODS_order_detail_id": F.col("id") + 1, "orig_order_detail_id": key, "quantity_per_unit": F.col("id") % 5,
             "site_id": F.lit(2)}
    return spark.range(n).select(*(given.get(c.name, F.lit(None)).cast(c.stored).alias(c.name) for c in t.cols))


def test_heavy_keys_are_found(spark):
    state = half_on_one_key(spark)
    key = F.col("orig_order_detail_id")
    want = state.where(key == 7).select(F.xxhash64(key)).first()[0]
    assert heavy_keys(state, [key], 1 / 32) == [want]
    assert heavy_keys(state.where(key != 7), [key], 1 / 32) == []
    assert heavy_keys(state.limit(0), [key], 1 / 32) == []


def test_update_of_a_hot_key_is_split(spark, no_broadcast):
    t = TABLES["order_detail"]
    state = half_on_one_key(spark)
    src = spark.createDataFrame([(7, 3), (7, 4), (101, 4), (103, 4), (None, 1)], "k int, q int")
    spec = UpdateSpec("u", src, [("k", "orig_order_detail_id")], [track("quantity_per_unit", "q", "count")], repeats=True)
    plain = UpdateSpec("u", src, spec.match, spec.tracks)
    ts = F.lit("2024-11-24 00:00:00").cast("timestamp_ntz")
    got = apply_update(state, spec, t, ts)
    tasks = {r["p"]: r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    alone = {r["p"]: r["n"] for r in apply_update(state, plain, t, ts).groupBy(
        F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    # unsplit, one task holds the hot half; split, no task holds twice its even part
    assert max(alone.values()) >= 20_000 and max(tasks.values()) <= 2 * 40_000 / 8
    names = t.names
    assert Counter(map(tuple, got.select(names).collect())) == Counter(
        map(tuple, apply_update(state, plain, t, ts).select(names).collect()))
    told = {r[0]: r[1] for r in got.where("orig_order_detail_id = 7").groupBy("quantity_per_unit").count().collect()}
    # rows that hold 3 take the other class, all others the smaller
    assert told == {3: 16_000, 4: 4_000}


def test_join_without_heavy_keys_is_plain(spark):
    a = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "k long, id long")
    b = spark.createDataFrame([(1, "x")], "j long, v string")
    for heavy in ([], [a.where("k = 1").select(F.xxhash64("k")).first()[0]]):
        got = join_one_per_key(a, b, [("k", "j")], heavy, ["id"], 4)
        assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, "x"), (2, None), (3, None)]
