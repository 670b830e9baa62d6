"""Keys beyond five digits stay whole; the default stamp is the current time;
strict lookups keep the sites apart; keyless rows go round the update join."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from sitemerge.plans.pipeline import now, run_updates
from sitemerge.plans.queries import context
from sitemerge.sources.fixtures import _pad5

from .conftest import SMALL


def test_padding_never_cuts(spark):
    df = spark.createDataFrame([(7,), (99999,), (15_000_000,)], "k long")
    assert [r[0] for r in df.select(_pad5(F.col("k"))).collect()] == ["00007", "99999", "15000000"]


def test_default_stamp_is_now():
    gap = datetime.now(timezone.utc) - datetime.strptime(now(), "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    assert abs(gap.total_seconds()) < 5


def test_keyless_rows_go_round_the_update(spark):
    ctx = context(spark, SMALL, "address")
    before, after = ctx.state["address"], run_updates(ctx, "address")
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(orig_address_id" in plan and "Union" in plan
    keyless = "orig_address_id is null"
    assert before.where(keyless).count() > 0
    assert after.where(keyless).exceptAll(before.where(keyless)).count() == 0
    assert before.count() == after.count()


def test_keys_beyond_the_declared_widths(spark, tmp_path):
    """User ids past 16 bits, order keys past 32: every row arrives, and the report counts the excess."""
    from sitemerge.plans.checks import q_range
    from sitemerge.plans.pipeline import run_pipeline
    from sitemerge.sources.fixtures import TEST_TABLES, derive_staging

    grow = {"events": ("user_id", 100 * 1500), "orders": ("o_orderkey", 100 * 60_000_000),
            "lineitem": ("l_orderkey", 100 * 60_000_000)}
    for t in TEST_TABLES:
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        if t in grow:
            key, by = grow[t]
            df = df.withColumn(key, F.col(key).cast("long"))
            df = df.unionByName(df.withColumn(key, F.col(key) + by))
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    names = ["employee", "order", "order_detail"]
    base = run_pipeline(spark, derive_staging(spark, SMALL), load_ts="2024-11-24 00:00:00")
    wide = run_pipeline(spark, derive_staging(spark, str(tmp_path)), load_ts="2024-11-24 00:00:00")
    for n in names:
        assert wide[n].count() == 2 * base[n].count() > 0, n
    assert wide["employee"].agg(F.max("orig_employee_id")).first()[0] > 150_000
    assert wide["order_detail"].agg(F.max("orig_order_detail_id")).first()[0] > 60_000_000_000
    out = {r["source"]: r["out_of_range"] for r in q_range(spark, str(tmp_path)).collect()
           if r["target_type"] == "smallint" and r["source"] != "Stg_Region"}
    assert sum(out.values()) * 2 == wide["employee"].count()
    # the expected rows come from statements that hold keys of this size too
    import duckdb

    from ods_oracle import oracle_statements
    from sitemerge.plans.queries import load_queries
    from tools.check_oracle import rows_of

    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for n in names:
        got = load_queries()[f"load_{n}"](spark, str(tmp_path))
        want = con.execute(oracle_statements()[f"load_{n}"])
        cols = [d[0] for d in want.description]
        assert rows_of(got.columns, got.collect()) == rows_of(cols, want.fetchall()), n
