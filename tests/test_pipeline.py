"""The whole pipeline on sf0.001: first run, rerun, foreign keys, DDL."""

from pyspark.sql import functions as F

from sitemerge.operators.quality import check_fk
from sitemerge.plans.loads import ORDER, Options
from sitemerge.plans.pipeline import pipeline_counts, run_pipeline
from sitemerge.sources.fixtures import derive_staging
from sitemerge.sources.targets import TABLES, create_table_sql

from .conftest import SMALL


def _counts(before, after, ts):
    return {r["table_name"]: (r["rows"], r["inserted"], r["updated"])
            for r in pipeline_counts(before, after, ts).collect()}


def test_strict_rerun_changes_nothing_and_keys_hold(spark):
    stg = derive_staging(spark, SMALL)
    first = run_pipeline(spark, stg, options=Options(strict=True), load_ts="2024-11-24 00:00:00")
    second = run_pipeline(spark, stg, first, options=Options(strict=True),
                          load_ts="2024-11-25 00:00:00")
    counts = _counts(first, second, "2024-11-25 00:00:00")
    for name in ORDER:
        rows, inserted, updated = counts[name]
        assert (inserted, updated) == (0, 0), (name, counts[name])
        assert rows == first[name].count(), name
    for name in ORDER:
        for fk in TABLES[name].fks:
            orphans = check_fk(second[name], list(fk.cols), second[fk.parent], list(fk.parent_cols))
            assert orphans.count() == 0, (name, fk)
        if TABLES[name].id_col:
            ids = second[name].agg(F.count("*"), F.countDistinct(TABLES[name].id_col),
                                   F.min(TABLES[name].id_col), F.max(TABLES[name].id_col)).first()
            assert ids[0] == ids[1] == ids[3] and ids[2] in (1, None), name


def test_faithful_rerun_keeps_rows_and_ids(spark):
    stg = derive_staging(spark, SMALL)
    first = run_pipeline(spark, stg, load_ts="2024-11-24 00:00:00")
    second = run_pipeline(spark, stg, first, load_ts="2024-11-25 00:00:00")
    for name in ORDER:
        # no existing row is lost and ids stay
        t = TABLES[name]
        key = [t.id_col] if t.id_col else list(t.pk)
        lost = first[name].select(*key).join(second[name].select(*key), key, "left_anti")
        assert lost.count() == 0, name


def test_create_table_sql(spark, tmp_path):
    sql = create_table_sql(TABLES["customer"], name="ods_customer_ddl",
                           location=str(tmp_path / "customer"))
    assert "`orig_customer_id` VARCHAR(5)" in sql
    spark.sql(sql)
    cols = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE ods_customer_ddl").collect()}
    assert cols["orig_customer_id"] == "varchar(5)"
    spark.sql("DROP TABLE ods_customer_ddl")


def test_reads_declares_every_table_a_load_uses(spark):
    from sitemerge.plans.loads import Ctx, ts_literal
    from sitemerge.plans.pipeline import READS, run_load
    from sitemerge.sources.targets import empty_state

    stg = derive_staging(spark, SMALL)
    for name in ORDER:
        allowed = {t: empty_state(spark, TABLES[t]) for t in [name, *READS[name]]}
        ctx = Ctx(spark, stg, allowed, ts_literal("2024-11-24 00:00:00"))
        run_load(ctx, name)  # a KeyError here means an undeclared read


def test_parallel_levels_equal_serial_order(spark):
    stg = derive_staging(spark, SMALL)
    par = run_pipeline(spark, stg, load_ts="2024-11-24 00:00:00", parallel=True)
    ser = run_pipeline(spark, stg, load_ts="2024-11-24 00:00:00", parallel=False)
    for name in ORDER:
        a, b = par[name], ser[name]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_bucketed_state_is_not_shuffled_for_the_update(spark):
    from sitemerge.plans.loads import Ctx, ts_literal
    from sitemerge.plans.pipeline import run_updates

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stg = derive_staging(spark, SMALL)
    opts = Options(buckets=n)
    first = run_pipeline(spark, stg, options=opts, tables=["order", "order_detail"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large summary
    try:
        ctx = Ctx(spark, stg, first, ts_literal("2024-11-25 00:00:00"), opts)
        plan = run_updates(ctx, "order_detail")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning(orig_order_detail_id" not in plan
    assert "SortMergeJoin" in plan
