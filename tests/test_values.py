"""Value semantics of change detection and mapping (micro tables, literal
expected rows): null-default equality, sentinels, CONCAT, CASE, collation."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sitemerge.functions.exprs import (
    concat_null_empty,
    discontinued_from_active,
    null_default_eq,
    termination_from_active,
    text_key,
)
from sitemerge.operators.upsert import UpdateSpec, apply_update, track
from sitemerge.sources.targets import Col, Table, INT, STR, TS, DEC

def TS0():
    return F.lit("2024-11-24 00:00:00").cast("timestamp_ntz")

MICRO = Table(
    "micro",
    (Col("id", INT), Col("k", INT), Col("txt", STR, 10), Col("d", TS), Col("price", DEC(5, 2)),
     Col("cnt", INT), Col("last_update", TS)),
    ("id",),
    id_col="id",
    orig_col="k",
)


def _tgt(spark, rows):
    return spark.createDataFrame(rows, MICRO.schema)


def _run(spark, tgt_rows, src_rows, src_schema, tracks):
    tgt = _tgt(spark, tgt_rows)
    src = spark.createDataFrame(src_rows, src_schema)
    spec = UpdateSpec("micro", src, [("k", "k")], tracks)
    return {r["id"]: r for r in apply_update(tgt, spec, MICRO, TS0()).collect()}


def test_text_null_vs_empty_is_equal(spark):
    out = _run(spark, [(1, 1, "", None, None, None, None)], [(1, None)], "k int, v string",
               [track("txt", "v", "text")])
    assert out[1]["last_update"] is None and out[1]["txt"] == ""


def test_text_null_vs_value_updates_to_null(spark):
    out = _run(spark, [(1, 1, "a", None, None, None, None)], [(1, None)], "k int, v string",
               [track("txt", "v", "text")])
    assert out[1]["txt"] is None
    assert out[1]["last_update"] == dt.datetime(2024, 11, 24)


def test_date_sentinel(spark):
    out = _run(spark, [(1, 1, None, dt.datetime(1900, 1, 1), None, None, None)], [(1, None)],
               "k int, v timestamp_ntz", [track("d", "v", "date")])
    assert out[1]["last_update"] is None


def test_price_sentinel(spark):
    out = _run(spark, [(1, 1, None, None, Decimal("-1.00"), None, None),
                       (2, 2, None, None, Decimal("0.00"), None, None)],
               [(1, None), (2, None)], "k int, v decimal(5,2)", [track("price", "v", "price")])
    assert out[1]["last_update"] is None
    assert out[2]["last_update"] is not None and out[2]["price"] is None


def test_count_sentinel(spark):
    out = _run(spark, [(1, 1, None, None, None, 0, None)], [(1, None)], "k int, v int",
               [track("cnt", "v", "count")])
    assert out[1]["last_update"] is None


def test_null_default_eq_is_not_null_safe_eq(spark):
    df = spark.createDataFrame([(None, ""), (None, None), ("a", None)], "a string, b string")
    got = [r[0] for r in df.select(null_default_eq("a", "b", "text")).collect()]
    assert got == [True, True, False]


def test_concat_reads_null_as_empty(spark):
    df = spark.createDataFrame([("1 A St", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(concat_null_empty("a", F.lit(" "), "b")).collect()]
    assert got == ["1 A St ", " "]


def test_case_blind_collation(spark):
    df = spark.createDataFrame([("Ab ", "aB")], "a string, b string")
    row = df.select(
        (text_key("a") == text_key("b")).alias("binary"),
        (text_key("a", "UTF8_LCASE_RTRIM") == text_key("b", "UTF8_LCASE_RTRIM")).alias("ci"),
    ).first()
    assert row["binary"] is False and row["ci"] is True


def test_flag_and_termination_cases(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "a short")
    rows = df.select(discontinued_from_active("a").alias("disc"),
                     termination_from_active("a", TS0()).alias("term")).collect()
    assert [r["disc"] for r in rows] == [False, True, True]
    assert [r["term"] for r in rows] == [None, dt.datetime(2024, 11, 24), None]


def test_unchanged_rows_keep_last_update(spark):
    before = dt.datetime(2024, 1, 1)
    out = _run(spark, [(1, 1, "x", None, None, None, before), (2, 9, "y", None, None, None, before)],
               [(1, "x")], "k int, v string", [track("txt", "v", "text")])
    assert out[1]["last_update"] == before and out[2]["last_update"] == before
