"""E1-E8 against the reference's truth tables."""

import itertools
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from opslog.operators import measures as M


def test_proc_status(spark):
    rows = [(None, 0, "success"), (None, None, "failed"), (None, 1, "failed"), (None, 127, "failed"),
            ("boom", 0, "exception"), ("boom", 2, "exception")]
    df = spark.createDataFrame(rows, "exc string, code int, expected string")
    for r in df.select(M.proc_status("exc", "code").alias("s"), "expected").collect():
        assert r.s == r.expected


def test_proc_success(spark):
    a, b = dt(2024, 1, 1), dt(2025, 1, 1)
    rows = [(None, 0, "cmd", a, b, True), (None, 0, "cmd", b, a, True), (None, None, "cmd", a, b, False),
            (None, 1, "cmd", a, b, False), ("e", 0, "cmd", a, b, False), ("e", 3, "cmd", a, b, False),
            (None, None, None, a, b, False), (None, None, "cmd", None, b, False),
            (None, None, "cmd", a, None, False), (None, None, "cmd", None, None, False)]
    df = spark.createDataFrame(rows, "exc string, code int, cmd string, s timestamp_ntz, e timestamp_ntz, x boolean")
    for r in df.select(M.proc_success("exc", "code", "cmd", "s", "e").alias("ok"), "x").collect():
        assert r.ok == r.x


def test_process_elapsed(spark):
    rows = [(None, None, None), (None, dt(2024, 1, 1), None), (dt(2024, 1, 1), None, None),
            (dt(2024, 1, 1, 10, 1, 30), dt(2024, 1, 1, 9, 1, 30), None),
            (dt(2024, 1, 1, 10, 1, 30), dt(2024, 1, 1, 11, 1, 30), 3600 * 10**6),
            (dt(2024, 1, 1, 10, 1, 30), dt(2025, 1, 2, 11, 1, 35), (367 * 86400 + 3600 + 5) * 10**6)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, e timestamp_ntz, x long")
    for r in df.select(M.elapsed_us("s", "e", "process").alias("el"), "x").collect():
        assert r.el == r.x


def test_archive_success_truth_table(spark):
    combos = list(itertools.product([True, False], repeat=5))
    rows = [("d" if d else None, "a" if a else None, ex, dt(2024, 1, 1, 10, 30) if s else None,
             dt(2024, 1, 1, 10, 35, 10) if c else None, all([d, a, ex, s, c])) for d, a, ex, s, c in combos]
    df = spark.createDataFrame(rows, "d string, a string, ex boolean, s timestamp_ntz, c timestamp_ntz, x boolean")
    got = df.select(M.archive_success(F.lit(None).cast("string"), "s", "c", "d", "a", "ex").alias("ok"), "x").collect()
    assert len(got) == 32
    for r in got:
        assert r.ok == r.x
    # an exception always fails
    one = spark.createDataFrame([("dir", "arc")], "d string, a string").select(
        M.archive_success(F.lit("boom"), F.lit(dt(2024, 1, 1)), F.lit(dt(2024, 1, 2)), "d", "a", F.lit(True)).alias("ok"))
    assert one.first().ok is False


def test_upload_elapsed_and_speed(spark):
    s, e = dt(2024, 1, 1, 10, 30, 0), dt(2024, 1, 1, 10, 31, 0)
    rows = [(60_000, s, e, 1000), (0, s, e, 0), (100, s, None, 0)]
    df = spark.createDataFrame(rows, "size long, s timestamp_ntz, e timestamp_ntz, x long")
    ok = M.upload_success(F.lit(None).cast("string"), F.lit("file"), F.lit("key"), "size", "s", "e")
    out = df.select(M.speed_bps("size", M.elapsed_us("s", "e", "upload"), ok).alias("v"), "x").collect()
    assert [r.v for r in out] == [r.x for r in out]
    same = spark.createDataFrame([(s,)], "s timestamp_ntz").select(M.elapsed_us("s", "s", "upload").alias("el"))
    assert same.first().el == 10**6
    longer = spark.createDataFrame([(s, dt(2024, 1, 1, 11, 35, 7))], "s timestamp_ntz, e timestamp_ntz")
    assert longer.select(M.elapsed_us("s", "e", "upload").alias("el")).first().el == (3600 + 300 + 7) * 10**6


@pytest.mark.parametrize("size,elapsed,expected", [(10, 3_000_000, 3), (-10, 3_000_000, -4), (10, -3_000_000, -4),
                                                    (20 * 2**40, 7_000_000, 20 * 2**40 // 7), (5, 0, None)])
def test_speed_floor_and_overflow(spark, size, elapsed, expected):
    df = spark.createDataFrame([(size, elapsed)], "size long, el long")
    assert df.select(M.speed_bps("size", "el", F.lit(True)).alias("v")).first().v == expected


def test_visible_size(spark):
    df = spark.createDataFrame([(5, True), (5, False), (5, None)], "size long, ok boolean")
    assert [r.v for r in df.select(M.visible_size("size", "ok").alias("v")).collect()] == [5, None, None]


def test_summary_totals_beyond_bigint(spark, tmp_path):
    """A group's summed elapsed time may pass 2^63 microseconds; the summary then gives it as DECIMAL, else as BIGINT."""
    from opslog.plans.catalog_core import backup_summary_df

    for name, n in (("few", 3), ("many", 40)):
        orders = [(i, "1-URGENT", dt(1, 1, 1)) for i in range(n)] + [(n, "5-LOW", dt(2024, 1, 1))]
        items = [(i, 1, 10.0, "A", "F", dt(9999, 1, 1)) for i in range(n)] + [(n, 1, 10.0, "A", "F", dt(2024, 1, 2))]
        spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderdate timestamp_ntz") \
            .write.parquet(str(tmp_path / name / "orders.parquet"))
        spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, "
                              "l_shipdate timestamp_ntz").write.parquet(str(tmp_path / name / "lineitem.parquet"))
        df = backup_summary_df(spark, str(tmp_path / name))
        days = (dt(9999, 1, 1) - dt(1, 1, 1)).days * n
        got = {r.grp: r for r in df.collect()}
        assert got["1-URGENT"].ok_elapsed_us == days * 86_400_000_000
        assert got["1-URGENT"].elapsed_text == f"{days}d 00h 00m 00s" and got["1-URGENT"].speed_text == "0 B/s"
        assert got["5-LOW"].ok_elapsed_us == 86_400_000_000 and got["5-LOW"].elapsed_text == "1d 00h 00m 00s"
        assert dict(df.dtypes)["ok_elapsed_us"] == ("bigint" if name == "few" else "decimal(38,0)")
