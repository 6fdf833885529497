"""I1-I11 on own inputs, against the rules stated in plain Python."""

from datetime import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from opslog.functions import fmt
from opslog.operators.flatten import align

def _scaled(n, units, base):
    """Whole units and tenths cut, never rounded: tenths of the remainder in the next smaller unit."""
    if n < 1024:
        return f"{n}{base}"
    power = next(p for p in range(1, len(units) + 1) if n < 1024 ** (p + 1) or p == len(units))
    small = n // 1024 ** (power - 1)
    return f"{small // 1024}.{small % 1024 * 10 // 1024} {units[power - 1]}"


def _duration(us):
    """Days, hours and minutes by floor division; seconds rounded half to even, without a carry."""
    d, rest = divmod(us, 86_400_000_000)
    h, rest = divmod(rest, 3_600_000_000)
    m, rest = divmod(rest, 60_000_000)
    s = int((Decimal(rest) / 1_000_000).to_integral_value(ROUND_HALF_EVEN))
    parts = [f"{d}d", f"{h:02d}h", f"{m:02d}m", f"{s:02d}s"]
    first = next((i for i, n in enumerate((d, h, m, s)) if n), None)
    return "< 01s" if first is None else " ".join(parts[first:])


NUMBERS = sorted({max(0, 1024 ** p * k // 7 + d) for p in range(6) for k in (3, 7, 10, 51, 7000) for d in (-1, 0, 1)})
SIZES = [(n, _scaled(n, ["KB", "MB", "GB", "TB"], " bytes")) for n in NUMBERS]
SPEEDS = [(n, _scaled(n, ["KB/s", "MB/s", "GB/s"], " B/s")) for n in NUMBERS]
DURATIONS = [(u, _duration(u)) for u in sorted({s * k + d for s in (1, 10**6, 6 * 10**7, 36 * 10**8, 864 * 10**8) for k in (0, 1, 3, 59, 61)
                                                for d in (-7 * 10**6, -500_000, 0, 499_999, 500_000, 1_500_000, 13 * 10**6)})]


@pytest.mark.parametrize("fn,rows", [(fmt.fmt_size, SIZES), (fmt.fmt_speed, SPEEDS), (fmt.fmt_duration, DURATIONS)])
def test_number_formats(spark, fn, rows):
    df = spark.createDataFrame(rows, "n long, x string")
    for r in df.select(fn("n").alias("t"), "x").collect():
        assert r.t == r.x


def test_datetime_formats(spark):
    t1, t2 = dt(2031, 1, 9, 6, 5), dt(1999, 12, 30, 23, 0, 8)
    df = spark.createDataFrame([(t1, t2)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(fmt.fmt_datetime("a").alias("d1"), fmt.fmt_datetime("a", "%Y-%m-%d %H:%M:%S").alias("d2"),
                  fmt.fmt_datetime("b", "%Y/%m/%d_%H-%M-%S").alias("d3"), fmt.fmt_date("a").alias("e1"),
                  fmt.fmt_date("b", "%Y/%m/%d").alias("e2"), fmt.fmt_time("a").alias("f1"),
                  fmt.fmt_time("b", "%H-%M-%S").alias("f2")).first()
    assert (r.d1, r.d2, r.d3) == (str(t1), f"{t1:%Y-%m-%d %H:%M:%S}", f"{t2:%Y/%m/%d_%H-%M-%S}")
    assert (r.e1, r.e2, r.f1, r.f2) == (f"{t1:%Y-%m-%d}", f"{t2:%Y/%m/%d}", f"{t1:%H:%M:%S}", f"{t2:%H-%M-%S}")


TABLE = [["  kilo ", "12", "x"], ["mega", "  3456 ", "   yy   "], ["g", "7", ""], [" tera-long ", "", "zzzzz"]]
JUSTIFY = {"l": str.ljust, "r": str.rjust, "c": str.center}


def _aligned(table, letters):
    """Fields stripped and padded to the widest of their column; the last letter of a specification repeats if it is the only one."""
    stripped = [[f.strip() for f in row] for row in table]
    widths = [max(map(len, column)) for column in zip(*stripped)]
    return [[JUSTIFY[a](f, w) for a, f, w in zip(letters, row, widths)] for row in stripped]


@pytest.mark.parametrize("spec,letters", [("l", "lll"), ("r", "rrr"), ("c", "ccc"), ("lrc", "lrc"), ("crl", "crl"),
                                          ("", None), (None, None), ("lr", None), ("lxr", None)])
def test_align(spark, spec, letters):
    rows = [(k, i, *e) for k, part in ((None, TABLE), (1, TABLE[:2])) for i, e in enumerate(part)]  # a null key is a key
    df = spark.createDataFrame(rows, "k int, i int, f0 string, f1 string, f2 string")
    out = align(df, "k", ["f0", "f1", "f2"], spec).orderBy(F.col("k").isNotNull(), "i").collect()
    want = TABLE + TABLE[:2] if letters is None else _aligned(TABLE, letters) + _aligned(TABLE[:2], letters)
    assert [[r.a_f0, r.a_f1, r.a_f2] for r in out] == want


def test_center_matches_python(spark):
    pairs = [(t, w) for t in ["", "a", "ab", "abc", "abcd"] for w in range(0, 9)]
    df = spark.createDataFrame(pairs, "t string, w int")
    for r in df.select("t", "w", fmt.pad_center("t", F.col("w")).alias("c")).collect():
        assert r.c == r.t.center(r.w)


def test_row_line(spark):
    df = spark.createDataFrame([("Started", "x" * 30)], "a string, b string")
    r = df.select(fmt.row_line(["a", "b"], indent=4, width=30).alias("l"),
                  fmt.row_line(["b"], indent=0, width=30).alias("m")).first()
    assert r.l == "    Started" + " " * (30 - 11) + "x" * 30
    assert r.m == "x" * 30  # an exact multiple still pads a full width, then the line is right-stripped


def test_strip_symbol_progress_wrap(spark):
    df = spark.createDataFrame([(" \t x y \n ", "success", "unknown-kind", 42, "word " * 50)],
                               "s string, k string, u string, p int, w string")
    r = df.select(fmt.strip("s").alias("s"), fmt.symbol("k").alias("k"), fmt.symbol("u").alias("u"),
                  fmt.fmt_progress("p").alias("p"), fmt.wrap("w", 100).alias("w"),
                  fmt.one_decimal(F.lit(5), F.lit(5 * 1024 + 1023)).alias("d")).first()
    assert r.s == "x y" and r.k == fmt.SYMBOLS["success"] and r.u == "unknown-kind" and r.p == "42"
    assert all(len(x) <= 100 for x in r.w) and " ".join(r.w) == ("word " * 50).strip()
    assert r.d == "5.9"
