"""Report formatting as Catalyst expressions (operators I1-I11).

All of these are built from integer arithmetic and string functions so they
stay inside whole-stage codegen; only ``wrap`` (I8) needs Python and runs as
an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import textwrap

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KIB = 1024


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``div``), exact for any BIGINT."""
    return F.call_function("div", _c(a), b if isinstance(b, Column) else F.lit(b))


def floor_div(a, b) -> Column:
    """Integer division rounding toward minus infinity (Python ``//``)."""
    a, b = _c(a), (b if isinstance(b, Column) else F.lit(b))
    q = idiv(a, b)
    return F.when((a % b != 0) & ((a < 0) != (b < 0)), q - 1).otherwise(q)


def one_decimal(major, minor) -> Column:
    """``major.d`` where d is the first decimal of ``(minor mod 1024) / 1024``, truncated."""
    return F.concat(_c(major).cast("string"), F.lit("."),
                    idiv(F.pmod(_c(minor), F.lit(KIB)) * 10, KIB).cast("string"))


def _scaled(n: Column, units: list[str], cap_unit: str, base_suffix: str) -> Column:
    # units[0] is the first scaled unit (KB / KB/s); each step divides by 1024.
    # Scaled branches only see n >= 1024, so plain ``div`` / ``pmod`` are exact.
    out = None
    for i in range(len(units), 0, -1):
        major = idiv(n, KIB ** i)
        digit = idiv(F.pmod(idiv(n, KIB ** (i - 1)), F.lit(KIB)) * 10, KIB)
        text = F.concat(major.cast("string"), F.lit("."), digit.cast("string"), F.lit(" " + units[i - 1]))
        out = text if out is None else F.when(n < F.lit(KIB ** (i + 1)), text).otherwise(out)
    return F.when(n < KIB, F.concat(n.cast("string"), F.lit(base_suffix))).otherwise(out)


def fmt_size(col) -> Column:
    """``n bytes`` below 1 KiB, then KB / MB / GB / TB with one truncated decimal (TB is the cap)."""
    return _scaled(_c(col).cast("bigint"), ["KB", "MB", "GB", "TB"], "TB", " bytes")


def fmt_speed(col) -> Column:
    """``n B/s`` below 1 KiB/s, then KB/s, MB/s, GB/s (GB/s is the cap)."""
    return _scaled(_c(col).cast("bigint"), ["KB/s", "MB/s", "GB/s"], "GB/s", " B/s")


US_PER_S = 1_000_000
US_PER_M = 60 * US_PER_S
US_PER_H = 60 * US_PER_M
US_PER_D = 24 * US_PER_H


def fmt_duration(us, wide: bool = False) -> Column:
    """Elapsed microseconds as ``2d 00h 05m 17s``.

    Days are floored (negative spans give a negative day count and positive
    remainders), seconds are rounded half-to-even, leading zero units are
    dropped and an all-zero span reads ``< 01s``.  ``wide`` spans are DECIMAL(38,0).
    """
    u = _c(us).cast("decimal(38,0)" if wide else "bigint")
    # every unit straight from u (no chain of dependent sub-expressions): floor
    # division for days, then remainders, which pmod keeps non-negative
    d = idiv(u - F.pmod(u, F.lit(US_PER_D)), US_PER_D)
    h = idiv(F.pmod(u, F.lit(US_PER_D)), US_PER_H)
    m = idiv(F.pmod(u, F.lit(US_PER_H)), US_PER_M)
    s = F.bround(F.pmod(u, F.lit(US_PER_M)).cast("double") / F.lit(float(US_PER_S)), 0).cast("bigint")

    def two(x):
        return F.lpad(x.cast("string"), 2, "0")

    ds = F.concat(d.cast("string"), F.lit("d"))
    hs = F.concat(two(h), F.lit("h"))
    ms = F.concat(two(m), F.lit("m"))
    ss = F.concat(two(s), F.lit("s"))
    return (F.when(u.isNull(), F.lit(None).cast("string"))
            .when(d != 0, F.concat_ws(" ", ds, hs, ms, ss))
            .when(h != 0, F.concat_ws(" ", hs, ms, ss))
            .when(m != 0, F.concat_ws(" ", ms, ss))
            .when(s != 0, ss)
            .otherwise(F.lit("< 01s")))


# Strftime directive -> Spark datetime pattern letters.
STRFTIME_TO_SPARK = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD",
}

DEFAULT_DATETIME = "%Y-%m-%d %H:%M:%S"
DEFAULT_DATE = "%Y-%m-%d"
DEFAULT_TIME = "%H:%M:%S"


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime format (driver-side, once per query) to a Spark pattern."""
    out, lit = [], []

    def flush():
        if lit:
            text = "".join(lit).replace("'", "''")
            out.append(f"'{text}'")
            lit.clear()

    i = 0
    while i < len(fmt):
        c = fmt[i]
        if c == "%" and i + 1 < len(fmt):
            nxt = fmt[i + 1]
            if nxt == "%":
                lit.append("%")
            elif nxt in STRFTIME_TO_SPARK:
                flush()
                out.append(STRFTIME_TO_SPARK[nxt])
            else:
                raise ValueError(f"unsupported strftime directive %{nxt}")
            i += 2
            continue
        if c.isalpha():
            lit.append(c)
        else:
            flush()
            out.append(c if c not in "[]{}#" else f"'{c}'")
        i += 1
    flush()
    return "".join(out)


def fmt_datetime(col, fmt: str | None = None) -> Column:
    """I4: timestamp as text, default ``%Y-%m-%d %H:%M:%S``."""
    return F.date_format(_c(col), strftime_to_spark(fmt or DEFAULT_DATETIME))


def fmt_date(col, fmt: str | None = None) -> Column:
    return F.date_format(_c(col), strftime_to_spark(fmt or DEFAULT_DATE))


def fmt_time(col, fmt: str | None = None) -> Column:
    return F.date_format(_c(col), strftime_to_spark(fmt or DEFAULT_TIME))


def fmt_progress(col) -> Column:
    """Integer percentage as text."""
    return _c(col).cast("bigint").cast("string")


# Whitespace as Python's str.strip() sees it, derived from str.isspace (BMP scan).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(col) -> Column:
    """Remove leading and trailing whitespace (Spark ``trim`` alone removes spaces only)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def rstrip(col) -> Column:
    return F.rtrim(_c(col), F.lit(WHITESPACE))


def pad_left(col, width) -> Column:
    """Right-justify without truncating (``lpad`` cuts longer values)."""
    c = _c(col)
    return F.concat(F.repeat(F.lit(" "), F.greatest(_c(width) - F.length(c), F.lit(0))), c)


def pad_right(col, width) -> Column:
    c = _c(col)
    return F.concat(c, F.repeat(F.lit(" "), F.greatest(_c(width) - F.length(c), F.lit(0))))


def pad_center(col, width) -> Column:
    """Centre like Python's ``str.center``: the odd space goes left when the width is odd."""
    c = _c(col)
    w = _c(width)
    p = F.greatest(w - F.length(c), F.lit(0))
    left = idiv(p, 2) + F.when((p % 2 == 1) & (w % 2 == 1), 1).otherwise(0)
    return F.concat(F.repeat(F.lit(" "), left.cast("int")), c, F.repeat(F.lit(" "), (p - left).cast("int")))


ALIGNERS = {"l": pad_right, "r": pad_left, "c": pad_center}


def valid_alignment(spec: str | None, n_cols: int) -> str | None:
    """Expand a one-letter spec to every column; ``None`` when the spec is unusable."""
    if not spec:
        return None
    if len(spec) == 1:
        spec = spec * n_cols
    if any(a not in ALIGNERS for a in spec) or len(spec) < n_cols:
        return None
    return spec


def row_line(parts: list, indent: int = 0, width: int = 30, indent_char: str = " ") -> Column:
    """One text line of a report row.

    Each column is padded to the next multiple of ``width`` (an exact multiple
    still gets a full width); only the first column counts the indent; the
    line is right-stripped, so the last column needs no padding.
    """
    pieces = [F.lit(indent_char * indent)]
    for i, p in enumerate(parts):
        c = _c(p) if not isinstance(p, (int, float)) else F.lit(str(p))
        c = c.cast("string")
        used = F.length(c) + (indent if i == 0 else 0)
        pieces.append(c)
        if i < len(parts) - 1 or indent_char not in WHITESPACE:
            pieces.append(F.repeat(F.lit(indent_char), (F.lit(width) - used % width).cast("int")))
    return rstrip(F.concat(*pieces))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _wrap_udf(text: pd.Series, width: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else textwrap.wrap(t, int(w)) for t, w in zip(text, width)])


def wrap(col, width: int = 100) -> Column:
    """I8: word wrap into an array of lines (Python ``textwrap`` rules, Arrow-batched)."""
    return _wrap_udf(_c(col), F.lit(width))


# Kind -> symbol, as the reference's report and notifications print them.
SYMBOLS = {
    "summary": "📄️",
    "details": "🔍",
    "cloud": "☁️",
    "directory": "📁",
    "mapping": "🗺️",
    "backup": "💼",
    "upload": "⬆️",
    "download": "⬇️",
    "exception": "⚠️",
    "exitcode": "❗",
    "outgoing": "📤",
    "incoming": "📥",
    "chart": "📈",
    "service": "⚙️",
    "deployment": "🏗️",
    "shell": "➡️",
    "docker": "🐳",
    "docker-compose": "🐳",
    "link": "🔗",
    "archive": "📦",
    "save": "💾",
    "attachment": "📎",
    "total": "∑",
    "ok": "✓",
    "nok": "✗",
    "success": "👍",
    "failure": "❌",
    "lock": "🔒",
    "lock-open": "🔓",
    "key": "🔑",
    "key-old": "🗝️",
    "time": "🗓️",
    "duration": "⌛",
    "size": "⚖️",
    "speed": "🚀",
}


def symbol(kind) -> Column:
    """Fixed lookup; an unknown kind returns itself."""
    m = F.create_map(*[F.lit(x) for kv in SYMBOLS.items() for x in kv])
    k = _c(kind)
    return F.coalesce(F.try_element_at(m, k), k)


def sym(kind: str) -> str:
    """Driver-side constant for a literal kind (titles)."""
    return SYMBOLS.get(kind, kind)
