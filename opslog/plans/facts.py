"""Shared derived views for the registered queries, in Spark and as oracle SQL.

``entry_facts`` adds the per-row measures of E1-E8 to the ``entries`` binding
in one projection (no shuffle beyond the binding's own join).  ``success`` is
the process rule (E2).  For the rar entries of this binding it equals the
archive-and-process rule (E4, queries e3/e4): the archive listing holds every
archive whose process returned an exit code, so an entry with exit code 0
always finds its own archive, and E4 costs a self-join that E2 does not.  The SQL
helpers spell the same formulas for DuckDB, so each oracle states the rule
independently of the Spark code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opslog.functions.paths import archive_name
from opslog.operators import measures as M
from opslog.sources import bindings as B

ARCHIVE_DEST = "/backup"
ARCHIVE_EXT = "rar"


def entry_facts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return facts_from(B.entries(spark, sf_dir, **options))


def facts_from(e: DataFrame) -> DataFrame:
    """Per-row measures over an ``entries``-shaped DataFrame (batch or stream)."""
    success = M.proc_success("exc", "exitcode", "directory", "started", "completed")
    elapsed = M.elapsed_us("started", "completed", "archive")
    return e.select(
        "*",
        archive_name(ARCHIVE_DEST, "grp", "directory", "started", ARCHIVE_EXT).alias("archive"),
        M.proc_status("exc", "exitcode").alias("status"),
        success.alias("success"),
        elapsed.alias("elapsed_us"),
    ).withColumn("speed", M.speed_bps("size", "elapsed_us", "success"))


# --------------------------------------------------------------------------------------------
# Oracle SQL pieces
# --------------------------------------------------------------------------------------------

def sql_floor_div(a: str, b: str) -> str:
    return (f"(({a}) // ({b}) - CASE WHEN ({a}) % ({b}) <> 0 AND (({a}) < 0) <> (({b}) < 0) "
            f"THEN 1 ELSE 0 END)")


def _sql_scaled(x: str, units: list[str], base_suffix: str) -> str:
    parts = [f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) < 1024 THEN CAST({x} AS VARCHAR) || '{base_suffix}'"]
    for i, unit in enumerate(units, start=1):
        major = f"(({x}) // {1024 ** i})"
        minor = f"(({x}) // {1024 ** (i - 1)})"
        text = (f"CAST({major} AS VARCHAR) || '.' || CAST(((({minor}) % 1024) * 10) // 1024 AS VARCHAR) "
                f"|| ' {unit}'")
        if i < len(units):
            parts.append(f"WHEN ({x}) < {1024 ** (i + 1)} THEN {text}")
        else:
            parts.append(f"ELSE {text}")
    return " ".join(parts) + " END"


def sql_fmt_size(x: str) -> str:
    return _sql_scaled(x, ["KB", "MB", "GB", "TB"], " bytes")


def sql_fmt_speed(x: str) -> str:
    return _sql_scaled(x, ["KB/s", "MB/s", "GB/s"], " B/s")


def sql_fmt_duration(u: str) -> str:
    D, H, Mi, S = 86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000
    d = sql_floor_div(u, str(D))
    rem = f"(({u}) - {d} * {D})"
    h = f"({rem} // {H})"
    m = f"(({rem} % {H}) // {Mi})"
    s = f"CAST(round_even(CAST({rem} % {Mi} AS DOUBLE) / {S}.0, 0) AS BIGINT)"

    def two(x):
        return f"lpad(CAST({x} AS VARCHAR), 2, '0')"
    ds = f"CAST({d} AS VARCHAR) || 'd'"
    hs, ms, ss = f"{two(h)} || 'h'", f"{two(m)} || 'm'", f"{two(s)} || 's'"
    return (f"CASE WHEN ({u}) IS NULL THEN NULL "
            f"WHEN {d} <> 0 THEN {ds} || ' ' || {hs} || ' ' || {ms} || ' ' || {ss} "
            f"WHEN {h} <> 0 THEN {hs} || ' ' || {ms} || ' ' || {ss} "
            f"WHEN {m} <> 0 THEN {ms} || ' ' || {ss} "
            f"WHEN {s} <> 0 THEN {ss} ELSE '< 01s' END")


def sql_speed(size: str, elapsed: str, success: str) -> str:
    num = f"(CAST({size} AS HUGEINT) * 1000000)"
    den = f"nullif({elapsed}, 0)"
    return f"CASE WHEN coalesce({success}, false) THEN CAST({sql_floor_div(num, den)} AS BIGINT) ELSE 0 END"


def sql_base_name(p: str) -> str:
    return f"regexp_extract(regexp_replace({p}, '/+$', ''), '[^/]*$')"


def sql_archive_name(grp: str, directory: str, ts: str) -> str:
    name = sql_base_name(directory)
    return (f"'{ARCHIVE_DEST}' || '/' || {grp} || '/' || {name} || '/' || {name} || '_' "
            f"|| strftime({ts}, '%Y-%m-%d_%H%M') || '.{ARCHIVE_EXT}'")


FACTS_SQL = f"""
SELECT *,
  {sql_archive_name('grp', 'directory', 'started')} AS archive,
  CASE WHEN exc IS NOT NULL THEN 'exception' WHEN exitcode IS DISTINCT FROM 0 THEN 'failed'
       ELSE 'success' END AS status,
  coalesce(exc IS NULL AND exitcode IS NOT DISTINCT FROM 0 AND directory IS NOT NULL AND length(directory) > 0
           AND started IS NOT NULL AND completed IS NOT NULL, false) AS success,
  epoch_us(completed) - epoch_us(started) AS elapsed_us
FROM entries
"""

FACTS2_SQL = f"SELECT *, {sql_speed('size', 'elapsed_us', 'success')} AS speed FROM facts0"


def with_facts(sql: str, **more: str) -> str:
    views = {"entries": B.ENTRIES_SQL, "facts0": FACTS_SQL, "facts": FACTS2_SQL}
    views.update(more)
    return B.with_views(sql, **views)
