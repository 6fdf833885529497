"""Row-level status and measures of runs, archives and uploads (operators E1-E8).

Every function returns a Column, so a caller composes them in one
``select`` and Catalyst evaluates them in the same codegen stage as the scan.
Success is three-valued in the source records (a missing field reads as
"not present"), so each success flag is coalesced to a plain boolean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opslog.functions.fmt import floor_div

SUCCESS, FAILED, EXCEPTION = "success", "failed", "exception"
US_PER_S = 1_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def present(col) -> Column:
    """A field counts as present when it is not null and, for text, not empty."""
    c = _c(col)
    return c.isNotNull() & (F.length(c.cast("string")) > 0)


def proc_status(exc, exitcode) -> Column:
    """``exception`` if one was raised, ``failed`` unless the exit code is 0 (null fails), else ``success``."""
    return (F.when(_c(exc).isNotNull(), F.lit(EXCEPTION))
            .when(~_c(exitcode).eqNullSafe(F.lit(0)), F.lit(FAILED))
            .otherwise(F.lit(SUCCESS)))


def proc_success(exc, exitcode, cmd, started, completed) -> Column:
    """Status success and the command and both timestamps present."""
    return F.coalesce((proc_status(exc, exitcode) == SUCCESS) & present(cmd)
                      & _c(started).isNotNull() & _c(completed).isNotNull(), F.lit(False))


def archive_success(exc, started, completed, directory, archive, exists) -> Column:
    """No exception, timestamps, directory and archive present, and the archive exists."""
    return F.coalesce(_c(exc).isNull() & _c(started).isNotNull() & _c(completed).isNotNull()
                      & present(directory) & present(archive) & _c(exists), F.lit(False))


def proc_archive_success(archive_ok, proc_ok) -> Column:
    """An archive made by an external process also needs that process to succeed."""
    return F.coalesce(_c(archive_ok) & _c(proc_ok), F.lit(False))


def upload_success(exc, filepath, key, size, started, completed) -> Column:
    """E5: no exception; path, key, timestamps present; a size of 0 is not a success."""
    return F.coalesce(_c(exc).isNull() & present(filepath) & present(key)
                      & _c(size).isNotNull() & (_c(size) != 0)
                      & _c(started).isNotNull() & _c(completed).isNotNull(), F.lit(False))


def elapsed_us(started, completed, mode: str = "archive") -> Column:
    """Elapsed microseconds.

    ``archive``: null if either end is missing, may be negative;
    ``process``: also null when started > completed;
    ``upload``: at least one second.
    """
    s, e = _c(started), _c(completed)
    diff = F.timestamp_diff("MICROSECOND", s, e)
    if mode == "archive":
        return diff
    if mode == "process":
        return F.when(s <= e, diff)
    if mode == "upload":
        return F.greatest(diff, F.lit(US_PER_S).cast("bigint"))
    raise ValueError(f"unknown elapsed mode {mode!r}")


def speed_bps(size, elapsed, success, wide: bool = False) -> Column:
    """Whole bytes per second, floored; 0 when not successful; null for a zero span; ``wide`` spans are DECIMAL(38,0)."""
    # bytes * 10^6 passes 2^63 only beyond ~9 TB: exact BIGINT arithmetic below
    # that, DECIMAL(38,0) above it (the slow path is taken only when needed).
    sz = _c(size).cast("bigint")
    den = _c(elapsed).cast("decimal(38,0)" if wide else "bigint")
    den = F.when(den != 0, den)
    big = floor_div(sz.cast("decimal(38,0)") * F.lit(US_PER_S).cast("decimal(38,0)"),
                    den.cast("decimal(38,0)")).cast("bigint")
    q = big if wide else F.when(F.abs(sz) < F.lit(9_000_000_000_000), floor_div(sz * F.lit(US_PER_S), den)).otherwise(big)
    return F.when(F.coalesce(_c(success), F.lit(False)), q).otherwise(F.lit(0).cast("bigint"))


def visible_size(size, success) -> Column:
    """The size of a successful entry, else null."""
    return F.when(F.coalesce(_c(success), F.lit(False)), _c(size))
