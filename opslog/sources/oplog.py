"""Operation log text (operator A2): ``<asctime> [LEVEL] - message`` lines.

The level is written cut and padded to five characters (``INFO ``, ``WARNI``,
``CRITI``); reading maps the five-character form back to the full name.
Lines that do not start with a header continue the previous record and take
its time stamp and level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Log record layout and level names.
ASCTIME_PATTERN = "yyyy-MM-dd HH:mm:ss,SSS"
HEADER_RE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \[(.{5})\] - (.*)$"
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]


def format_log_line(ts, level, message) -> Column:
    """Write one record the way the log handler lays it out."""
    lv = F.rpad(F.substring(level if isinstance(level, Column) else F.lit(level), 1, 5), 5, " ")
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(t, ASCTIME_PATTERN), F.lit(" ["), lv, F.lit("] - "), message)


def _level_name(short: Column) -> Column:
    m = F.create_map(*[x for lv in LEVELS for x in (F.lit(lv[:5].ljust(5)), F.lit(lv))])
    return F.coalesce(F.try_element_at(m, short), F.trim(short))


def parse_oplog(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Header lines only: ``ts_text``, ``ts``, ``level`` and ``message``."""
    v = F.col(col)
    hit = lines.where(v.rlike(HEADER_RE))
    return hit.select(
        *(keep or []),
        F.regexp_extract(v, HEADER_RE, 1).alias("ts_text"),
        F.to_timestamp(F.regexp_extract(v, HEADER_RE, 1), ASCTIME_PATTERN).alias("ts"),
        _level_name(F.regexp_extract(v, HEADER_RE, 2)).alias("level"),
        F.regexp_extract(v, HEADER_RE, 3).alias("message"),
    )


def read_oplog(spark: SparkSession, path: str) -> DataFrame:
    """A2: read log files; continuation lines inherit the previous header's time and level.

    Lines are ordered by (file, block, line_id): the file block that the line was
    read from, and a number that grows along it.  The carry runs in a window per
    block; one row per block then says which header its first lines continue, so
    no task holds a whole file.  Lines before a file's first header have no time.
    """
    v = F.col("value")
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                       F.monotonically_increasing_id().alias("line_id"), "value")
    head = F.struct(F.to_timestamp(F.regexp_extract(v, HEADER_RE, 1), ASCTIME_PATTERN).alias("ts"),
                    _level_name(F.regexp_extract(v, HEADER_RE, 2)).alias("level"))
    lines = raw.select("file", "block", "line_id", F.when(v.rlike(HEADER_RE), head).alias("_head"),
                       F.when(v.rlike(HEADER_RE), F.regexp_extract(v, HEADER_RE, 3)).otherwise(v).alias("message"))
    ends = lines.groupBy("file", "block").agg(F.max_by("_head", F.when(F.col("_head").isNotNull(), F.col("line_id"))).alias("_end"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("file", "block", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    here = Window.partitionBy("file", "block").orderBy("line_id").rowsBetween(Window.unboundedPreceding, 0)
    found = lines.withColumn("_here", F.last("_head", ignorenulls=True).over(here)).join(carried, ["file", "block"])
    record = F.coalesce("_here", "_before")
    return found.select("file", "block", "line_id", record["ts"].alias("ts"), record["level"].alias("level"), "message")
