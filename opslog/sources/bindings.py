"""Operation-log views over the driver's parquet tables (FIXTURES.md section 2).

Each binding is a lazy DataFrame; nothing is read until an action runs, and
Catalyst prunes every column an operator does not use down to the parquet
scan.  The SQL text next to each binding is the same view written for the
DuckDB oracle, so a query and its oracle start from identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# --- entries: one archive / process row per line item --------------------------------------

def entries(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None, tasks: int | None = None,
            more: dict[str, Column] | None = None) -> DataFrame:
    """``tasks`` spreads both tables by run over that many tasks, so that the entries of a run are in one of them.

    ``more`` are further columns, made of ``exc`` before that: Spark does not know how rows are spread once Python has seen them.
    """
    li = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    o = table(spark, sf_dir, "orders")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    li, more = li.withColumn("exc", F.when((rf == "N") & (ls == "O"), F.lit("boom"))), more or {}
    if tasks:
        li = li.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate", "exc", *[c.alias(n) for n, c in more.items()]).repartition(tasks, "l_orderkey")
        o = o.select("o_orderkey", "o_orderpriority", "o_orderdate").repartition(tasks, "o_orderkey")
    else:
        li = li.withColumns(more) if more else li
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("grp"),
        F.concat(F.lit("/mnt/s"), F.col("l_suppkey").cast("string")).alias("directory"),
        F.col("o_orderdate").alias("started"),
        F.col("l_shipdate").alias("completed"),
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 1024).alias("size"),
        F.when(rf == "A", F.lit(0)).when(rf == "R", F.lit(6)).alias("exitcode"),
        "exc", *more,
    )


ENTRIES_SQL = """
SELECT o_orderkey AS run_id, o_orderpriority AS grp,
       concat('/mnt/s', CAST(l_suppkey AS VARCHAR)) AS directory,
       o_orderdate AS started, l_shipdate AS completed,
       CAST(round(l_extendedprice * 100) AS BIGINT) * 1024 AS size,
       CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 6 END AS exitcode,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'boom' END AS exc
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# --- chunks: bytes arriving per uploaded file; file size = their total ----------------------

def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("file"),
        F.col("event_id").alias("seq"),
        "ts",
        F.round(F.col("value") * 100).cast("bigint").alias("bytes"),
    )
    # File size as a grouped total joined back (partial aggregation before the
    # shuffle; a hot file is split by AQE's skew join instead of one window task).
    sizes = ev.groupBy("file").agg(F.sum("bytes").cast("bigint").alias("filesize"))
    return ev.join(sizes, "file")


CHUNKS_SQL = """
SELECT user_id AS file, event_id AS seq, ts,
       CAST(round(value * 100) AS BIGINT) AS bytes,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id) AS BIGINT) AS filesize
FROM events
"""


# --- steps: ordered actions of a run ---------------------------------------------------------

def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
        "ts",
        (F.col("event_type") != "error").alias("ok"),
    )


STEPS_SQL = """
SELECT user_id AS run_id, event_id AS seq, event_type AS kind, ts, event_type <> 'error' AS ok
FROM events
"""


# --- paths: a file listing with markers at two depths ----------------------------------------

def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of ``pages``: each page yields its path plus, for some pages, marker files."""
    url = F.col("url")
    path = F.split_part(F.split_part(F.split_part(url, F.lit("://"), F.lit(2)), F.lit("?"), F.lit(1)),
                        F.lit("#"), F.lit(1))
    p = table(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    part1 = F.split_part(F.col("path"), F.lit("/"), F.lit(1))
    part2 = F.split_part(F.col("path"), F.lit("/"), F.lit(2))
    deep = F.when(F.col("page_id") % 3 == 0, F.concat(part1, F.lit("/"), part2, F.lit("/compose.yml")))
    top = F.when(F.col("page_id") % 10 == 0, F.concat(part1, F.lit("/compose.yaml")))
    every = p.select(F.explode(F.array(F.col("path"), deep, top)).alias("path"))
    return every.where(F.col("path").isNotNull()).distinct()


PATHS_SQL = """
WITH p AS (SELECT page_id, split_part(split_part(split_part(url,'://',2),'?',1),'#',1) AS path FROM pages)
SELECT path FROM p
UNION SELECT concat(split_part(path,'/',1),'/',split_part(path,'/',2),'/compose.yml') FROM p WHERE page_id % 3 = 0
UNION SELECT concat(split_part(path,'/',1),'/compose.yaml') FROM p WHERE page_id % 10 = 0
"""


# --- overlays: environment settings per service glob (configuration, not data) --------------

# The overlay table of FIXTURES.md (ord, pattern, key, value).
OVERLAY_ROWS = [
    (0, "*", "UID", "1001"),
    (0, "*", "GID", "1001"),
    (1, "red *", "UID", "1002"),
    (2, "* widget", "PORT", "8080"),
    (2, "* widget", "UID", "1003"),
]


def overlays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OVERLAY_ROWS, "ord INT, pattern STRING, k STRING, v STRING")


OVERLAYS_SQL = """
SELECT * FROM (VALUES (0,'*','UID','1001'),(0,'*','GID','1001'),(1,'red *','UID','1002'),
                      (2,'* widget','PORT','8080'),(2,'* widget','UID','1003')) AS t(ord, pattern, k, v)
"""


# --- records: JSON configuration records with missing / unexpected / bad values -------------

def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    js = F.concat(
        F.lit('{"name":"'), F.col("p_name"), F.lit('"'),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(',"provider":"'), F.col("p_type"), F.lit('"'))),
        F.lit(',"compress":'), (F.col("p_size") % 8).cast("string"),
        F.when(k % 11 == 0, F.lit(',"other":1')).otherwise(F.lit("")),
        F.lit("}"),
    )
    return table(spark, sf_dir, "part").select(k.alias("id"), js.alias("js"))


RECORDS_SQL = """
SELECT p_partkey AS id,
       concat('{"name":"', p_name, '"',
              CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat(',"provider":"', p_type, '"') END,
              ',"compress":', CAST(p_size % 8 AS VARCHAR),
              CASE WHEN p_partkey % 11 = 0 THEN ',"other":1' ELSE '' END, '}') AS js
FROM part
"""


# --- directory groups: one configuration per order, priority -> directories -----------------

def dir_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory groups per configuration (one per order): priority -> directories."""
    o = table(spark, sf_dir, "orders")
    dirs = (F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>"))
            .otherwise(F.array(F.concat(F.lit("/mnt/c"), F.col("o_custkey").cast("string")),
                               F.when(F.col("o_orderstatus") == "F", F.lit("~/backup")).otherwise(F.lit("")))))
    return o.select(F.col("o_orderkey").alias("cfg_id"), F.create_map(F.col("o_orderpriority"), dirs).alias("groups"))


DIR_GROUPS_SQL = """
SELECT o_orderkey AS cfg_id, o_orderpriority AS grp,
       CASE WHEN o_orderstatus = 'P' THEN []::VARCHAR[]
            ELSE ['/mnt/c' || CAST(o_custkey AS VARCHAR),
                  CASE WHEN o_orderstatus = 'F' THEN '~/backup' ELSE '' END] END AS dirs
FROM orders
"""


def with_views(sql: str, **views: str) -> str:
    """Prefix an oracle query with the binding views it uses."""
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in views.items())
    return f"WITH {ctes}\n{sql.strip()}"
