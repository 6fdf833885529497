"""Registered queries: the flagship plus projection (B), filter (C), measures (E),
aggregation (F) and formatting (I) operators, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.functions import fmt
from opslog.functions.globs import glob_match
from opslog.functions.paths import (archive_ext, argv, base_name, expand_home, map_overlay, nested_get,
                                    output_lines, strip_base, upload_key)
from opslog.operators import measures as M
from opslog.operators import rollup as R
from opslog.operators.discover import entry_exists
from opslog.operators.scan import PER_TASK
from opslog.operators.select import select_by_glob_table, select_by_globs, where_failed, where_success
from opslog.operators.flatten import align, config_rows, explode_groups, map_text  # noqa: F401
from opslog.plans.facts import (ARCHIVE_DEST, entry_facts, sql_base_name, sql_fmt_duration, sql_fmt_size,
                                sql_fmt_speed, sql_speed, with_facts)
from opslog.plans.registry import query
from opslog.session import materialize
from opslog.sources import bindings as B
from opslog.sources.bindings import DIR_GROUPS_SQL, dir_groups  # noqa: F401

# --------------------------------------------------------------------------------------------
# Flagship: which groups succeeded, how many bytes, how fast
# --------------------------------------------------------------------------------------------

SELECTORS = ["1-*", "2-*", "5-LOW"]


def backup_summary_df(spark, sf_dir):
    f = select_by_globs(entry_facts(spark, sf_dir), "grp", SELECTORS)
    g = f.groupBy("grp").agg(
        R.any_success().alias("passed"),
        *R.outcome_counts(),
        R.total_size().alias("total_bytes"),
        R.sum_elapsed("elapsed_us", "success", wide=True).alias("ok_elapsed_us"),
    )
    g = g.select(
        "*",
        fmt.fmt_size("total_bytes").alias("size_text"),
        fmt.fmt_duration("ok_elapsed_us", wide=True).alias("elapsed_text"),
        fmt.fmt_speed(M.speed_bps("total_bytes", "ok_elapsed_us", "passed", wide=True)).alias("speed_text"),
    )
    # one row per group; over some ten million entries a group's total elapsed time passes BIGINT
    return R.narrowed(materialize(g, "backup-summary"), "ok_elapsed_us")


_SUMMARY_SQL = with_facts(f"""
SELECT *, {sql_fmt_size('total_bytes')} AS size_text, {sql_fmt_duration('ok_elapsed_us')} AS elapsed_text,
       {sql_fmt_speed(sql_speed('total_bytes', 'ok_elapsed_us', 'passed'))} AS speed_text
FROM (SELECT grp, coalesce(bool_or(success), false) AS passed, CAST(count(*) AS BIGINT) AS total,
             CAST(count_if(success) AS BIGINT) AS ok, CAST(count_if(NOT success) AS BIGINT) AS failed,
             CAST(coalesce(sum(CASE WHEN success THEN size END), 0) AS BIGINT) AS total_bytes,
             CAST(coalesce(sum(CASE WHEN success THEN elapsed_us END), 0) AS BIGINT) AS ok_elapsed_us
      FROM facts WHERE grp GLOB '1-*' OR grp GLOB '2-*' OR grp GLOB '5-LOW' GROUP BY grp) s
""")

query("backup_summary", _SUMMARY_SQL)(backup_summary_df)


# --------------------------------------------------------------------------------------------
# B: projection and flattening
# --------------------------------------------------------------------------------------------




@query("b1_explode_groups", B.with_views("""
SELECT cfg_id, grp, CAST(u.i - 1 AS INTEGER) AS pos, u.x AS directory FROM g, unnest(dirs) WITH ORDINALITY AS u(x, i)
UNION ALL SELECT cfg_id, grp, NULL, NULL FROM g WHERE len(dirs) = 0
""", g=DIR_GROUPS_SQL))
def b1(spark, d):
    return explode_groups(dir_groups(spark, d))


HOME = "/home/ops"


@query("b2_expand_home", B.with_views(f"""
SELECT cfg_id, CAST(u.i - 1 AS INTEGER) AS pos,
       CASE WHEN u.x = '~' OR starts_with(u.x, '~/') THEN '{HOME}' || substr(u.x, 2) ELSE u.x END AS path
FROM g, unnest(dirs) WITH ORDINALITY AS u(x, i)
""", g=DIR_GROUPS_SQL))
def b2(spark, d):
    e = explode_groups(dir_groups(spark, d)).where(F.col("directory").isNotNull())
    return e.select("cfg_id", "pos", expand_home("directory", HOME).alias("path"))


@query("b3_nested_get", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k.x') AS kx,
       json_extract_string(props, '$.missing') AS missing FROM events
""")
def b3(spark, d):
    ev = B.table(spark, d, "events")
    return ev.select("event_id", nested_get("props", "k").alias("k"), nested_get("props", "k.x").alias("kx"),
                     nested_get("props", "missing").alias("missing"))


@query("b4_base_name", B.with_views(f"SELECT path, {sql_base_name('path')} AS name FROM paths", paths=B.PATHS_SQL))
def b4(spark, d):
    return B.paths(spark, d).select("path", base_name("path").alias("name"))


@query("b5_archive_name", with_facts("SELECT run_id, directory, size, started, archive FROM facts"))
def b5(spark, d):
    return entry_facts(spark, d).select("run_id", "directory", "size", "started", "archive")


@query("b6_upload_key", with_facts(
    f"SELECT run_id, size, grp || '/' || {sql_base_name('directory')} || '/' || {sql_base_name('archive')} AS key "
    f"FROM facts"))
def b6(spark, d):
    return entry_facts(spark, d).select("run_id", "size", upload_key("grp", "directory", "archive").alias("key"))


_KIND_SQL = "CASE p_size % 4 WHEN 0 THEN 'tar' WHEN 1 THEN 'zip' WHEN 2 THEN 'rar' ELSE 'tar' END"
_CODEC_SQL = "CASE p_partkey % 3 WHEN 0 THEN 'gz' WHEN 1 THEN 'xz' END"


@query("b7_archive_ext", f"""
SELECT p_partkey, kind, codec,
       CASE kind WHEN 'tar' THEN CASE WHEN codec IS NULL THEN 'tar' ELSE 'tar.' || codec END
                 WHEN 'zip' THEN 'zip' WHEN 'rar' THEN 'rar' END AS ext
FROM (SELECT p_partkey, {_KIND_SQL} AS kind, {_CODEC_SQL} AS codec FROM part) t
""")
def b7(spark, d):
    p = B.table(spark, d, "part")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("tar", "zip", "rar", "tar")]),
                        (F.col("p_size") % 4 + 1).cast("int"))
    codec = F.when(F.col("p_partkey") % 3 == 0, "gz").when(F.col("p_partkey") % 3 == 1, "xz")
    t = p.select("p_partkey", kind.alias("kind"), codec.alias("codec"))
    return t.select("*", archive_ext("kind", "codec").alias("ext"))


@query("b8_strip_base", with_facts(
    f"SELECT run_id, size, substr(replace(archive, '{ARCHIVE_DEST}', ''), 2) AS name FROM facts"))
def b8(spark, d):
    return entry_facts(spark, d).select("run_id", "size", strip_base("archive", ARCHIVE_DEST).alias("name"))


@query("b9_argv", """
SELECT conv_id, turn, CAST(len(a) AS INTEGER) AS n_args, a[1] AS first_arg, array_to_string(a, '|') AS args
FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS a
      FROM conversations) t
""")
def b9(spark, d):
    c = B.table(spark, d, "conversations").select("conv_id", "turn", argv("text").alias("a"))
    return c.select("conv_id", "turn", F.size("a").alias("n_args"), F.try_element_at("a", F.lit(1)).alias("first_arg"),
                    F.array_join("a", "|").alias("args"))


_STRIP_SQL = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


@query("b10_split_lines", f"""
SELECT conv_id, turn, CAST(u.i - 1 AS INTEGER) AS line_no, u.x AS line
FROM (SELECT conv_id, turn, {_STRIP_SQL} AS s FROM conversations) t,
     unnest(string_split(s, chr(10))) WITH ORDINALITY AS u(x, i)
WHERE s <> ''
""")
def b10(spark, d):
    c = B.table(spark, d, "conversations")
    return c.select("conv_id", "turn", F.posexplode(output_lines("text")).alias("line_no", "line"))


def run_params(spark, d):
    o = B.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("cfg_id"),
                    F.create_map(F.lit("Command"), F.lit("Backup"), F.lit("Priority"), F.col("o_orderpriority"),
                                 F.lit("Status"), F.col("o_orderstatus")).alias("config"))


@query("b11_config_rows", """
SELECT o_orderkey AS cfg_id, 0 AS pos, 'Command' AS key, 'Backup' AS value FROM orders
UNION ALL SELECT o_orderkey, 1, 'Priority', o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, 2, 'Status', o_orderstatus FROM orders
""")
def b11(spark, d):
    return config_rows(run_params(spark, d))


@query("b12_run_config", """
SELECT o_orderkey AS cfg_id,
       CASE WHEN o_orderstatus = 'P'
            THEN 'Destination=/backup;Upload=false'
            ELSE 'Destination=/backup;Upload=aws;S3 Bucket=b-' || CAST(o_custkey AS VARCHAR) END AS config
FROM orders
""")
def b12(spark, d):
    o = B.table(spark, d, "orders")
    base = F.create_map(F.lit("Destination"), F.lit("/backup"), F.lit("Upload"), F.lit("false"))
    up = F.when(F.col("o_orderstatus") != "P",
                F.create_map(F.lit("S3 Bucket"), F.concat(F.lit("b-"), F.col("o_custkey").cast("string")),
                             F.lit("Upload"), F.lit("aws")))
    return o.select(F.col("o_orderkey").alias("cfg_id"), map_text(map_overlay(base, up)).alias("config"))


# --------------------------------------------------------------------------------------------
# C: selection
# --------------------------------------------------------------------------------------------

C1_PATTERNS = ["*widget", "red *", "sm?ll*", "[bh]*", "[!a-m]*", "*o*t"]


@query("c1_glob_match", "SELECT p_partkey, p_name, " + ", ".join(
    f"p_name GLOB '{p}' AS m{i}" for i, p in enumerate(C1_PATTERNS)) + " FROM part")
def c1(spark, d):
    p = B.table(spark, d, "part")
    return p.select("p_partkey", "p_name", *[glob_match("p_name", pat).alias(f"m{i}")
                                             for i, pat in enumerate(C1_PATTERNS)])


C2_SELECTORS = ["red *", "*gear", "sm?ll*"]


@query("c2_select_by_globs", "SELECT p_partkey, p_name FROM part WHERE " + " OR ".join(
    f"p_name GLOB '{p}'" for p in C2_SELECTORS))
def c2(spark, d):
    return select_by_globs(B.table(spark, d, "part").select("p_partkey", "p_name"), "p_name", C2_SELECTORS)


def selector_table(spark, d):
    """Selectors held as data: '<first word> *' globs and some exact names, both from part."""
    p = B.table(spark, d, "part")
    globs = p.where(F.col("p_size") == 1).select(
        F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(" *")).alias("pattern"))
    exact = p.where(F.col("p_size") == 2).select(F.col("p_name").alias("pattern"))
    return globs.union(exact)


_SELECTORS_SQL = """
SELECT split_part(p_name, ' ', 1) || ' *' AS pattern FROM part WHERE p_size = 1
UNION ALL SELECT p_name FROM part WHERE p_size = 2
"""


@query("c3_select_by_glob_table", B.with_views("""
SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM sel WHERE p_name GLOB sel.pattern)
""", sel=_SELECTORS_SQL))
def c3(spark, d):
    return select_by_glob_table(B.table(spark, d, "part").select("p_partkey", "p_name"), "p_name",
                                selector_table(spark, d))


@query("c4_where_success", with_facts("SELECT run_id, directory, size, started FROM facts WHERE success"))
def c4(spark, d):
    return where_success(entry_facts(spark, d)).select("run_id", "directory", "size", "started")


@query("c5_where_failed", with_facts("SELECT run_id, directory, size, status FROM facts WHERE NOT success"))
def c5(spark, d):
    return where_failed(entry_facts(spark, d)).select("run_id", "directory", "size", "status")


# --------------------------------------------------------------------------------------------
# E: row measures
# --------------------------------------------------------------------------------------------

@query("e1_proc_status", with_facts("SELECT run_id, directory, size, exitcode, exc, status FROM facts"))
def e1(spark, d):
    return entry_facts(spark, d).select("run_id", "directory", "size", "exitcode", "exc", "status")


@query("e2_proc_success", with_facts("SELECT run_id, directory, size, success FROM facts"))
def e2(spark, d):
    return entry_facts(spark, d).select("run_id", "directory", "size", "success")


def archive_facts(spark, d):
    f = entry_facts(spark, d)
    listing = f.where(F.col("exitcode").isNotNull()).select(F.col("archive").alias("path"))
    f = entry_exists(f, listing, "archive", "path")
    ok = M.archive_success("exc", "started", "completed", "directory", "archive", "exists")
    return f.withColumn("archive_ok", ok).withColumn("proc_archive_ok", M.proc_archive_success("archive_ok", "success"))


def _archive_sql(select: str) -> str:
    return with_facts(select, af=f"""
SELECT f.*, l.path IS NOT NULL AS exists,
       coalesce(exc IS NULL AND started IS NOT NULL AND completed IS NOT NULL AND length(directory) > 0
                AND length(archive) > 0 AND l.path IS NOT NULL, false) AS archive_ok
FROM facts f LEFT JOIN (SELECT DISTINCT archive AS path FROM facts WHERE exitcode IS NOT NULL) l
  ON f.archive = l.path""")


@query("e3_archive_success", _archive_sql("SELECT run_id, directory, size, exists, archive_ok FROM af"))
def e3(spark, d):
    return archive_facts(spark, d).select("run_id", "directory", "size", "exists", "archive_ok")


@query("e4_proc_archive_success", _archive_sql(
    "SELECT run_id, directory, size, coalesce(archive_ok AND success, false) AS proc_archive_ok FROM af"))
def e4(spark, d):
    return archive_facts(spark, d).select("run_id", "directory", "size", "proc_archive_ok")


def uploads(spark, d):
    """Upload rows for the successful archives: start at archive completion, last size % 97 s."""
    f = where_success(entry_facts(spark, d))
    return f.select(
        "run_id", "grp", "directory", "archive",
        F.col("archive").alias("filepath"),
        upload_key("grp", "directory", "archive").alias("key"),
        "size",
        F.col("completed").alias("u_started"),
        F.timestamp_add("SECOND", F.col("size") % 97, F.col("completed")).alias("u_completed"),
        F.when(F.col("size") % 7 == 0, F.lit("timeout")).alias("u_exc"),
    ).withColumn("u_success", M.upload_success("u_exc", "filepath", "key", "size", "u_started", "u_completed"))


UPLOADS_SQL = f"""
SELECT run_id, grp, directory, archive, archive AS filepath,
       grp || '/' || {sql_base_name('directory')} || '/' || {sql_base_name('archive')} AS key, size,
       completed AS u_started, completed + to_seconds(size % 97) AS u_completed,
       CASE WHEN size % 7 = 0 THEN 'timeout' END AS u_exc
FROM facts WHERE success
"""

UPLOADS2_SQL = """
SELECT *, coalesce(u_exc IS NULL AND length(filepath) > 0 AND length(key) > 0 AND size IS NOT NULL AND size <> 0
                   AND u_started IS NOT NULL AND u_completed IS NOT NULL, false) AS u_success FROM uploads0
"""


def _uploads_sql(select: str) -> str:
    return with_facts(select, uploads0=UPLOADS_SQL, uploads=UPLOADS2_SQL)


@query("e5_upload_success", _uploads_sql("SELECT run_id, key, size, u_exc, u_success FROM uploads"))
def e5(spark, d):
    return uploads(spark, d).select("run_id", "key", "size", "u_exc", "u_success")


@query("e6_elapsed", with_facts("""
SELECT run_id, directory, size, elapsed_us AS archive_us,
       CASE WHEN started <= completed THEN elapsed_us END AS process_us,
       greatest(elapsed_us, 1000000) AS upload_us FROM facts"""))
def e6(spark, d):
    f = entry_facts(spark, d)
    return f.select("run_id", "directory", "size", F.col("elapsed_us").alias("archive_us"),
                    M.elapsed_us("started", "completed", "process").alias("process_us"),
                    M.elapsed_us("started", "completed", "upload").alias("upload_us"))


@query("e7_speed", with_facts("SELECT run_id, directory, size, speed FROM facts"))
def e7(spark, d):
    return entry_facts(spark, d).select("run_id", "directory", "size", "speed")


@query("e8_visible_size", with_facts(
    "SELECT run_id, directory, size, CASE WHEN success THEN size END AS visible FROM facts"))
def e8(spark, d):
    return entry_facts(spark, d).select("run_id", "directory", "size", M.visible_size("size", "success").alias("visible"))


# --------------------------------------------------------------------------------------------
# F: aggregation
# --------------------------------------------------------------------------------------------

@query("f1_any_success", with_facts(
    "SELECT grp, coalesce(bool_or(success), false) AS passed FROM facts GROUP BY grp"))
def f1(spark, d):
    return entry_facts(spark, d).groupBy("grp").agg(R.any_success().alias("passed"))


@query("f2_all_success", with_facts("""
SELECT o_orderkey AS run_id, coalesce(s.ok, true) AS passed
FROM orders LEFT JOIN (SELECT run_id, bool_and(success) AS ok FROM facts GROUP BY run_id) s ON o_orderkey = s.run_id
"""))
def f2(spark, d):
    runs = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"))
    s = entry_facts(spark, d).groupBy("run_id").agg(R.all_success().alias("passed"))
    return R.with_children(runs, s, ["run_id"], {"passed": True})


@query("f3_total_size", with_facts(
    "SELECT grp, CAST(coalesce(sum(CASE WHEN success THEN size END), 0) AS BIGINT) AS total_bytes "
    "FROM facts GROUP BY grp"))
def f3(spark, d):
    return entry_facts(spark, d).groupBy("grp").agg(R.total_size().alias("total_bytes"))


@query("f4_outcome_counts", with_facts(
    "SELECT grp, CAST(count(*) AS BIGINT) AS total, CAST(count_if(success) AS BIGINT) AS ok, "
    "CAST(count_if(NOT success) AS BIGINT) AS failed FROM facts GROUP BY grp"))
def f4(spark, d):
    return entry_facts(spark, d).groupBy("grp").agg(*R.outcome_counts())


@query("f5_sum_elapsed", with_facts(
    "SELECT run_id, CAST(coalesce(sum(elapsed_us), 0) AS BIGINT) AS all_us, "
    "CAST(coalesce(sum(CASE WHEN success THEN elapsed_us END), 0) AS BIGINT) AS ok_us FROM facts GROUP BY run_id"))
def f5(spark, d):
    return entry_facts(spark, d).groupBy("run_id").agg(R.sum_elapsed().alias("all_us"),
                                                      R.sum_elapsed("elapsed_us", "success").alias("ok_us"))


@query("f6_time_span", with_facts(
    "SELECT grp, min(started) AS first_started, max(completed) AS last_completed FROM facts GROUP BY grp"))
def f6(spark, d):
    return entry_facts(spark, d).groupBy("grp").agg(*R.time_span())


@query("f7_group_list", with_facts("""
SELECT o_orderkey AS run_id, coalesce(s.names, '[none]') AS dirs
FROM orders LEFT JOIN (SELECT run_id, string_agg(DISTINCT directory, ', ' ORDER BY directory) AS names
                       FROM facts GROUP BY run_id) s ON o_orderkey = s.run_id
"""))
def f7(spark, d):
    runs = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"))
    s = entry_facts(spark, d).groupBy("run_id").agg(R.group_list("directory").alias("dirs"))
    return R.with_children(runs, s, ["run_id"], {"dirs": "[none]"})


@query("f8_run_rollup", with_facts("""
SELECT run_id, bool_and(op_success) AS run_success, CAST(count(*) AS BIGINT) AS n_ops,
       CAST(count_if(op_success) AS BIGINT) AS n_ops_ok, CAST(sum(n_proc) AS BIGINT) AS n_proc,
       CAST(sum(op_bytes) AS BIGINT) AS run_bytes, CAST(sum(op_elapsed_us) AS BIGINT) AS run_elapsed_us
FROM (SELECT run_id, directory, bool_and(success) AS op_success, count(*) AS n_proc,
             coalesce(sum(elapsed_us), 0) AS op_elapsed_us,
             coalesce(sum(CASE WHEN success THEN size END), 0) AS op_bytes
      FROM facts GROUP BY run_id, directory) o
GROUP BY run_id
"""))
def f8(spark, d):
    tasks = -(-B.table(spark, d, "lineitem").count() // PER_TASK)
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return R.run_rollup(entry_facts(spark, d), tasks=tasks if tasks > given else None)


def _levels_oracle() -> str:
    procs = """SELECT run_id, 'backup' AS action, directory AS operation, success, size, elapsed_us, started, completed FROM facts
        UNION ALL SELECT run_id, 'upload', directory, size % 7 <> 0, size, elapsed_us, started, completed FROM facts WHERE success
        UNION ALL SELECT run_id, 'deploy', grp, success, size, elapsed_us, started, completed FROM facts WHERE size % 2048 = 0"""
    ops = """SELECT run_id, action, operation, bool_and(success) AS success, count(*) AS n, coalesce(sum(size) FILTER (WHERE success), 0) AS bytes,
        coalesce(sum(elapsed_us), 0) AS elapsed_us, min(started) AS started, max(completed) AS completed FROM procs GROUP BY run_id, action, operation"""
    acts = """SELECT run_id, action, CASE WHEN action IN ('backup', 'upload') THEN bool_or(success) ELSE bool_and(success) END AS success, sum(n) AS n,
        sum(bytes) AS bytes, min(started) AS started, max(completed) AS completed FROM ops GROUP BY run_id, action"""
    rows = """SELECT o.run_id, 'operation' AS level, o.action, o.operation, o.success, o.n, o.bytes, o.elapsed_us, o.started, o.completed,
            a.started AS scope_started, a.completed AS scope_completed FROM ops o JOIN acts a ON o.run_id = a.run_id AND o.action = a.action
        UNION ALL SELECT run_id, 'action', action, NULL, success, n, bytes, epoch_us(completed) - epoch_us(started), started, completed, started, completed FROM acts
        UNION ALL SELECT run_id, 'run', NULL, NULL, ok, n, bytes, epoch_us(en) - epoch_us(st), st, en, st, en
            FROM (SELECT run_id, bool_and(success) AS ok, sum(n) AS n, sum(bytes) AS bytes, min(started) AS st, max(completed) AS en FROM acts GROUP BY run_id) r"""
    return with_facts("SELECT * REPLACE (CAST(n AS BIGINT) AS n, CAST(bytes AS BIGINT) AS bytes, CAST(elapsed_us AS BIGINT) AS elapsed_us) FROM levels",
                      procs=procs, ops=ops, acts=acts, levels=rows)


@query("f8_outcome_levels", _levels_oracle())
def f8_levels(spark, d):
    f = entry_facts(spark, d)
    cols = ["success", "size", "elapsed_us", "started", "completed"]
    backup = f.select("run_id", F.lit("backup").alias("action"), F.col("directory").alias("operation"), *cols)
    upload = f.where("success").select("run_id", F.lit("upload").alias("action"), F.col("directory").alias("operation"), (F.col("size") % 7 != 0).alias("success"), *cols[1:])
    deploy = f.where("size % 2048 = 0").select("run_id", F.lit("deploy").alias("action"), F.col("grp").alias("operation"), *cols)
    return R.outcome_levels(backup.unionByName(upload).unionByName(deploy))


# --------------------------------------------------------------------------------------------
# I: formatting
# --------------------------------------------------------------------------------------------

@query("i1_fmt_size", with_facts(f"SELECT run_id, size, {sql_fmt_size('size')} AS size_text FROM facts"))
def i1(spark, d):
    return entry_facts(spark, d).select("run_id", "size", fmt.fmt_size("size").alias("size_text"))


@query("i2_fmt_speed", with_facts(f"SELECT run_id, size, speed, {sql_fmt_speed('speed')} AS speed_text FROM facts"))
def i2(spark, d):
    return entry_facts(spark, d).select("run_id", "size", "speed", fmt.fmt_speed("speed").alias("speed_text"))


@query("i3_fmt_duration", with_facts(
    f"SELECT run_id, size, elapsed_us, {sql_fmt_duration('elapsed_us')} AS elapsed_text FROM facts"))
def i3(spark, d):
    return entry_facts(spark, d).select("run_id", "size", "elapsed_us",
                                        fmt.fmt_duration("elapsed_us").alias("elapsed_text"))


@query("i4_fmt_datetime", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt, strftime(ts, '%Y-%m-%d') AS d,
       strftime(ts, '%H:%M:%S') AS t, strftime(ts, '%Y/%m/%d_%H-%M-%S') AS custom FROM events
""")
def i4(spark, d):
    ev = B.table(spark, d, "events")
    return ev.select("event_id", fmt.fmt_datetime("ts").alias("dt"), fmt.fmt_date("ts").alias("d"),
                     fmt.fmt_time("ts").alias("t"), fmt.fmt_datetime("ts", "%Y/%m/%d_%H-%M-%S").alias("custom"))


@query("i6_one_decimal", with_facts(
    "SELECT run_id, size, CAST(size // 1048576 AS VARCHAR) || '.' || "
    "CAST((((size // 1024) % 1024) * 10) // 1024 AS VARCHAR) AS mib FROM facts"))
def i6(spark, d):
    f = entry_facts(spark, d)
    return f.select("run_id", "size", fmt.one_decimal(fmt.idiv("size", 1048576), fmt.idiv("size", 1024)).alias("mib"))


def _sql_pad(a: str, x: str, w: str) -> str:
    p = f"({w} - length({x}))"
    if a == "l":
        return f"{x} || repeat(' ', {p})"
    if a == "r":
        return f"repeat(' ', {p}) || {x}"
    left = f"({p} // 2 + CASE WHEN {p} % 2 = 1 AND {w} % 2 = 1 THEN 1 ELSE 0 END)"
    return f"repeat(' ', {left}) || {x} || repeat(' ', {p} - {left})"


_I7_COLS = ["name", "size_text", "elapsed_text", "speed_text"]
_I7_SPEC = "lrrc"


@query("i7_align", with_facts(f"""
SELECT grp, run_id, size, {', '.join(_sql_pad(a, c, 'max(length(' + c + ')) OVER (PARTITION BY grp)') + ' AS a_' + c
                                     for a, c in zip(_I7_SPEC, _I7_COLS))}
FROM (SELECT grp, run_id, size, substr(replace(archive, '{ARCHIVE_DEST}', ''), 2) AS name,
             {sql_fmt_size('size')} AS size_text, {sql_fmt_duration('elapsed_us')} AS elapsed_text,
             {sql_fmt_speed('speed')} AS speed_text FROM facts WHERE success) t
"""))
def i7(spark, d):
    f = where_success(entry_facts(spark, d)).select(
        "grp", "run_id", "size", strip_base("archive", ARCHIVE_DEST).alias("name"),
        fmt.fmt_size("size").alias("size_text"), fmt.fmt_duration("elapsed_us").alias("elapsed_text"),
        fmt.fmt_speed("speed").alias("speed_text"))
    a = align(f, "grp", _I7_COLS, _I7_SPEC)
    return a.select("grp", "run_id", "size", *[f"a_{c}" for c in _I7_COLS])


@query("i8_wrap")
def i8(spark, d):
    c = B.table(spark, d, "conversations")
    return c.select("conv_id", "turn", F.posexplode(fmt.wrap("text", 100)).alias("line_no", "line"))


@query("i9_symbol", f"""
SELECT event_id, event_type, event_type AS kind_symbol,
       CASE WHEN event_type <> 'error' THEN '{fmt.sym("success")}' ELSE '{fmt.sym("failure")}' END AS outcome_symbol
FROM events
""")
def i9(spark, d):
    ev = B.table(spark, d, "events")
    outcome = F.when(F.col("event_type") != "error", F.lit("success")).otherwise(F.lit("failure"))
    return ev.select("event_id", "event_type", fmt.symbol("event_type").alias("kind_symbol"),
                     fmt.symbol(outcome).alias("outcome_symbol"))


@query("i10_row_line", with_facts(f"""
SELECT run_id, size, rtrim(repeat(' ', 4) || 'Size' || repeat(' ', 30 - ((4 + 4) % 30)) || st
                            || repeat(' ', 30 - (length(st) % 30))) AS line
FROM (SELECT run_id, size, {sql_fmt_size('size')} AS st FROM facts) t
"""))
def i10(spark, d):
    f = entry_facts(spark, d)
    return f.select("run_id", "size", fmt.row_line([F.lit("Size"), fmt.fmt_size("size")], indent=4, width=30)
                    .alias("line"))


@query("i11_strip", f"SELECT conv_id, turn, {_STRIP_SQL} AS stripped FROM conversations")
def i11(spark, d):
    return B.table(spark, d, "conversations").select("conv_id", "turn", fmt.strip("text").alias("stripped"))


@query("j1_map_overlay", """
SELECT event_id,
       CASE WHEN value > 100 THEN 'k=' || json_extract_string(props, '$.k') || ';type=' || upper(event_type)
                                  || ';big=true'
            ELSE 'k=' || json_extract_string(props, '$.k') || ';type=' || event_type END AS merged
FROM events
""")
def j1(spark, d):
    ev = B.table(spark, d, "events")
    base = F.create_map(F.lit("k"), nested_get("props", "k"), F.lit("type"), F.col("event_type"))
    over = F.when(F.col("value") > 100, F.create_map(F.lit("type"), F.upper("event_type"), F.lit("big"), F.lit("true")))
    return ev.select("event_id", map_text(map_overlay(base, over)).alias("merged"))
