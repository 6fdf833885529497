"""Registered queries: sequences (G), ordering (H), joins (D), validation (K),
payloads (J2, J3) and operation-log parsing (A2, C6), each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.functions import fmt
from opslog.functions.paths import upload_key
from opslog.operators import sequence as S
from opslog.operators import validate as K
from opslog.operators.discover import backup_upload_join, entry_exists, free_slot, marker_roots, marker_roots_under
from opslog.operators.overlay import env_overlay, env_text, profile_lookup
from opslog.operators.select import min_level, where_success
from opslog.sources.bindings import dir_groups
from opslog.plans.facts import entry_facts, sql_base_name, sql_fmt_duration, with_facts
from opslog.plans.registry import query
from opslog.functions.fmt import sym
from opslog.plans.report import details_by_kind, notify_payloads, report_lines
from opslog.session import scratch_path
from opslog.sources import bindings as B
from opslog.sources.oplog import ASCTIME_PATTERN, format_log_line, parse_oplog, read_oplog

# --------------------------------------------------------------------------------------------
# G: sequences
# --------------------------------------------------------------------------------------------

@query("g1_executed_prefix", B.with_views("""
SELECT run_id, seq, kind, ok,
       coalesce(bool_and(ok) OVER (PARTITION BY run_id ORDER BY seq
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS executed
FROM steps""", steps=B.STEPS_SQL))
def g1(spark, d):
    return S.executed_prefix(B.steps(spark, d).select("run_id", "seq", "kind", "ok"), "run_id", "seq")


_G2_ORDER = ["directory", "size", "completed", "started"]


@query("g2_index_of_total", with_facts("""
SELECT run_id, directory, size,
       '[' || CAST(row_number() OVER (PARTITION BY run_id ORDER BY directory, size, completed, started) AS VARCHAR)
       || '/' || CAST(count(*) OVER (PARTITION BY run_id) AS VARCHAR) || ']' AS label
FROM facts"""))
def g2(spark, d):
    f = entry_facts(spark, d).select("run_id", *_G2_ORDER)
    return S.index_of_total(f, "run_id", _G2_ORDER).select("run_id", "directory", "size", "label")


@query("g3_arrival_index", B.with_views("""
SELECT run_id, seq, printf('%02d', row_number() OVER (PARTITION BY run_id ORDER BY seq) - 1) || '. ' AS label
FROM steps""", steps=B.STEPS_SQL))
def g3(spark, d):
    return S.arrival_index(B.steps(spark, d).select("run_id", "seq"), "run_id", "seq")


@query("g4_list_labels", B.with_views("""
SELECT run_id, seq,
       CASE WHEN count(*) OVER (PARTITION BY run_id) < 10
            THEN CAST(row_number() OVER (PARTITION BY run_id ORDER BY seq) AS VARCHAR)
            ELSE printf('%02d', row_number() OVER (PARTITION BY run_id ORDER BY seq)) END || '. ' AS label
FROM steps""", steps=B.STEPS_SQL))
def g4(spark, d):
    return S.list_labels(B.steps(spark, d).select("run_id", "seq"), "run_id", "seq", "number")


PCT_SQL = """
SELECT file, seq, ts, bytes, filesize, uploaded,
       least(CAST(trunc(uploaded / filesize * 100) AS INTEGER), 100) AS pct
FROM (SELECT *, CAST(sum(bytes) OVER (PARTITION BY file ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uploaded
      FROM chunks) t
"""

EMITTED_SQL = """
SELECT c.file, c.seq, c.ts, c.uploaded, c.pct FROM emit_state t JOIN pc c ON t.file = c.file AND t.rn = c.rn
WHERE t.emit
"""

THROTTLE_VIEWS = {
    "chunks": B.CHUNKS_SQL,
    "pct": PCT_SQL,
    "pc": "SELECT *, row_number() OVER (PARTITION BY file ORDER BY seq) AS rn FROM pct",
}

# recursive CTE: the sequential throttle rule, row by row
THROTTLE_RECURSIVE = """
WITH RECURSIVE emit_state(file, rn, last, emit) AS (
  SELECT DISTINCT file, CAST(0 AS BIGINT), 0, false FROM pc
  UNION ALL
  SELECT c.file, c.rn,
         CASE WHEN c.pct >= t.last + 10 OR (c.pct = 100 AND t.last <> 100) THEN c.pct ELSE t.last END,
         c.pct >= t.last + 10 OR (c.pct = 100 AND t.last <> 100)
  FROM emit_state t JOIN pc c ON c.file = t.file AND c.rn = t.rn + 1
)
"""


def throttle_oracle(select: str) -> str:
    views = B.with_views("SELECT 1", **THROTTLE_VIEWS)
    head = views[: views.rindex("\nSELECT 1")]
    rec = THROTTLE_RECURSIVE.strip()[len("WITH RECURSIVE "):]
    return "WITH RECURSIVE " + head[len("WITH "):] + ",\n" + rec + ",\nemitted AS (" + EMITTED_SQL + ")\n" + select


def progress(spark, d):
    return S.cumulative_pct(B.chunks(spark, d))


@query("g5_cumulative_pct", B.with_views("SELECT file, seq, uploaded, pct FROM pct", chunks=B.CHUNKS_SQL, pct=PCT_SQL))
def g5(spark, d):
    return progress(spark, d).select("file", "seq", "uploaded", "pct")


@query("i5_fmt_progress", B.with_views("SELECT file, seq, CAST(pct AS VARCHAR) AS pct_text FROM pct",
                                       chunks=B.CHUNKS_SQL, pct=PCT_SQL))
def i5(spark, d):
    return progress(spark, d).select("file", "seq", fmt.fmt_progress("pct").alias("pct_text"))


@query("g6_throttle_progress", throttle_oracle("SELECT file, seq, pct FROM emitted"))
def g6(spark, d):
    return S.throttle_progress(progress(spark, d)).select("file", "seq", "pct")


def emitted_rates(spark, d):
    ch = B.chunks(spark, d)
    em = S.throttle_progress(S.cumulative_pct(ch))
    return S.progress_rate(em, S.upload_starts(ch))


@query("g7_progress_rate", throttle_oracle("""
SELECT e.file, e.seq, e.pct, greatest(epoch_us(e.ts) - epoch_us(s.st), 1000000) AS elapsed_us,
       CAST((CAST(e.uploaded AS HUGEINT) * 1000000) // greatest(epoch_us(e.ts) - epoch_us(s.st), 1000000) AS BIGINT)
         AS speed
FROM emitted e JOIN (SELECT file, min(ts) AS st FROM chunks GROUP BY file) s ON e.file = s.file
"""))
def g7(spark, d):
    return emitted_rates(spark, d).select("file", "seq", "pct", "elapsed_us", "speed")


# --------------------------------------------------------------------------------------------
# H: ordering, first match, sections, split
# --------------------------------------------------------------------------------------------

@query("h1_sort_by_name", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey")
def h1(spark, d):
    return S.sort_by_name(B.table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")


@query("h2_sort_multi", with_facts("SELECT grp, directory, run_id, size FROM facts ORDER BY grp, directory, run_id, size"))
def h2(spark, d):
    return S.sort_multi(entry_facts(spark, d).select("grp", "directory", "run_id", "size"),
                        "grp", "directory", "run_id", "size")


@query("h3_first_match", B.with_views("""
SELECT r.run_id, f.seq AS first_seq, f.ts AS first_ts
FROM (SELECT DISTINCT run_id FROM steps) r
LEFT JOIN (SELECT run_id, min(seq) AS seq FROM steps WHERE kind = 'purchase' GROUP BY run_id) m ON r.run_id = m.run_id
LEFT JOIN steps f ON f.seq = m.seq
""", steps=B.STEPS_SQL))
def h3(spark, d):
    st = B.steps(spark, d).select("run_id", "seq", "ts", "kind")
    m = S.first_match(st, "run_id", "seq", F.col("kind") == "purchase")
    return m.select("run_id", F.col("first.seq").alias("first_seq"), F.col("first.ts").alias("first_ts"))


@query("h4_union_sections", with_facts("""
SELECT 0 AS section_no, 0 AS line_no, repeat('=', 100) AS text
UNION ALL
SELECT 1, CAST(row_number() OVER (ORDER BY grp) - 1 AS INTEGER),
       rtrim(repeat(' ', 4) || grp || repeat(' ', 30 - ((4 + length(grp)) % 30))
             || (CAST(ok AS VARCHAR) || '/' || CAST(total AS VARCHAR))
             || repeat(' ', 30 - (length(CAST(ok AS VARCHAR) || '/' || CAST(total AS VARCHAR)) % 30)))
FROM (SELECT grp, count_if(success) AS ok, count(*) AS total FROM facts GROUP BY grp) g
UNION ALL SELECT 2, 0, ''
UNION ALL SELECT 2, 1, repeat('=', 100)
"""))
def h4(spark, d):
    return report_lines(entry_facts(spark, d))


@query("h5_split_outcome", with_facts("""
SELECT run_id, directory, size, 'ok' AS outcome FROM facts WHERE success
UNION ALL SELECT run_id, directory, size, 'failed' FROM facts WHERE NOT success"""))
def h5(spark, d):
    ok, failed = S.split_outcome(entry_facts(spark, d).select("run_id", "directory", "size", "success"))
    return (ok.drop("success").withColumn("outcome", F.lit("ok"))
            .unionByName(failed.drop("success").withColumn("outcome", F.lit("failed"))))


# --------------------------------------------------------------------------------------------
# D: joins
# --------------------------------------------------------------------------------------------

@query("d1_env_overlay", B.with_views("""
SELECT n.name, coalesce(string_agg(p.k || '=' || p.v, ',' ORDER BY p.k), '') AS env
FROM names n LEFT JOIN (SELECT name, k, max_by(v, ord) AS v
                        FROM names JOIN overlays ON name GLOB pattern GROUP BY name, k) p ON n.name = p.name
GROUP BY n.name""", overlays=B.OVERLAYS_SQL, names="SELECT DISTINCT p_name AS name FROM part"))
def d1(spark, d):
    names = B.table(spark, d, "part").select(F.col("p_name").alias("name"))
    return env_overlay(names, B.overlays(spark)).select("name", env_text("env").alias("env"))


# Built-in archive profiles (name, provider, compress).
DEFAULT_PROFILES = [("rar", "rar", "3"), ("tar", "tar", "xz"), ("zip", "zip", "xz")]
EXTRA_REQUESTS = ["rar", "tar", "zip", "nothing"]


@query("d2_profile_lookup", B.with_views("""
SELECT r.name, CASE WHEN c.name IS NOT NULL THEN c.provider ELSE df.provider END AS provider,
       CASE WHEN c.name IS NOT NULL THEN c.compress ELSE df.compress END AS compress,
       CASE WHEN c.name IS NOT NULL THEN 'custom' WHEN df.name IS NOT NULL THEN 'default' END AS source
FROM req r
LEFT JOIN (SELECT name, p.provider AS provider, p.compress AS compress
           FROM (SELECT name, min_by({'provider': provider, 'compress': compress}, id) AS p
                 FROM (SELECT id, json_extract_string(js, '$.name') AS name,
                              json_extract_string(js, '$.provider') AS provider,
                              json_extract_string(js, '$.compress') AS compress FROM records) x
                 GROUP BY name) y) c
  ON r.name = c.name
LEFT JOIN (VALUES ('rar', 'rar', '3'), ('tar', 'tar', 'xz'), ('zip', 'zip', 'xz')) df(name, provider, compress)
  ON r.name = df.name""", records=B.RECORDS_SQL,
    req="SELECT DISTINCT p_name AS name FROM part "
        "UNION SELECT * FROM (VALUES ('rar'), ('tar'), ('zip'), ('nothing')) v(name)"))
def d2(spark, d):
    m = K.as_map("js")
    custom = B.records(spark, d).select(
        F.col("id").alias("ord"), F.try_element_at(m, F.lit("name")).alias("name"),
        F.try_element_at(m, F.lit("provider")).alias("provider"), F.try_element_at(m, F.lit("compress")).alias("compress"))
    defaults = spark.createDataFrame(DEFAULT_PROFILES, "name string, provider string, compress string")
    extra = spark.createDataFrame([(x,) for x in EXTRA_REQUESTS], "name string")
    req = B.table(spark, d, "part").select(F.col("p_name").alias("name")).union(extra).distinct()
    out = profile_lookup(req, custom, defaults)
    return out.select("name", F.col("profile.provider").alias("provider"),
                      F.col("profile.compress").alias("compress"), "source")


@query("d3_marker_roots", B.with_views("""
SELECT regexp_extract(directory, '[^/]*$') AS name, 'docker-compose' AS kind, directory
FROM m WHERE NOT EXISTS (SELECT 1 FROM m m2 WHERE starts_with(m.directory, m2.directory || '/'))
""", paths=B.PATHS_SQL, m="""
SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory FROM paths
WHERE regexp_extract(path, '[^/]*$') IN ('compose.yml', 'compose.yaml', 'docker-compose.yml', 'docker-compose.yaml')
  AND contains(path, '/')"""))
def d3(spark, d):
    return marker_roots(B.paths(spark, d))


GIVEN_ROOTS_SQL = """
SELECT '' AS root UNION SELECT split_part(path, '/', 1) FROM paths UNION SELECT split_part(path, '/', 1) || '/' || split_part(path, '/', 2) FROM paths"""


@query("d3_given_roots", B.with_views("""
SELECT g.root, regexp_extract(m.directory, '[^/]*$') AS name, 'docker-compose' AS kind, m.directory
FROM g JOIN m ON g.root = '' OR m.directory = g.root OR starts_with(m.directory, g.root || '/')
WHERE NOT EXISTS (SELECT 1 FROM m x WHERE starts_with(m.directory, x.directory || '/')
                  AND (g.root = '' OR x.directory = g.root OR starts_with(x.directory, g.root || '/')))
""", paths=B.PATHS_SQL, g=GIVEN_ROOTS_SQL, m="""
SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory FROM paths
WHERE regexp_extract(path, '[^/]*$') IN ('compose.yml', 'compose.yaml', 'docker-compose.yml', 'docker-compose.yaml')
  AND contains(path, '/')"""))
def d3_given(spark, d):
    paths = B.paths(spark, d)
    part = lambda n: F.split_part(F.col("path"), F.lit("/"), F.lit(n))
    given = paths.select(F.explode(F.array(F.lit(""), part(1), F.concat(part(1), F.lit("/"), part(2)))).alias("root")).distinct()
    return marker_roots_under(paths, given)


@query("d4_entry_exists", with_facts("""
SELECT run_id, size, archive, archive IN (SELECT archive FROM facts WHERE exitcode IS NOT NULL) AS exists
FROM facts"""))
def d4(spark, d):
    f = entry_facts(spark, d)
    listing = f.where(F.col("exitcode").isNotNull()).select(F.col("archive").alias("path"))
    return entry_exists(f, listing, "archive", "path").select("run_id", "size", "archive", "exists")


@query("d5_backup_upload_join", with_facts("""
SELECT f.run_id, f.directory, f.size, u.archive IS NOT NULL AS attempted,
       coalesce(f.success AND u.u_success, false) AS pair_success
FROM facts f LEFT JOIN (SELECT archive, length(archive) % 5 <> 0 AS u_success FROM facts WHERE success GROUP BY archive) u
  ON f.archive = u.archive"""))
def d5(spark, d):
    f = entry_facts(spark, d)
    ups = (where_success(f).select("archive").distinct()
           .withColumn("success", F.length("archive") % 5 != 0))
    j = backup_upload_join(f, ups, "archive")
    return j.select("run_id", "directory", "size", "attempted", "pair_success")


@query("d6_free_slot", with_facts("""
SELECT q.base, q.run_id, q.size, fr.slot
FROM req q JOIN fr ON q.base = fr.base AND q.r = fr.r""",
    req="""SELECT regexp_replace(archive, '\\.rar$', '') AS base, run_id, size,
                  row_number() OVER (PARTITION BY regexp_replace(archive, '\\.rar$', '')
                                     ORDER BY run_id, size, directory, completed) AS r
           FROM facts WHERE exitcode = 0""",
    ex="""SELECT DISTINCT regexp_replace(archive, '\\.rar$', '') AS base, (size // 1024) % 3 AS slot
          FROM facts WHERE exitcode = 6""",
    cand="""SELECT c.base, s.slot FROM (SELECT base, count(*) AS n FROM req GROUP BY base) c,
                   unnest(range(0, c.n + 4)) AS s(slot)""",
    fr="""SELECT base, slot, row_number() OVER (PARTITION BY base ORDER BY slot) AS r FROM cand
          WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.base = cand.base AND ex.slot = cand.slot)"""))
def d6(spark, d):
    f = entry_facts(spark, d).withColumn("base", F.regexp_replace("archive", r"\.rar$", ""))
    req = f.where(F.col("exitcode") == 0).select("base", "run_id", "size", "directory", "completed")
    ex = f.where(F.col("exitcode") == 6).select("base", (fmt.idiv("size", 1024) % 3).alias("slot"))
    out = free_slot(req, ex, "base", ("run_id", "size", "directory", "completed"))
    return out.select("base", "run_id", "size", "slot")


# --------------------------------------------------------------------------------------------
# K: validation of records
# --------------------------------------------------------------------------------------------

_ALLOWED = "['name', 'provider', 'compress', 'recovery', 'password']"

_RECORD_FIELDS = """
SELECT id, js, json_keys(js) AS keys, json_extract_string(js, '$.provider') AS prov,
       json_extract_string(js, '$.compress') AS comp, json_extract_string(js, '$.recovery') AS rec,
       json_extract_string(js, '$.password') AS pwd FROM records"""

_MISSING = ("list_transform(list_filter(['name', 'provider'], lambda x: NOT list_contains(keys, x)), "
            "lambda x: 'missing:' || x)")
_UNEXPECTED = (f"list_transform(list_filter(keys, lambda x: NOT list_contains({_ALLOWED}, x)), "
               "lambda x: 'unexpected:' || x)")
_ENUM = "CASE WHEN prov IS NOT NULL AND prov NOT IN ('rar', 'tar', 'zip') THEN ['enum:provider'] ELSE [] END"
_TYPE_C = ("CASE WHEN comp IS NOT NULL AND NOT (comp IN ('gz', 'xz', 'bz2') OR regexp_matches(comp, '^[+-]?[0-9]+$')) "
           "THEN ['type:compress'] ELSE [] END")
_TYPE_R = "CASE WHEN rec IS NOT NULL AND NOT regexp_matches(rec, '^[+-]?[0-9]+$') THEN ['type:recovery'] ELSE [] END"
_RANGE_C = "CASE WHEN try_cast(comp AS BIGINT) NOT BETWEEN 0 AND 5 THEN ['range:compress'] ELSE [] END"
_RANGE_R = "CASE WHEN try_cast(rec AS BIGINT) NOT BETWEEN 0 AND 1000 THEN ['range:recovery'] ELSE [] END"
_EMPTY_P = "CASE WHEN pwd = '' THEN ['empty:password'] ELSE [] END"


def _k_sql(select: str) -> str:
    return B.with_views(select, records=B.RECORDS_SQL, rf=_RECORD_FIELDS)


def record_maps(spark, d):
    return B.records(spark, d).select("id", K.as_map("js").alias("m"))


def _joined(arr):
    return F.array_join(F.array_sort(arr), ";")


@query("k1_require_fields", _k_sql(f"SELECT id, array_to_string(list_sort({_MISSING}), ';') AS missing FROM rf"))
def k1(spark, d):
    return record_maps(spark, d).select("id", _joined(K.require_fields("m", K.ARCHIVE_PROFILE.required)).alias("missing"))


@query("k2_forbid_unexpected", _k_sql(
    f"SELECT id, array_to_string(list_sort({_UNEXPECTED}), ';') AS unexpected FROM rf"))
def k2(spark, d):
    allowed = K.ARCHIVE_PROFILE.required + K.ARCHIVE_PROFILE.optional
    return record_maps(spark, d).select("id", _joined(K.forbid_unexpected("m", allowed)).alias("unexpected"))


@query("k3_enum_rule", _k_sql(f"SELECT id, len({_ENUM}) > 0 AS enum_bad FROM rf"))
def k3(spark, d):
    return record_maps(spark, d).select("id", (F.size(K.enum_rule("m", "provider", ["rar", "tar", "zip"])) > 0)
                                        .alias("enum_bad"))


@query("k4_typed_rule", _k_sql(f"SELECT id, len({_TYPE_C}) > 0 AS type_bad FROM rf"))
def k4(spark, d):
    return record_maps(spark, d).select(
        "id", (F.size(K.typed_rule("m", "compress", "enum|int", ["gz", "xz", "bz2"])) > 0).alias("type_bad"))


@query("k5_range_rule", _k_sql(f"SELECT id, comp, len({_RANGE_C}) > 0 AS range_bad FROM rf"))
def k5(spark, d):
    m = F.col("m")
    return record_maps(spark, d).select("id", F.try_element_at(m, F.lit("compress")).alias("comp"),
                                        (F.size(K.range_rule("m", "compress", 0, 5)) > 0).alias("range_bad"))


@query("k6_nested_rule", B.with_views("""
SELECT cfg_id, CASE WHEN len(list_filter(dirs, lambda x: x IS NULL OR length(x) = 0)) > 0
                    THEN 'nested-item:' || grp ELSE '' END AS problems
FROM g""", g=B.DIR_GROUPS_SQL))
def k6(spark, d):
    return dir_groups(spark, d).select("cfg_id", _joined(K.nested_rule("groups")).alias("problems"))


@query("k7_split_valid", _k_sql(f"""
SELECT id, len(r) = 0 AS valid, array_to_string(r, ';') AS reasons
FROM (SELECT id, list_sort({_MISSING} || {_UNEXPECTED} || {_ENUM} || {_TYPE_C} || {_TYPE_R} || {_RANGE_C}
                           || {_RANGE_R} || {_EMPTY_P}) AS r FROM rf) t"""))
def k7(spark, d):
    tagged = K.tag_valid(B.records(spark, d), "js", K.ARCHIVE_PROFILE)
    return tagged.select("id", (F.size("reasons") == 0).alias("valid"), F.array_join("reasons", ";").alias("reasons"))


# --------------------------------------------------------------------------------------------
# Operation log lines
# --------------------------------------------------------------------------------------------

_LEVEL_OF_KIND_SQL = ("CASE kind WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'purchase' THEN 'CRITICAL' "
                      "WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END")


def log_lines(spark, d):
    st = B.steps(spark, d)
    level = (F.when(F.col("kind") == "error", "ERROR").when(F.col("kind") == "signup", "WARNING")
             .when(F.col("kind") == "purchase", "CRITICAL").when(F.col("kind") == "view", "DEBUG").otherwise("INFO"))
    msg = F.concat(F.col("kind"), F.lit(" by "), F.col("run_id").cast("string"))
    return st.select(F.col("seq").alias("line_id"), "kind", format_log_line("ts", level, msg).alias("value"))


_OPLOG_SQL = f"""
SELECT seq AS line_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || lpad(CAST((epoch_us(ts) % 1000000) // 1000 AS VARCHAR), 3, '0') AS ts_text,
       {_LEVEL_OF_KIND_SQL} AS level, kind || ' by ' || CAST(run_id AS VARCHAR) AS message
FROM steps"""


# Steps that failed are logged with a second line, which has no header of its own.
@query("a2_read_oplog", B.with_views("""
SELECT ts_text, level, message FROM lg
UNION ALL
SELECT ts_text, level, '  step ' || CAST(line_id AS VARCHAR) FROM lg WHERE level = 'ERROR'""", steps=B.STEPS_SQL, lg=_OPLOG_SQL))
def a2(spark, d):
    path = scratch_path(spark, "oplog")
    more = F.when(F.col("kind") == "error", F.concat(F.lit("\n  step "), F.col("line_id").cast("string"))).otherwise(F.lit(""))
    log_lines(spark, d).select(F.concat("value", more).alias("value")).write.text(path)
    return read_oplog(spark, path).select(F.date_format("ts", ASCTIME_PATTERN).alias("ts_text"), "level", "message")


@query("c6_min_level", B.with_views(
    "SELECT * FROM lg WHERE level IN ('WARNING', 'ERROR', 'CRITICAL')", steps=B.STEPS_SQL, lg=_OPLOG_SQL))
def c6(spark, d):
    p = parse_oplog(log_lines(spark, d), keep=["line_id"])
    return min_level(p, "WARNING").select("line_id", "ts_text", "level", "message")


# --------------------------------------------------------------------------------------------
# Notification payloads
# --------------------------------------------------------------------------------------------

PAYLOAD_TS = "2026-01-01T00:00:00+00:00"

_DETAIL_LINES_SQL = f"""
SELECT run_id, printf('%02d', row_number() OVER (PARTITION BY run_id ORDER BY directory, size, completed, started) - 1)
       || '. ' || CASE WHEN success THEN '{sym("success")}' ELSE '{sym("failure")}' END || ' {sym("directory")} ' || directory AS line,
       row_number() OVER (PARTITION BY run_id ORDER BY directory, size, completed, started) AS rn
FROM facts"""

_RUNS_SQL = """
SELECT run_id, coalesce(bool_or(success), false) AS ok, min(started) AS st, max(completed) AS en
FROM facts GROUP BY run_id"""


@query("j2_run_payload", with_facts(f"""
SELECT r.run_id, to_json({{'embeds': [{{
   'title': CASE WHEN ok THEN '{sym("success")}' ELSE '{sym("failure")}' END || ' Backup',
   'color': CASE WHEN ok THEN 65280 ELSE 16711680 END,
   'timestamp': '{PAYLOAD_TS}',
   'fields': [{{'name': '{sym("duration")} Elapsed', 'value': {sql_fmt_duration('epoch_us(en) - epoch_us(st)')}, 'inline': true}},
              {{'name': '{sym("time")} Started', 'value': strftime(st, '%Y-%m-%d %H:%M:%S'), 'inline': true}},
              {{'name': '{sym("time")} Completed', 'value': strftime(en, '%Y-%m-%d %H:%M:%S'), 'inline': true}},
              {{'name': '{sym("backup")} Backups', 'value': l.txt, 'inline': false}}]}}]}}) AS payload
FROM runs r JOIN (SELECT run_id, string_agg(line, chr(10) ORDER BY rn) AS txt FROM lines GROUP BY run_id) l
  ON r.run_id = l.run_id""", lines=_DETAIL_LINES_SQL, runs=_RUNS_SQL))
def j2(spark, d):
    return notify_payloads(entry_facts(spark, d), timestamp=PAYLOAD_TS).select("run_id", "payload")


@query("a7_notify_payloads", with_facts(f"""
SELECT run_id, to_json({{'title': CASE WHEN ok THEN '{sym("success")}' ELSE '{sym("failure")}' END || ' Backup',
                         'color': CASE WHEN ok THEN 65280 ELSE 16711680 END}}) AS payload FROM runs""",
    runs=_RUNS_SQL))
def a7(spark, d):
    from opslog.plans.report import run_outcomes, title_payload
    return title_payload(run_outcomes(entry_facts(spark, d)))


@query("j3_details_by_kind", with_facts(f"""
SELECT run_id, 'backup' AS kind, line FROM lines
UNION ALL
SELECT run_id, 'upload',
       printf('%02d', row_number() OVER (PARTITION BY run_id ORDER BY key, size) - 1) || '. '
       || CASE WHEN u_success THEN '{sym("success")}' ELSE '{sym("failure")}' END || ' {sym("archive")} ' || key
FROM (SELECT run_id, size, grp || '/' || {sql_base_name('directory')} || '/' || {sql_base_name('archive')} AS key,
             size % 7 <> 0 AS u_success FROM facts WHERE success) u""", lines=_DETAIL_LINES_SQL))
def j3(spark, d):
    f = entry_facts(spark, d)
    backups = f.select("run_id", F.lit("backup").alias("kind"), "success", "directory", "size", "completed",
                       "started", F.col("directory").alias("subject"))
    ups = where_success(f).select(
        "run_id", F.lit("upload").alias("kind"), (F.col("size") % 7 != 0).alias("success"),
        upload_key("grp", "directory", "archive").alias("subject"), "size")
    acts = backups.unionByName(ups, allowMissingColumns=True)
    return details_by_kind(acts).select("run_id", "kind", "line")


# --------------------------------------------------------------------------------------------
# --------------------------------------------------------------------------------------------

DEPLOY_SELECTORS = ["th*", "*an", "blog.*"]


@query("deploy_services", B.with_views("""
SELECT r.name, r.kind, r.directory, coalesce(e.env, '') AS env
FROM r LEFT JOIN (SELECT name, string_agg(k || '=' || v, ',' ORDER BY k) AS env
                  FROM (SELECT name, k, max_by(v, ord) AS v
                        FROM (SELECT DISTINCT name FROM r) n JOIN overlays ON n.name GLOB pattern
                        GROUP BY name, k) x GROUP BY name) e ON r.name = e.name
""", paths=B.PATHS_SQL, overlays=B.OVERLAYS_SQL, m="""
SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory FROM paths
WHERE regexp_extract(path, '[^/]*$') IN ('compose.yml', 'compose.yaml', 'docker-compose.yml', 'docker-compose.yaml')
  AND contains(path, '/')""", r="""
SELECT * FROM (SELECT regexp_extract(directory, '[^/]*$') AS name, 'docker-compose' AS kind, directory FROM m
               WHERE NOT EXISTS (SELECT 1 FROM m m2 WHERE starts_with(m.directory, m2.directory || '/'))) t
WHERE """ + " OR ".join(f"name GLOB '{p}'" for p in DEPLOY_SELECTORS)))
def deploy(spark, d):
    from opslog.plans.flows import deploy_services
    out = deploy_services(B.paths(spark, d), DEPLOY_SELECTORS, B.overlays(spark))
    return out.select("name", "kind", "directory", env_text("env").alias("env"))


# --------------------------------------------------------------------------------------------
# --------------------------------------------------------------------------------------------

def _report_oracle() -> str:
    from opslog.plans.facts import ARCHIVE_DEST, sql_fmt_size, sql_fmt_speed
    from opslog.plans.report import FAILED_TAIL, FAILED_TITLE, OK_TAIL, OK_TITLE

    def num(rn, n):
        return f"(CASE WHEN {n} < 10 THEN CAST({rn} AS VARCHAR) ELSE printf('%02d', {rn}) END) || '. '"
    ok = f"""SELECT run_id, size, substr(replace(archive, '{ARCHIVE_DEST}', ''), 2) AS name,
               {sql_fmt_size('size')} AS size_text, {sql_fmt_duration('elapsed_us')} AS elapsed_text,
               {sql_fmt_speed('speed')} AS speed_text FROM facts WHERE success"""
    okw = """SELECT *, max(length(name)) OVER w AS wn, max(length(size_text)) OVER w AS ws,
               max(length(elapsed_text)) OVER w AS wd, max(length(speed_text)) OVER w AS wv,
               row_number() OVER (PARTITION BY run_id ORDER BY name, size_text, elapsed_text, speed_text) AS rn,
               count(*) OVER w AS n
             FROM ok WINDOW w AS (PARTITION BY run_id)"""
    bad = f"""SELECT run_id, '{sym("directory")} ' || directory AS entry FROM facts WHERE NOT success"""
    sel = f"""
SELECT run_id, 0 AS section_no, 0 AS line_no,
       '{sym("success")} {OK_TITLE} [ {sym("size")} ' || {sql_fmt_size('total')} || ' ]{OK_TAIL}' AS text
FROM (SELECT run_id, CAST(sum(size) AS BIGINT) AS total FROM ok GROUP BY run_id) t
UNION ALL
SELECT run_id, 1, CAST(rn - 1 AS INTEGER),
       '    ' || {num('rn', 'n')} || '{sym("archive")} ' || name || repeat(' ', wn - length(name))
       || ' [ {sym("size")} ' || repeat(' ', ws - length(size_text)) || size_text
       || ' | {sym("duration")} ' || repeat(' ', wd - length(elapsed_text)) || elapsed_text
       || ' | {sym("speed")} ' || repeat(' ', wv - length(speed_text)) || speed_text || ' ]'
FROM okw
UNION ALL
SELECT DISTINCT run_id, 2, 0, '{sym("failure")} {FAILED_TITLE}{FAILED_TAIL}' FROM bad
UNION ALL
SELECT run_id, 3, CAST(rn - 1 AS INTEGER), '    ' || {num('rn', 'n')} || entry
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY entry) AS rn,
             count(*) OVER (PARTITION BY run_id) AS n FROM bad) b"""
    return with_facts(sel, ok=ok, okw=okw, bad=bad)


@query("backup_report", _report_oracle())
def backup_report_q(spark, d):
    from opslog.plans.facts import ARCHIVE_DEST
    from opslog.plans.report import backup_report
    return backup_report(entry_facts(spark, d), ARCHIVE_DEST)


# --------------------------------------------------------------------------------------------
# --------------------------------------------------------------------------------------------

BACKUP_SELECTORS = ["1-*", "3-*"]
RUN_TS = "2026-01-01 12:34:00"


def _backup_targets_oracle() -> str:
    from opslog.plans.catalog_core import HOME
    from opslog.plans.facts import ARCHIVE_DEST
    name = sql_base_name("directory")
    return B.with_views(f"""
SELECT cfg_id, grp, pos, directory, archive,
       grp || '/' || {name} || '/' || regexp_extract(archive, '[^/]*$') AS key
FROM (SELECT *, base || CASE WHEN slot = 0 THEN '' ELSE '_' || printf('%02d', slot) END || '.rar' AS archive
      FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY cfg_id, pos) - 1 AS slot
            FROM (SELECT *, '{ARCHIVE_DEST}/' || grp || '/' || {name} || '/' || {name} || '_2026-01-01_1234' AS base
                  FROM d) b) c) e""", g=B.DIR_GROUPS_SQL, d=f"""
SELECT cfg_id, grp, CAST(u.i - 1 AS INTEGER) AS pos,
       CASE WHEN u.x = '~' OR starts_with(u.x, '~/') THEN '{HOME}' || substr(u.x, 2) ELSE u.x END AS directory
FROM g, unnest(dirs) WITH ORDINALITY AS u(x, i)
WHERE u.x <> '' AND ({' OR '.join(f"grp GLOB '{p}'" for p in BACKUP_SELECTORS)})""")


@query("backup_targets", _backup_targets_oracle())
def backup_targets_q(spark, d):
    from opslog.plans.catalog_core import HOME
    from opslog.plans.facts import ARCHIVE_DEST
    from opslog.plans.flows import backup_targets
    return backup_targets(dir_groups(spark, d), BACKUP_SELECTORS, ARCHIVE_DEST, HOME, RUN_TS)
