"""Registered query of notifications over all kinds of actions (J2) and its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.functions.fmt import sym
from opslog.functions.paths import upload_key
from opslog.plans.facts import entry_facts, sql_base_name, sql_fmt_duration, with_facts
from opslog.plans.registry import query
from opslog.plans.report import action_payloads

WRITTEN = "2026-01-01T12:34:00+00:00"
ARRIVAL = ["completed", "subject", "size", "success"]

_ENTRIES = f"""
SELECT run_id, 0 AS action_no, 'backup' AS kind, '{sym("directory")}' AS symbol, directory AS subject, success, started, completed, size FROM facts
UNION ALL SELECT run_id, 1, 'upload', '{sym("archive")}', grp || '/' || {sql_base_name('directory')} || '/' || {sql_base_name('archive')},
                 size % 7 <> 0, started, completed, size FROM facts WHERE success
UNION ALL SELECT run_id, 2, 'deploy', '{sym("docker")}', grp, success, started, completed, size FROM facts WHERE size % 2048 = 0"""
_LINES = f"""
SELECT *, printf('%02d', row_number() OVER (PARTITION BY run_id, action_no ORDER BY completed, subject, size, success) - 1) || '. '
          || CASE WHEN success THEN '{sym("success")}' ELSE '{sym("failure")}' END || ' ' || symbol || ' ' || subject AS line,
       row_number() OVER (PARTITION BY run_id, action_no ORDER BY completed, subject, size, success) AS rn FROM told"""
_ACTIONS = """
SELECT run_id, action_no, kind, CASE WHEN kind = 'deploy' THEN bool_and(success) ELSE bool_or(success) END AS ok, min(started) AS st, max(completed) AS en,
       string_agg(line, chr(10) ORDER BY rn) AS txt FROM lines GROUP BY run_id, action_no, kind"""
_RUNS = f"""
SELECT run_id, bool_and(ok) AS ok, min(st) AS st, max(en) AS en,
       list({{'name': CASE kind WHEN 'backup' THEN '{sym("backup")} Backups' WHEN 'upload' THEN '{sym("upload")} Uploads' ELSE '{sym("service")} Services' END,
             'value': txt, 'inline': false}} ORDER BY action_no) AS told FROM actions GROUP BY run_id"""


@query("j2_action_payloads", with_facts(f"""
SELECT run_id, to_json({{'embeds': [{{
   'title': CASE WHEN ok THEN '{sym("success")}' ELSE '{sym("failure")}' END || CASE WHEN run_id % 2 = 0 THEN ' Backup' ELSE ' Up' END,
   'color': CASE WHEN ok THEN 65280 ELSE 16711680 END, 'timestamp': '{WRITTEN}',
   'fields': list_concat([{{'name': '{sym("duration")} Elapsed', 'value': {sql_fmt_duration('epoch_us(en) - epoch_us(st)')}, 'inline': true}},
                          {{'name': '{sym("time")} Started', 'value': strftime(st, '%Y-%m-%d %H:%M:%S'), 'inline': true}},
                          {{'name': '{sym("time")} Completed', 'value': strftime(en, '%Y-%m-%d %H:%M:%S'), 'inline': true}}], told)}}]}}) AS payload
FROM runs_told""", told=_ENTRIES, lines=_LINES, actions=_ACTIONS, runs_told=_RUNS))
def j2_actions(spark, d):
    f = entry_facts(spark, d)

    def told(df, number, kind, symbol, subject, success):
        return df.select("run_id", F.lit(number).alias("action_no"), F.lit(kind).alias("kind"), F.lit(symbol).alias("symbol"), subject.alias("subject"),
                         success.alias("success"), "started", "completed", "size")
    entries = (told(f, 0, "backup", "directory", F.col("directory"), F.col("success"))
               .unionByName(told(f.where("success"), 1, "upload", "archive", upload_key("grp", "directory", "archive"), F.col("size") % 7 != 0))
               .unionByName(told(f.where("size % 2048 = 0"), 2, "deploy", "docker", F.col("grp"), F.col("success"))))
    commands = f.select("run_id").distinct().withColumn("command", F.when(F.col("run_id") % 2 == 0, F.lit("Backup")).otherwise(F.lit("Up")))
    return action_payloads(entries, commands, ARRIVAL, WRITTEN)
