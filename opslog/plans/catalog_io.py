"""Registered queries for sources, sinks and streams.

Each call writes below a fresh folder inside the shared checkpoint folder
(``spark.checkpoint.dir``) and returns what it reads back, so the check sees
what was actually written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from opslog.operators.select import where_success
from opslog.functions.paths import upload_key
from opslog.plans.catalog_seq import throttle_oracle
from opslog.plans.facts import entry_facts, with_facts
from opslog.plans.registry import ORACLES, query
from opslog.plans.report import report_lines, title_payload
from opslog.session import checkpoint_path
from opslog.sources import bindings as B
from opslog.sources.sinks import archive_shards, fan_out, publish, scan_tree, snapshot_groups, write_report
from opslog.streaming.ordered import attach_progress, completed_runs, dealt_stream, started_with_rocksdb, throttle_any_order
from opslog.streaming.throttle import EMIT_SCHEMA, batch_dir_sink, run_to_sink, stream_notify, stream_progress_log


def _fresh(spark, tag: str) -> str:
    return checkpoint_path(spark, f"{tag}-{uuid.uuid4().hex}")


@query("a1_scan_tree")
def a1(spark, d):
    return scan_tree(spark, d).select("rel_path", "length")


@query("a3_snapshot_groups", "SELECT lang, count(*) AS n_rows FROM documents GROUP BY lang")
def a3(spark, d):
    docs = B.table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    return snapshot_groups(docs, "lang", _fresh(spark, "snapshot"), fmt="json", codec="gz") \
        .select("lang", F.col("rows").alias("n_rows"))


@query("a4_archive_shards", """
SELECT lang, CAST(count(*) AS BIGINT) AS files, CAST(sum(strlen(text)) AS BIGINT) AS bytes
FROM documents GROUP BY lang""")
def a4(spark, d):
    docs = B.table(spark, d, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), "text", "lang")
    man = archive_shards(docs, "name", "text", _fresh(spark, "shards"), kind="tar", codec="gz", group_col="lang")
    return man.groupBy(F.col("group").alias("lang")).agg(F.sum("files").cast("bigint").alias("files"),
                                                         F.sum("bytes").cast("bigint").alias("bytes"))


@query("a5_publish", with_facts("""
SELECT grp, CAST(count(*) AS BIGINT) AS n_uploads, CAST(sum(size) AS BIGINT) AS bytes FROM facts WHERE success
GROUP BY grp"""))
def a5(spark, d):
    ok = where_success(entry_facts(spark, d)).select(
        "run_id", "grp", upload_key("grp", "directory", "archive").alias("key"), "size")
    back = publish(ok, _fresh(spark, "publish"), "grp")
    return back.groupBy("grp").agg(F.count(F.lit(1)).alias("n_uploads"), F.sum("size").cast("bigint").alias("bytes"))


_REPORT_SQL = ORACLES["h4_union_sections"]


@query("a6_write_report", "SELECT text FROM (" + _REPORT_SQL + ") r")
def a6(spark, d):
    dest = _fresh(spark, "report")
    write_report(report_lines(entry_facts(spark, d)), dest)
    return spark.read.text(dest).select(F.col("value").alias("text"))


@query("a8_fan_out", _REPORT_SQL)
def a8(spark, d):
    base = _fresh(spark, "fanout")
    lines = report_lines(entry_facts(spark, d))
    fan_out(lines, [lambda df: write_report(df, os.path.join(base, "txt")),
                    lambda df: df.write.mode("errorifexists").json(os.path.join(base, "json"))])
    return spark.read.schema("section_no int, line_no int, text string").json(os.path.join(base, "json"))


def _ordered_progress(spark, d, name: str) -> str:
    """L1 over the chunks, dealt at random over micro-batches; the folder of the emitted rows."""
    base = _fresh(spark, name)
    chunks = dealt_stream(B.chunks(spark, d), "seq", f"{name}-chunks")
    with started_with_rocksdb(spark):
        run_to_sink(throttle_any_order(chunks), os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return os.path.join(base, "out")


@query("l1_stream_throttle", throttle_oracle("SELECT file, seq, pct FROM emitted"))
def l1(spark, d):
    return spark.read.schema(EMIT_SCHEMA).parquet(_ordered_progress(spark, d, "l1")).select("file", "seq", "pct")


@query("l2_stream_progress_log", throttle_oracle("SELECT file, seq, uploaded, pct FROM emitted"))
def l2(spark, d):
    return stream_progress_log(spark, d, f"l2-{uuid.uuid4().hex}", partition_by="file_bucket") \
        .select("file", "seq", "uploaded", "pct")


@query("l2_upload_progress", throttle_oracle("""
SELECT e.file, concat('u/', e.file, '.rar') AS key, e.seq, e.pct, e.uploaded, greatest(epoch_us(e.ts) - epoch_us(u.st), 1000000) AS elapsed_us,
       CAST((CAST(e.uploaded AS HUGEINT) * 1000000) // greatest(epoch_us(e.ts) - epoch_us(u.st), 1000000) AS BIGINT) AS speed
FROM emitted e JOIN (SELECT file, min(ts) AS st FROM chunks GROUP BY file) u ON e.file = u.file"""))
def l2_attached(spark, d):
    uploads = B.chunks(spark, d).groupBy("file").agg(F.min("ts").alias("started")) \
        .withColumn("key", F.concat(F.lit("u/"), F.col("file").cast("string"), F.lit(".rar")))
    log = spark.readStream.schema(EMIT_SCHEMA).option("maxFilesPerTrigger", 16).parquet(_ordered_progress(spark, d, "l2-log"))
    base = _fresh(spark, "l2-attached")
    # both streams are dealt at random over the whole time range, so either may lag by all of it
    joined = attach_progress(log, dealt_stream(uploads, "file", "l2-uploads"), longest="3650 DAYS", late="3650 days")
    run_to_sink(joined, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return spark.read.schema(joined.schema).parquet(os.path.join(base, "out")) \
        .select("file", "key", "seq", "pct", "uploaded", "elapsed_us", "speed")


@query("l3_stream_notify", ORACLES["a7_notify_payloads"])
def l3(spark, d):
    base = _fresh(spark, "notify")
    facts = entry_facts(spark, d).select("run_id", "success", "started", "completed")
    counts = facts.groupBy(F.col("run_id").alias("_run")).agg(F.count("*").alias("expected"))
    dealt = dealt_stream(facts.join(counts, F.col("run_id") == F.col("_run")).drop("_run"), F.struct("run_id", "completed"), "l3-entries")
    sinks = [batch_dir_sink(os.path.join(base, "a")), batch_dir_sink(os.path.join(base, "b"))]
    stream_notify(completed_runs(dealt), title_payload, sinks, os.path.join(base, "ckpt"))
    # all that one sink ever got: a run's payload is there once
    return spark.read.schema("run_id long, payload string").json(os.path.join(base, "a")).select("run_id", "payload")
