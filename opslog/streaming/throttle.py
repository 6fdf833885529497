"""Streaming progress throttle and notifications (operators L1-L3).

L1 keeps, per uploaded file, the bytes seen so far and the last reported
percentage in Structured Streaming state (``applyInPandasWithState``), and
emits a progress row whenever the throttle rule fires (the batch form is G6).
Chunks of one file must arrive in ``seq`` order across micro-batches (as the
upload callback delivers them); inside a micro-batch they are sorted.

L2 appends every emitted row to a sink partitioned by file; L3 keeps the
outcome of each run as aggregation state and hands the payloads of changed
runs to several sinks with ``foreachBatch``, writing per batch id so a
replayed batch overwrites itself instead of duplicating.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from opslog.operators.sequence import THROTTLE_STEP
from opslog.session import checkpoint_path

EMIT_SCHEMA = "file long, seq long, ts timestamp_ntz, uploaded long, pct int"
STATE_SCHEMA = "uploaded long, last int"


def _throttle_group(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    uploaded, last = (state.get if state.exists else (0, 0))
    # one file's chunks of this micro-batch, put in arrival order
    batch = pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="stable")
    seqs = batch["seq"].to_numpy()
    sizes = batch["filesize"].to_numpy(dtype=np.float64)
    running = uploaded + np.cumsum(batch["bytes"].to_numpy(dtype=np.int64))
    part = np.divide(running, sizes, out=np.ones(len(sizes)), where=sizes != 0) * 100  # an empty file is all there
    pct = np.minimum(part, 100).astype(np.int64)
    keep = []
    for i, p in enumerate(pct):
        if p >= last + THROTTLE_STEP or (p == 100 and last != 100):
            last = int(p)
            keep.append(i)
    state.update((int(running[-1]) if len(running) else uploaded, int(last)))
    if keep:
        out = pd.DataFrame({
            "file": np.full(len(keep), key[0], dtype=np.int64),
            "seq": seqs[keep].astype(np.int64),
            "ts": batch["ts"].to_numpy()[keep],
            "uploaded": running[keep].astype(np.int64),
            "pct": pct[keep].astype(np.int32),
        })
        yield out


def stream_throttle(chunks: DataFrame, file: str = "file") -> DataFrame:
    """L1: throttled progress rows from a stream of ``(file, seq, ts, bytes, filesize)`` chunks."""
    return chunks.groupBy(file).applyInPandasWithState(
        _throttle_group, EMIT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table (a file or a folder of part files) as a stream.

    A pattern that only the table's own name matches: the file source takes a
    plain path for a folder, while a pattern may match a file as well.
    """
    schema = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
    return spark.readStream.schema(schema).parquet(os.path.join(sf_dir, f"{name}.parque[t]"))


def chunk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``chunks`` binding as a stream: event rows joined to per-file sizes (stream-static join).

    All part files that are there are one micro-batch: chunks of an upload may be spread over them in any order.
    """
    ev = table_stream(spark, sf_dir, "events")
    chunks = ev.select(F.col("user_id").alias("file"), F.col("event_id").alias("seq"), "ts",
                       F.round(F.col("value") * 100).cast("bigint").alias("bytes"))
    sizes = (spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
             .groupBy(F.col("user_id").alias("file"))
             .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("bigint").alias("filesize")))
    return chunks.join(sizes, "file")


def run_to_sink(stream_df: DataFrame, sink_dir: str, ckpt: str, partition_by: str | None = None,
                fmt: str = "parquet") -> None:
    """Run a stream over everything available now into an append sink, then stop."""
    w = stream_df.writeStream.format(fmt).option("path", sink_dir).option("checkpointLocation", ckpt)
    if partition_by:
        w = w.partitionBy(partition_by)
    q = w.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


FILE_BUCKETS = 256


def stream_progress_log(spark: SparkSession, sf_dir: str, run_name: str,
                        partition_by: str | None = "file_bucket") -> DataFrame:
    """L1 + L2: throttle the chunk stream and append the emitted rows.

    With ``partition_by="file_bucket"`` rows land in one of ``FILE_BUCKETS``
    folders by hashed file id, so a file's progress log is found by pruning
    while the folder count stays fixed however many files are uploaded.
    """
    base = checkpoint_path(spark, run_name)
    emitted = stream_throttle(chunk_stream(spark, sf_dir))
    if partition_by == "file_bucket":
        emitted = emitted.withColumn("file_bucket", F.pmod(F.xxhash64("file"), F.lit(FILE_BUCKETS)))
    run_to_sink(emitted, os.path.join(base, "out"), os.path.join(base, "ckpt"), partition_by=partition_by)
    return spark.read.schema(EMIT_SCHEMA).parquet(os.path.join(base, "out"))


def stream_consume(stream_df: DataFrame, consumers: list, ckpt: str, prepare=None, mode: str = "append") -> None:
    """Hand each micro-batch, prepared once, to every consumer as ``consumer(rows, batch_id)`` (M3).

    ``stream_df`` may be the emitted progress of L1 or a streaming aggregate
    (``mode="update"``: each batch holds the groups that changed).
    """

    def each_batch(batch: DataFrame, batch_id: int):
        rows = (prepare(batch) if prepare else batch).persist()
        try:
            for consumer in consumers:
                consumer(rows, batch_id)
        finally:
            rows.unpersist()

    q = (stream_df.writeStream.outputMode(mode).foreachBatch(each_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_notify(runs: DataFrame, to_payloads, sinks: list, ckpt: str) -> None:
    """L3: payloads of the runs that a micro-batch changed, handed to every sink with the batch id.

    ``runs`` is a streaming aggregate with one row per run, so a run whose
    entries arrive in several batches keeps its outcome as state, and its later
    payload replaces the earlier one (``latest_payloads``).
    """
    stream_consume(runs, sinks, ckpt, to_payloads, "update")


def latest_payloads(spark: SparkSession, dest: str, schema: str = "run_id long, payload string", key: str = "run_id") -> DataFrame:
    """The payload of each run in its last batch, from a folder written by ``batch_dir_sink``."""
    sent = spark.read.schema(schema + ", batch_id long").json(dest)
    return sent.groupBy(key).agg(F.max_by("payload", "batch_id").alias("payload"))


def batch_dir_sink(dest: str, fmt: str = "json"):
    """A sink writing each batch to ``dest/batch_id=<n>`` (overwrite: replays are idempotent)."""
    def sink(df: DataFrame, batch_id: int):
        df.write.mode("overwrite").format(fmt).save(os.path.join(dest, f"batch_id={batch_id}"))
    return sink
