"""Streams that wait for what is missing (operators L1-L3).

* ``throttle_any_order`` (L1): chunks of an upload may arrive in any order and
  in any micro-batch.  They are held as list state, appended batch by batch,
  until the bytes that arrived make up the file; then the throttle rule runs
  over them in order, once.  Files share state by buckets, so that a
  micro-batch costs calls by the bucket and not by the file.  With ``wait``, an upload that stays incomplete is
  closed by a timer when the watermark has passed its last chunk by that long.
* ``attach_progress`` (L2): every emitted row meets its upload entry in a
  stream-stream join bounded by watermarks on both sides.
* ``completed_runs`` (L3): a run's outcome as aggregation state, handed on in
  the micro-batch that brings the last of its entries and in no other.

State is kept by RocksDB for L1 (``started_with_rocksdb``), on the executors'
disks and in the checkpoint, so held chunks do not live on the heap.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from opslog.operators import measures as M
from opslog.operators import rollup as R
from opslog.operators.sequence import THROTTLE_STEP
from opslog.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextlib.contextmanager
def started_with_rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own choice holds again afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _micros(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), ts)


def _time(micros) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))


def throttled(seq: np.ndarray, nbytes: np.ndarray, filesize: int, step: int = THROTTLE_STEP) -> list[tuple[int, int, int]]:
    """(place, uploaded, pct) of the chunks at which a throttled reporter speaks; chunks in any order.

    Percentages only grow, so a value can be spoken at its first chunk alone: at most 101 of them are looked at.
    """
    order = np.argsort(seq, kind="stable")
    running = np.cumsum(nbytes[order])
    part = np.ones(len(order)) if filesize == 0 else running / np.float64(filesize)  # an empty file is all there
    pct = np.minimum(part * 100, 100).astype(np.int64)
    last, out = 0, []
    for at in np.unique(pct, return_index=True)[1].tolist():
        p = int(pct[at])
        if p >= last + step or (p == 100 and last != 100):
            last = p
            out.append((int(order[at]), int(running[at]), p))
    return out


BUCKETS = 1 << 13  # of files; the calls to Python of one micro-batch are at most as many
PART = 10_000  # held chunks of one entry that is written anew
ABSENT = -(1 << 63)  # a missing seq, time or size in a packed row; sorts first
HELD = np.dtype([("file", "i8"), ("seq", "i8"), ("us", "i8"), ("bytes", "i8")])
OPEN = np.dtype([("file", "i8"), ("arrived", "i8"), ("filesize", "i8"), ("latest", "i8")])


def counted(uploads: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The OPEN rows, one per file in order of files, after the HELD ``rows`` of files of ``sizes``."""
    files, at = np.unique(np.concatenate([uploads["file"], rows["file"]]), return_inverse=True)
    out = np.zeros(len(files), OPEN)
    out["file"], out["filesize"], out["latest"] = files, ABSENT, ABSENT
    out[at[:len(uploads)]] = uploads
    at = at[len(uploads):]
    np.add.at(out["arrived"], at, rows["bytes"])
    np.maximum.at(out["latest"], at, rows["us"])
    known = sizes != ABSENT
    first = np.unique(at[known], return_index=True)
    out["filesize"][first[0]] = sizes[known][first[1]]
    return out


class HeldUploads(StatefulProcessor):
    """Holds the chunks of a bucket of files, those of each file until all its bytes are there.

    Rows are kept packed: one list entry per part of a micro-batch, so a call costs a few state requests however many files
    the bucket has.  Chunks of closed files stay in their entries until they are more than those still waited for.
    """

    def __init__(self, wait_ms: int | None):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "part binary")
        self.uploads = handle.getValueState("uploads", "part binary, held long")  # open files, entries' chunks
        self.closed = handle.getListState("closed", "part binary")  # files, as they were closed

    @staticmethod
    def unpacked(state, kind: np.dtype) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(part) for part, in state.get()), kind)

    def open_uploads(self) -> tuple[np.ndarray, int]:
        part, held = self.uploads.get() or (b"", 0)
        return np.frombuffer(bytes(part), OPEN), held

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        uploads, held = self.open_uploads()
        closed, seen = None, []
        for part in rows:  # a part at a time; the group is never one table
            new = np.empty(len(part), HELD)
            for name in HELD.names:
                new[name] = part[name].to_numpy()
            sizes = part["filesize"].to_numpy()
            if not np.isin(new["file"], uploads["file"]).all():
                closed = self.unpacked(self.closed, np.dtype("i8")) if closed is None else closed
                fresh = ~np.isin(new["file"], closed)  # chunks of a closed file say nothing new
                new, sizes = new[fresh], sizes[fresh]
            if len(new):
                self.chunks.appendValue((new.tobytes(),))
                uploads, held = counted(uploads, new, sizes), held + len(new)
                seen.append(new["file"])
        if not seen:
            return
        complete = (uploads["filesize"] != ABSENT) & (uploads["arrived"] >= uploads["filesize"])
        if self.wait_ms is not None:
            waits = uploads[~complete & np.isin(uploads["file"], np.concatenate(seen)) & (uploads["latest"] != ABSENT)]
            for expiry in np.unique(waits["latest"] // 1000 + self.wait_ms).tolist():
                self.handle.registerTimer(expiry)
        yield from self.close_uploads(key, uploads, held, complete)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        uploads, held = self.open_uploads()
        # a timer of an earlier batch closes no file of which a later chunk has set another one
        over = (uploads["latest"] != ABSENT) & (uploads["latest"] // 1000 + self.wait_ms <= expiredTimerInfo.getExpiryTimeInMs())
        if over.any():
            yield from self.close_uploads(key, uploads, held, over)

    def close_uploads(self, key, uploads: np.ndarray, held: int, over: np.ndarray) -> Iterator[pd.DataFrame]:
        """Gives the rows of the files that are ``over`` and keeps the state of the others."""
        out, rest = [], uploads[~over]
        if over.any():
            chunks = self.unpacked(self.chunks, HELD)
            chunks = chunks[np.argsort(chunks["file"], kind="stable")]  # each file's as they arrived
            ends = zip(*(np.searchsorted(chunks["file"], uploads["file"][over], side).tolist() for side in ("left", "right")))
            for upload, (a, b) in zip(uploads[over], ends):
                if upload["filesize"] != ABSENT:
                    mine = chunks[a:b]
                    out += [(int(upload["file"]), int(mine["seq"][at]), int(mine["us"][at]), uploaded, pct)
                            for at, uploaded, pct in throttled(mine["seq"], mine["bytes"], int(upload["filesize"]))]
            self.closed.appendValue((uploads["file"][over].tobytes(),))
            live = chunks[np.isin(chunks["file"], rest["file"])]
            if not len(live):
                self.chunks.clear()
                held = 0
            elif 2 * len(live) < held:
                self.chunks.put([(live[at:at + PART].tobytes(),) for at in range(0, len(live), PART)])
                held = len(live)
        self.uploads.update((rest.tobytes(), held))
        if out:
            file, seq, us, uploaded, pct = zip(*out)
            yield pd.DataFrame({"file": [None] * len(out) if key[0] == BUCKETS else file, "seq": seq, "us": us, "uploaded": uploaded,
                                "pct": np.array(pct, np.int32)})

    def close(self) -> None:
        pass


def _or_absent(x: Column) -> Column:
    return F.coalesce(x.cast("long"), F.lit(ABSENT))


def _present(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(ABSENT))


def _event_time(ts) -> Column:
    """A wall-clock time as the instant that watermarks ask for."""
    return F.timestamp_micros(_micros(ts))


def throttle_any_order(chunks: DataFrame, wait: str | None = None, late: str = "1 day") -> DataFrame:
    """L1: throttled progress rows of ``(file, seq, ts, bytes, filesize)`` chunks that arrive in any order.

    A file's rows come out when all of its bytes have arrived; chunks of no bytes that come later change nothing.  With
    ``wait`` (such as "2 days") an upload that stays incomplete gives the rows of what arrived once the watermark, which
    lags ``late`` behind the newest chunk, is that far past its last chunk.  A file without a known size gives none.
    """
    wait_ms = None if wait is None else int(pd.Timedelta(wait).total_seconds() * 1000)
    known = F.col("file").isNotNull()  # files without a name are one, in a bucket of its own
    held = chunks.select(F.when(known, F.pmod(F.xxhash64("file"), F.lit(BUCKETS))).otherwise(F.lit(BUCKETS)).cast("int").alias("bucket"),
                         F.coalesce("file", F.lit(0)).cast("long").alias("file"), _or_absent(F.col("seq")).alias("seq"),
                         _or_absent(_micros(F.col("ts"))).alias("us"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
                         _or_absent(F.col("filesize")).alias("filesize"))
    if wait:
        held = held.withColumn("at", F.timestamp_micros(_present("us"))).withWatermark("at", late)
    out = held.groupBy("bucket").transformWithStateInPandas(
        HeldUploads(wait_ms), "file long, seq long, us long, uploaded long, pct int", "Append", "EventTime" if wait else "None")
    return out.select("file", _present("seq").alias("seq"), _time(_present("us")).alias("ts"), "uploaded", "pct")


def attach_progress(emitted: DataFrame, uploads: DataFrame, longest: str, late: str) -> DataFrame:
    """L2: emitted rows (file, seq, ts, uploaded, pct) with their upload entry (file, key, started): a stream-stream join.

    A row belongs to the entry of its file that began at most ``longest`` before it; state older than that and ``late``
    (how far either stream may lag) is dropped.  Adds elapsed time and speed since the upload began (G7).
    """
    p = emitted.withColumn("_at", _event_time(F.col("ts"))).withWatermark("_at", late)
    u = uploads.select(F.col("file").alias("_file"), "key", "started", _event_time(F.col("started")).alias("_begun")).withWatermark("_begun", late)
    joined = p.join(u, F.expr(f"file = _file AND _at >= _begun AND _at <= _begun + INTERVAL {longest}"))
    el = M.elapsed_us("started", "ts", mode="upload")
    return joined.select("file", "key", "seq", "ts", "started", "uploaded", "pct", el.alias("elapsed_us")) \
                 .withColumn("speed", M.speed_bps("uploaded", "elapsed_us", F.lit(True)))


def completed_runs(entries: DataFrame, run_key: str = "run_id", wait: str | None = None) -> DataFrame:
    """L3: outcome of each run in the micro-batch in which it is complete; for ``update`` mode.

    ``entries`` carry ``expected``, the number of entries of their run.  A run is handed on when as many have arrived,
    so never twice and never unfinished.  With ``wait`` runs are also told apart by their start, and the state of runs
    that began longer than that before the newest one is dropped: theirs is then never handed on.
    """
    keys = [run_key]
    if wait is not None:
        entries = entries.withColumn("_begun", _event_time(F.col("run_started"))).withWatermark("_begun", wait)
        keys = [run_key, "_begun"]
    runs = entries.groupBy(*keys).agg(R.any_success().alias("ok"), F.min("started").alias("st"), F.max("completed").alias("en"),
                                      F.count("*").alias("_seen"), F.max("expected").alias("_expected"))
    return runs.where("_seen = _expected").drop("_seen", "_expected", "_begun")


def dealt_stream(df: DataFrame, by, name: str, batches: int = 8) -> DataFrame:
    """``df`` written once, its rows dealt at random by a hash of ``by``, and read back as a stream of ``batches`` micro-batches."""
    spark = df.sparkSession
    files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")) // batches * batches)
    path = scratch_path(spark, name)
    df.repartition(files, F.xxhash64(by)).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files // batches).parquet(path)
