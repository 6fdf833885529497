"""Streams over rows that are dealt at random: chunks in any order, progress with its upload, runs handed on once."""
import random
from datetime import datetime as dt, timedelta as td

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from opslog.operators import sequence as S
from opslog.session import ship_package
from opslog.plans.report import run_outcomes, title_payload
from opslog.streaming.ordered import ABSENT, HeldUploads, attach_progress, completed_runs, dealt_stream, started_with_rocksdb, throttle_any_order, throttled
from opslog.streaming.throttle import EMIT_SCHEMA, batch_dir_sink, run_to_sink, stream_notify

CHUNKS = "file long, seq long, ts timestamp_ntz, bytes long, filesize long"
T0 = dt(2024, 1, 1)


def _uploads(seed, files=12):
    rnd, rows = random.Random(seed), []
    for f in range(files):
        sizes = [rnd.choice([0, 1, 5, 40, 300]) for _ in range(rnd.randint(1, 60))]
        rows += [(f, 7 * i + f, T0 + td(seconds=60 * i + f), b, sum(sizes)) for i, b in enumerate(sizes)]
    return rows


def _write(spark, rows, schema, path, parts):
    for p in range(parts):
        spark.createDataFrame([r for i, r in enumerate(rows) if i % parts == p], schema).coalesce(1).write.mode("append").parquet(path)


def _run(spark, src, tmp_path, **options):
    stream = spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", 1).parquet(src)
    with started_with_rocksdb(spark):
        run_to_sink(throttle_any_order(stream, **options), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    return sorted(((r.file, r.seq, r.uploaded, r.pct, r.ts) for r in spark.read.schema(EMIT_SCHEMA).parquet(str(tmp_path / "out")).collect()),
                  key=lambda r: (r[0] is None, r))


def _batch(spark, rows):
    d = spark.createDataFrame(rows, CHUNKS)
    return sorted((r.file, r.seq, r.uploaded, r.pct, r.ts) for r in S.throttle_progress(S.cumulative_pct(d)).collect())


def test_chunks_in_any_order_with_a_restart(spark, tmp_path):
    ship_package(spark)
    rows = _uploads(1)
    random.Random(2).shuffle(rows)
    src, cut = str(tmp_path / "src"), len(rows) * 5 // 8
    _write(spark, rows[:cut], CHUNKS, src, 5)
    first = _run(spark, src, tmp_path)
    want = _batch(spark, rows)
    assert set(first) < set(want)  # only complete files speak, and none that lacks a chunk
    _write(spark, rows[cut:], CHUNKS, src, 3)
    assert _run(spark, src, tmp_path) == want
    _write(spark, [(0, 10**6, T0, 0, rows[0][4])], CHUNKS, src, 1)  # an empty chunk after the end
    assert _run(spark, src, tmp_path) == want


def test_odd_uploads(spark, tmp_path):
    ship_package(spark)
    rows = [(1, 0, T0, 0, 0), (2, 0, T0, None, 10), (2, 1, T0, 10, 10), (3, 0, T0, 5, None), (4, 1, T0, 30, 20), (None, 0, T0, 4, 4)]
    _write(spark, rows, CHUNKS, str(tmp_path / "src"), 2)
    got = _run(spark, str(tmp_path / "src"), tmp_path)
    assert [(f, s, u, p) for f, s, u, p, _ in got] == [(1, 0, 0, 100), (2, 1, 10, 100), (4, 1, 30, 100), (None, 0, 4, 100)]


def test_an_abandoned_upload_is_closed_by_its_timer(spark, tmp_path):
    ship_package(spark)
    src = str(tmp_path / "src")
    rows = [(1, i, T0 + td(minutes=i), 30, 100) for i in (2, 0)] + [(2, 0, T0, 50, 100)]
    spark.createDataFrame(rows, CHUNKS).coalesce(1).write.parquet(src)
    spark.createDataFrame([(2, 1, T0 + td(hours=1), 20, 100)], CHUNKS).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(9, 0, T0 + td(days=9), 1, 100)], CHUNKS).coalesce(1).write.mode("append").parquet(src)
    got = _run(spark, src, tmp_path, wait="1 day", late="1 hour")
    assert [(f, s, u, p) for f, s, u, p, _ in got] == [(1, 0, 30, 30), (1, 2, 60, 60), (2, 0, 50, 50), (2, 1, 70, 70)]


def test_progress_meets_its_upload(spark, tmp_path):
    ship_package(spark)
    rows = _batch(spark, _uploads(5))
    emitted = spark.createDataFrame([(f, s, ts, u, p) for f, s, u, p, ts in rows], EMIT_SCHEMA)
    # two uploads of file 3, the second long after; file 5 has no entry
    entries = [(f, f"k{f}", T0) for f in range(12) if f != 5] + [(3, "again", T0 + td(days=30)), (99, "silent", T0)]
    uploads = spark.createDataFrame(entries, "file long, key string, started timestamp_ntz")
    out = attach_progress(dealt_stream(emitted, "seq", "t-log"), dealt_stream(uploads, "key", "t-up"), "10 DAYS", "60 days")
    run_to_sink(out, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = sorted((r.file, r.key, r.seq, r.pct, r.elapsed_us, r.speed) for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())
    el = lambda ts: max(int((ts - T0).total_seconds() * 10**6), 10**6)
    assert got == sorted((f, f"k{f}", s, p, el(ts), u * 10**6 // el(ts)) for f, s, u, p, ts in rows if f != 5)


def test_a_run_is_handed_on_once_and_only_when_complete(spark, tmp_path):
    ship_package(spark)
    rnd, rows = random.Random(3), []
    for run in range(30):
        n = rnd.randint(1, 9)
        rows += [(run, rnd.random() < 0.4, T0 + td(days=run), T0 + td(days=run, hours=i), n + (run == 7)) for i in range(n)]  # run 7 lacks one
    schema = "run_id long, success boolean, started timestamp_ntz, completed timestamp_ntz, expected long"
    facts = spark.createDataFrame(rows, schema)
    want = sorted((r.run_id, r.payload) for r in title_payload(run_outcomes(facts.where("run_id <> 7"))).collect())
    for wait, name in ((None, "a"), ("60 days", "b")):
        src, dest = str(tmp_path / f"src-{name}"), str(tmp_path / f"sent-{name}")
        shuffled = rows[:]
        rnd.shuffle(shuffled)
        _write(spark, shuffled[:len(rows) // 2], schema, src, 3)

        def notify():
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).withColumn("run_started", F.col("started"))
            stream_notify(completed_runs(stream, wait=wait), title_payload, [batch_dir_sink(dest)], str(tmp_path / f"c-{name}"))
        notify()
        _write(spark, shuffled[len(rows) // 2:], schema, src, 3)
        notify()  # goes on from the checkpoint
        sent = spark.read.schema("run_id long, payload string").json(dest).collect()
        assert sorted((r.run_id, r.payload) for r in sent) == want


class _Kept:
    """A state variable in memory that counts its requests."""

    def __init__(self, asked):
        self.rows, self.asked = [], asked

    def get(self):
        self.asked.append("get")
        return iter(list(self.rows))

    def appendValue(self, row):
        self.asked.append("append")
        self.rows.append(row)

    def put(self, rows):
        self.asked.append("put")
        self.rows = list(rows)

    def clear(self):
        self.asked.append("clear")
        self.rows = []


class _KeptValue(_Kept):
    def get(self):
        return next(super().get(), None)

    def update(self, row):
        self.put([row])


def test_many_files_of_a_bucket_cost_a_few_state_requests():
    asked = []
    held = HeldUploads(None)
    held.init(type("Handle", (), {"getListState": lambda self, *a: _Kept(asked), "getValueState": lambda self, *a: _KeptValue(asked)})())
    rows = [(f, s, 0 if f % 7 else ABSENT, b, z) for f, s, _, b, z in _uploads(8, files=300)]
    rows[0] = (rows[0][0], ABSENT, *rows[0][2:])
    late = [(f, 10**6, 0, 0, 0) for f in range(300)]  # empty chunks of closed files
    random.Random(4).shuffle(rows)
    got, batches = [], [rows[at::20] for at in range(20)] + [late]
    for batch in batches:
        asked.clear()
        part = pd.DataFrame(batch, columns=["file", "seq", "us", "bytes", "filesize"])
        for out in held.handleInputRows((0,), iter([part]), None):
            got += out.itertuples(index=False, name=None)
        assert len(asked) <= 7
    want = []
    for file in range(300):
        f, s, us, b, z = zip(*[r for r in rows if r[0] == file])
        want += [(file, s[at], us[at], n, p) for at, n, p in throttled(np.array(s), np.array(b), z[0])]
    assert sorted(got) == sorted(want)
    assert not held.chunks.rows and len(held.closed.rows) <= len(batches)
