"""G1-G7, H1-H3 on own vectors; stream form (L1) equals the batch form."""

import itertools
from datetime import datetime as dt, timedelta as td

from pyspark.sql import functions as F

from opslog.operators import sequence as S
from opslog.streaming.throttle import run_to_sink, stream_throttle, EMIT_SCHEMA

def _reported(size, chunks):
    """The throttle rule, stated plainly: at least STEP more than last reported, and 100 once."""
    done, last, out = 0, 0, []
    for n in chunks:
        done += n
        pct = min(done * 100 // size, 100)
        if pct >= last + S.THROTTLE_STEP or (pct == 100 and last != 100):
            last = pct
            out.append(pct)
    return out


UPLOADS = [(100, [4] * 25), (1000, [90, 10, 5, 95, 300, 500]), (64, [1] * 64), (50, [20, 1, 1, 28]), (8, [8]), (200, [19, 1] * 12),
           (7, [3, 3])]
PROGRESS = [(size, chunks, _reported(size, chunks)) for size, chunks in UPLOADS]


def _chunks(spark, vectors):
    t0 = dt(2024, 1, 1, 10)
    rows = [(f, i, t0 + td(seconds=5 * i), b, size)
            for f, (size, ups, _) in enumerate(vectors) for i, b in enumerate(ups)]
    return spark.createDataFrame(rows, "file long, seq long, ts timestamp_ntz, bytes long, filesize long")


def test_throttle_batch(spark):
    em = S.throttle_progress(S.cumulative_pct(_chunks(spark, PROGRESS))).orderBy("file", "seq").collect()
    for f, (_, _, reported) in enumerate(PROGRESS):
        assert [r.pct for r in em if r.file == f] == reported


def test_progress_rate(spark):
    ch = _chunks(spark, PROGRESS[1:2])  # 10 % after 2 chunks (5 s in); 100 % after 6 chunks (25 s in)
    rated = S.progress_rate(S.throttle_progress(S.cumulative_pct(ch)), S.upload_starts(ch)).orderBy("seq").collect()
    first, last = rated[0], rated[-1]
    assert first.pct == 10 and first.elapsed_us == 5 * 10**6 and first.speed == 100 // 5
    assert last.pct == 100 and last.elapsed_us == 25 * 10**6 and last.speed == 1000 // 25


def test_throttle_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    ch = _chunks(spark, PROGRESS)
    # three micro-batches, each a later seq range of every file (arrival order is kept across batches)
    for lo, hi in [(0, 3), (3, 20), (20, 1000)]:
        ch.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(src)
    schema = ch.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_to_sink(stream_throttle(stream), out, ckpt)
    got = spark.read.schema(EMIT_SCHEMA).parquet(out).orderBy("file", "seq").collect()
    for f, (_, _, reported) in enumerate(PROGRESS):
        assert [r.pct for r in got if r.file == f] == reported
    # restart from the checkpoint with one more chunk of the unfinished upload: only its progress is new
    f = len(PROGRESS) - 1
    spark.createDataFrame([(f, 2, dt(2024, 1, 2), 1, 7)], schema).write.mode("append").parquet(src)
    run_to_sink(stream_throttle(spark.readStream.schema(schema).parquet(src)), out, ckpt)
    again = spark.read.schema(EMIT_SCHEMA).parquet(out)
    assert again.count() == len(got) + 1 and [r.pct for r in again.where(F.col("file") == f).orderBy("seq").collect()] == [42, 85, 100]


def test_streams_read_folders_and_runs_spread_over_batches(spark, tmp_path):
    """Tables in several part files: chunks of a file in any of them, a run's entries in several micro-batches."""
    from opslog.plans.report import run_outcomes, title_payload
    from opslog.streaming import throttle as T
    ev = spark.createDataFrame([(i, i % 3, dt(2024, 1, 1) + td(seconds=i), float(1 + i % 5)) for i in range(200)],
                               "event_id long, user_id long, ts timestamp_ntz, value double")
    ev.repartition(4, F.xxhash64("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    T.stream_consume(T.stream_throttle(T.chunk_stream(spark, str(tmp_path))), [lambda rows, n: seen.extend(rows.collect())],
                     str(tmp_path / "c1"))  # M3: a consumer of L1's rows
    sizes = {u: [100 * (1 + i % 5) for i in range(200) if i % 3 == u] for u in range(3)}
    assert {u: [r.pct for r in sorted(seen, key=lambda r: r.seq) if r.file == u] for u in range(3)} == \
        {u: _reported(sum(c), c) for u, c in sizes.items()}

    src, dest = str(tmp_path / "facts"), str(tmp_path / "sent")
    facts = spark.createDataFrame([(r, b, r % 2 == 0 and b == r % 4, dt(2024, 1, 1), dt(2024, 1, 2)) for r in range(8) for b in range(4)],
                                  "run_id long, b int, success boolean, started timestamp_ntz, completed timestamp_ntz")
    for b in range(4):
        facts.where(F.col("b") == b).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1).parquet(src)
    T.stream_notify(run_outcomes(stream), title_payload, [T.batch_dir_sink(dest)], str(tmp_path / "c2"))
    got = {r.run_id: r.payload for r in T.latest_payloads(spark, dest).collect()}
    assert got == {r.run_id: r.payload for r in title_payload(run_outcomes(facts)).collect()} and len(got) == 8


# Every run of three steps: steps after the first failure never ran.
STEPS = list(itertools.product([True, False], repeat=3))
FIRST_FAILURE = [(list(st), list(st[:st.index(False) + 1]) if False in st else list(st)) for st in STEPS]


def test_executed_prefix(spark):
    rows = [(k, i, ok) for k, (st, _) in enumerate(FIRST_FAILURE) for i, ok in enumerate(st)]
    df = spark.createDataFrame(rows, "run long, seq long, ok boolean")
    out = S.executed_prefix(df, "run", "seq").where("executed").orderBy("run", "seq").collect()
    for k, (_, expected) in enumerate(FIRST_FAILURE):
        assert [r.ok for r in out if r.run == k] == expected


def test_labels(spark):
    df = spark.createDataFrame([(0, i) for i in range(12)] + [(1, i) for i in range(3)], "k long, s long")
    idx = {(r.k, r.s): r.label for r in S.index_of_total(df, "k", "s").collect()}
    assert idx[(0, 0)] == "[1/12]" and idx[(1, 2)] == "[3/3]"
    arr = {(r.k, r.s): r.label for r in S.arrival_index(df, "k", "s").collect()}
    assert arr[(0, 0)] == "00. " and arr[(0, 11)] == "11. "
    num = {(r.k, r.s): r.label for r in S.list_labels(df, "k", "s", "number").collect()}
    assert num[(0, 0)] == "01. " and num[(1, 0)] == "1. "
    assert S.list_labels(df, "k", "s", "bullet").first().label == "- "


def test_first_match(spark):
    rows = [(0, 0, "a", 1), (0, 1, "b", 3), (0, 2, "b", 4), (1, 0, "a", 1)]
    df = spark.createDataFrame(rows, "k long, ord long, name string, val long")
    out = {r.k: r.first for r in S.first_match(df, "k", "ord", F.col("name") == "b").collect()}
    assert out[0].val == 3 and out[1] is None
    nulls = spark.createDataFrame([(None, 0, "b", 9)], df.schema)
    assert S.first_match(nulls, "k", "ord", F.col("name") == "b").first().first.val == 9


def test_split_outcome_partitions_input(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, success boolean")
    ok, failed = S.split_outcome(df)
    assert sorted(r.id for r in ok.collect()) == [1]
    assert sorted(r.id for r in failed.collect()) == [2, 3]


def test_ordered_scan_equals_duckdb(spark, tmp_path):
    """A hot key, null and NaN keys, integers above 2^53, null values: as windows in DuckDB."""
    import duckdb
    from opslog.operators.scan import ordered_scan
    big = (1 << 53) + 1
    rows = [(None if i % 10 < 7 else float("nan") if i % 10 == 7 else float(i % 5), i, None if i % 11 == 0 else (big + i % 13) * (-1) ** (i // 10))
            for i in range(30_000)]
    df = spark.createDataFrame(rows, "k double, s long, v long")
    df.coalesce(1).write.parquet(str(tmp_path / "t"))
    scanned = ordered_scan(df, "k", "s", value="v", rn_col="rn", cum_col="cum", count_col="n", num_partitions=16)
    got = sorted(map(tuple, scanned.select("s", "rn", "cum", "n").collect()))
    want = duckdb.sql(f"""SELECT s, row_number() OVER w, CAST(coalesce(sum(v) OVER w, 0) AS BIGINT), count(*) OVER (PARTITION BY k)
                          FROM read_parquet('{tmp_path}/t/*.parquet') WINDOW w AS (PARTITION BY k ORDER BY s)""").fetchall()
    assert got == sorted(want) and len(got) == 30_000
    two = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 1), (None, None, 5)], "p string, q string, s int")
    assert sorted((str(r.p), str(r.q), r.s, r.rn) for r in ordered_scan(two, ["p", "q"], "s", rn_col="rn").collect()) == \
        [("None", "None", 5, 1), ("a", "None", 1, 1), ("a", "None", 2, 2), ("a", "x", 1, 1)]


def test_sorts_return_rows_in_order(spark):
    rows = [(f"n{(i * 37) % 101:03d}", i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, x int").repartition(5)
    assert [tuple(r) for r in S.sort_by_name(df, "name", "x").collect()] == sorted(rows)
    assert [(r.x, r.name) for r in S.sort_multi(df, "x", "name").collect()] == sorted((x, n) for n, x in rows)


def test_null_key_is_cut_and_odd_sizes_do_not_fail(spark):
    from opslog.operators.sequence import cumulative_pct, executed_prefix
    df = spark.createDataFrame([(None, 1, True), (None, 2, False), (None, 3, True), ("a", 1, True)], "k string, o int, ok boolean")
    assert sorted(((r.k, r.o, r.executed) for r in executed_prefix(df, "k", "o").collect()), key=str) == sorted(
        [(None, 1, True), (None, 2, True), (None, 3, False), ("a", 1, True)], key=str)
    up = spark.createDataFrame([("f", 1, 5, 0), ("g", 1, 1 << 60, 1)], "file string, seq int, bytes long, filesize long")
    assert {r.file: r.pct for r in cumulative_pct(up).collect()} == {"f": 100, "g": 100}


def test_ordered_scan_splits_large_keys_only(spark):
    """Keys beyond ``whole`` rows are cut into ranges, the others are scanned where they are; nothing is written for those."""
    from opslog.operators.scan import ordered_scan
    from opslog.session import SCRATCH
    rows = [(None if i % 4 == 0 else "hot" if i % 4 == 1 else f"k{i % 40}", i % 3, i, i % 7) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, a int, s int, v int")
    seen, want = {}, set()
    for k, a, s, v in rows:  # in the order of s
        n, total = seen.get((k, a), (0, 0))
        seen[k, a] = (n + 1, total + v)
        want.add((k, a, s, v, n + 1, total + v))
    want = {(*r, *seen[r[:2]]) for r in want}
    for together in (None, "k"):
        for whole in (100_000, 200):
            before = len(SCRATCH)
            got = ordered_scan(df, ["k", "a"], "s", value="v", rn_col="rn", cum_col="cum", count_col="n", key_sums={"total": F.col("v")},
                               together=together, whole=whole)
            assert (len(SCRATCH) > before) == (whole == 200)
            assert set(map(tuple, got.collect())) == want
            if whole > 200:
                assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1
