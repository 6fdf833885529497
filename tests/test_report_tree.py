"""The whole report as a tree of lines, against lines written by hand and a plain loop over a large run."""
from datetime import datetime as dt, timedelta as td

from pyspark.sql import functions as F

from opslog.functions.fmt import sym
from opslog.plans.report_tree import run_report
from opslog.session import ship_package

FACTS = ("run_id long, grp string, directory string, success boolean, exitcode int, exc string, started timestamp_ntz, completed timestamp_ntz, elapsed_us long, "
         "size long, speed long, archive string, up_key string, up_success boolean, up_started timestamp_ntz, up_completed timestamp_ntz, up_elapsed_us long, up_speed long")
T0 = dt(2024, 5, 6, 7, 8, 9)


def fact(run, grp, directory, ok, size=2048, exitcode=None, exc=None, up=None, seconds=61):
    end, name = T0 + td(seconds=seconds), (directory or "").strip("/")
    base = (run, grp, directory, ok, 0 if ok else exitcode, exc, T0, end, seconds * 10**6, size, size // seconds if ok else 0, f"/backup/{name}.rar")
    return base + ((None,) * 6 if up is None else (f"{grp}/{name}.rar", up, end, end + td(seconds=2), 2 * 10**6, size // 2 if up else 0))


def report(spark, rows, **options):
    ship_package(spark)
    out = run_report(spark.createDataFrame(rows, FACTS), "/backup", "2026-01-01 00:00:00", **options).collect()
    lines = {}
    for r in sorted(out, key=lambda r: (str(r.run_id), r.line_no)):
        assert r.line_no == len(lines.setdefault(r.run_id, []))
        assert r.text == "" or len(r.text) - len(r.text.lstrip(" ")) == 4 * r.indent
        lines[r.run_id].append(r.text)
    return lines


def test_lines(spark):
    rows = [fact(1, "b", "/srv/two", True, 5_000_000, up=True), fact(1, "a", "/srv/one", True, 100, up=False), fact(1, "a", "/x", False, exitcode=6),
            fact(1, "a", "/y", False, exc="word " * 30)]
    got = report(spark, rows, config={"Destination": "/backup"})[1]
    s = sym
    when = f"{s('time')} 2024-05-06 07:08:09"
    assert got[:12] == ["=" * 100, "== 2026-01-01 00:00:00", "", f"{s('summary')} Summary", "    Command                   Backup", "    Groups                    a, b",
                        "    Destination               /backup", f"    Started                   {when}",
                        f"    Completed                 {s('time')} 2024-05-06 07:09:12", f"    Elapsed                   {s('duration')} 01m 03s", "",
                        f"    {s('success')} Successful backups [ {s('size')} 4.7 MB ] -- (ﾉ◕ヮ◕)ﾉ"]
    assert got[12:24] == [
        f"        1. {s('archive')} srv/one.rar [ {s('size')} 100 bytes | {s('duration')} 01m 01s | {s('speed')}     1 B/s ]",
        f"        2. {s('archive')} srv/two.rar [ {s('size')}    4.7 MB | {s('duration')} 01m 01s | {s('speed')} 80.0 KB/s ]",
        "", f"    {s('failure')} Failed backups -- ¯\\_(ツ)_/¯", f"        1. {s('directory')} /x", f"        2. {s('directory')} /y",
        "", f"    {s('success')} Successful uploads [ {s('size')} 4.7 MB ] -- (ﾉ◕ヮ◕)ﾉ",
        f"        1. {s('archive')} b/srv/two.rar [ {s('size')} 4.7 MB | {s('duration')} 02s | {s('speed')} 2.3 MB/s ]",
        "", f"    {s('failure')} Failed uploads -- ¯\\_(ツ)_/¯", f"        1. {s('archive')} /backup/srv/one.rar"]
    details = got[got.index(f"{s('details')} Details"):]
    assert details[8:14] == ["        Group [a]:", f"            {s('directory')} /srv/one", f"            {s('directory')} /x", f"            {s('directory')} /y", "",
                             "        Group [b]:"]
    at = details.index(f"        [2/4] [a] {s('directory')} /x")
    assert details[at + 1:at + 6] == [f"            Success           {s('failure')} False", f"            Started           {when}",
                                      f"            Completed         {s('time')} 2024-05-06 07:09:10", f"            Elapsed           {s('duration')} 01m 01s",
                                      f"            Exit Code         {s('exitcode')} 6"]
    at = details.index(f"        [3/4] [a] {s('directory')} /y")
    assert details[at + 5:at + 9] == ["", f"            {s('exception')} Exception", "                " + " ".join(["word"] * 20), "                " + " ".join(["word"] * 10)]
    assert f"        [1/2] {s('archive')} a/srv/one.rar" in details and got[-2:] == ["", "=" * 100]


def test_large_and_odd_runs(spark):
    many = [fact(7, f"g{i % 3}", f"/d{i:04d}", i % 2 == 0, up=i % 4 == 0 if i % 2 == 0 else None) for i in range(400)]
    odd = [fact(None, None, None, None), fact(8, "g", "/same", True), fact(8, "g", "/same", True), fact(9, "g", "/only", False, exitcode=1)]
    got = report(spark, many + odd, arguments=["g*"])
    seven = got[7]
    assert [x for x in seven if x.startswith("        01. ")] and sum(x.startswith("        200. ") for x in seven) == 2
    assert [x.split("]")[0].strip(" [") for x in seven if x.startswith("        [") and "[g" in x] == [f"{i}/400" for i in range(1, 401)]
    assert "    Arguments                 g*" in seven and "    Groups                    g0, g1, g2" in seven
    assert not any("Upload" in x for x in got[9]) and sum("[g] " in x for x in got[8]) == 2 and None in got


def test_no_runs(spark):
    assert report(spark, []) == {}


def test_small_runs_are_not_shuffled_as_blocks(spark):
    """Small runs become blocks where their entries are: no shuffle and no table of blocks; large runs give the same lines."""
    from opslog.session import SCRATCH
    rows = [fact(i % 5 or None, f"g{i % 3}", f"/d{i:04d}", i % 2 == 0, up=i % 4 == 0 if i % 2 == 0 else None) for i in range(60)] + \
        [fact(9, f"g{i % 2}", f"/e{i:04d}", i % 3 == 0, exitcode=2) for i in range(90)]
    want = report(spark, rows)
    assert want == report(spark, rows, whole=50) and len(want) == 6
    before = len(SCRATCH)
    df = run_report(spark.createDataFrame(rows, FACTS), "/backup", "2026-01-01 00:00:00")
    assert [s.rsplit("/", 1)[-1].rsplit("-", 1)[0] for s in SCRATCH[before:]] == ["report-entries"]
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.index("Union") < plan.index("Exchange ")  # only what lies below the blocks is shuffled


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines()
    return {f for f in files if "/shuffle_" in f}


def test_entries_are_on_disk_once(spark):
    """The numbering leaves the written entries alone behind, no shuffle and no split; only totals of runs are shuffled after it."""
    import time

    from opslog.session import SCRATCH
    rows = [fact(i % 7 or None, f"g{i % 3}", f"/d{i:04d}", i % 2 == 0, exc="word " * (i % 40) if i % 5 == 3 else None,
                 up=i % 4 == 0 if i % 2 == 0 else None) for i in range(90)] + [fact(9, f"g{i % 2}", f"/e{i:04d}", i % 3 == 0, exitcode=2) for i in range(70)]
    ship_package(spark)
    for whole in (1000, 50):
        before, files = len(SCRATCH), _shuffle_files(spark)
        df = run_report(spark.createDataFrame(rows, FACTS), "/backup", "2026-01-01 00:00:00", whole=whole)
        assert [s.rsplit("/", 1)[-1].rsplit("-", 1)[0] for s in SCRATCH[before:]] == ["report-entries"]
        for _ in range(50):
            if not (left := _shuffle_files(spark) - files):
                break
            time.sleep(0.2)
        assert not left
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange ") == 1 and "partial_" in plan[plan.index("Exchange "):] and "Window" not in plan
    assert report(spark, rows) == report(spark, rows, whole=50)


def test_entries_alike_but_for_their_outcome(spark):
    """Entries of one directory, time and size stand in some order, but all numbers and lines agree, in one task or in ranges."""
    rows = [fact(5, f"g{i % 2}", "/same", i % 3 == 0, exitcode=i % 2 if i % 3 else None, exc="word " * 30 if i % 5 == 4 else None,
                 up=i % 2 == 0 if i % 3 == 0 else None) for i in range(60)]
    for options in ({}, {"whole": 10}):
        got = report(spark, rows, **options)[5]
        details = got[got.index(f"{sym('details')} Details"):]
        assert [x.split("]")[0].strip(" [") for x in details if "/60] [g" in x] == [f"{i}/60" for i in range(1, 61)]
        assert [x.split("]")[0].strip(" [") for x in details if "/20] " in x] == [f"{i}/20" for i in range(1, 21)]
        mapped = details[7:7 + 64]
        assert mapped == [x for g in ("g0", "g1") for x in ["", f"        Group [{g}]:"] + [f"            {sym('directory')} /same"] * 30]


def test_entries_spread_by_run(spark, tmp_path):
    """Tables that are spread by run before their join give the same entries, and windows over runs shuffle them no more."""
    from pyspark.sql import Window

    from opslog.functions import fmt
    from opslog.sources import bindings as B
    ship_package(spark)
    day = lambda i: T0 + td(days=i)
    items = [(None if i == 3 else i // 4, i, 10.5 + i, "NRA"[i % 3], "OF"[i % 2], None if i == 5 else day(i)) for i in range(60)] + [(2, 1, None, None, None, day(1))] * 2
    orders = [(i, f"{i % 5}-P", day(i)) for i in range(14)] + [(4, "again", day(0)), (None, "none", day(0))]
    spark.createDataFrame(items, "l_orderkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spread = B.entries(spark, str(tmp_path), tasks=5, more={"exc_lines": fmt.wrap("exc")})
    plain = B.entries(spark, str(tmp_path)).withColumn("exc_lines", fmt.wrap("exc"))
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(plain) == rows(spread) and len(rows(plain)) == 61
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = spread.withColumn("n", F.row_number().over(Window.partitionBy("run_id", "grp").orderBy("directory")))
        assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
