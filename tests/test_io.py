"""Sources and sinks: A1-A6, A8."""

import os
import tarfile
import zipfile

import pytest

from opslog.operators.select import min_level
from opslog.sources.oplog import read_oplog
from opslog.sources.sinks import archive_shards, fan_out, publish, scan_tree, snapshot_groups, write_report


def test_scan_tree_relative_paths(spark, tmp_path):
    for f in ["a/x.txt", "a/b/y.txt", "z.txt", ".env", ".git/config", "_data/q r.txt"]:
        p = tmp_path / f
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("hello")
    got = sorted((r.rel_path, r.length) for r in scan_tree(spark, str(tmp_path)).collect())
    assert got == [(".env", 5), (".git/config", 5), ("_data/q r.txt", 5), ("a/b/y.txt", 5), ("a/x.txt", 5), ("z.txt", 5)]
    assert sorted((r.rel_path, r.length) for r in scan_tree(spark, "file://" + str(tmp_path)).collect()) == got


def test_read_oplog_continuation_and_levels(spark, tmp_path):
    log = tmp_path / "2024-01-01.log"
    log.write_text("2024-01-01 10:00:00,123 [INFO ] - started\n"
                   "2024-01-01 10:00:01,000 [WARNI] - disk almost full\n"
                   "  second line of the warning\n"
                   "2024-01-01 10:00:02,500 [CRITI] - gave up\n")
    rows = read_oplog(spark, str(log)).orderBy("line_id").collect()
    assert [r.level for r in rows] == ["INFO", "WARNING", "WARNING", "CRITICAL"]
    assert rows[2].message == "  second line of the warning" and rows[2].ts == rows[1].ts
    assert [r.message for r in min_level(read_oplog(spark, str(log)), "ERROR").collect()] == ["gave up"]


def test_read_oplog_records_cross_blocks(spark, tmp_path):
    """A file read in many small blocks, with a record longer than a block, next to one without a header at its start."""
    lines = []
    for i in range(300):
        lines.append(f"2024-01-01 10:{i // 60:02d}:{i % 60:02d},000 [{'ERROR' if i % 3 else 'INFO '}] - m{i}")
        lines += [f"  more {i} {j}" for j in range(400 if i == 50 else i % 4)]
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.log").write_text("lost\n2024-01-02 00:00:00,000 [DEBUG] - found\n")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = read_oplog(spark, str(tmp_path)).orderBy("file", "block", "line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    a, b = [r for r in rows if r.file.endswith("a.log")], [r for r in rows if r.file.endswith("b.log")]
    want, level, at = [], None, None
    for text in lines:
        if text[0] == "2":
            level, at, text = text[25:30].strip(), text[:19], text[34:]
        want.append((at, level, text))
    assert len({r.block for r in a}) > 5 and [(str(r.ts), r.level, r.message) for r in a] == want
    assert [(r.level, r.message) for r in b] == [(None, "lost"), ("DEBUG", "found")]


def test_snapshot_refuses_overwrite_and_rejects_xz(spark, tmp_path):
    df = spark.createDataFrame([(i, "g%d" % (i % 3), "t" * i) for i in range(30)], "id long, g string, t string")
    dest = str(tmp_path / "snap")
    man = {r.g: r.rows for r in snapshot_groups(df, "g", dest, codec="gz").collect()}
    assert man == {"g0": 10, "g1": 10, "g2": 10}
    assert any(f.endswith(".gz") for _, _, fs in os.walk(dest) for f in fs)
    with pytest.raises(Exception):
        snapshot_groups(df, "g", dest, codec="gz")
    with pytest.raises(ValueError):
        snapshot_groups(df, "g", str(tmp_path / "other"), codec="xz")


@pytest.mark.parametrize("kind,codec", [("tar", "gz"), ("tar", None), ("tar", "bz2"), ("zip", "gz"), ("zip", None)])
def test_archive_shards_roundtrip(spark, tmp_path, kind, codec):
    df = spark.createDataFrame([(f"f{i}.txt", "x" * i, "ab"[i % 2]) for i in range(50)], "n string, d string, g string")
    dest = str(tmp_path / "shards")
    man = archive_shards(df, "n", "d", dest, kind=kind, codec=codec, group_col="g").collect()
    assert sum(r.files for r in man) == 50 and sum(r.bytes for r in man) == sum(range(50))
    names = {}
    for r in man:
        if kind == "tar":
            with tarfile.open(r.shard) as t:
                names.update({m.name: t.extractfile(m).read() for m in t.getmembers()})
        else:
            with zipfile.ZipFile(r.shard) as z:
                names.update({n: z.read(n) for n in z.namelist()})
    assert len(names) == 50 and names["f7.txt"] == b"x" * 7
    more = archive_shards(df, "n", "d", dest, kind=kind, codec=codec, group_col="g").collect()  # a second write adds shards
    assert len({r.shard for r in more}) == len(more) == 2 * len(man) and all(os.path.exists(r.shard) for r in more)
    assert not any(f.endswith(".tmp") for _, _, fs in os.walk(dest) for f in fs)


def test_groups_keep_their_exact_values(spark, tmp_path):
    groups = ["01", "1", "", None, "null", "a/b c=%", "__HIVE_DEFAULT_PARTITION__"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "x long, g string")
    man = snapshot_groups(df, "g", str(tmp_path / "s")).collect()
    assert sorted(map(repr, (r.g for r in man))) == sorted(map(repr, groups))
    assert all(r.rows == 1 and r.files == 1 and r.bytes > 0 and r.status == "success" for r in man)
    stored = publish(df, str(tmp_path / "p"), "g").collect()
    assert {(r.x, r.g) for r in stored} == set(enumerate(groups))


def test_report_append_and_fan_out(spark, tmp_path):
    lines = spark.createDataFrame([(1, 1, "b"), (0, 0, "="), (1, 0, "a")], "section_no int, line_no int, text string")
    dest = str(tmp_path / "report")
    write_report(lines, dest)
    write_report(lines, dest)  # appends a second report
    assert spark.read.text(dest).count() == 6
    seen = []
    fan_out(lines, [lambda d: seen.append(d.count()), lambda d: seen.append(d.where("section_no = 1").count())])
    assert seen == [3, 2]
