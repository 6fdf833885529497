"""D1-D6 (service discovery vectors, overlay example, slots)."""

import pytest
from pyspark.sql import functions as F

from opslog.operators.discover import entry_exists, free_slot, marker_roots
from opslog.operators.overlay import env_overlay, profile_lookup
from opslog.operators.select import select_by_globs
from opslog.functions.paths import map_overlay

# Own trees: a folder is a service when one of its files has a marker name; (files, selectors, expected names).
SERVICES = [
    ([], [], []),
    (["alpha/docker-compose.yml", "beta/compose.yaml", "gamma/readme.md"], [], ["alpha", "beta"]),
    (["alpha/docker-compose.yml", "beta/compose.yaml", "gamma/readme.md"], ["gamma"], []),
    (["x/y/wiki/compose.yml", "x/mail/docker-compose.yaml", "x/y/notes.txt"], [], ["wiki", "mail"]),
    (["x/y/wiki/compose.yml", "x/mail/docker-compose.yaml"], ["w?ki"], ["wiki"]),
    (["x/y/wiki/compose.yml", "x/mail/docker-compose.yaml"], ["y"], []),
    (["x/y/wiki/compose.yml", "x/mail/docker-compose.yaml", "z/chat/compose.yml"], ["m*", "*t"], ["mail", "chat"]),
    (["x/wiki/compose.yml.bak", "x/mail/mycompose.yml", "x/chat/Compose.yml"], [], []),
]


@pytest.mark.parametrize("files,selectors,names", SERVICES)
def test_marker_roots(spark, files, selectors, names):
    df = spark.createDataFrame([(f"/opt/stacks/{f}",) for f in files], "path string")
    roots = select_by_globs(marker_roots(df), "name", selectors)
    got = [(r.name, r.kind) for r in roots.collect()]
    assert sorted(got) == sorted((n, "docker-compose") for n in names)


def test_marker_shadows_subtree(spark):
    df = spark.createDataFrame([("a/compose.yml",), ("a/b/compose.yml",), ("a/b/c/docker-compose.yaml",),
                                ("x/y/compose.yaml",)], "path string")
    assert sorted(r.directory for r in marker_roots(df).collect()) == ["a", "x/y"]


def test_env_overlay_readme_example(spark):
    names = spark.createDataFrame([("red widget",), ("blue widget",), ("red gear",), ("plain",)], "name string")
    overlays = spark.createDataFrame([(0, "*", {"UID": "1001", "GID": "1001"}), (1, "red *", {"UID": "1002"}),
                                      (2, "* widget", {"PORT": "8080", "UID": "1003"})],
                                     "ord int, pattern string, env map<string,string>")
    got = {r.name: dict(r.env) for r in env_overlay(names, overlays).collect()}
    assert got["red widget"] == {"UID": "1003", "GID": "1001", "PORT": "8080"}
    assert got["blue widget"] == {"UID": "1003", "GID": "1001", "PORT": "8080"}
    assert got["red gear"] == {"UID": "1002", "GID": "1001"}
    assert got["plain"] == {"UID": "1001", "GID": "1001"}


def test_env_overlay_no_match_is_empty(spark):
    names = spark.createDataFrame([("x",)], "name string")
    ov = spark.createDataFrame([(0, "y*", "K", "V")], "ord int, pattern string, k string, v string")
    assert env_overlay(names, ov).first().env == {}


def test_profile_lookup(spark):
    req = spark.createDataFrame([("mine",), ("tar",), ("none",)], "name string")
    custom = spark.createDataFrame([(0, "mine", "zip", None), (1, "mine", "tar", "gz")],
                                   "ord int, name string, provider string, compress string")
    defaults = spark.createDataFrame([("tar", "tar", "xz")], "name string, provider string, compress string")
    got = {r.name: (r.profile, r.source) for r in profile_lookup(req, custom, defaults).collect()}
    assert got["mine"][0].provider == "zip" and got["mine"][0].compress is None and got["mine"][1] == "custom"
    assert got["tar"][0].compress == "xz" and got["tar"][1] == "default"
    assert got["none"] == (None, None)


def test_free_slot_fills_gaps(spark):
    ex = spark.createDataFrame([("b", 0), ("b", 1), ("b", 3)], "base string, slot long")
    req = spark.createDataFrame([("b", i) for i in range(4)] + [("c", 0)], "base string, seq long")
    got = sorted((r.base, r.seq, r.slot) for r in free_slot(req, ex).collect())
    assert got == [("b", 0, 2), ("b", 1, 4), ("b", 2, 5), ("b", 3, 6), ("c", 0, 0)]


def test_entry_exists(spark):
    e = spark.createDataFrame([("a",), ("b",)], "archive string")
    listing = spark.createDataFrame([("a",), ("a",)], "path string")
    assert {r.archive: r.exists for r in entry_exists(e, listing).collect()} == {"a": True, "b": False}


def test_map_overlay_keeps_dict_order(spark):
    df = spark.createDataFrame([({"Destination": "/b", "Upload": "false"}, {"S3 Bucket": "x", "Upload": "aws"})],
                               "base map<string,string>, over map<string,string>")
    r = df.select(F.map_entries(map_overlay("base", "over")).alias("m"),
                  map_overlay("base", F.lit(None).cast("map<string,string>")).alias("n")).first()
    assert [(e.key, e.value) for e in r.m] == [("Destination", "/b"), ("Upload", "aws"), ("S3 Bucket", "x")]
    assert r.n == {"Destination": "/b", "Upload": "false"}


def test_free_slot_against_a_counter(spark):
    """Many taken slots in runs and gaps, requests of a null base: each request takes the next number not taken."""
    taken = {None: {0, 2, 3}, "b": set(range(0, 900)) | set(range(950, 1000, 2)), "c": {5}}
    ex = spark.createDataFrame([(b, s) for b, ss in taken.items() for s in ss] * 2, "base string, slot long")
    req = spark.createDataFrame([(b, i) for b in [None, "b", "c", "d"] for i in range(120)], "base string, seq long")
    want = {}
    for b in [None, "b", "c", "d"]:
        free = (s for s in range(10000) if s not in taken.get(b, ()))
        want.update({(b, i): next(free) for i in range(120)})
    assert {(r.base, r.seq): r.slot for r in free_slot(req, ex).collect()} == want


def test_marked_root_is_a_root_and_hides_what_is_below(spark):
    rows = [("compose.yml",), ("a/compose.yml",), ("a/b/x.txt",)]
    got = marker_roots(spark.createDataFrame(rows, "path string")).select("directory").collect()
    assert [r.directory for r in got] == [""]
