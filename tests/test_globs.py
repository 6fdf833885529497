"""C1-C3 on own names and selectors, against fnmatch."""

import fnmatch

import pytest

from opslog.functions.globs import glob_match, glob_to_regex
from opslog.operators.select import select_by_glob_table, select_by_globs

# Own names and selectors; a name matches as fnmatch.fnmatchcase says.
NAMES = ["db", "db1", "db12", "mydb", "web", "web.old", "Web", "w[b", "]", "", "a\n", "x-y_z", "été"]
SELECTORS = ["", "*", "?", "??", "db", "db?", "db*", "*db", "*db*", "d[a-c]", "d[!a-c]*", "[dw]*", "web.*", "w[b", "[]]", "[!]]*",
             "*e*", "?t?", "*.old", "a?", "a", "x-y_z", "*_*", "[x-z]-*"]
MATCH = [(n, s, fnmatch.fnmatchcase(n, s)) for n in NAMES for s in SELECTORS]


def test_glob_match_follows_fnmatch(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = df.select("name", *[glob_match("name", s).alias(f"m{i}") for i, s in enumerate(SELECTORS)]).collect()
    assert sorted((r.name, s, r[f"m{i}"]) for r in got for i, s in enumerate(SELECTORS)) == sorted(MATCH)


def test_prefix_glob_pushes_down(spark, tmp_path):
    p = str(tmp_path / "names")
    spark.createDataFrame([("nginx",), ("cloud",)], "name string").write.parquet(p)
    plan = spark.read.parquet(p).where(glob_match("name", "ngi*"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan


def test_regex_is_anchored():
    assert glob_to_regex("a*").endswith("\\z")


SETS = [[], ["*"], ["*", "db"], ["*b"], ["db?", "w*"], ["?eb", "[d]b"], ["db"], ["nothing"], ["*1*", "*.old"], ["[!d]*"]]


def _matched(selectors):
    return sorted(n for n in NAMES if not selectors or any(fnmatch.fnmatchcase(n, s) for s in selectors))


@pytest.mark.parametrize("selectors", SETS)
def test_select_by_globs(spark, selectors):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    assert [r.name for r in select_by_globs(df, "name", selectors, sort=True).collect()] == _matched(selectors)


@pytest.mark.parametrize("selectors", SETS)
def test_select_by_glob_table(spark, selectors):
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    pats = spark.createDataFrame([(s,) for s in selectors], "pattern string")
    got = select_by_glob_table(df, "name", pats)
    assert sorted(r.name for r in got.collect()) == _matched(selectors)  # each row at most once
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_glob_table_prefix_selectors(spark):
    """Many selectors match one name; each row comes back once."""
    names = spark.createDataFrame([(f"svc{i:03d}",) for i in range(200)], "name string")
    pats = spark.createDataFrame([(f"svc{i:03d}*",) for i in range(0, 200, 2)] + [("svc*",)], "pattern string")
    got = select_by_glob_table(names, "name", pats)
    assert got.count() == 200
    assert got.distinct().count() == 200


def test_glob_table_leading_wildcards(spark):
    """Selectors that start with a wildcard are keyed by their other literal text; rows come back once."""
    names = spark.createDataFrame([(f"svc{i:03d}",) for i in range(200)] + [("other",)], "name string")
    pats = spark.createDataFrame([(f"*{i:03d}",) for i in range(0, 200, 2)] + [("*c1?9",), ("s*0",)],
                                 "pattern string")
    got = {r.name for r in select_by_glob_table(names, "name", pats).collect()}
    want = {f"svc{i:03d}" for i in range(200) if i % 2 == 0 or (100 <= i < 200 and i % 10 == 9) or i % 10 == 0}
    assert got == want


def test_glob_pairs_each_pair_once(spark):
    from opslog.operators.select import glob_pairs
    names = spark.createDataFrame([("ab",), ("abc",), ("b",)], "name string")
    pats = spark.createDataFrame([(0, "ab"), (1, "a*"), (2, "ab*"), (3, "*c"), (4, "abc*"), (5, "*b*"), (6, "*")], "ord int, pattern string")
    got = sorted((r.name, r.ord) for r in glob_pairs(names, "name", pats).collect())
    assert got == sorted([("ab", 0), ("ab", 1), ("ab", 2), ("abc", 1), ("abc", 2), ("abc", 3), ("abc", 4),
                          *[(n, o) for n in ("ab", "abc", "b") for o in (5, 6)]])
