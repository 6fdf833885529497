"""Outcome of operations, actions and runs; discovery from several given roots."""
from datetime import datetime as dt, timedelta as td

from opslog.operators.discover import marker_roots_under
from opslog.operators.rollup import outcome_levels

T0 = dt(2024, 1, 1)
PROCS = "run_id long, action string, operation string, success boolean, size long, elapsed_us long, started timestamp_ntz, completed timestamp_ntz"


def _proc(run, action, operation, ok, size, lo, hi):
    return (run, action, operation, ok, size, (hi - lo) * 10**6, T0 + td(seconds=lo), T0 + td(seconds=hi))


def test_each_level_has_its_rule(spark):
    rows = [_proc(1, "mapping", "m", False, 0, 0, 1), _proc(1, "backup", "a", True, 5, 1, 4), _proc(1, "backup", "b", False, 9, 2, 9),
            _proc(1, "deploy", "s", True, 1, 9, 10), _proc(1, "deploy", "s", True, 2, 12, 15), _proc(2, "deploy", "s", True, 1, 0, 1),
            _proc(2, "deploy", "t", None, 1, 5, 6), _proc(None, "other", None, True, 4, 0, 2)]
    got = {(r.run_id, r.level, r.action, r.operation): r for r in outcome_levels(spark.createDataFrame(rows, PROCS)).collect()}
    ok = {k: r.success for k, r in got.items()}
    assert ok[1, "action", "mapping", None] and ok[1, "action", "backup", None] and ok[1, "action", "deploy", None] and ok[1, "run", None, None]
    assert not ok[1, "operation", "backup", "b"] and not ok[2, "action", "deploy", None] and not ok[2, "run", None, None]
    assert ok[None, "run", None, None] and len(got) == 7 + 5 + 3
    op, act, run = got[1, "operation", "deploy", "s"], got[1, "action", "backup", None], got[1, "run", None, None]
    assert (op.n, op.bytes, op.elapsed_us, op.scope_started, op.scope_completed) == (2, 3, 4 * 10**6, T0 + td(seconds=9), T0 + td(seconds=15))
    assert (act.n, act.bytes, act.elapsed_us) == (2, 5, 8 * 10**6) and (run.n, run.bytes, run.elapsed_us) == (5, 8, 15 * 10**6)
    late = got[2, "operation", "deploy", "s"]  # one service, in the span of the whole deployment
    assert (late.completed, late.scope_completed) == (T0 + td(seconds=1), T0 + td(seconds=6))
    assert outcome_levels(spark.createDataFrame([], PROCS)).count() == 0


def _walk(files, root):
    """The search as one does it by hand: from the root down, not below a marked directory."""
    marked = {f.rsplit("/", 1)[0] if "/" in f else "" for f in files if f.rsplit("/", 1)[-1] == "compose.yml"}
    dirs = {""} | {f[:i] for f in files for i, c in enumerate(f) if c == "/"}
    root, out = root.rstrip("/"), []

    def visit(d):
        if d in marked:
            out.append(d)
            return
        for c in dirs:
            if c and (c.rsplit("/", 1)[0] if "/" in c else "") == d:
                visit(c)
    if root in dirs:
        visit(root)
    return sorted(out)


def test_given_roots_nest_and_overlap(spark):
    files = ["a/compose.yml", "a/b/compose.yml", "a/b/c/compose.yml", "a/b/d/x.txt", "e/f/compose.yml", "e/f/g/h/compose.yml", "ab/compose.yml", "e/i/j/compose.yml"]
    roots = ["", "a", "a/b", "a/b/c/", "a/b/d", "e", "e/f/g", "nowhere", "ab", "e/"]
    listing = spark.createDataFrame([(f,) for f in files], "path string")
    given = spark.createDataFrame([(r,) for r in roots], "root string")
    got = [(r.root, r.directory, r.name) for r in marker_roots_under(listing, given).collect()]
    assert sorted(got) == sorted((r, d, d.rsplit("/", 1)[-1]) for r in roots for d in _walk(files, r))
    top = spark.createDataFrame([("compose.yml",), ("a/compose.yml",)], "path string")
    assert sorted((r.root, r.directory) for r in marker_roots_under(top, given.where("root in ('', 'a')")).collect()) == [("", ""), ("a", "a")]


def test_rollup_spread_over_tasks(spark):
    """The rollup is the same over any number of tasks, and its first aggregate then holds a task's share only."""
    from opslog.operators.rollup import run_rollup

    rows = [(i % 50 or None, f"/d{i % 7}", None if i % 11 == 0 else i % 3 != 0, None if i % 13 == 0 else i, i * 10) for i in range(2000)]
    df = spark.createDataFrame(rows, "run_id long, directory string, success boolean, elapsed_us long, size long")
    spread = run_rollup(df, tasks=40)
    assert sorted(map(str, run_rollup(df).collect())) == sorted(map(str, spread.collect())) and spread.count() == 50
    assert "hashpartitioning(run_id" in (plan := spread._jdf.queryExecution().executedPlan().toString()) and ", 40), REPARTITION_BY_NUM" in plan
