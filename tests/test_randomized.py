"""Randomized checks against plain-Python statements of the rules (one Spark job each)."""

import fnmatch
import random

from pyspark.sql import functions as F

from opslog.operators import sequence as S
from opslog.operators.select import glob_regex

ALPHABET = "ab*?[]!-."


def _random_pattern(rng):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 6)))


def _random_name(rng):
    return "".join(rng.choice("ab-.]![") for _ in range(rng.randint(0, 5)))


def test_glob_regex_agrees_with_fnmatch(spark):
    rng = random.Random(7)
    pairs = [(_random_name(rng), _random_pattern(rng)) for _ in range(4000)]
    df = spark.createDataFrame(pairs, "name string, pattern string")
    got = df.select("name", "pattern", F.regexp_like("name", glob_regex("pattern")).alias("m")).collect()
    bad = [(r.name, r.pattern, r.m) for r in got if r.m != fnmatch.fnmatchcase(r.name, r.pattern)]
    assert not bad, bad[:10]


def _throttle_reference(sizes):
    """The rule as a loop: report when +10 points since the last report, or once at 100."""
    total, up, last, out = sum(sizes), 0, 0, []
    for i, b in enumerate(sizes):
        up += b
        p = min(int((up / total) * 100), 100)
        if p >= last + 10 or (p == 100 and last != 100):
            last = p
            out.append((i, p))
    return out


def test_throttle_agrees_with_loop(spark):
    rng = random.Random(11)
    files = []
    for f in range(300):
        n = rng.randint(1, 60)
        files.append([rng.choice([0, 1, 1, 2, 3, 5, 8, 40, 200]) + (1 if k == 0 else 0) for k in range(n)])
    rows = [(f, i, b, sum(sz)) for f, sz in enumerate(files) for i, b in enumerate(sz)]
    df = spark.createDataFrame(rows, "file long, seq long, bytes long, filesize long")
    em = S.throttle_progress(S.cumulative_pct(df)).collect()
    got = {}
    for r in em:
        got.setdefault(r.file, []).append((r.seq, r.pct))
    for f, sz in enumerate(files):
        assert sorted(got.get(f, [])) == _throttle_reference(sz), f


def _size_reference(n, units, base):
    if n < 1024:
        return f"{n} {base}"
    level = 1
    while level < len(units) and n >= 1024 ** (level + 1):
        level += 1
    major = n // 1024 ** level
    below = (n // 1024 ** (level - 1)) % 1024
    return f"{major}.{below * 10 // 1024} {units[level - 1]}"


def _duration_reference(us):
    total = us / 1_000_000
    days, rest = divmod(total, 86_400)
    hours, rest = divmod(rest, 3_600)
    minutes, seconds = divmod(rest, 60)
    parts = [("d", round(days)), ("h", round(hours)), ("m", round(minutes)), ("s", round(seconds))]
    while parts and parts[0][1] == 0:
        parts.pop(0)
    if not parts:
        return "< 01s"
    return " ".join(f"{v}{u}" if u == "d" else f"{v:02d}{u}" for u, v in parts)


def test_formatters_agree_with_reference_rules(spark):
    from opslog.functions import fmt
    rng = random.Random(3)
    sizes = [rng.randint(0, 1024 ** rng.randint(1, 5) * 3) for _ in range(3000)] + [1023, 1024, 1024 ** 2 - 1,
                                                                                    1024 ** 2, 1024 ** 4 * 5000]
    durs = [rng.randint(-10 ** 12, 10 ** 12) for _ in range(2000)] + [rng.randint(0, 10 ** 8) for _ in range(2000)] \
        + [59_500_000, 60_500_000, 500_000, 1_500_000, -1, 0]
    df = spark.createDataFrame([(sizes[i % len(sizes)], durs[i % len(durs)]) for i in range(max(len(sizes), len(durs)))],
                               "n long, us long")
    for r in df.select("n", "us", fmt.fmt_size("n").alias("s"), fmt.fmt_speed("n").alias("v"),
                       fmt.fmt_duration("us").alias("d")).collect():
        assert r.s == _size_reference(r.n, ["KB", "MB", "GB", "TB"], "bytes"), r
        assert r.v == _size_reference(r.n, ["KB/s", "MB/s", "GB/s"], "B/s"), r
        assert r.d == _duration_reference(r.us), r
