"""The conversation trie against plain loops over all prefixes."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from opslog.llm.prefix_trie import conversation_trie, split_component
from opslog.session import ship_package

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The trie of the rebuilt conversations, every total by looking at every pair of nodes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        base = c if c is None else c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    least = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    leaf = {p for p in members if not any(q[:-1] == p and q for q in members)}
    saved = {p: (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p, m in members.items()}
    out = []
    for p, m in members.items():
        under = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in m if c is not None and len(rebuilt[c]) == len(p))
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(m), sum(len(q) == len(p) + 1 for q in under), sum(q in leaf for q in under),
                    sum(saved[q] for q in under), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def key(rows):
    return sorted(map(repr, rows))


def run(spark, rows, **options):
    ship_package(spark)
    got = conversation_trie(spark.createDataFrame(rows, TURNS), **options).select(*COLUMNS).collect()
    return key(map(tuple, got))


def chats(seed, n=60):
    rnd, rows = random.Random(seed), []
    for c in range(n):
        length = rnd.choice([0, 1, 2, 3, 5, 9])
        rows += [(c, t, rnd.choice(["user", "tool"]) if t else "user", rnd.choice(["a b", "hello there you", "a  b"])) for t in range(length)]
    return rows


@pytest.mark.parametrize("local", [200_000, 8, 1])
def test_same_as_plain_loops_whatever_is_split_over_the_cluster(spark, local):
    rows = chats(3) + [(200, t, "user", f"turn {t}") for t in range(40)]  # and one long chain
    assert run(spark, rows, local=local) == key(brute(rows))


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (5, 2, "b", ""), (5, 2, "a", None), (5, None, "z", "first"), (5, 2, "a", None),
            (-3, 1, "user", "one two"), (0, 0, "user", "one two"), (0, 1, "user", "one two three"), (7, 0, "user", "x"), (7, 0, "user", "x")]
    assert run(spark, rows) == key(brute(rows))
    assert run(spark, []) == []
    assert run(spark, rows[:2]) == key(brute(rows[:2]))


def test_copies_and_turnless_conversations(spark):
    # ids 1 to 3 have fewer turns than they take from their missing base, so some are turnless; thousands are equal
    rows = [(1000 + i, 0, "user", "same words here") for i in range(3000)] + [(c, 0, "user", "alone") for c in range(1, 8)]
    assert run(spark, rows, local=100) == key(brute(rows))


def test_extra_columns(spark):
    rows = chats(5, 12)
    ship_package(spark)
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], TURNS + ", x long, weight long, part long")
    assert key(map(tuple, conversation_trie(df).select(*COLUMNS).collect())) == key(brute(rows))


def test_split_component_adds_each_descendant_once():
    rnd = random.Random(7)
    for n in (1, 2, 30, 400):
        for reach in (1, 3, n):  # a chain, a bushy tree, a shallow one
            parent = [-1] + [max(0, i - rnd.randint(1, reach)) for i in range(1, n)]
            own = [rnd.randint(0, 9) for _ in range(n)]
            weight, total = [1] * n, list(own)
            for i in range(n - 1, 0, -1):
                weight[parent[i]] += weight[i]
                total[parent[i]] += total[i]
            got = list(own)
            split_component(parent, weight, [got])
            assert got == total
