"""Set-similarity joins, substring dedup, snapshots, components: brute force on small tables with every odd case."""
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslog.llm import line_dedup, ngram_join
from opslog.llm.chat_prefix import format_chats
from opslog.llm.components import components
from opslog.llm.line_dedup import dedup_lines, document_lines
from opslog.llm.ngram_join import jaccard_components
from opslog.llm.superkmer import dedup_substrings
from opslog.session import materialize, ship_package

TEXTS = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def union(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_copies(seed, n_words=300):
    rnd = random.Random(seed)
    vocab = [f"W{i}" for i in range(n_words)]
    rows = []
    for g in range(30):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(3, 120))]
        for _ in range(40 if g % 10 == 0 else rnd.choice([1, 2, 5])):
            w = list(base)
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, "one"), (n + 3, "ONE"), (n + 4, "one two"), (n + 5, " \t\n"), (n + 6, "b c d " * 3000)]


@pytest.mark.parametrize("k,num,few,block", [(3, 90, 128, 1000), (3, 90, 4, 10), (5, 80, 3, 7)])
def test_jaccard_components(spark, k, num, few, block):
    rows = near_copies(5)

    def shingles(t):
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    sets = [shingles(t) for _, t in rows]
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= num * len(a | b)]
    comp = union(edges, range(len(rows)))
    df = spark.createDataFrame(rows, TEXTS).withColumn("set_id", F.lit("clash")).withColumn("n", F.lit(None).cast("int"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k, num, 100, few, block).collect()}
    assert got == {d: (len(sets[d]), comp[d]) for d, _ in rows}


@pytest.mark.parametrize("few,block", [(8, 9), (128, 1000)])
def test_jaccard_drifting_copies(spark, few, block):
    """Copies that drift away from their start: leaders join only near ones, blocks have to find the rest of the chain."""
    rng, rows, doc = np.random.default_rng(7), [], 0
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(120)]
        for step in range(70):
            rows.append((doc, " ".join(words)))
            doc += 1
            for at in rng.integers(0, 120, 2 if step % 20 == 19 else 1):
                words[at] = f"x{rng.integers(1 << 30)}"
    sets = {d: {tuple(w[i:i + 3]) for i in range(len(w) - 2)} for d, w in ((d, t.split()) for d, t in rows)}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard_components(df, 3, 90, 100, few, block).collect()}
    assert got == {d: find(d) for d in sets}


def test_jaccard_writes_and_compares_little(spark, monkeypatch):
    """Prefixes of one order alone are written, and a group of near copies is not compared in all its pairs."""
    words = [f"w{i}" for i in range(200)]
    rows = [(d, " ".join([*words[:3 * d], f"x{d}", *words[3 * d + 1:]])) for d in range(60)]
    lists, compared = {}, []

    def written(df, name):
        lists[name] = max(lists.get(name, 0), sum(f.dataType.typeName() == "array" for f in df.schema.fields))
        return materialize(df, name)

    def links(pairs, *rest):
        compared.append(pairs.count())
        return pair_links(pairs, *rest)
    pair_links = ngram_join._pair_links
    monkeypatch.setattr(ngram_join, "materialize", written)
    monkeypatch.setattr(ngram_join, "_pair_links", links)
    got = jaccard_components(spark.createDataFrame(rows, TEXTS)).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(compared) < 2 * len(rows) and max(lists.values()) == 1, (compared, lists)


def test_jaccard_repeated_rows_null_ids_empty(spark):
    df = spark.createDataFrame([(2, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None)], TEXTS)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()), key=str)
    assert got == sorted([(2, 2, 1), (2, 2, 1), (1, 2, 1), (None, 2, None), (None, 0, None)], key=str)
    assert jaccard_components(df.limit(0)).count() == 0


def substring_brute(rows, k):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    seen = collections.Counter(tuple(w[i:i + k]) for _, w in words for i in range(len(w) - k + 1))
    out = []
    for d, w in words:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [20_000, 5])
def test_substrings(spark, hot):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(30)]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows = [(i, " ".join([rnd.choice(vocab) for _ in range(rnd.randint(0, 80))] + (passage[rnd.randint(0, 20):] if i % 3 == 0 else [])
                         + [rnd.choice(vocab) for _ in range(10)])) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "a " * 200), (302, "a " * 200), (None, rows[0][1]), (303, " ".join(vocab * 20)), (304, "é x " * 20)]
    df = spark.createDataFrame(rows, TEXTS).withColumn("packed", F.lit(1)).withColumn("start", F.lit("clash"))
    got = dedup_substrings(df, k=12, m=4, bits=16, hot_rows=hot)
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == substring_brute(rows, 12)


def test_substrings_empty(spark):
    assert dedup_substrings(spark.createDataFrame([], TEXTS)).count() == 0


def line_brute(rows, num=80):
    def place(d, t):
        return d is not None, d or 0, hashlib.md5(t.encode()).hexdigest()

    def shingles(x):
        w = re.findall(WORD, x)
        return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))
    lines = [((*place(d, t), i), x) for d, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    first = {}
    for at, x in lines:
        first[x] = min(first.get(x, at), at)
    sets = {x: shingles(x) for x in first}
    gone = {x for x in first for y in first if first[y] < first[x] and 100 * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]) > 0}
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        all_ = t.split("\n")
        kept = [x for i, x in enumerate(all_) if not sets[x] or (first[x] == (*place(d, t), i) and x not in gone)]
        out.append((d, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("leaders", [8, 1])
def test_lines(spark, leaders):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(200)]
    pool = [[rnd.choice(vocab) for _ in range(rnd.randint(1, 60))] for _ in range(20)]
    rows = []
    for d in range(80):
        made = []
        for _ in range(rnd.randint(0, 8)):
            w = list(rnd.choice(pool))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            made.append(rnd.choice([" ", " ", "  ", "\t"]).join(w))
        rows.append((d, "\n".join(made)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, rows[3][1]), (203, "a b c d e " * 2000), (204, "a b c d e " * 2001)]
    rows += [(None, rows[5][1] + "\nAll  rights reserved."), (None, "All rights reserved.\nx"), (7, "All rights reserved."), (7, rows[8][1]), (205, "x")]
    df = spark.createDataFrame(rows, TEXTS).withColumn("line", F.lit(1)).withColumn("id", F.lit("clash"))
    got = dedup_lines(df, leaders=leaders).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == line_brute(rows)


@pytest.mark.parametrize("few", [1, 3, 64])
def test_lines_of_large_buckets(spark, few):
    rnd = random.Random(8)
    stem = [f"s{i}" for i in range(40)]  # a common passage: its shingles are in the buckets of many lines
    rows = []
    for d in range(120):
        w = stem[:rnd.randint(20, 40)] + [f"o{d // 3}-{i}" for i in range(rnd.randint(0, 30))]
        if rnd.random() < 0.5:
            w[rnd.randrange(len(w))] = "edit"
        rows.append((d, "\n".join([" ".join(w), "short line", " ".join(stem)][:rnd.randint(1, 3)])))
    rows += [(None, rows[0][1]), rows[1], rows[1]]
    got = dedup_lines(spark.createDataFrame(rows, TEXTS), leaders=2, few=few).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == line_brute(rows)


def test_line_names_are_made_once_a_document(spark):
    plan = document_lines(spark.createDataFrame([(1, "a\nb")], TEXTS))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "md5" in below and "md5" not in above  # above the generator, each line would hash its document's whole text


def test_lines_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f\nx"), (1, "a b c d e f\nx"), (2, "a b c d e f")], TEXTS)
    got = sorted((r.doc_id, r.text, r.n_removed) for r in dedup_lines(df).collect())
    assert got == [(1, "a b c d e f\nx", 0), (1, "a b c d e f\nx", 0), (2, "", 1)]
    assert dedup_lines(df.limit(0)).count() == 0


def test_rarity_is_no_literal_of_a_plan(spark, monkeypatch):
    rows = [(d, f"common words at the start of line {d} and more of them") for d in range(20)]
    df = spark.createDataFrame(rows, TEXTS)
    sizes = {}

    def written(df, name):
        sizes[name] = len(df._jdf.queryExecution().toString())
        return materialize(df, name)
    monkeypatch.setattr(line_dedup, "materialize", written)
    got = line_dedup.dedup_lines(df, few=1).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == line_brute(rows)
    assert "rare" in sizes and max(sizes.values()) < 200_000, sizes  # a literal of all counters alone takes 500,000 letters


def test_snapshots(spark):
    rnd = random.Random(4)
    base = [[("user" if i % 2 == 0 else "assistant", f"t{rnd.randint(0, 3)}") for i in range(8)] for _ in range(6)]
    rows = [(c, i, *b[i]) for c in range(60) for b in [rnd.choice(base)] for i in range(rnd.randint(1, 8))]
    rows += [(500, i, "user", f"x{i}") for i in range(1500)] + [(501, i, "user", f"x{i}") for i in range(1300)]
    rows += [(None, 0, "user", None), (None, 1, None, "q"), (502, 0, "user", ""), rows[0], rows[0]]
    seq = {}
    for c, _, r, x in sorted(set(rows), key=lambda z: (z[0] is not None, z[0] or 0, z[1])):
        seq.setdefault(c, []).append((r, x))
    kept = [c for c, s in seq.items() if not any(len(o) > len(s) and o[:len(s)] == s for o in seq.values())
            and not any(o == s and d != c and (d is None or (c is not None and d < c)) for d, o in seq.items())]
    want = {c: "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in seq[c]) for c in kept}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("clash"))
    got = collections.defaultdict(dict)
    for r in format_chats(df, part_turns=1000).collect():
        got[r.conv_id][r.part] = r.text
        assert r.n_turns == len(seq[r.conv_id])
    assert {c: "".join(p[i] for i in sorted(p)) for c, p in got.items()} == want
    assert len(got[500]) == 2
    assert format_chats(df.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(5001, 5300)]
    nodes = {x for e in edges for x in e}
    want = {n: c for n, c in union(edges, nodes).items() if any(n in e and e[0] != e[1] for e in edges)}
    df = spark.createDataFrame(edges + [(None, 1)], "u long, v long")
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0
