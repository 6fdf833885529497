"""Ranked search against plain loops; the K2-treap against a dense grid."""
import math
import random
import re
from collections import Counter

import numpy as np

from opslog.llm import k2_search
from opslog.llm.k2_search import Best, Treap, corpus_size, count_terms, index_documents, ranked_search, search_items, terms
from opslog.session import materialize, ship_package

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scores = []
        for doc_id, bag in bags:
            tf, score = Counter(bag), 0
            for t in set(words(text)):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 90 + (90 * len(bag) * n_docs) // total
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr((r.item_id, r["rank"], r.doc_id, r.score)) for r in df.collect())


def test_terms_of_bytes():
    texts = ["", "a", "A-b 9", "été ÉTÉ", "\x00\x7f", "x" * 9 + "\n", "漢字 kanji·x", " lead", "snake_case a@b"]
    cells = [t.encode() for t in texts]
    h, bounds = terms(cells)
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts] == count_terms(cells).tolist()
    name = dict(zip([w for t in texts for w in words(t)], h.tolist()))
    assert len(set(name.values())) == len(name) and h.tolist() == [name[w] for t in texts for w in words(t)]


def test_treap_finds_the_best_of_a_dense_grid():
    rnd = np.random.default_rng(3)
    for n_terms, n_docs, share in ((1, 1, 1.0), (1, 9, 1.0), (40, 3, 0.5), (30, 200, 0.2), (5, 130, 0.9)):
        grid = np.where(rnd.random((n_terms, n_docs)) < share, rnd.integers(1, 1000, (n_terms, n_docs)), 0)
        names = np.sort(rnd.choice(10**9, n_terms, replace=False)).astype(np.uint64)
        t, d = np.nonzero(grid)
        treap = Treap.unpack(*Treap.build(names[t], d, grid[t, d], n_docs).pack()).open()
        for _ in range(20):
            rows_ = rnd.choice(n_terms, rnd.integers(1, n_terms + 1), replace=False)
            w = rnd.integers(0, 30, len(rows_))
            best = Best(10)
            best.ids = [(1, -int(i)) for i in range(n_docs)]
            treap.search(np.append(names[rows_], np.uint64(5)), np.append(w, 7), best)  # and a term that is nowhere
            score = (grid[rows_] * w[:, None]).sum(axis=0)
            want = sorted(((int(s), 1, -i) for i, s in enumerate(score) if s > 0), reverse=True)[:10]
            assert sorted(best.heap, reverse=True) == want


def test_same_as_plain_loops(spark):
    ship_package(spark)
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ranked_search(docs, items)) == want


def test_blocks_and_groups_of_items_change_nothing(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(k2_search, "ITEMS_ROWS", 3)
    monkeypatch.setattr(k2_search, "OPEN", 2)
    rnd = random.Random(6)
    vocab = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rnd.choices(vocab, weights=range(30, 0, -1), k=rnd.randint(0, 40)))) for i in range(150)]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(0, 8)))) for i in range(8)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    size = corpus_size(d)
    for points, most in ((1, 5), (40, 7), (10**6, 10**6)):
        index = materialize(index_documents(d, size, points, most), "index")
        assert rows(search_items(index, spark.createDataFrame(items, "item_id long, text string"), size[0])) == brute(docs, items)


def test_odd_rows(spark):
    ship_package(spark)
    docs = [(None, "apple pear"), (None, "apple pear"), (3, "apple pear"), (3, "apple pear"), (1, "APPLE, pear!"), (5, None), (6, ""), (7, "--- ..."),
            (8, "plum " * 50_000 + "apple"), (2, "fig"), (9, "été")]
    items = [(1, "Apple"), (1, "pear plum"), (None, "apple"), (2, None), (3, ""), (4, "?!"), (5, "nowhere"), (6, "Été été"), (1, "Apple")]
    d = spark.createDataFrame([(*r, 0, 1) for r in docs], "doc_id long, text string, score long, `rank` int")
    i = spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, doc_id long")
    assert rows(ranked_search(d, i)) == brute(docs, items)
    assert rows(ranked_search(d.where("false"), i)) == [] == rows(ranked_search(d, i.where("false")))
    assert rows(ranked_search(d.where("doc_id in (5, 6, 7)"), i)) == []
    # more ties than places
    ties = [(i, "same text") for i in range(40)] + [(100, "other")]
    assert rows(ranked_search(spark.createDataFrame(ties, "doc_id long, text string"), i.limit(0).unionByName(
        spark.createDataFrame([(1, "text", 0)], "item_id long, text string, doc_id long")))) == brute(ties, [(1, "text")])
