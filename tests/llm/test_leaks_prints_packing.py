"""Decontamination, fingerprints, packing and the pipeline: brute force, round trips, planted cases."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from opslog.llm.best_fit import (
    SEQUENCE, STEPS, WordTokenizer, fill, pack_documents, pack_plan, plan_rows, sequences, solve_lp, tokenize,
)
from opslog.llm.cgk import MIN_WORDS, ItemIndex, edit_place, find_leaks
from opslog.llm.common import doc_words
from opslog.llm.prefix_hash import PrefixHash, SEED, code_points, edited, fingerprint_documents, likeness
from opslog.llm.queries import TOKENIZER
from opslog.session import ship_package

SF = "/root/testdata/sf0.001"
TEXTS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def distance(x, y):
    d = list(range(len(y) + 1))
    for i, p in enumerate(x):
        n = [i + 1]
        for j, q in enumerate(y):
            n.append(min(d[j] + (p != q), d[j + 1] + 1, n[j] + 1))
        d = n
    return d[-1]


def test_edit_place_is_the_best_span():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.randrange(4) for _ in range(rnd.randint(1, 6))]
        b = [rnd.randrange(4) for _ in range(rnd.randint(0, 9))]
        e, s, t = edit_place(np.array(a), np.array(b, dtype=np.int64))
        assert e == distance(a, b[s:t]) == min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))


def test_recall_of_edited_passages(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index, rnd, hit = ItemIndex(items), random.Random(2), 0
    for _ in range(200):
        i, t = rnd.choice(items)
        w = t.split()
        for _ in range(rnd.randint(0, int(0.2 * len(w)))):
            k, kind = rnd.randrange(len(w)), rnd.randrange(3)
            w[k:k + (kind != 1)] = ["changed"] if kind != 2 else []
        pad = [f"p{rnd.randrange(50)}" for _ in range(rnd.randint(0, 90))]
        h = doc_words(" ".join(pad + w + pad[:20]).encode())[2]
        hit += any(r[1] == i for r in index.search(h, np.array([0, len(h)])))
    assert hit >= 190


@pytest.mark.parametrize("n", [5, 20, 40, 64])
def test_recall_of_evenly_edited_items_of_hard_lengths(n):
    rnd = random.Random(n)
    easy = [(10_000 + i, " ".join(f"e{rnd.randrange(20_000)}" for _ in range(14))) for i in range(500)]
    items = [(i, " ".join(f"v{rnd.randrange(20_000)}" for _ in range(n))) for i in range(500)]
    index, hit = ItemIndex(easy + items), 0
    for i, t in items[-300:]:
        w, d = t.split(), n // 5
        for e in range(d):
            w[(2 * e + 1) * n // (2 * d)] = f"changed{e}"
        pad = [f"p{rnd.randrange(5000)}" for _ in range(rnd.randint(0, 40))]
        h = doc_words(" ".join(pad + w + pad[:9]).encode())[2]
        hit += any(r[1] == i for r in index.search(h, np.array([0, len(h)])))
    assert hit >= 0.92 * 300


def test_a_target_out_of_reach_is_an_error():
    with pytest.raises(ValueError, match="repetitions find"):
        ItemIndex([(1, "a b c d e")], target=1.01)


def test_exact_passages_and_nothing_else(spark, docs):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = docs.collect()
    want = {(r.doc_id, b.item_id) for b in benchmark.collect() for r in rows
            if " " + " ".join(b.text.split()) + " " in " " + " ".join(r.text.split()) + " "}
    got = find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.edits == 0} == want and want
    text = {r.doc_id: r.text.split() for r in rows}
    item = {b.item_id: b.text.split() for b in benchmark.collect()}
    for r in got:
        assert distance(item[r.item_id], text[r.doc_id][r.start:r.start + r.length]) == r.edits <= 0.2 * len(item[r.item_id])


def test_leaks_odd_rows(spark, docs):
    item = " ".join(f"i{k}" for k in range(20))
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "two words"), (None, item)], "item_id long, text string")
    rows = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (None, "x " * 50_000 + item, 0), (5, "two words", 0)],
                                 TEXTS + ", item_id int")
    got = sorted(((r.doc_id, r.item_id, r.start, r.edits) for r in find_leaks(rows, items).collect()), key=str)
    assert got == sorted([(1, 1, 0, 0), (1, 1, 0, 0), (None, 1, 50_000, 0)], key=str) and MIN_WORDS > 2
    assert find_leaks(rows, items.limit(0)).count() == 0 and find_leaks(rows.limit(0), items).count() == 0


@given(st.text("ab", max_size=30), st.text("ab", max_size=30), st.integers(0, 30), st.integers(0, 30))
@settings(max_examples=200, deadline=None)
def test_prefix_hash_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    x, y = PrefixHash(code_points(a)), PrefixHash(code_points(b))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert x.common_extension(i, y, j) == n
    assert (x.fingerprint() == y.fingerprint()) == (a == b)
    assert likeness(x.fingerprint(), y.fingerprint()) == likeness(y.fingerprint(), x.fingerprint()) <= 1


def shared_run(a, i, b, j, step):
    n = 0
    while 0 <= i + n * step < len(a) and 0 <= j + n * step < len(b) and a[i + n * step] == b[j + n * step]:
        n += 1
    return n


def alike(a, b):
    """Likeness of two texts by plain string search."""
    if len(a) > len(b):
        return alike(b, a)
    if not a:
        return float(not b)
    head = shared_run(a, 0, b, 0, 1)
    if a == b:
        return 1.0
    tail = min(shared_run(a, len(a) - 1, b, len(b) - 1, -1), len(a) - head)
    end, there, shared, done, shift = len(a) - tail, len(b) - tail, head + tail, head, None
    for i in range(head, end - SEED + 1, SEED):
        j = b.find(a[i:i + SEED], head, there)
        if i + SEED <= done or j < 0:
            continue
        if shift is not None and head <= i + shift <= there - SEED and b[i + shift:i + shift + SEED] == a[i:i + SEED]:
            j = i + shift
        shift = j - i
        start = max(done, i - shared_run(a, i - 1, b, j - 1, -1))
        stop = min(end, i + shared_run(a, i, b, j, 1))
        shared += max(0, stop - start)
        done = max(done, stop)
    return shared / len(b)


def test_likeness_by_extensions():
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(3000))

    def near(a, b):
        x, y = PrefixHash(code_points(a)), PrefixHash(code_points(b))
        assert x.likeness(y) == alike(a, b)
        return x.likeness(y)
    assert near("x" + text, text) > 0.99  # one code point put in front
    assert near(text[:700] + "Z" + text[700:1500] + text[1501:2500] + "YY" + text[2500:], text) > 0.97
    assert near(text[1500:] + text[:1500], text) > 0.97  # halves swapped
    for i in range(50, 3000, 100):  # one change in each of a grid's spans
        text = text[:i] + "Z" + text[i + 1:]
    assert near(text, text.replace("Z", "Y")) > 0.7 and near(text, text[::-1]) < 0.05
    assert near("", "") == 1 and near("", "a") == 0 and near("ab" * 900, "ab" * 1000 + "c") > 0.85 and near("a" * 99, "a" * 99) == 1
    for _ in range(150):  # repeated phrases, cuts and moves
        bits = [text[k:k + rnd.randint(1, 90)] for k in (rnd.randrange(2900) for _ in range(4))]
        near("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))))


def test_fingerprints(spark, docs):
    rnd = random.Random(1)
    rows = [(i * 3, "".join(rnd.choice("aé\U0001F600 ") for _ in range(rnd.randint(0, 50)))) for i in range(150)]
    rows += [(None, "x"), (6, "dup"), (6, None), (9, "long " * 50_000)]

    def mark(t):
        return PrefixHash(code_points(t)).fingerprint()
    for part in (rows, rows[:1], rows[:2]):
        order = sorted(((d, t or "") for d, t in part), key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode()))
        want = []
        for i, (d, t) in enumerate(order):
            n = order[(i + 1) % len(order)][1]
            e = edited(t, n)
            want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), mark(t), mark(e), alike(t, e), alike(t, n)))
        df = spark.createDataFrame(part, TEXTS).withColumn("bucket", F.lit("clash"))
        assert sorted((tuple(r) for r in fingerprint_documents(df).collect()), key=str) == sorted(want, key=str)
    assert fingerprint_documents(df.limit(0)).count() == 0


def test_half_edited_texts_are_near_and_others_far(docs):
    rows = fingerprint_documents(docs.where("n_chars > 40")).collect()
    assert min(r.near_edited for r in rows) > 0.4
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(TOKENIZER)


def same(words, text):
    return np.frombuffer(words.ids(text), "<u4").tolist() == words.full.encode(text, add_special_tokens=False).ids


def test_tokens_are_the_library_s(words, docs):
    assert all(same(words, r.text) for r in docs.collect())


@given(st.text(st.sampled_from("abcdeEFGßéèñÀŸžıİµªº'´`^~.,;:!?-_()[]{}<>|/\\@#$%&*+=\"019²½ \n\t\r\x0b\x1c\x85\xa0 Ωж中́"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_tokens_of_odd_texts(words, text):
    assert same(words, text) and same(words, text + "<|endoftext|> it's")


@given(st.lists(st.integers(0, 9), min_size=1, max_size=24))
@settings(max_examples=60, deadline=None)
def test_plans_hold_every_piece_once(counts):
    counts = np.array([0, *counts])
    cap = len(counts) - 1
    plan = pack_plan(counts)
    assert (sum((c * t for c, t in plan), np.zeros(cap + 1, np.int64)) == counts).all()
    assert all((c * np.arange(cap + 1)).sum() <= cap and t > 0 for c, t in plan)
    assert sequences(plan) <= sequences(fill(counts))
    for step in STEPS:
        found, between, lower = solve_lp(counts, step)
        assert (sum((c * x for c, x in found + between), np.zeros(cap + 1, np.int64)) == counts).all()
        assert lower <= sequences(plan) + 1e-6 and all((c * np.arange(cap + 1)).sum() <= cap for c, _ in found)
    rows = plan_rows(plan)
    for length in np.flatnonzero(counts):
        spans = sorted((r[1], r[2]) for r in rows if r[0] == length)
        assert spans[0][0] == 0 and spans[-1][1] == counts[length] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_the_words_kept_stay_few():
    own = WordTokenizer(TOKENIZER)
    text = " ".join(f"w{i}" for i in range(60_000)) + " w59999 w7"
    assert own.ids(text) == np.array(own.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(own.cache) <= 50_000


def test_the_program_places_nearly_all_tokens():
    rnd = np.random.default_rng(3)
    lengths = np.minimum(rnd.lognormal(5.5, 1.0, 6000).astype(int) + 1, SEQUENCE)
    for times in (1, 30):
        counts = np.bincount(lengths, minlength=SEQUENCE + 1) * times
        found, between, lower = solve_lp(counts)
        held = sum(int((c * np.arange(SEQUENCE + 1)).sum()) * t for c, t in found)
        assert held >= 0.9 * int((counts * np.arange(SEQUENCE + 1)).sum())
        assert np.ceil(lower - 1e-6) <= sequences(pack_plan(counts)) <= min(sequences(fill(counts)), lower + 2)


def check_packed(pieces, most):
    by = {}
    for r in pieces:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_packing(spark, docs):
    rows = spark.createDataFrame([(10 ** 6, None), (10 ** 6 + 1, ""), (10 ** 6 + 2, "word " * 9000), (None, "x"), (None, "x")], TEXTS)
    both = docs.select("doc_id", "text").unionByName(rows)
    got = pack_documents(both.withColumn("length", F.lit("clash")), TOKENIZER).collect()
    n = check_packed(got, SEQUENCE)
    assert n <= -(-sum(r.length for r in got) // SEQUENCE) + 2
    ids = {(r.doc_id, r.piece): r for r in tokenize(both.where("doc_id is not null"), TOKENIZER, with_ids=True).collect()}
    texts = {r.doc_id: r.text for r in both.collect()}
    full = WordTokenizer(TOKENIZER).full
    for r in got:
        if r.doc_id is not None:
            assert zlib.crc32(ids[r.doc_id, r.piece].ids) == r.ids_crc32 and r.start == SEQUENCE * r.piece
    for d, t in texts.items():
        if d is not None:
            data = b"".join(bytes(ids[d, p].ids) for p in range(sum(1 for k in ids if k[0] == d)))
            assert np.frombuffer(data, "<u4").tolist() == full.encode(t or "", add_special_tokens=False).ids + [0]
    assert pack_documents(both.limit(0), TOKENIZER).count() == 0


def test_pipeline_stages(spark, docs):
    """Every stage against its own input: what it must drop goes, clean documents stay, columns are kept."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = [r.text for r in docs.where("lang = 'en' and n_chars between 600 and 3000").orderBy("doc_id").limit(5).collect()]
    fresh = " ".join(f"own{i}" for i in range(80))
    planted = [(10 ** 6, None), (10 ** 6 + 1, "12 !"), (10 ** 6 + 2, fresh), (10 ** 6 + 3, fresh + " end"),
               (10 ** 6 + 4, " ".join(f"q{i}" for i in range(60)) + " " + item)]
    more = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in planted], docs.schema)
    given_ = docs.unionByName(more)
    ids = lambda df: {r.doc_id for r in df.collect()}
    kept = corpus_pipeline.language_id(spark, given_, SF)
    assert ids(given_) - ids(kept) >= {10 ** 6, 10 ** 6 + 1} and kept.columns == docs.columns
    assert len(ids(given_) - ids(kept)) <= 4
    lines = corpus_pipeline.line_dedup(spark, given_, SF)
    assert lines.columns == docs.columns and {10 ** 6, 10 ** 6 + 2} <= ids(lines) and 10 ** 6 + 3 not in ids(lines)
    assert all(r.n_chars == len(r.text) for r in lines.where("text is not null and doc_id < 1000000").collect())
    near = corpus_pipeline.near_duplicates(spark, given_, SF)
    assert 10 ** 6 + 2 in ids(near) and 10 ** 6 + 3 not in ids(near) and near.columns == docs.columns
    leaks = ids(find_leaks(given_, spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert ids(given_) - ids(corpus_pipeline.decontamination(spark, given_, SF)) == leaks and 10 ** 6 + 4 in leaks
    assert clean and [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_pipeline_drops_rows_not_ids(spark, docs):
    """A null or shared id does not take clean rows along; identical rows become one."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    rows = [(None, text["a"] + " " + item), (None, text["b"]), (7, text["c"] + " " + item), (7, text["d"])]

    def frame(rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], docs.schema)

    def left(df):
        return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert left(corpus_pipeline.decontamination(spark, frame(rows), SF)) == sorted([rows[1], rows[3]], key=str)
    near = [(1, text["a"]), (7, text["a"] + " end"), (7, text["b"]), (8, text["c"]), (8, text["c"]), (None, text["d"]), (None, text["d"]),
            (None, text["e"]), (9, text["e"] + " end"), (5, None), (5, None), (None, "")]
    want = [near[0], near[2], near[3], near[5], near[8], near[9], near[10], near[11]]
    assert left(corpus_pipeline.near_duplicates(spark, frame(near), SF)) == sorted(want, key=str)


def test_pipeline_whole_and_empty(spark, docs, tmp_path):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and check_packed(out, SEQUENCE) <= -(-sum(r.length for r in out) // SEQUENCE) + 2
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
