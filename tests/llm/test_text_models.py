"""Quality network, language model, HTML blocks: held-out accuracy, small cases, odd inputs."""
import itertools

import numpy as np
import pytest

from opslog.llm.common import held_out
from opslog.llm.html_blocks import LABELLED, default_tree, extract_pages, main_text
from opslog.llm.langid import LangModel, fit_languages, identify, predict_languages
from opslog.llm.quality_cnn import CHUNK, STEP, ByteCNN, score_quality
from opslog.session import ship_package

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_chunks_cover_every_byte():
    for n in (1, 7, 8, 9, CHUNK - 1, CHUNK, CHUNK + 1, STEP + 9, 5 * STEP + 3):
        text = bytes(i % 251 for i in range(n))
        x = ByteCNN.chunks(text)
        seen = np.zeros(n, bool)
        for i, row in enumerate(x):
            part = row[: max(0, n - i * STEP)]
            assert bytes(part[part < 256].astype(np.uint8)) == text[i * STEP:i * STEP + CHUNK]
            seen[i * STEP:i * STEP + CHUNK] = True
        assert seen.all()


def test_score_in_blocks_is_the_score_of_the_whole():
    net, rng = ByteCNN(), np.random.default_rng(1)
    text = rng.integers(32, 127, 4096 * STEP + 5000).astype(np.uint8).tobytes()
    best, _ = net.pooled(net.chunks(text))
    f = np.maximum(best + net.bias, 0)
    v = np.concatenate([f.mean(axis=0), f.max(axis=0)])
    assert net.score(text) == pytest.approx(1 / (1 + np.exp(-(v @ net.out[:-1] + net.out[-1]))), abs=1e-4)


def test_quality_on_held_out_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_odd_rows(spark, docs):
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "a" * 200_000, None)], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = score_quality(rows, none).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    one = spark.createDataFrame([(1, 1), (2, None), (1, 1)], "doc_id long, quality int")
    assert score_quality(rows.limit(0), one).count() == 0


def test_languages_on_held_out_rows(docs):
    rows = predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.95


def test_mixed_text_and_odd_rows(spark, docs):
    model = fit_languages(docs)
    texts = {r.lang: r.text for r in docs.where("lang in ('en', 'de') and n_chars > 1500").select("lang", "text").dropDuplicates(["lang"]).collect()}
    spans = model.spans(texts["de"][:800] + " " + texts["en"][:800])
    assert [s[0] for s in spans] == ["de", "en"]
    rows = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "123 !? ²", 9), (4, "Привет мир", 9), (5, "the of and " * 40_000, 9)],
                                 "doc_id long, text string, score int")
    got = {r.doc_id: r for r in identify(rows, model, "__lang", "__share").collect()}
    assert [got[i]["__lang"] for i in (1, 2, 3)] == ["und"] * 3
    assert got[4]["__lang"] in model.langs and got[5]["__lang"] == "en" and got[5].score == 9
    assert [r.lang_pred for r in predict_languages(rows.withColumn("lang", rows.text.substr(1, 0)).limit(0)).collect()] == []


def test_no_labels_gives_und(spark, docs):
    rows = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert predict_languages(rows).first().lang_pred == "und"


def test_held_out_matches_crc32(spark):
    import zlib
    got = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body class="with-sidebar"><header><p>Site name</p></header>
<nav><ul><li><a href="/a">A</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<main><article><header><h1>One &amp; two</h1></header><p>First <b>bold</b>face a &lt; b.<br>Next
line</p><script>var x = "<p>no</p>";</script><form><p>Subscribe now</p></form><p><b>Open<p>No.</p>
<section class="comments"><article><p>A reader comment that is long enough to look like running text, with many words.</p></article></section>
</article></main><aside>Related</aside><footer>&copy; Site</footer></body></html>"""


def test_main_text_of_a_marked_page():
    assert main_text(PAGE) == "One & two First boldface a < b. Next line Open No."


def test_main_text_of_an_unmarked_page():
    words = "word " * 50
    page = f"<div><a href=x>Home</a></div><div><a href=y>News</a></div><p>{words}</p><p>Short one.</p><p>{words}</p><div>Copyright 2020</div>"
    assert main_text(page) == f"{words.strip()} Short one. {words.strip()}"


def test_tree_fits_its_table():
    tree = default_tree()
    assert all(tree.keep(r[:-1]) == bool(r[-1]) for r in LABELLED)


def test_pages_against_an_independent_parser(spark, docs):
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.on, self.out = False, []

        def handle_starttag(self, tag, attrs):
            self.on |= tag == "article"
            if tag != "b":
                self.out.append(" ")

        def handle_endtag(self, tag):
            if tag == "article":
                self.on = False
            if tag != "b":
                self.out.append(" ")

        def handle_data(self, data):
            if self.on:
                self.out.append(data)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        p = Article()
        p.feed(r.html)
        assert got[r.page_id].text == " ".join("".join(p.out).split())
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_pages_odd_rows(spark, docs):
    rows = spark.createDataFrame([(1, "u", None), (1, None, ""), (None, "u", "<p"), (2, "u", "<" * 5000 + "<a title='x"), (3, "u", "<p>" * 3000 + "x")],
                                 "page_id long, url string, html string")
    got = extract_pages(rows).collect()
    assert len(got) == 5 and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert extract_pages(rows.limit(0)).count() == 0


def test_viterbi_is_the_best_path_of_a_plain_loop():
    rnd = np.random.default_rng(8)
    model = LangModel(["a", "b", "c"], np.zeros((1, 3), np.float32), np.zeros((1, 3), np.float32), 0)
    for n in (1, 2, 5, 7):
        scores = [rnd.integers(-9, 9, (rnd.integers(1, n + 1), 3)).astype(np.float32) for _ in range(5)]

        def worth(s, path):
            return sum(float(s[t, k]) for t, k in enumerate(path)) - 4.0 * sum(a != b for a, b in zip(path, path[1:]))
        for s, path in zip(scores, model.label(scores, switch=4.0)):
            best = max(worth(s, p) for p in itertools.product(range(3), repeat=len(s)))
            assert worth(s, path.tolist()) == pytest.approx(best)


def test_letters_of_unlearned_scripts_are_held_by_no_language(spark):
    rows = [(i, t, lang) for i in range(40) for t, lang in (("the cat and the dog were there", "en"), ("der Hund und die Katze sind hier", "de"))]
    docs = spark.createDataFrame(rows + [(i, "the the", "en") for i in range(40, 60)], "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert model.predict(["καλημέρα κόσμε"]) == [("en", 0.0)]  # the most frequent language, with no share
    lang, share = model.predict(["the dog " + "καλημέρα " * 9])[0]
    assert lang == "en" and 0 < share < 0.3
    assert model.predict(["the dog and the cat"])[0] == ("en", 1.0)
