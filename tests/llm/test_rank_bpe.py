"""The rank-array BPE against the tokenizers library."""
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from opslog.llm.bpe import SHORT, RankBPE, decode_documents, encode_documents, token_digests
from opslog.llm.queries import TOKENIZER
from opslog.session import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    return RankBPE(TOKENIZER), Tokenizer.from_file(TOKENIZER)


def same(both, text):
    mine, theirs = both
    ids = theirs.encode(text, add_special_tokens=False).ids
    got = mine.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids, text[:200]
    assert mine.decode(got) == theirs.decode(ids, skip_special_tokens=False)


def test_every_code_point(both):
    for first in range(0, 0x110000, 0x400):
        points = [c for c in range(first, first + 0x400) if not 0xD800 <= c < 0xE000]
        same(both, " ".join(f"a{chr(c)}b {chr(c)}" for c in points))
        same(both, "".join(map(chr, points)))


def test_mixtures(both):
    rnd = random.Random(4)
    parts = [*"ab'sßé̸< >|\n\t\x85\x1cΣσİ12.-,", "<|endoftext|>", "<|startoftext|>", "'ll", "'S", "the", "</w>", "ing."]
    for _ in range(5000):
        same(both, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))))


def test_long_words_merge_in_the_same_order(both):
    rnd = random.Random(5)
    for n in (SHORT - 1, SHORT, SHORT + 1, 3000):
        for letters in ("a", "ab", "thein", "é1", "abcdefghijklmnop"):
            same(both, "".join(rnd.choice(letters) for _ in range(n)))


def test_caches_and_stretches(both, monkeypatch):
    from opslog.llm import bpe
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "STRETCH", 11)
    for text in ("one two three four five one two. six, seven one " * 9, "a\x85b　c d" * 20, "word" * 30):
        same((RankBPE(TOKENIZER), both[1]), text)


def test_query_rows(spark, both):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in token_digests(docs, TOKENIZER).collect()}
    assert len(rows) == docs.count()
    for d in docs.collect():
        ids = both[1].encode(d.text or "", add_special_tokens=False).ids
        text = both[1].decode(ids, skip_special_tokens=False)
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark, both, monkeypatch):
    from opslog.llm import bpe
    monkeypatch.setattr(bpe, "OUT_BYTES", 100)  # batches are handed back in parts
    ship_package(spark)
    texts = [None, "", " \n ", "same", "same", "long " * 60_000, "x" * 2000, "tie"]
    docs = spark.createDataFrame([(None if i % 3 == 0 else i // 2, t, i, "d") for i, t in enumerate(texts)], "doc_id long, text string, ids long, decoded string")
    enc = decode_documents(encode_documents(docs, TOKENIZER), TOKENIZER).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in enc) == sorted(
        (str(None if i % 3 == 0 else i // 2), both[1].decode(both[1].encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False))
        for i, t in enumerate(texts))
    assert token_digests(docs.where("false"), TOKENIZER).collect() == []
    assert decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), TOKENIZER).first().decoded == ""
