"""Language identification of mixed-language text.

A word is a maximal run of letters.  Its script, from fixed code point ranges,
narrows the candidates to the languages that were learned with that script;
hashed letter bigrams, trigrams and quadgrams give the word a log-likelihood
for each candidate; a Viterbi pass with a penalty for every switch labels the
words, so that a foreign quotation becomes a span of its own instead of
blurring the whole text.  The document's language is the one that holds most
letters, its score their share.

Counts are gathered by Spark from a sample of labelled rows of documented size
(``PER_LANG`` documents of each language, by a hash of the id); every label is
learned, and what reaches the driver is one table of ``BUCKETS`` counts per
language.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslog.llm.common import grouped, held_out, slices, utf8_cells

BUCKETS = 1 << 15
PER_LANG = 4000
ROWS, GROUP_BYTES = 1000, 1 << 21  # rows and bytes of texts that are labelled together
SWITCH = 8.0  # nats that a change of language costs
SCRIPT_SHARE = 0.005  # of a language's letters, for the script to count as one of its own
NOT_A_CANDIDATE = -1e4

# First code points of scripts, each up to the next entry; 0 is "any other".
SCRIPTS = [(0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7),
           (0x0980, 8), (0x0A00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 0), (0x1E00, 1),
           (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x3040, 12), (0x3100, 0), (0x3130, 11), (0x3190, 0),
           (0x3400, 13), (0xA000, 0), (0xA640, 3), (0xA6A0, 0), (0xA720, 1), (0xA800, 0), (0xAC00, 11), (0xD800, 0),
           (0xF900, 13), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 1), (0xFF66, 12),
           (0xFFA0, 11), (0xFFE0, 0), (0x20000, 13)]
N_SCRIPTS = 14


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _script(cp: np.ndarray) -> np.ndarray:
    starts, ids = np.array([s for s, _ in SCRIPTS]), np.array([i for _, i in SCRIPTS])
    return ids[np.searchsorted(starts, cp, side="right") - 1]


def letter_grams(text: str):
    """Of the lower-cased text's letters: word number, word starts among the letters, scripts of words, gram buckets.

    ``buckets`` has a row for each gram size; a neighbour that is no letter is 0, so grams know where words begin and end.
    """
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[cp]
    c = np.zeros(len(cp) + 3, np.uint64)
    c[2:-1] = np.where(is_letter, cp, 0)
    at = np.flatnonzero(is_letter)
    if not len(at):
        return None
    first = np.flatnonzero(~np.concatenate([[False], is_letter[:-1]])[at])
    c0, c1, c2 = c[at + 2], c[at + 1], c[at + 3]
    before = np.where(c1 > 0, c[at], 0)
    two = c1 * np.uint64(0x9E3779B97F4A7C15) + c0 * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two + c2 * np.uint64(0x165667B19E3779F9) + np.uint64(1)
    four = three + before * np.uint64(0x27D4EB2F165667C5) + np.uint64(2)
    shift = np.uint64(64 - 15)
    buckets = np.stack([((g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> shift for g in (two, three, four)])
    return at, first, _script(cp[at[first]]), buckets.astype(np.int64)


@dataclass
class LangModel:
    langs: list[str]
    logp: np.ndarray  # (BUCKETS, L)
    script: np.ndarray  # (N_SCRIPTS, L): 0, or NOT_A_CANDIDATE
    prior: int  # the most frequent language

    @staticmethod
    def from_counts(langs: list[str], counts: np.ndarray, scripts: np.ndarray) -> "LangModel":
        grams, letters = counts.sum(axis=0), np.maximum(scripts.sum(axis=0), 1)
        logp = np.log((counts + 0.5) / (grams + 0.5 * BUCKETS)).astype(np.float32) / 3  # three grams share a letter
        own = scripts / letters >= SCRIPT_SHARE
        return LangModel(langs, logp, np.where(own, 0, NOT_A_CANDIDATE).astype(np.float32), int(grams.argmax()) if langs else 0)

    def word_scores(self, text: str):
        """(letters of each word, scores (words, L), known); a word in a script that no language has is neutral, not known."""
        g = letter_grams(text)
        if g is None:
            return np.empty(0, np.int64), np.empty((0, len(self.langs)), np.float32), np.empty(0, bool)
        at, first, script, buckets = g
        per = self.logp[buckets[0]] + self.logp[buckets[1]] + self.logp[buckets[2]]
        narrow = self.script[script]
        known = narrow.max(axis=1) == 0
        scores = np.add.reduceat(per, first, axis=0) + narrow
        scores[~known] = 0
        return np.diff(np.append(first, len(at))), scores, known

    def label(self, scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
        """Viterbi paths of several documents in step, the longest first; a step of the loop moves all of them by a word."""
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        size = np.array([len(scores[i]) for i in order])
        total, n_langs = int(size.sum()), len(self.langs)
        if not total:
            return [np.empty(0, np.int64) for _ in scores]
        flat = np.concatenate([scores[i] for i in order])
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        best_before = np.zeros(total, np.uint16)
        stays = np.ones((total, n_langs), bool)
        v = np.zeros((len(order), n_langs), np.float32)
        active = len(size) - np.searchsorted(size[::-1], np.arange(1, size[0] + 1))
        for t in range(size[0]):
            a = active[t]
            rows, cur = first[:a] + t, v[:a]
            if t:
                top = cur.argmax(axis=1)
                floor = cur[np.arange(a), top][:, None] - switch
                stay = cur >= floor
                best_before[rows], stays[rows] = top, stay
                cur = np.where(stay, cur, floor)
                cur -= cur.max(axis=1, keepdims=True)
            v[:a] = cur + flat[rows]
        path = np.zeros(total, np.int64)
        state = v.argmax(axis=1)
        for t in range(size[0] - 1, -1, -1):
            a = active[t]
            rows, s = first[:a] + t, state[:a]
            path[rows] = s
            if t:
                state[:a] = np.where(stays[rows, s], s, best_before[rows])
        out: list = [None] * len(scores)
        for k, i in enumerate(order):
            out[i] = path[first[k]:first[k] + size[k]]
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, share of the letters) of each text; 'und' and 0 without a letter or without a learned language.

        No language holds a neutral word, so letters of scripts that were not learned lower the share; a text of such
        letters alone gets the most frequent language with a share of 0.
        """
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        words = [self.word_scores(t) for t in texts]
        out = []
        for (letters, _, known), path in zip(words, self.label([s for _, s, _ in words])):
            if not len(letters):
                out.append(("und", 0.0))
                continue
            held = np.bincount(path, letters * known, len(self.langs))
            k = int(held.argmax()) if known.any() else self.prior
            out.append((self.langs[k], float(held[k] / letters.sum())))
        return out

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(language, start, end) of the labelled spans, as code points of the lower-cased text."""
        g = letter_grams(text)
        if g is None or not self.langs:
            return []
        at, first, _, _ = g
        letters, scores, _ = self.word_scores(text)
        path = self.label([scores])[0]
        cut = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]]))
        last = np.append(cut[1:], len(path)) - 1
        return [(self.langs[path[a]], int(at[first[a]]), int(at[first[b] + letters[b] - 1]) + 1) for a, b in zip(cut, last)]


def fit_languages(docs: DataFrame, per_lang: int = PER_LANG) -> LangModel:
    """Learn from text and non-null lang of documents that are not held out.

    About ``per_lang`` documents of each language, by hash of id and text.  Without such rows the model knows no language.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select("doc_id", "lang", "text")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    langs = sorted(sizes)
    if not langs:
        return LangModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), np.float32), 0)
    keep = F.lit(False)
    for lang in langs:
        keep = keep | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", "text", F.lit("lang sample")), F.lit(1_000_000))
                                                  < int(1_000_000 * min(1.0, per_lang / sizes[lang]))))
    width = BUCKETS + N_SCRIPTS
    number = {lang: k for k, lang in enumerate(langs)}

    def count(batches):
        import pyarrow as pa
        seen: dict[int, np.ndarray] = {}
        for batch in (part for whole in batches for part in slices(whole)):
            for lang, cell in zip(batch.column(0).to_pylist(), utf8_cells(batch.column(1))):
                g = letter_grams(cell.decode("utf-8", "replace"))
                if g is None:
                    continue
                own = seen.setdefault(number[lang], np.zeros(width, np.int64))
                at, first, script, buckets = g
                own[:BUCKETS] += np.bincount(buckets.ravel(), minlength=BUCKETS)
                own[BUCKETS:] += np.bincount(script, np.diff(np.append(first, len(at))), N_SCRIPTS).astype(np.int64)
        for k, own in seen.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)),
                                              pa.array(own[at])], names=["lang", "cell", "n"])

    rows = (known.where(keep).select("lang", "text").mapInArrow(count, "lang int, cell int, n long")
            .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())  # at most languages * width rows
    table = np.zeros((width, len(langs)))
    table[rows["cell"], rows["lang"]] = rows["n"]
    return LangModel.from_counts(langs, table[:BUCKETS], table[BUCKETS:])


def identify(docs: DataFrame, model: LangModel, pred: str = "lang_pred", score: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with the predicted language and its share of the letters; every other column is kept (text if ``keep_text``).

    Null text and text without a letter give 'und' and 0.  Columns of the two new names are replaced.
    """
    read = [c for c in docs.columns if c not in (pred, score)]
    rest = [c for c in read if keep_text or c != "text"]
    at, text = [read.index(c) for c in rest], read.index("text")

    def scan(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in slices(whole, ROWS)):
            cells, out = utf8_cells(batch.column(text)), []
            for a, b in grouped(cells, GROUP_BYTES):
                out += model.predict([c.decode("utf-8", "replace") for c in cells[a:b]])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in at), pa.array([o[0] for o in out], pa.string()),
                                              pa.array([o[1] for o in out], pa.float64())], names=[*rest, pred, score])

    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in rest]
                          + [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.select(*read).mapInArrow(scan, schema)


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the rows that are not held out."""
    model = fit_languages(docs)
    return identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model, keep_text=False)
