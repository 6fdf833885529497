"""Benchmark decontamination by CGK random-walk embedding and bit-sampling LSH.

The CGK walk reads a sequence of words: at step j it writes the word under its
pointer and moves on or stays by a random bit of (j, word).  Two sequences at a
small edit distance drift apart at an edit and fall into step again, so their
walks agree at most steps: edit distance becomes Hamming distance.  A hash of a
few sampled steps then finds near sequences as exact matches, and repetitions
with other walks and other samples raise the recall.

Items are grouped by length; a class has windows of ``W`` words (a quarter to a
half of its items, at most 32), taken at every offset of its items and, in the
documents, at every ``W / 4``-th word, so that a passage holds several windows
whatever its alignment.  Each class has its own number of repetitions: the least
that finds ``TARGET`` of edited copies of the items themselves at the largest
distance that counts, for every range of lengths in the class and for edits at
random and at even distances alike.  A class that ``MAX_REPEATS`` repetitions
do not bring there is an error.  Every hit is verified by the exact word edit
distance of the item to its best place in the text around the hit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import doc_words, group_words, grouped, mix, slices, U64, utf8_cells

SIMILARITY = 0.8
MIN_WORDS = 5  # items with fewer words are no evidence of a leak and are not searched for
SAMPLED = 6
TARGET, MAX_REPEATS, TRIALS = 0.95, 256, 400  # copies of each range of lengths and way of editing
TRIAL_WORDS = 1 << 20  # about so many words of copies, where items are very long
SLOTS = 1 << 16
ITEM_BLOCK = 64 << 20  # bytes of item text that are indexed and broadcast at once
FOUND = "doc_id long, text_key long, item_id long, start long, length long, edits long, similarity double"


def window_size(n: int) -> int:
    return max(4, min(32, 1 << max(0, n.bit_length() - 2)))


def walk_keys(h: np.ndarray, starts: np.ndarray, w: int, repeat: int) -> np.ndarray:
    """Hash of the sampled steps of the walk over ``w`` words from each start, under the walk and sample of one repetition."""
    rng = np.random.default_rng((w, repeat))
    steps = np.sort(rng.choice(2 * w - 2, min(SAMPLED, 2 * w - 2), replace=False))
    coins = mix(h ^ U64(rng.integers(1, 1 << 62)))  # a word's bit j is its coin at step j; w is at most 32
    at = starts.copy()
    end = starts + w
    pad = len(h) - 1
    key = np.zeros(len(starts), U64)
    sampled = set(steps.tolist())
    for j in range(int(steps[-1]) + 1):
        here = np.minimum(at, pad)
        if j in sampled:
            key = mix(key * U64(3) + np.where(at < end, h[here], U64(0)) + U64(1))
        at = at + ((coins[here] >> U64(j)) & U64(1)).astype(at.dtype)
    return key


def edit_place(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least word edit distance of ``item`` to a span of ``text``, and the span [a, b): the leftmost end, the longest start."""
    n = len(text)
    idx = np.arange(n + 1)
    dist, origin = np.zeros(n + 1, np.int64), idx.copy()
    for i, word in enumerate(item):
        swap, drop = dist[:-1] + (text != word), dist[1:] + 1
        new, org = np.minimum(swap, drop), np.where(swap <= drop, origin[:-1], origin[1:])
        new, org = np.concatenate([[i + 1], new]), np.concatenate([[0], org])
        lead = np.minimum.accumulate(new - idx)  # words of the text that the item lacks
        src = np.maximum.accumulate(np.where(new - idx == lead, idx, 0))
        dist, origin = lead + idx, org[src]
    b = int(dist.argmin())
    return int(dist[b]), int(origin[b]), b


class ItemIndex:
    """Keys of every window of a block of items, for each class and repetition."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, target: float = TARGET):
        self.similarity = similarity
        words = [doc_words(t.encode())[2] for _, t in items]
        keep = [i for i, w in enumerate(words) if len(w) >= MIN_WORDS]
        self.ids = [items[i][0] for i in keep]
        self.words = [words[i] for i in keep]
        self.classes = sorted({window_size(len(w)) for w in self.words})
        self.tables: dict[tuple[int, int], tuple] = {}
        self.repeats = {w: self._enough(w, target) for w in self.classes}

    def allowed(self, n: int) -> int:
        return int(n * (1 - self.similarity) + 1e-9)

    def _table(self, w: int, repeat: int):
        own = [i for i, x in enumerate(self.words) if window_size(len(x)) == w]
        size = np.array([len(self.words[i]) - w + 1 for i in own])
        flat = np.concatenate([self.words[i] for i in own])
        first = np.concatenate([[0], np.cumsum([len(self.words[i]) for i in own])[:-1]])
        offset = np.concatenate([np.arange(s) for s in size])
        item = np.repeat(np.array(own), size)
        keys = walk_keys(flat, np.repeat(first, size) + offset, w, repeat)
        order = np.argsort(keys, kind="stable")
        slots = np.zeros(SLOTS, bool)
        slots[(keys & U64(SLOTS - 1)).astype(np.int64)] = True
        return keys[order], item[order], offset[order], slots

    def _copies(self, w: int):
        """Edited copies, between unrelated words, of the items of a class: (item of each, word hashes, bounds).

        A group for each range of lengths and way of editing: substitutions, insertions and deletions alike at random, and
        substitutions at even distances.  The items are spread over the whole block.
        """
        rng = np.random.default_rng(5)
        ranges: dict[int, list[int]] = {}
        for i, x in enumerate(self.words):
            if window_size(len(x)) == w:
                ranges.setdefault(min(len(x), 8 * w) * 4 // w, []).append(i)
        for own in ranges.values():
            longest = max(len(self.words[i]) for i in own)
            trials = max(20, min(TRIALS, TRIAL_WORDS // longest))
            chosen = np.resize(np.array(own)[np.linspace(0, len(own) - 1, min(trials, len(own))).astype(np.int64)], trials)
            for even in (False, True):
                parts = []
                for i in chosen.tolist():
                    copy = list(self.words[i])
                    edits = self.allowed(len(copy))
                    for e in range(edits):
                        if even:
                            copy[(2 * e + 1) * len(copy) // (2 * edits)] = U64(rng.integers(1 << 62))
                            continue
                        at, kind = int(rng.integers(len(copy))), int(rng.integers(3))
                        fresh = U64(rng.integers(1 << 62))
                        copy[at:at + (kind != 1)] = [fresh] if kind != 2 else []
                    lead = rng.integers(1 << 62, size=int(rng.integers(40))).astype(U64)
                    parts.append(np.concatenate([lead, np.array(copy, U64), lead[:8]]))
                yield chosen, np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _enough(self, w: int, target: float) -> int:
        """Builds a class's tables until ``target`` of each group of its edited copies is hit; the number of repetitions."""
        repeat = 0
        for chosen, h, bounds in self._copies(w):
            doc, starts = self._windows(bounds, w)
            missed, r = np.ones(len(chosen), bool), 0
            while missed.sum() > (1 - target) * len(chosen):
                if r == MAX_REPEATS:
                    raise ValueError(f"{MAX_REPEATS} repetitions find {1 - missed.mean():.3f} of edited copies of items of "
                                     f"{len(self.words[chosen[0]])} words, less than {target}")
                if r == repeat:
                    self.tables[w, r] = self._table(w, r)
                    repeat += 1
                on = missed[doc]
                for x, d, _ in self._equal(h, doc[on], starts[on], w, r):
                    if x == chosen[d]:
                        missed[d] = False
                r += 1
        return repeat

    @staticmethod
    def _windows(bounds: np.ndarray, w: int):
        """Document and first word of every window of the texts that is looked up for a class."""
        size, stride = np.diff(bounds), w // 4
        n = np.maximum(0, (size - w) // stride + 1)
        doc = np.repeat(np.arange(len(size)), n)
        return doc, bounds[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * stride

    def _equal(self, h: np.ndarray, doc: np.ndarray, starts: np.ndarray, w: int, r: int):
        """(item, document, first word the item would have) of every equal key of one class and repetition."""
        if not len(starts):
            return
        keys, item, offset, slots = self.tables[w, r]
        key = walk_keys(h, starts, w, r)
        at = np.flatnonzero(slots[(key & U64(SLOTS - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(keys, key[at], "left"), np.searchsorted(keys, key[at], "right")
        for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            for x in range(a, b):
                yield int(item[x]), int(doc[p]), int(starts[p] - offset[x])

    def hits(self, h: np.ndarray, bounds: np.ndarray):
        """(item, document, first word the item would have) of every equal key."""
        out = set()
        for w in self.classes:
            doc, starts = self._windows(bounds, w)
            for r in range(self.repeats[w]):
                out.update(self._equal(h, doc, starts, w, r))
        return out

    def search(self, h: np.ndarray, bounds: np.ndarray):
        """Verified (document, item id, first word, words, edits, similarity): the best place of each pair."""
        best: dict[tuple[int, int], tuple] = {}
        places: dict[tuple[int, int], list[int]] = {}
        for i, d, p in self.hits(h, bounds):
            places.setdefault((d, i), []).append(p)
        for (d, i), found in places.items():
            item, done = self.words[i], None
            slack = self.allowed(len(item)) + 1
            for p in sorted(found):
                if done is not None and p - done <= 1:
                    continue
                done = p
                lo, hi = max(int(bounds[d]), p - slack), min(int(bounds[d + 1]), p + len(item) + slack)
                edits, a, b = edit_place(item, h[lo:hi])
                if edits <= self.allowed(len(item)):
                    row = (edits, lo + a - int(bounds[d]), b - a)
                    best[d, i] = min(best.get((d, i), row), row)
                    if edits == 0:
                        break
        return [(d, self.ids[i], a, n, e, 1 - e / len(self.words[i])) for (d, i), (e, a, n) in sorted(best.items())]


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, length, edits, similarity): documents that hold a benchmark item, and where.

    A document holds an item when the word edit distance of the item to some span of its words is at most
    ``(1 - similarity)`` of the item's words; the best span of each pair is returned, in words from 0.  Words are
    compared as they are.  Null and empty texts and items, and items of fewer than MIN_WORDS words, match nothing;
    items that repeat an id are one item with several texts, repeated documents give their rows again.  Other columns
    are ignored, whatever their names.

    The benchmark is read in blocks of ITEM_BLOCK bytes, each searched in all documents, so what is broadcast is bounded.
    """
    return leaking_rows(docs, benchmark, similarity).drop("text_key")


def leaking_rows(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``find_leaks`` with the column text_key, the xxhash64 of the row's text, which tells rows of one id apart."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = int(size // ITEM_BLOCK + 1)
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().collect()
        part = _search(docs, spark.sparkContext.broadcast(ItemIndex(sorted((r.item_id, r.text) for r in own), similarity)))
        found = part if found is None else found.unionByName(part)
    best = F.min_by(F.struct("start", "length", "edits", "similarity"), F.struct("edits", "start", "length"))
    return found if blocks == 1 else found.groupBy("doc_id", "text_key", "item_id").agg(best.alias("b")).select("doc_id", "text_key", "item_id", "b.*")


def _search(docs: DataFrame, index) -> DataFrame:
    def scan(batches):
        import pyarrow as pa
        items = index.value
        for batch in (part for whole in batches for part in slices(whole)):
            ids, text_keys, cells = batch.column(0), batch.column(1), utf8_cells(batch.column(2))
            for a, b in grouped(cells):
                bounds, _, _, h, _, _ = group_words(cells[a:b])
                rows = items.search(h, bounds) if len(h) else []
                if rows:
                    # items that share an id: the best of them
                    one = {}
                    for r in sorted(rows, key=lambda r: (r[4], r[2], r[3])):
                        one.setdefault((r[0], r[1]), r)
                    cols = list(zip(*sorted(one.values())))
                    at = pa.array([d + a for d in cols[0]])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), text_keys.take(at)] + [pa.array(c, pa.int64()) for c in cols[1:5]]
                        + [pa.array(cols[5], pa.float64())], names=["doc_id", "text_key", "item_id", "start", "length", "edits", "similarity"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
            .where("text is not null").mapInArrow(scan, FOUND))
