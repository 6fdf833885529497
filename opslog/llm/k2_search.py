"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are indexed in blocks, each in the task that reads it.  A block's
grid has a row for each of its terms and a column for each of its documents;
a point is a term's impact in a document, without the term's weight.  The grid
is halved in both directions again and again; a cell that holds points keeps
the greatest impact among them, an empty one is a zero bit.  Bits stand four by
four in level order, so the children of a cell are found by counting the ones
before them, and a cell keeps what it lacks of its parent's maximum, in as few
bytes as the level needs.

An item descends with the rows of all its terms at once.  A state is a range
of documents with, for each term, the cell that holds its row there; the sum
of weight x maximum over the cells bounds every score in the range.  The states
of the greatest bounds are opened first, many at a time, until no bound left
reaches the item's k-th best score.  Neighbouring rows are terms of like
frequency, so that a cell's maximum says something of each of them.

All numbers are exact: impacts and scores are 64-bit integers, and a bound that
equals the k-th score is still opened, as a smaller document id may win a tie.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import grouped, hash_words, slices, trim, utf8_cells
from opslog.session import materialize

POINTS, DOCS = 200_000, 1 << 13  # a block is closed when it has as many points or documents
READ_ROWS, READ_BYTES = 500, 1 << 19  # texts that are cut into terms at a time
ITEMS_BYTES, ITEMS_ROWS = 8 << 20, 5_000  # texts of items that go to the tasks together
OPEN = 128  # states that are opened at a time
TOP = 10

_TERM = np.full(256, 0x20, np.uint8)  # bytes of terms, A-Z in lower case; others are white space
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM[_a:_b] = np.arange(_a, _b)
_TERM[0x41:0x5B] += 32


def terms(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of several texts, one after the other, and the bounds of each text's own among them."""
    data = _TERM[np.frombuffer(b" ".join(cells), np.uint8)]
    starts, _, h = hash_words(data)
    first = np.zeros(len(cells) + 1, np.int64)
    np.cumsum([len(c) + 1 for c in cells], out=first[1:])
    return h, np.searchsorted(starts, first)


def count_terms(cells: list[bytes]) -> np.ndarray:
    """How many terms each text has, with repeats."""
    data = _TERM[np.frombuffer(b" ".join(cells) + b" ", np.uint8)] != 0x20
    ends = np.concatenate([[0], np.cumsum(data[:-1] & ~data[1:])])
    return np.diff(ends[np.concatenate([[0], np.cumsum([len(c) + 1 for c in cells]) - 1])])


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_part(n: int, docs: int, total: int) -> int:
    return 10 + (90 * n * docs) // total


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same values in the smallest unsigned type."""
    top = int(x.max()) if len(x) else 0
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


# for the four bits of a cell: how many are set, and how many before each place
_ONES = np.array([f.bit_count() for f in range(16)], np.uint8)
_BEFORE = np.array([[(f & ((1 << j) - 1)).bit_count() for j in range(4)] for f in range(16)], np.uint8)


class Treap:
    """K2-treap of one block: term hashes in order with their rows and document counts, four bits a cell, maxima.

    ``levels`` holds, from the top, the bits of the level's cells and what its children lack of their parents' maxima.
    """

    def __init__(self, names: np.ndarray, row: np.ndarray, df: np.ndarray, top: int, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.names, self.row, self.df, self.height, self.top, self.levels = names, row, df, len(levels), top, levels

    @staticmethod
    def build(h: np.ndarray, doc: np.ndarray, value: np.ndarray, docs: int) -> "Treap":
        """Points (term hash, column, impact), each once."""
        names, of, df = np.unique(h, return_inverse=True, return_counts=True)
        row = np.empty(len(names), np.int64)
        row[np.lexsort((names, -df))] = np.arange(len(names))
        height = max(int(len(names) - 1).bit_length(), int(docs - 1).bit_length())
        y, x, code = row[of], doc.astype(np.int64), np.zeros(len(h), np.int64)
        for b in range(height):
            code |= ((y >> b & 1) << (2 * b + 1)) | ((x >> b & 1) << (2 * b))
        del y, x, of
        order = np.argsort(code)
        code, best, levels = code[order], value[order].astype(np.int32), []
        del order
        for _ in range(height):  # upwards, so that only two levels are there in full at a time
            up = code >> 2
            new = np.concatenate([[True], up[1:] != up[:-1]])
            first = np.flatnonzero(new)
            above = np.maximum.reduceat(best, first)
            four = np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), first)
            levels.append((four, _narrow(above[np.cumsum(new) - 1] - best)))
            code, best = up[first], above
        return Treap(names, row.astype("<u4"), df.astype("<u4"), int(best[0]), levels[::-1])

    def pack(self) -> tuple[bytes, bytes]:
        """The terms and the grid, each compressed."""
        names = [np.array([len(self.names)], "<i8"), self.names.astype("<u8"), self.row, self.df]
        parts = [np.array([self.height, self.top], "<i8")]
        for four, lack in self.levels:
            even = np.append(four, np.zeros(len(four) % 2, np.uint8))
            planes = lack.view(np.uint8).reshape(len(lack), -1).T  # low bytes first, then the mostly empty high ones
            parts += [np.array([len(four), len(lack), lack.itemsize], "<i8"), even[::2] | even[1::2] << 4, planes]
        press = zstandard.ZstdCompressor(level=1).compress
        return press(b"".join(x.tobytes() for x in names)), press(b"".join(p.tobytes() for p in parts))

    @staticmethod
    def unpack(terms: bytes, grid: bytes | None = None) -> "Treap":
        """From the terms alone it can only look them up."""
        expand, at = zstandard.ZstdDecompressor().decompress, 0
        data = expand(terms)

        def take(n, kind):
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x
        n = int(take(1, "<i8")[0])
        names, row, df, top, levels = take(n, "<u8"), take(n, "<u4"), take(n, "<u4"), 0, []
        if grid is not None:
            data, at = expand(grid), 0
            height, top = take(2, "<i8").tolist()
            for _ in range(height):
                cells, kids, width = take(3, "<i8").tolist()
                two = take((cells + 1) // 2, np.uint8)
                four = np.empty(2 * len(two), np.uint8)
                four[::2], four[1::2] = two & 15, two >> 4
                levels.append((four[:cells], np.ascontiguousarray(take(width * kids, np.uint8).reshape(width, kids).T).view(f"<u{width}")[:, 0]))
        return Treap(names, row, df, top, levels)

    def open(self) -> "Treap":
        """Makes the maxima and the counts of bits before each cell, with cells numbered through all levels."""
        self.four = np.concatenate([f for f, _ in self.levels]) if self.levels else np.empty(0, np.uint8)
        # cell 0 is the whole grid; a cell's children follow those of the cells before it
        self.start = np.cumsum(_ONES[self.four], dtype=np.int32) - _ONES[self.four] + np.int32(1)
        self.best = np.empty(1 + sum(len(x) for _, x in self.levels), np.int32)
        self.best[0], above, at = self.top, np.array([self.top], np.int32), 1
        for four, lack in self.levels:
            above = np.repeat(above, _ONES[four]) - lack.astype(np.int32)
            self.best[at:at + len(above)] = above
            at += len(above)
        self.levels = []
        return self

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``names`` of hashes, and which of them are there."""
        at = np.minimum(np.searchsorted(self.names, h), len(self.names) - 1)
        return at, self.names[at] == h

    def search(self, h: np.ndarray, w: np.ndarray, found: "Best") -> None:
        """Offers ``found`` every column whose score may be among the best; h and w are an item's terms and weights."""
        at, here = self.find(h)
        rows, w = self.row[at[here]].astype(np.int64), w[here]
        if not len(rows):
            return
        # states: bound, level, first column, a cell per term (-1 for none)
        bound, level, column = np.array([int(w.sum()) * self.top]), np.zeros(1, np.int64), np.zeros(1, np.int64)
        cells = np.zeros((1, len(rows)), np.int32)
        while True:
            live = bound >= max(found.least, 1)
            if not live.all():
                bound, level, column, cells = bound[live], level[live], column[live], cells[live]
            if not len(bound):
                return
            if len(bound) > OPEN:
                pick = np.argpartition(bound, len(bound) - OPEN)[-OPEN:]
                rest = np.ones(len(bound), bool)
                rest[pick] = False
                keep = (bound[rest], level[rest], column[rest], cells[rest])
            else:
                pick, keep = slice(None), None
            lv, co, ce = level[pick], column[pick], cells[pick]
            done = lv == self.height
            if done.any():
                found.offer(bound[pick][done], co[done])
                lv, co, ce = lv[~done], co[~done], ce[~done]
            if len(lv):
                half = self.height - 1 - lv
                place = 2 * (rows[None, :] >> half[:, None] & 1)
                four, start = self.four[np.maximum(ce, 0)], self.start[np.maximum(ce, 0)]
                halves = []
                for side in (0, 1):  # the left half of the documents, and the right
                    there = (ce >= 0) & (four >> (place + side) & 1 == 1)
                    halves.append(np.where(there, start + _BEFORE[four, place + side], -1))
                new = np.concatenate(halves)
                score = (np.where(new >= 0, self.best[new], 0) * w[None, :]).sum(axis=1)
                out = (score, np.concatenate([lv, lv]) + 1, np.concatenate([co, co + (1 << half)]), new)
            else:
                out = None
            both = [s for s in (keep, out) if s is not None]
            if not both:
                return
            bound, level, column, cells = (np.concatenate(x) for x in zip(*both))


class Best:
    """The k best (score, document id) of one item; the smaller id wins a tie, a null id loses it, equal rows may both stay."""

    def __init__(self, k: int):
        self.k, self.heap, self.ids = k, [], None  # heap of (score, -id)

    @property
    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 0

    def offer(self, scores: np.ndarray, columns: np.ndarray) -> None:
        for s, c in zip(scores.tolist(), columns.tolist()):
            entry = (s, *self.ids[c])
            if s > 0 and len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif s > 0 and entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents that have a term, and their terms with repeats."""
    def scan(batches):
        import pyarrow as pa
        n = total = 0
        for batch in (part for whole in batches for part in slices(whole, READ_ROWS)):
            cells = utf8_cells(batch.column(0))
            for a, b in grouped(cells, READ_BYTES):
                count = count_terms(cells[a:b])
                n, total = n + int((count > 0).sum()), total + int(count.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "total"])
        trim()

    r = docs.select("text").mapInArrow(scan, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return r.n or 0, r.total or 0


def index_documents(docs: DataFrame, size: tuple[int, int] | None = None, points: int = POINTS, most: int = DOCS) -> DataFrame:
    """(ids, terms, grid) per block: the document ids of its columns and its packed K2-treap, over every term of every row.

    A row without a term has no column.  A block ends at ``points`` points or ``most`` documents, or with its task's
    rows; a document is in one block however long it is.
    """
    n_docs, total = size or corpus_size(docs)

    def scan(batches):
        import pyarrow as pa

        ids, parts, held = [], [], 0

        def flush():
            h, doc, value = (np.concatenate(x) for x in zip(*parts))
            names, grid = Treap.build(h, doc, value, len(ids)).pack()
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([names], pa.binary()), pa.array([grid], pa.binary())],
                                              names=["ids", "terms", "grid"])
        for batch in (part for whole in batches for part in slices(whole, READ_ROWS)):
            names, cells = batch.column(0).to_pylist(), utf8_cells(batch.column(1))
            for a, b in grouped(cells, READ_BYTES):
                h, bounds = terms(cells[a:b])
                for i in range(b - a):
                    own = h[bounds[i]:bounds[i + 1]]
                    if not len(own):
                        continue
                    name, tf = np.unique(own, return_counts=True)
                    m = length_part(len(own), n_docs, total)
                    parts.append((name, np.full(len(name), len(ids), np.int32), impact(tf, m)))
                    ids.append(names[a + i])
                    held += len(name)
                    if held >= points or len(ids) >= most:
                        yield flush()
                        ids, parts, held = [], [], 0
        if ids:
            yield flush()
        trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "ids array<long>, terms binary, grid binary")


def document_counts(index: DataFrame, wanted: np.ndarray) -> dict[int, int]:
    """How many documents hold each of the wanted term hashes (sorted, of one group of items), over all blocks."""
    def scan(batches):
        import pyarrow as pa
        df = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for cell in batch.column(0):
                treap = Treap.unpack(cell.as_buffer())
                at, here = treap.find(wanted)
                df[here] += treap.df[at[here]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["i", "df"])
        trim()

    rows = index.select("terms").mapInArrow(scan, "i long, df long").groupBy("i").agg(F.sum("df").alias("df")).collect()  # at most a row per wanted term
    return {int(wanted[r.i]): r.df for r in rows}


def _groups(items: DataFrame):
    """Items (item_id, text) in groups of bounded size, in a stable order; one group is on the driver at a time."""
    held, size = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        text = (r.text or "").encode()
        if held and (len(held) >= ITEMS_ROWS or size + len(text) > ITEMS_BYTES):
            yield held
            held, size = [], 0
        held.append((r.item_id, text))
        size += len(text)
    if held:
        yield held


def search_items(index: DataFrame, items: DataFrame, n_docs: int, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item row's ``k`` best documents in a written index.

    Items go over the index in groups of bounded size.  A null or empty item finds nothing; items that share an id, or
    are equal, are ranked each on its own.  Equal scores stand by ascending id, nulls last.
    """
    spark = index.sparkSession
    out = []
    for group in _groups(items.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        h, bounds = terms([t for _, t in group])
        own = [np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:])]
        df = document_counts(index, np.unique(h))
        asked = [(i, item, hs, np.array([weight(n_docs, df[int(x)]) for x in hs], np.int64))
                 for i, (item, _) in enumerate(group) if len(hs := own[i][[int(x) in df for x in own[i]]])]
        asked = [(i, item, hs[w > 0], w[w > 0]) for i, item, hs, w in asked]
        shipped = spark.sparkContext.broadcast(asked)  # bounded by the group's bytes

        def scan(batches):
            import pyarrow as pa
            best = [Best(k) for _ in shipped.value]
            for ids, names, grid in (cells for batch in batches for cells in zip(*batch.columns)):
                treap = Treap.unpack(names.as_buffer(), grid.as_buffer()).open()
                # greater is better: a small id, any id before none
                keys = [(0, 0) if d is None else (1, -d) for d in ids.as_py()]
                for (_, _, hs, w), b in zip(shipped.value, best):
                    if len(hs):
                        b.ids = keys
                        treap.search(hs, w, b)
            rows = [(i, item, None if not e[1] else -e[2], e[0]) for (i, item, _, _), b in zip(shipped.value, best) for e in b.heap]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["no", "item_id", "doc_id", "score"])
            trim()

        hits = index.mapInArrow(scan, "no long, item_id long, doc_id long, score long")
        order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))  # at most k rows of each task
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(materialize(ranked.select("item_id", "rank", "doc_id", "score"), "hits"))
        shipped.unpersist()
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if not out else _union(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest score above 0, over all documents.

    Documents and items without a term (null, empty, only signs) match nothing.  Repeated rows and rows that share an id
    are documents of their own.  Empty tables give an empty result.  Columns other than doc_id, item_id and text are
    ignored, whatever their names.  Terms are told apart by 64-bit hashes.
    """
    size = corpus_size(docs)
    if not size[0]:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return search_items(materialize(index_documents(docs, size), "k2-index"), items, size[0], k)
