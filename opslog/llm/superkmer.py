"""Exact substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words.  Its minimiser is the smallest hash of the
``m``-word grams in it; consecutive windows with the same minimiser travel as
one packed string (a super-k-mer) to the minimiser's bucket, where equal
windows must meet and sorting counts them exactly.

1. One scan counts the super-k-mers of each minimiser.  A minimiser with a
   single super-k-mer has no repeated window, so only super-k-mers of repeated
   minimisers travel.  A bit table of fixed size tells them apart in the second scan; its
   false positives cost traffic, never results.
2. The second scan emits the packed super-k-mers.  Minimisers of very many
   super-k-mers (a short phrase that a large share of the documents holds, in
   changing surroundings) would make hot buckets; their windows are re-keyed
   by the smallest gram that is not hot.  Equal super-k-mers are added up
   before they are shuffled to buckets, so a passage that stands in a third of
   all documents arrives as one row with a count.
3. A bucket's windows are sorted by their hash; runs of equal hashes are
   compared word by word.  Buckets are streamed in key order, about a MB of
   whole buckets at a time.
4. Flags go back to the documents that hold the super-k-mer.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import doc_words, gram_hashes, group_words, grouped, signed, slices, U64, utf8_cells
from opslog.session import materialize

K, M = 35, 8
FILTER_BITS = 26  # log2 of the bits of the repeated-minimiser table: 8 MB
CHUNK_BITS = 16
HOT = 20_000  # super-k-mers of one minimiser that make it hot, if at least a HOT_SHARE of all
HOT_SHARE = 1e-5  # so at most 100,000 minimisers can be hot
GRAM_BITS, AT_BITS = 37, 26  # of a gram's hash and of its place among at most 2^26 words
BLOCK = 1 << 20  # bytes of packed strings that are sorted together, whole buckets at a time


def _sliding_min(g: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    span, out = 1, g
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _keyed(value: np.ndarray) -> np.ndarray:
    """Gram hash and position in one number, so that a minimum is the leftmost smallest gram."""
    return (value << U64(AT_BITS)) | np.arange(len(value), dtype=U64)


def _runs(h: np.ndarray, bounds: np.ndarray, k: int, m: int, hot: np.ndarray | None = None):
    """Super-k-mers of several documents: first window, number of windows, bucket, minimiser.

    A run ends where the minimiser's place changes, so equal windows are never in one run and a minimiser with one run
    has no repeated window.  The bucket is the minimiser, or for hot minimisers the smallest gram that is not hot.
    """
    none = (np.empty(0, np.int64),) * 2 + (np.empty(0, U64),) * 2
    if len(h) < k:
        return none
    w = k - m + 1
    g = gram_hashes(h, m) >> U64(64 - GRAM_BITS)
    low = _sliding_min(_keyed(g), w)
    key = low
    if hot is not None and len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, g), len(hot) - 1)] == g
        if is_hot.any():
            key = _sliding_min(_keyed(np.where(is_hot, g | U64(1 << GRAM_BITS), g)), w)
    n = len(low)
    ok = np.zeros(n, bool)  # windows that lie whole in one document
    for a, b in zip(bounds[:-1], bounds[1:]):
        ok[a:max(a, b - k + 1)] = True
    brk = np.ones(n, bool)
    brk[1:] = (low[1:] != low[:-1]) | (key[1:] != key[:-1]) | ~ok[:-1]
    first = np.flatnonzero(brk & ok)
    stop = np.flatnonzero(np.append(brk[1:] | ~ok[1:], True) & ok) + 1
    return first, stop - first, key[first] >> U64(AT_BITS), low[first] >> U64(AT_BITS)


def _packed(text: bytes) -> bytes:
    return b" ".join(text.split())  # bytes.split() cuts at the six ASCII white space characters


def repeated_minimisers(docs: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """(minimiser, n) of the minimisers of more than one super-k-mer."""
    def scan(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in slices(whole)):
            cells = utf8_cells(batch.column(0))
            for a, b in grouped(cells):
                bounds, _, _, h, _, _ = group_words(cells[a:b])
                low = _runs(h, bounds, k, m)[3]
                if len(low):
                    yield pa.RecordBatch.from_arrays([pa.array(signed(low))], names=["minimiser"])
    return (docs.select("text").mapInArrow(scan, "minimiser long")
            .groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1"))


def bit_table(minimisers: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for each hash value of a minimiser; built in pieces by the executors, 2^bits bits however many there are."""
    def fill(pdf):
        import pandas as pd
        piece = np.zeros(1 << CHUNK_BITS, bool)
        piece[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "set": [np.packbits(piece).tobytes()]})
    at = F.pmod(F.col("minimiser"), F.lit(1 << bits))
    cells = (minimisers.select(F.shiftright(at, CHUNK_BITS).cast("int").alias("piece"),
                               F.pmod(at, F.lit(1 << CHUNK_BITS)).cast("int").alias("bit")).distinct())
    table = np.zeros((1 << bits) // 8, np.uint8)
    step = (1 << CHUNK_BITS) // 8
    for r in cells.groupBy("piece").applyInPandas(fill, "piece int, set binary").collect():
        table[r.piece * step:(r.piece + 1) * step] = np.frombuffer(r.set, np.uint8)
    return table


def _super_kmers(docs: DataFrame, table: np.ndarray, hot: np.ndarray, k: int, m: int, bits: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((table, hot))  # 2^bits bits and at most 1 / HOT_SHARE hashes

    def scan(batches):
        import pyarrow as pa
        table, hot = shared.value
        for batch in (part for whole in batches for part in slices(whole)):
            ids, keys = batch.column(0), batch.column(1)
            cells = utf8_cells(batch.column(2))
            for a, b in grouped(cells):
                bounds, starts, ends, h, joined, _ = group_words(cells[a:b])
                first, size, key, low = _runs(h, bounds, k, m, hot)
                at = low & U64((1 << bits) - 1)
                want = (table[(at >> U64(3)).astype(np.int64)] >> (U64(7) - (at & U64(7))).astype(np.uint8)) & 1
                sel = np.flatnonzero(want)
                if not len(sel):
                    continue
                first, size, key = first[sel], size[sel], key[sel]
                doc = np.searchsorted(bounds, first, side="right") - 1
                packed = [_packed(joined[x:y]) for x, y in zip(starts[first].tolist(), ends[first + size + k - 2].tolist())]
                rows = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), keys.take(rows), pa.array((first - bounds[doc]).astype(np.int32)),
                     pa.array(signed(key)), pa.array(packed, pa.binary())],
                    names=["doc_id", "doc_key", "start", "bucket", "packed"])

    return (docs.select("doc_id", "doc_key", "text")
            .mapInArrow(scan, "doc_id long, doc_key long, start int, bucket long, packed binary"))


def _flag(rows: list[tuple[bytes, int]], k: int) -> list[tuple[bytes, bytes]]:
    """Of whole buckets' distinct super-k-mers with their counts, those with repeated windows, and a bit per window."""
    bounds, starts, ends, h, joined, _ = group_words([p for p, _ in rows])
    size = np.diff(bounds) - k + 1
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(rows)), size)
    at = np.arange(len(owner)) - first[owner] + bounds[owner]  # a window's first word
    hashes = gram_hashes(h, k)[at]
    repeated = np.array([n > 1 for _, n in rows])[owner]
    order = np.argsort(hashes, kind="stable")
    sh = hashes[order]
    cut = np.flatnonzero(np.concatenate([[True], sh[1:] != sh[:-1]]))
    runs = np.diff(np.append(cut, len(sh)))
    begin, end = starts[at].tolist(), ends[at + k - 1].tolist()
    for c, n in zip(cut[runs > 1].tolist(), runs[runs > 1].tolist()):
        run = order[c:c + n].tolist()
        words = [joined[begin[j]:end[j]] for j in run]
        if words.count(words[0]) == n:
            repeated[run] = True
            continue
        seen = Counter(words)
        for j, w in zip(run, words):
            repeated[j] |= seen[w] > 1
    some = np.add.reduceat(repeated, first) > 0
    return [(rows[i][0], np.packbits(repeated[first[i]:first[i] + size[i]]).tobytes()) for i in np.flatnonzero(some).tolist()]


def repeated_windows(kmers: DataFrame, k: int) -> DataFrame:
    """(packed, flags): for each distinct super-k-mer with a repeated window, a bit for each of its windows."""
    distinct = kmers.groupBy("bucket", "packed").agg(F.count("*").alias("n"))
    parts = int(kmers.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        import pyarrow as pa
        rows, held, current = [], 0, None
        for batch in batches:
            found = []
            for key, packed, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current and held > BLOCK:
                    found += _flag(rows, k)
                    rows, held = [], 0
                current = key
                rows.append((packed, n))
                held += len(packed)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=["packed", "flags"])
        if rows and (found := _flag(rows, k)):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=["packed", "flags"])

    return (distinct.repartition(parts, "bucket").sortWithinPartitions("bucket", "packed")
            .mapInArrow(count, "packed binary, flags binary"))


def dedup_substrings(docs: DataFrame, k: int = K, m: int = M, bits: int = FILTER_BITS, hot_rows: int = HOT) -> DataFrame:
    """Remove every word that a repeated ``k``-word window covers.

    Returns per row of ``docs`` doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space).
    Null and empty texts have no words.  A repeated row repeats every window of its text.  Null ids are kept;
    other columns of ``docs`` are ignored, whatever their names.  ``m`` is at most ``k``.
    """
    base = docs.select("doc_id", "text")
    keyed = base.select("doc_id", F.xxhash64("text").alias("doc_key"), "text")
    seen = materialize(repeated_minimisers(base, k, m), "minimisers")
    total = seen.agg(F.sum("n")).first()[0] or 0
    hot_from = max(hot_rows, int(total * HOT_SHARE) + 1)
    hot = np.sort(np.array([r.minimiser for r in seen.where(F.col("n") >= hot_from).select("minimiser").collect()], dtype=np.int64).view(U64))
    kmers = materialize(_super_kmers(keyed, bit_table(seen, bits), hot, k, m, bits), "superkmers")
    flags = materialize(repeated_windows(kmers, k), "windows")
    name = [F.xxhash64("packed").alias("h1"), F.xxhash64(F.lit(1), "packed").alias("h2")]
    found = (kmers.select("doc_id", "doc_key", "start", *name).join(flags.select("flags", *name), ["h1", "h2"])
             .groupBy("doc_id", "doc_key").agg(F.collect_set(F.struct("start", "flags")).alias("found")))  # one document's

    d, f = keyed.alias("d"), found.alias("f")
    both = d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.doc_key") == F.col("f.doc_key")), "left")

    def keep(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for text, found in zip(utf8_cells(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                if found:
                    cover = np.zeros(len(words) + 1, np.int64)
                    for x in found:
                        at = x["start"] + np.flatnonzero(np.unpackbits(np.frombuffer(x["flags"], np.uint8)))
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + k, -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                    out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
                else:
                    kept = b" ".join(words)
                    out.append((len(words), 0, hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return both.select(F.col("d.doc_id").cast("long").alias("doc_id"), "d.text", "f.found").mapInArrow(
        keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
