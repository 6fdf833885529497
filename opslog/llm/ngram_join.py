"""N-gram Jaccard join by filtering under several global token orders.

A document is its set of distinct ``k``-word shingles.  Two sets of Jaccard at
least t share a token in their prefixes (the first ``n - ceil(t n) + 1``
tokens) under *every* global order of tokens, so pairs are generated from the
prefixes of one order and must share as many tokens of these as leaves room for
enough shared tokens in all, before any set is compared.  Only these prefixes
are written and shuffled; those of the others, which sets that meet in blocks
must share too, are made from the sets in the task that holds them.

All orders put rare tokens first.  Rarity comes from a count over all
documents in a table of ``CELLS`` counters (tokens share counters by hash;
only tokens in the lowest quarter of the hash range are counted and these come
first), which is a fixed function of the token, so each order is total and the
filter exact.  Inside a rarity class each order uses its own hash.

Equal sets are one class from the start.  A token in few prefixes gives its
pairs of classes: each class first meets the least of its partners, then only
those that are still of another component.  In the bucket of a token in many,
all classes first meet a few leaders; the links found join most of a group of
near copies, and a bucket whose classes are all of one component is done.  What is left is exact too:
classes outside a bucket's main component meet all others in blocks, and a task
reports a spanning forest of the links it verified between components, so near
copies in thousands do not become all their pairs.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import gram_hashes, group_words, grouped, mix, shingle_set, signed, slices, small_side, U64, utf8_cells
from opslog.llm.components import components
from opslog.session import materialize

CELL_BITS, PIECE_BITS = 20, 14
CELLS = 1 << CELL_BITS
ORDERS = (U64(0x243F6A8885A308D3), U64(0x13198A2E03707344), U64(0xA4093822299F31D0))
FEW = 128  # classes in a bucket that gives pairs; larger buckets go by leaders and blocks
LEADERS = 4  # leaders of a large bucket, which all its classes meet before the blocks
BLOCK, TOKENS = 2000, 500  # classes in a block, and tokens of a class that a block has room for on average


def _sets(cells: list[bytes], k: int):
    """The shingle set of each cell, a group of cells hashed at once."""
    bounds, _, _, h, _, _ = group_words(cells, lower=True)
    grams = gram_hashes(h, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.unique(grams[a:b - k + 1]) if b - a >= k else shingle_set(h[a:b], k)


def rarity_classes(docs: DataFrame, k: int) -> np.ndarray:
    """Base-2 logarithm of the number of documents behind each counter, over all documents.

    A task adds up its documents in one table and sends it in compressed pieces; equal pieces are added as a stream.
    """
    size = 1 << PIECE_BITS

    def count(batches):
        import pyarrow as pa
        table = np.zeros(CELLS, np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            cells = utf8_cells(batch.column(0))
            for a, b in grouped(cells):
                sets = [s for s in _sets(cells[a:b], k)]
                s = np.concatenate(sets)
                table += np.bincount((s[s >> U64(62) == 0] & U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        pieces = [i for i in range(CELLS >> PIECE_BITS) if table[i * size:(i + 1) * size].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(pieces, pa.int32()), pa.array([zlib.compress(table[i * size:(i + 1) * size].tobytes(), 1) for i in pieces], pa.binary())],
            names=["piece", "counts"])

    def add(batches):
        import pyarrow as pa
        current, total, out = None, None, []
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if piece != current:
                    if current is not None:
                        out.append((current, total))
                    current, total = piece, np.zeros(size, np.int64)
                total = total + np.frombuffer(zlib.decompress(data), np.int64)
        if current is not None:
            out.append((current, total))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in out], pa.int32()),
             pa.array([np.ceil(np.log2(t + 1)).astype(np.uint8).tobytes() for _, t in out], pa.binary())], names=["piece", "classes"])

    tasks = docs.select("text").mapInArrow(count, "piece int, counts binary")
    classes = np.zeros(CELLS, np.uint8)
    for r in tasks.repartition(16, "piece").sortWithinPartitions("piece").mapInArrow(add, "piece int, classes binary").collect():
        classes[r.piece * size:(r.piece + 1) * size] = np.frombuffer(r.classes, np.uint8)
    return classes


def prefix(s: np.ndarray, classes: np.ndarray, order: np.uint64, num: int, den: int) -> np.ndarray:
    """The ranks, ascending, of the first ``n - ceil(n num / den) + 1`` tokens of a set under one global order.

    A rank names its token: not counted or counted, rarity class, 57 bits of the order's hash.
    """
    p = len(s) + (-num * len(s)) // den + 1
    rank = np.where(s >> U64(62) == 0, classes[(s & U64(CELLS - 1)).astype(np.int64)].astype(U64) << U64(57), U64(1 << 63)) \
        | (mix(s ^ order) >> U64(7))
    return np.sort(np.partition(rank, p - 1)[:p] if p < len(s) else rank)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether den * |a & b| >= num * |a | b| for sorted distinct tokens."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) * den < num * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _document_sets(docs: DataFrame, k: int, shared, num: int, den: int) -> DataFrame:
    """Per document: set size, two 64-bit sums that name the set, and its prefix under the first order.

    ``shared`` is the broadcast of the rarity classes.
    """
    def scan(batches):
        import pyarrow as pa
        classes = shared.value
        for batch in (part for whole in batches for part in slices(whole)):
            cells = utf8_cells(batch.column(2))
            n, sig, pre = [], [], []
            for a, b in grouped(cells):
                for s in _sets(cells[a:b], k):
                    n.append(len(s))
                    sig.append((np.add.reduce(mix(s + U64(1))), np.add.reduce(mix(s ^ ORDERS[0]))))
                    pre.append(prefix(s, classes, ORDERS[0], num, den) if len(s) else s)
            sig = np.array(sig, U64).reshape(-1, 2)
            flat = (np.concatenate(pre) if pre else np.empty(0, U64)) ^ U64(1 << 63)  # the order of ranks as signed numbers
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in pre])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(n, np.int64)), pa.array(signed(np.ascontiguousarray(sig[:, 0]))),
                 pa.array(signed(np.ascontiguousarray(sig[:, 1]))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(flat)))],
                names=["doc_id", "text_key", "n", "set_id", "sig", "prefix"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
            .mapInArrow(scan, "doc_id long, text_key long, n long, set_id long, sig long, prefix array<long>"))


def _bucket_pairs(buckets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes that share enough tokens of ``buckets`` (token, set_id, n, at) if they share no others of their prefixes.

    What two sets share beyond their last common token of the prefixes lies behind it in both, and behind the prefix that ends
    first.  A linked pair that shares a token of a large bucket may be missed here; it is found there.
    """
    x, y = buckets.alias("x"), buckets.alias("y")
    met = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.set_id") < F.col("y.set_id"))
                  & (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num))
           .groupBy(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"))
           .agg(F.count("*").alias("shared"), F.max("x.at").alias("i"), F.max("y.at").alias("j")))
    behind = F.ceil(F.greatest("n", "m") * num / den) - 1  # of the longer set's tokens behind its prefix
    room = F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1, behind)
    return met.where((F.col("shared") + room) * (num + den) >= (F.col("n") + F.col("m")) * num).select("a", "b")


def _class_sets(texts: DataFrame, k: int) -> DataFrame:
    """(set_id, grams) of (set_id, text): the shingle set as sorted 64-bit numbers in one binary value."""
    def scan(batches):
        import pyarrow as pa
        for batch in (part for whole in batches for part in slices(whole)):
            cells = utf8_cells(batch.column(1))
            for a, b in grouped(cells):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([s.tobytes() for s in _sets(cells[a:b], k)], pa.binary())], names=["set_id", "grams"])
    return texts.select("set_id", "text").mapInArrow(scan, "set_id long, grams binary")


def _pair_links(pairs: DataFrame, grams: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the written ``pairs`` whose sets are similar enough."""
    @F.pandas_udf("boolean")
    def similar(x, y):
        import pandas as pd
        return pd.Series([linked(np.frombuffer(a, U64), np.frombuffer(b, U64), num, den) for a, b in zip(x, y)], dtype=bool)
    ids = materialize(pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct(), "met")
    grams = grams.join(small_side(ids), "set_id", "left_semi")  # only sets that are compared are shuffled
    a = grams.select(F.col("set_id").alias("a"), F.col("grams").alias("ga"))
    b = grams.select(F.col("set_id").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(a, "a").join(b, "b").where(similar("ga", "gb")).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose classes are not yet of one component; ``found`` has (node, component)."""
    a, b = (found.select(F.col("node").alias(x), F.col("component").alias(f"{x}c")) for x in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("ac", "a") != F.coalesce("bc", "b")).select("a", "b"))


def _open_buckets(large: DataFrame, found: DataFrame) -> DataFrame:
    """(token, set_id, n, component) of the large buckets whose classes are not yet of one component."""
    found = found.select(F.col("node").alias("set_id"), "component")
    rows = large.join(found, "set_id", "left").select("token", "set_id", "n", F.coalesce("component", "set_id").alias("component"))
    mixed = rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("token")
    return materialize(rows.join(mixed, "token", "left_semi"), "open")


def _leader_pairs(large: DataFrame, leaders: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes of a bucket with its leaders: in each of ``leaders`` shares the class with the least hash.

    The hash is one for all buckets, so buckets of one group of near copies have mostly the same leaders.
    """
    share = F.pmod(F.xxhash64(F.lit(1), "set_id"), F.lit(leaders))
    first = F.min(F.struct(F.xxhash64(F.lit(0), "set_id"), "set_id", "n"))
    chosen = large.groupBy("token", share.alias("share")).agg(first.alias("f")).select("token", "f.set_id", "f.n")
    x, y = large.alias("x"), chosen.alias("y")
    return (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.set_id") != F.col("y.set_id"))
                   & (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num))
            .select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct())


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """How many tokens each array of distinct tokens in ``a`` shares with each in ``b``: products of 0/1 matrices, ``width`` tokens at a time."""
    flat = [np.concatenate(x) for x in (a, b)]
    at = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (a, b)]
    common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    shared = np.zeros((len(a), len(b)), np.float32)  # exact up to 2^24 tokens of one set
    if len(common):
        for side in (0, 1):
            col = np.minimum(np.searchsorted(common, flat[side]), len(common) - 1)
            hit = np.flatnonzero(common[col] == flat[side])
            hit = hit[np.argsort(col[hit], kind="stable")]
            flat[side], at[side] = col[hit], at[side][hit]
    for first in range(0, len(common), width):
        part = []
        for x, col, row in zip((a, b), flat, at):
            lo, hi = np.searchsorted(col, [first, first + width])
            m = np.zeros((len(x), width), np.float32)
            m[row[lo:hi], col[lo:hi] - first] = 1
            part.append(m)
        shared += part[0] @ part[1].T
    return shared


def _forest(members: list, across: bool, classes: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the members' components: a spanning forest over all their links, or over those between the two sides.

    A member is (set_id, side, component, grams).  Candidates meet under the second and the third order too.
    """
    side, label = np.array([m[1] for m in members]), np.array([m[2] for m in members])
    left, right = (np.flatnonzero(side == side[0]), np.flatnonzero(side != side[0])) if across else [np.arange(len(members))] * 2
    sets = [np.frombuffer(m[3], U64) for m in members]
    n = np.array([len(s) for s in sets], np.int64)

    def fits(x, y):
        nx, ny = n[x][:, None], n[y][None, :]
        return (label[x][:, None] != label[y][None, :]) & (nx * den >= ny * num) & (ny * den >= nx * num)
    if not len(right) or not fits(left, right).any():
        return []
    may = fits(left, right)
    for order in ORDERS[1:]:
        heads = [prefix(s, classes, order, num, den) for s in sets]
        may &= _overlaps([heads[i] for i in left], [heads[i] for i in right]) > 0
    rows, cols = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if not len(rows):
        return []
    left, right, may = left[rows], right[cols], may[np.ix_(rows, cols)]
    both = _overlaps([sets[i] for i in left], [sets[i] for i in right]).astype(np.int64)
    may &= den * both >= num * (n[left][:, None] + n[right][None, :] - both)
    edges = []
    for i, row in zip(left, may):
        for j in right[row]:
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                edges.append((members[i][0], members[j][0]))
    return edges


def _block_links(rows: DataFrame, grams: DataFrame, shared, num: int, den: int, block: int) -> DataFrame:
    """Links between components inside open buckets: each class outside a bucket's main component meets all others.

    Outsiders are dealt to blocks, then members of the main component to further ones; a pair of blocks meets in one task
    of at most about 2 * block classes and 2 * block * TOKENS tokens (a single larger set is alone).  Pairs of main blocks are left out, so a bucket with few outsiders costs each
    member of its main component one place.
    """
    sizes = rows.groupBy("token", "component").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    main = sizes.groupBy("token").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max(F.struct("size", "component", "n")).alias("main"))
    blocks = lambda size, n: F.ceil(F.greatest(size / block, n / (block * TOKENS))).cast("int")
    main = main.select("token", F.col("main.component").alias("main"), blocks(F.col("size") - F.col("main.size"), F.col("n") - F.col("main.n")).alias("outer"),
                       blocks(F.col("main.size"), F.col("main.n")).alias("inner"))
    placed = rows.join(main, "token").withColumn("inside", F.col("component") == F.col("main"))
    own = F.when(F.col("inside"), F.col("outer") + F.pmod(F.xxhash64("set_id"), F.col("inner"))).otherwise(F.pmod(F.xxhash64("set_id"), F.col("outer")))
    last = F.when(F.col("inside"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    dealt = (placed.select("token", "set_id", "component", own.cast("int").alias("side"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
             .select("token", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "set_id", "component"))
    dealt = grams.join(small_side(materialize(dealt, "dealt")), "set_id")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def link(batches):
        import pyarrow as pa

        def out(edges):
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in edges], pa.int64()) for i in (0, 1)], names=["u", "v"])
        current, members, classes = None, [], shared.value
        for batch in (part for whole in batches for part in slices(whole)):
            for token, i, j, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if (token, i, j) != current:
                    if len(members) > 1:
                        yield out(_forest(members, current[1] != current[2], classes, num, den))
                    current, members = (token, i, j), []
                members.append(member)
        if len(members) > 1:
            yield out(_forest(members, current[1] != current[2], classes, num, den))

    return (dealt.select("token", "i", "j", "side", "component", "set_id", "grams").repartition(parts, "token", "i", "j")
            .sortWithinPartitions("token", "i", "j", "set_id")
            .select("token", "i", "j", "set_id", "side", "component", "grams").mapInArrow(link, "u long, v long"))


def _marked(docs: DataFrame, k: int, num: int, den: int, few: int, block: int, null_ids: bool, leaders: int = LEADERS) -> DataFrame:
    """doc_id, text_key, n, component of every row; rows with a null id give links only if ``null_ids``."""
    base = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(rarity_classes(base, k))  # CELLS bytes
    sets = materialize(_document_sets(base, k, shared, num, den), "sets")
    filled = sets.where("n > 0" if null_ids else "n > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "text_key", "prefix")).alias("f")
    reps = materialize(filled.groupBy("set_id", "sig", "n").agg(first).select("set_id", "n", "f.*"), "classes")

    tokens = reps.select("set_id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("at", "token"))
    sized = tokens.withColumn("bucket_size", F.count("*").over(Window.partitionBy("token")))  # less to shuffle than counts and a join
    buckets = materialize(sized.where("bucket_size > 1"), "buckets")
    pairs = materialize(_bucket_pairs(buckets.where(F.col("bucket_size") <= few), num, den), "pairs")
    large = buckets.where(F.col("bucket_size") > few).select("token", "set_id", "n")
    some = bool(large.take(1))

    need = materialize(pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id")))
                       .unionByName(large.select("set_id")).distinct().join(reps.select("set_id", "doc_id", "text_key"), "set_id"), "needed")
    b, w = base.select("doc_id", F.xxhash64("text").alias("text_key"), "text").where("text is not null").alias("b"), small_side(need).alias("w")
    same_id = F.col("b.doc_id").eqNullSafe(F.col("w.doc_id")) if null_ids else F.col("b.doc_id") == F.col("w.doc_id")
    texts = b.join(w, same_id & (F.col("b.text_key") == F.col("w.text_key"))).select("w.set_id", "b.text").dropDuplicates(["set_id"])
    grams = materialize(_class_sets(texts, k), "class-sets")

    met = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    if some:
        met = met.unionByName(_leader_pairs(large, leaders, num, den)).distinct()
    edges = materialize(_pair_links(materialize(met, "first-pairs"), grams, num, den), "links")
    found = components(edges)
    apart = materialize(_apart(pairs, found), "apart")
    if apart.take(1):
        edges = edges.unionByName(materialize(_pair_links(apart, grams, num, den), "links"))
        found = components(edges)
    rows = _open_buckets(large, found) if some else large
    if rows.take(1):
        found = components(edges.unionByName(materialize(_block_links(rows, grams, shared, num, den, block), "links")))

    found = found.select(F.col("node").alias("set_id"), "component")
    return (sets.select("doc_id", "text_key", "n", "set_id").join(found, "set_id", "left")
            .withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "set_id"))))


def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, few: int = FEW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id: documents linked when den * |intersection| >= num * |union| of their shingle sets.

    One row per row of ``docs``.  Null and empty texts have empty sets and no links; a document with fewer than ``k``
    words has its whole sequence as one shingle.  Rows that repeat an id are one document; a null id is linked with
    nothing and its component is null.  Other columns of ``docs`` are ignored, whatever their names.
    """
    marked = _marked(docs, k, num, den, few, block, False)
    least = marked.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (marked.join(least, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id")))


def surplus_rows(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, few: int = FEW, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Names (doc_id, text_key) of rows to drop so that each component keeps one, and of rows that stand there repeatedly.

    A component, as above but over rows with null ids too, keeps the row with the smallest id (null after all others),
    then the smallest text_key, the xxhash64 of the text.  Rows of equal id and text have one name; names that are kept and
    stand for several rows are in the second table.  Rows without words are in neither.
    """
    rows = materialize(_marked(docs, k, num, den, few, block, True).where("component is not null"), "marked")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    first = rows.groupBy("component").agg(F.min(place).alias("f"))
    same = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_key") == F.col("f.text_key"))
    gone = rows.join(first, "component").where(~same).select("doc_id", "text_key").distinct()
    repeated = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", "text_key")
    return gone, repeated
