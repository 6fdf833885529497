"""Conversation prefix trie with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns; its parent is the sequence
without the last of them.  Nodes are named by 128 bits: the exclusive or of
hashes of (place, role, text), so that a running window gives the names of all
prefixes of a conversation, also of one whose turns lie in several tasks.

What a node's members tell (how many, the smallest, those that end there, the
turns they still have ahead) needs one aggregate.  What its subtree tells
(leaves, repeated words) is rolled up along the forest of parent edges:

* a component's centroid is its deepest node that still has half of the
  component's weight below it; a node's weight is its number of members, so
  the turns ahead of all members give every subtree's weight beforehand;
* the centroid's own subtree is totalled once, and the total is added to every
  node on the path from the centroid to the component's top;
* centroid and path part, the rest falls into components of at most half the
  weight: one per child of the centroid, and what is left around the top.

Every pair of node and descendant is parted by exactly one centroid, on the
path between them, so each node gets each descendant once, after a number of
rounds logarithmic in the weight however deep or wide the trie is.  Components
beyond ``LOCAL`` are split by joins over the whole cluster; smaller ones are
dealt out whole and finished the same way inside a task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import WORD, trim
from opslog.session import materialize

LOCAL = 200_000  # weight, and so nodes at most, of a component that one task finishes
END_BITS = 12  # a block of a node's list of ends holds the ids of a range of 4096
SHARED = 3  # turns that a rebuilt conversation may take from its base


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, a, b, words): turns by conversation and order, ``at`` rising within a conversation.

    The rows are dealt by ranges of (conversation, order), so a conversation may lie in several parts; texts go no further.
    """
    spread = turns.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    return materialize(spread.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
                                     F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
                                     F.regexp_count("text", F.lit(WORD)).alias("words")), "turns")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, length), and their turns (conv_id, part, pos, length, a, b, words).

    Conversation c takes the first h turns of conversation c - c % 20, then its own turns after its first h, where h is
    crc32(c) % 4; one that is its own base is unchanged.  Turns of equal number stand by role, then text; a null role or
    text is empty, a null turn comes first, a null conversation is one of its own.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _numbered(turns)
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "parts")
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = own.select("conv_id", "own", base.alias("base"), F.when(base == F.col("conv_id"), 0).otherwise(F.coalesce(crc, F.lit(0))).alias("h"))
    there = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_len"))
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    convs = materialize(convs.join(there, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    c = convs.select(F.col("conv_id").alias("_c"), "h", "taken", "length")
    places = parts.join(c, F.col("conv_id").eqNullSafe(F.col("_c"))).select("conv_id", "part", "start", "before", "h", "taken", "length")
    same = F.col("r.conv_id").eqNullSafe(F.col("p.conv_id")) & (F.col("r.part") == F.col("p.part"))
    pos = F.col("at") - F.col("start") + F.col("before") + 1
    placed = rows.alias("r").join(places.alias("p"), same).select("r.*", pos.alias("pos"), "h", "taken", "length")
    kept = placed.where("pos > h").select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "length", "a", "b", "words")
    # at most SHARED turns of a base, each taken by fewer than 40 conversations
    heads = placed.where((F.col("pos") <= SHARED) & (F.col("conv_id") % 20 == 0)).select(F.col("conv_id").alias("base"), "pos", "a", "b", "words")
    takers = convs.where("taken > 0").select("conv_id", "base", "taken", "length")
    lent = heads.join(takers, "base").where("pos <= taken").select("conv_id", F.lit(-1).alias("part"), "pos", "length", "a", "b", "words")
    return convs.select("conv_id", "length"), kept.unionByName(lent)


def name_prefixes(turns: DataFrame) -> DataFrame:
    """Turns with x, y (the name of the prefix that they end), px, py (its parent's) and tx, ty (its first turn's)."""
    here = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = turns.select("conv_id", "part", "pos", "length", "words", F.xxhash64("pos", "a", "b").alias("e"),
                         F.xxhash64(F.lit(1), "b", "a", "pos").alias("f"))
    local = materialize(local.select("*", F.bit_xor("e").over(here).alias("lx"), F.bit_xor("f").over(here).alias("ly")), "prefixes")
    parts = local.groupBy("conv_id", "part").agg(
        F.bit_xor("e").alias("e"), F.bit_xor("f").alias("f"),
        F.max(F.when(F.col("pos") == 1, F.struct("e", "f"))).alias("first"))
    conv = Window.partitionBy("conv_id")
    upto = conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.coalesce(F.bit_xor("e").over(upto), F.lit(0)).alias("ox"),
                         F.coalesce(F.bit_xor("f").over(upto), F.lit(0)).alias("oy"), F.max("first").over(conv).alias("first"))
    x, y = F.col("lx").bitwiseXOR(F.col("ox")), F.col("ly").bitwiseXOR(F.col("oy"))
    return (local.join(parts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
            .select("conv_id", "pos", "length", "words", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("e")).alias("px"), y.bitwiseXOR(F.col("f")).alias("py"),
                    F.col("first.e").alias("tx"), F.col("first.f").alias("ty")))


def split_component(parent: list[int], weight: list[int], values: list[list[int]]) -> None:
    """Adds to every node's ``values`` those of its descendants, by centroid decomposition.

    ``parent[i]`` is a place before i, -1 for a component's top; ``weight`` of a subtree is that of its top.  Both lists
    may hold several components; ``weight`` is used up.
    """
    n = len(parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i, p in enumerate(parent):
        if p >= 0:
            kids[p].append(i)
    own = [list(v) for v in values]
    cut = bytearray(n)
    todo = [i for i in range(n) if parent[i] < 0]
    while todo:
        top = c = todo.pop()
        half = weight[top] / 2
        while True:  # down the one child that has half of the component's weight
            heavy = next((k for k in kids[c] if not cut[k] and weight[k] >= half), None)
            if heavy is None:
                break
            c = heavy
        totals, stack = [0] * len(values), [c]
        while stack:
            i = stack.pop()
            for t, v in enumerate(own):
                totals[t] += v[i]
            stack += [k for k in kids[i] if not cut[k]]
        for t, v in enumerate(values):
            v[c] += totals[t] - own[t][c]
        i, w = c, weight[c]
        while i != top:
            i = parent[i]
            weight[i] -= w
            for t, v in enumerate(values):
                v[i] += totals[t]
        cut[c] = 1
        todo += [k for k in kids[c] if not cut[k]]
        if c != top:
            todo.append(top)


def _finish(nodes: DataFrame) -> DataFrame:
    """Components of bounded weight, each dealt to a task whole: (x, y, leaves, saved) with their descendants' shares."""
    def scan(batches):
        import pyarrow as pa

        held: list[tuple] = []

        def flush():
            at, rows = {}, [r[2:] for r in held]
            for i, r in enumerate(rows):
                at[r[0], r[1]] = i
            # a component's top has no parent or a centroid, which is in no component any more
            parent = [at.get((r[2], r[3]), -1) for r in rows]
            leaves, saved = [r[5] for r in rows], [r[6] for r in rows]
            split_component(parent, [r[4] for r in rows], [leaves, saved])
            kind = pa.int64()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], kind),
                                               pa.array(leaves, kind), pa.array(saved, kind)], names=["x", "y", "leaves", "saved"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= LOCAL and held[-1][:2] != row[:2]:
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()
        trim()

    return (nodes.select("cx", "cy", "x", "y", "px", "py", "weight", "leaf", "words", "depth")
            .repartition("cx", "cy").sortWithinPartitions("cx", "cy", "depth").drop("depth")
            .mapInArrow(scan, "x long, y long, leaves long, saved long"))


def rollup(nodes: DataFrame, turns: DataFrame, local: int = LOCAL) -> DataFrame:
    """(x, y, leaves, saved): the sums of ``leaf`` and ``words`` over each node's subtree.

    ``nodes``: x, y, px, py, depth, conv (a member), weight (turns that members have from here on), leaf, words, cx and cy
    (the top of the component, at first the first turn).  ``turns``: the named turns of all conversations.
    """
    shares = []
    while True:
        tops = nodes.where("x = cx and y = cy").select("cx", "cy", F.col("weight").alias("total"), F.col("depth").alias("top_depth"))
        large = tops.where(F.col("total") > local)
        if large.isEmpty():
            break
        # components too heavy for one task; the rest is done
        inside = materialize(nodes.join(large, ["cx", "cy"]), "large")
        shares.append(_finish(nodes.join(large, ["cx", "cy"], "left_anti")))
        mid = inside.where(F.col("weight") * 2 >= F.col("total")).groupBy("cx", "cy").agg(
            F.max_by(F.struct("x", "y", "depth", "conv", "weight", "top_depth"), "depth").alias("m"))
        mid = materialize(mid.select("cx", "cy", F.col("m.x").alias("mx"), F.col("m.y").alias("my"), F.col("m.depth").alias("m_depth"),
                                     F.col("m.conv").alias("m_conv"), F.col("m.weight").alias("m_weight"), "m.top_depth"), "centroids")
        # below the centroid is a node whose member has the centroid as its prefix; the prefix one longer is the new component
        prefix = turns.select(F.col("conv_id").alias("_c"), F.col("pos").alias("_pos"), F.col("x").alias("bx"), F.col("y").alias("by"),
                              F.col("px").alias("ax"), F.col("py").alias("ay"))
        seen = inside.drop("total", "top_depth").join(mid.drop("m_conv", "m_weight", "top_depth"), ["cx", "cy"])
        at = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("_pos") == F.col("m_depth") + 1)
        deep = seen.where("depth > m_depth").join(prefix, at).drop("_c", "_pos")
        below = (F.col("ax") == F.col("mx")) & (F.col("ay") == F.col("my"))
        flat = seen.where("depth <= m_depth").withColumns({"bx": F.col("cx"), "by": F.col("cy"), "below": (F.col("x") == F.col("mx")) & (F.col("y") == F.col("my"))})
        deep = deep.withColumn("below", below).withColumns({"bx": F.when(below, F.col("bx")).otherwise(F.col("cx")),
                                                            "by": F.when(below, F.col("by")).otherwise(F.col("cy"))}).drop("ax", "ay")
        dealt = materialize(flat.unionByName(deep), "dealt")
        sums = dealt.where("below").groupBy("mx", "my").agg(F.sum("leaf").alias("leaves"), F.sum("words").alias("saved"))
        done = materialize(mid.join(sums, ["mx", "my"]), "totals")
        # the path from the centroid to the top: its member's prefixes between the two
        walk = turns.select("conv_id", F.col("pos").alias("depth"), "x", "y")
        path = done.join(walk, F.col("m_conv").eqNullSafe(F.col("conv_id"))).where("depth <= m_depth and depth >= top_depth")
        path = materialize(path.select("x", "y", "leaves", "saved", "m_weight"), "paths")
        shares.append(path.select("x", "y", "leaves", "saved"))
        # the centroid has its own total now and leaves; nodes above it keep its subtree's weight no more
        lost = path.select("x", "y", F.col("m_weight").alias("lost"))
        rest = dealt.where("not (x = mx and y = my)").join(lost, ["x", "y"], "left")
        nodes = materialize(rest.select("x", "y", "px", "py", "depth", "conv", (F.col("weight") - F.coalesce("lost", F.lit(0))).alias("weight"),
                                        "leaf", "words", F.col("bx").alias("cx"), F.col("by").alias("cy")), "nodes")
    shares.append(_finish(nodes))
    out = shares[0]
    for s in shares[1:]:
        out = out.unionByName(s)
    return out.groupBy("x", "y").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def hash_ends(ends: DataFrame) -> DataFrame:
    """(x, y, ends_sha256) of (x, y, conv_id): the ids in ascending order, comma-joined and hashed; null ids are left out.

    Ids are joined by blocks of the id range first, so the task that hashes a node's list, which no method can part,
    holds one block at a time and reads few rows.
    """
    blocks = (ends.where("conv_id is not null").groupBy("x", "y", F.shiftright("conv_id", END_BITS).alias("block"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("x", "y", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def scan(batches):
        import pyarrow as pa

        state, key, out = None, None, []
        for batch in batches:
            for x, y, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != (x, y):
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = (x, y), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["x", "y", "ends_sha256"])
                out = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], names=["x", "y", "ends_sha256"])

    return (blocks.repartition("x", "y").sortWithinPartitions("x", "y", "block").select("x", "y", "ids")
            .mapInArrow(scan, "x long, y long, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of rebuilt conversations; see ``rebuild`` for how turns are ordered and taken.

    conv_id (smallest member), depth, parent_conv_id (null for the textless root), n_convs, n_children, n_leaves (in the
    subtree), saved_tokens (subtree sum of (members - 1) x words of the last turn) and ends_sha256 (of the members that
    end there).  Repeated rows are turns of their own.  A null conv_id counts as a member but has no number: it is
    nobody's smallest member unless alone, and is not among the hashed ids.  Other columns are ignored; an empty table
    has no node, not even the root.
    """
    convs, turns = rebuild(conversations)
    turns = materialize(name_prefixes(turns), "named-turns")
    ahead = F.col("length") - F.col("pos") + 1
    nodes = materialize(turns.groupBy("x", "y").agg(
        F.first("px").alias("px"), F.first("py").alias("py"), F.first("pos").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.sum(ahead).alias("weight"),
        F.first("words").alias("last_words"), F.max("length").alias("longest"), F.first("tx").alias("cx"), F.first("ty").alias("cy")), "trie")
    inner = F.col("longest") > F.col("depth")
    parts = rollup(nodes.select("x", "y", "px", "py", "depth", F.col("conv_id").alias("conv"), "weight", F.when(inner, 0).otherwise(1).cast("long").alias("leaf"),
                                ((F.col("n_convs") - 1) * F.col("last_words")).alias("words"), "cx", "cy"), turns, local)
    ends = hash_ends(turns.where("pos = length").select("x", "y", "conv_id"))
    kids = nodes.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("n_children"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    body = materialize(nodes.join(parts, ["x", "y"]).join(kids, ["x", "y"], "left").join(ends, ["x", "y"], "left").select(
        "x", "y", "px", "py", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")), "trie-rows")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # the root: all conversations are its members, the first turns its children; one row each of constant size
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    first = body.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    lone = hash_ends(convs.where("length = 0").select(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv_id"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    root = (one(top).join(one(first), "_one").join(one(lone.select("ends_sha256")), "_one", "left").where("n_convs > 0")
            .select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
                    F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).cast("long").alias("n_leaves"),
                    F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256")))
    root_id = convs.agg(F.min("conv_id").alias("parent_conv_id"))
    parents = body.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    shallow = one(body.where("depth = 1")).join(F.broadcast(one(root_id)), "_one").select(*columns)  # one row
    deeper = body.where("depth > 1").join(parents, ["px", "py"]).select(*columns)
    return root.unionByName(shallow).unionByName(deeper)
