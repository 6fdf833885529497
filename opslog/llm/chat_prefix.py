"""Chat formatting after collapsing cumulative snapshots (DataFrame functions only).

Logs of a growing conversation hold it many times, each snapshot a prefix of a
longer one.  Every turn gets a hash of its place, role and text; the running
sum of these hashes names the turns up to it, so a conversation is a prefix of
another when its last name is one of the other's earlier names.  An anti-join
drops such conversations, a second one all but the first of equal
conversations; the maximal ones are rendered.

Running sums are taken in two steps (inside blocks of turns, then over the
blocks' totals), so that a single conversation may hold any share of the rows.
Names are pairs of 64-bit sums; only hashes, never texts, are shuffled before
the rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.session import materialize

BLOCK_TURNS = 256  # turn numbers in a block of the running sums
PART_TURNS = 1024  # turns in one rendered row

TURN_START, ROLE_END, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"  # fixed values: the usual chat markup


def _hash(seed: int, *cols) -> Column:
    """xxhash64 skips nulls, so each value comes with whether it is there."""
    parts = [F.lit(seed)]
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


def _wrap_sum(c: str, w=None) -> Column:
    """Sum modulo 2^64 of a long column."""
    total = F.sum(F.col(c).cast("decimal(38,0)"))
    total = total if w is None else total.over(w)
    low = F.pmod(total, F.lit("18446744073709551616").cast("decimal(38,0)"))
    half, full = F.lit("9223372036854775808").cast("decimal(38,0)"), F.lit("18446744073709551616").cast("decimal(38,0)")
    return F.when(low >= half, low - full).otherwise(low).cast("long")


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, text_key, pos, h1, h2): each distinct turn with its place from 1 and the names of the turns up to it.

    Turns are ordered by turn (nulls first), then role and text hash; rows equal in all four columns count once.
    """
    turns = (conversations.select("conv_id", "turn", _hash(3, "role", "text").alias("text_key"), F.xxhash64(F.lit(5), "text", "role").alias("k2"))
             .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)).distinct())
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "text_key", "k2")
    placed = turns.withColumn("n", F.row_number().over(inside))
    sizes = turns.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    blocks = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    lead = sizes.withColumn("lead", F.coalesce(F.sum("size").over(blocks), F.lit(0))).drop("size")
    on = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & F.col(f"{a}.block").eqNullSafe(F.col(f"{b}.block"))
    p, q = placed.alias("p"), lead.alias("q")
    hashed = (p.join(q, on("p", "q")).select("p.conv_id", "p.turn", "p.block", "p.text_key", "p.k2", (F.col("p.n") + F.col("q.lead")).alias("pos"))
              .withColumn("t1", F.xxhash64("pos", "text_key", "k2")).withColumn("t2", F.xxhash64("k2", F.lit(9), "pos", "text_key")))
    hashed = materialize(hashed, "turns")
    upto = Window.partitionBy("conv_id", "block").orderBy("pos")
    within = hashed.withColumn("s1", _wrap_sum("t1", upto)).withColumn("s2", _wrap_sum("t2", upto))
    totals = hashed.groupBy("conv_id", "block").agg(_wrap_sum("t1").alias("b1"), _wrap_sum("t2").alias("b2"))
    before = (totals.withColumn("l1", F.coalesce(_wrap_sum("b1", blocks), F.lit(0)))
              .withColumn("l2", F.coalesce(_wrap_sum("b2", blocks), F.lit(0))))
    w, b = within.alias("w"), before.alias("b")
    return (w.join(b, on("w", "b")).select("w.conv_id", "w.turn", "w.text_key", "w.pos",
                                           "s1", "s2", "l1", "l2")
            .select("conv_id", "turn", "text_key", "pos", _add("s1", "l1").alias("h1"), _add("s2", "l2").alias("h2")))


def _add(a: str, b: str) -> Column:
    """Sum of two longs modulo 2^64, without an overflow error."""
    full, half = F.lit("18446744073709551616").cast("decimal(38,0)"), F.lit("9223372036854775808").cast("decimal(38,0)")
    low = F.pmod(F.col(a).cast("decimal(38,0)") + F.col(b).cast("decimal(38,0)"), full)
    return F.when(low >= half, low - full).otherwise(low).cast("long")


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of conversations that are no proper prefix of another and the first, by id, of equal ones."""
    return _maximal(materialize(turn_prefixes(conversations), "prefixes"))


def _maximal(prefixes: DataFrame) -> DataFrame:
    sizes = prefixes.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("end"))
    ends = sizes.select("conv_id", F.col("end.pos").alias("pos"), F.col("end.h1").alias("h1"), F.col("end.h2").alias("h2"))
    firsts = ends.groupBy("pos", "h1", "h2").agg(F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("m"))
    # a name that is some conversation's end but stands before the end of another; both tables are distinct names
    p, e = prefixes.alias("p"), ends.alias("e")
    inner = (p.join(e, F.col("p.conv_id").eqNullSafe(F.col("e.conv_id"))).where("p.pos < e.pos")
             .select("p.pos", "p.h1", "p.h2").distinct())
    return (firsts.join(inner, ["pos", "h1", "h2"], "left_anti")
            .select(F.col("m.conv_id").alias("conv_id"), F.col("pos").alias("n_turns")))


def format_chats(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, part, n_turns, text: the maximal conversations, rendered.

    Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``; a null role or text is empty there, though it differs from an
    empty one when conversations are compared.  A conversation has one row for every ``part_turns`` turns (part 0, 1, ...), so that
    no row grows without bound.  Rows without a conversation id make up one conversation of their own.  Columns other than
    conv_id, turn, role and text are ignored, whatever their names.
    """
    base = conversations.select("conv_id", "turn", "role", "text")
    prefixes = materialize(turn_prefixes(base), "prefixes")
    kept = _maximal(prefixes).alias("m")
    x = prefixes.alias("x")
    places = x.join(kept, F.col("x.conv_id").eqNullSafe(F.col("m.conv_id"))).select("x.conv_id", "x.turn", "x.text_key", "x.pos", "m.n_turns")
    line = F.concat(F.lit(TURN_START), F.coalesce("role", F.lit("")), F.lit(ROLE_END), F.coalesce("text", F.lit("")), F.lit(TURN_END))
    texts = base.select("conv_id", "turn", _hash(3, "role", "text").alias("text_key"), line.alias("line")).distinct()
    t, p = texts.alias("t"), places.alias("p")
    lines = t.join(p, F.col("t.conv_id").eqNullSafe(F.col("p.conv_id")) & F.col("t.turn").eqNullSafe(F.col("p.turn"))
                   & (F.col("t.text_key") == F.col("p.text_key"))).select("p.conv_id", "p.pos", "p.n_turns", "t.line")
    # at most part_turns lines of one conversation
    return (lines.groupBy("conv_id", F.floor((F.col("pos") - 1) / part_turns).cast("int").alias("part"))
            .agg(F.first("n_turns").cast("long").alias("n_turns"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("ls"))
            .select("conv_id", "part", "n_turns", F.array_join(F.col("ls.line"), "").alias("text")))
