"""Line dedup by an exact set-similarity join (DataFrame functions only).

A line is the set of its distinct five-word shingles; a line of one to four words
is the set of its whole word sequence.  Under any one order of tokens, two lines of Jaccard t or more
share a token among the first ``n - ceil(t n) + 1`` of each; candidates must
also pass the length filter and the positional filter, and are verified by the
exact Jaccard of their sets.  A line that matches any earlier line is removed;
lines are ordered by document id (nulls first), hash of the document's text, place and hash.

All lines first meet under the order of token hashes.  Where the first token that two lines share stands in the
prefixes of more than ``FEW`` lines, that bucket is left out, and both belong to the lines that meet
again under the order of rarity: the number of such lines behind a token's counter in a table of
fixed size (tokens share counters by hash), then hash.

Equal lines are collapsed first.  A line's own edits are its rarest tokens, so
variants of one line that differ too much share no prefix token or fail the
positional filter.  In a token's bucket the ``LEADERS`` earliest
lines are compared with all; only lines that match none of them are compared
with the rest of the bucket, which lets thousands of variants of one line cost
a few comparisons each.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import WS_CHARS, small_side
from opslog.session import materialize

WORDS = 5  # a shingle
NUM, DEN = 80, 100
COUNTERS = 1 << 18
LEADERS = 8
FEW = 64  # lines in a bucket of the order by hash; lines of larger buckets meet under the order of rarity


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; an expression inside a lambda would be computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(line: Column) -> Column:
    """The words of a line; cut at single spaces, which is cheap, where the line has no other white space."""
    other = functools.reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in "\t\x0b\x0c\r"])
    return F.array_remove(F.when(other, F.split(line, WS_CHARS)).otherwise(F.split(line, " ")), "")


def _tokens(line: Column) -> Column:
    """Distinct shingle hashes of a line, ascending; fewer than WORDS words are one token, a blank line has none."""
    starts = lambda w: F.slice(F.sequence(F.lit(1), F.greatest(F.size(w) - (WORDS - 1), F.lit(1))), 1,
                               F.greatest(F.size(w) - (WORDS - 1), F.lit(0)))
    shingles = lambda w: F.transform(starts(w), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(-1, WORDS - 1)]))
    return F.sort_array(F.array_distinct(_let(_words(line), lambda w: F.when(
        F.size(w).between(1, WORDS - 1), F.array(F.xxhash64(F.size(w), w))).otherwise(shingles(w)))))


def text_key(text: Column | str) -> Column:
    """60 bits of a text's MD5: tells apart the rows that share an id, null ids included."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def document_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line) of every line of every text.

    Key and lines are made below the generator: what stands beside one is computed for every row that it makes.  The outer
    form is used since a plain one is preceded by a filter that cuts each text twice more.
    """
    cut = docs.select("doc_id", text_key("text").alias("text_key"), F.split("text", "\n").alias("lines"))
    return cut.select("doc_id", "text_key", F.posexplode_outer("lines").alias("line_no", "line")).where("line is not null")


def _named(lines: DataFrame) -> DataFrame:
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _prefix_size(n: Column, num: int, den: int) -> Column:
    return n - F.ceil(n * num / den).cast("int") + 1


def _halves(tokens: Column) -> Column:
    """The upper halves of token hashes.

    A half may stand for two tokens of a line; it then stands twice, so sizes and places in an order are those of the
    whole hashes.
    """
    return F.transform(tokens, lambda x: F.shiftright(x, 32).cast("int"))


def _line_table(docs: DataFrame, num: int, den: int) -> DataFrame:
    """Every line: its names, place, and ``set``: number of tokens (0: a blank line, not judged) and the halves of its prefix by hash."""
    part = lambda t: F.struct(F.size(t).alias("n"), _halves(F.slice(t, 1, _prefix_size(F.size(t), num, den))).alias("prefix"))
    return _named(document_lines(docs)).select("doc_id", "text_key", "line_no", "h1", "h2", _let(_tokens(F.col("line")), part).alias("set"))


def _counter(x: Column) -> Column:
    return F.pmod(x, F.lit(COUNTERS)).cast("int")


def _rarity(lines: DataFrame) -> DataFrame:
    """Base-2 logarithm of each counter's number of distinct lines, as one row with one array of COUNTERS small numbers.

    Read as a scalar subquery it is a value of the running query: as a literal it would stand in each printed plan, and
    adaptive execution prints a plan at every step.
    """
    counts = (lines.select(F.explode("tokens").alias("x")).groupBy(_counter(F.col("x")).alias("c"))
              .agg(F.ceil(F.log2(F.count("*") + F.lit(1))).cast("int").alias("k")))
    every = lines.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("c")).join(counts, "c", "left")
    placed = F.sort_array(F.collect_list(F.struct("c", F.coalesce("k", F.lit(0)).alias("k"))))  # COUNTERS entries
    return materialize(every.agg(placed.alias("placed")).select(F.col("placed.k").alias("classes")), "rarity")


def _earlier(a: str, b: str) -> Column:
    """Whether line a comes before line b."""
    key = lambda x: F.struct(F.col(f"{x}.doc_id").isNotNull(), f"{x}.doc_id", f"{x}.text_key", f"{x}.line_no", f"{x}.h1")
    return key(a) < key(b)


def _matches(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of (later, earlier) pairs, the later lines whose Jaccard with the earlier one reaches the threshold."""
    a = sets.select(F.col("id").alias("later"), F.col("tokens").alias("x"))
    b = sets.select(F.col("id").alias("earlier"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(a, "later").join(b, "earlier")
            .where(both * den >= (F.size("x") + F.size("y") - both) * num).select(F.col("later").alias("id")).distinct())


def _sets_of(ids: DataFrame, docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, tokens) of the lines named in ``ids``, cut again from their own texts alone; a repeated document gives its lines twice."""
    wanted = (distinct.select("id", "doc_id", "text_key", "line_no").join(ids, "id", "left_semi").groupBy("doc_id", "text_key")
              .agg(F.collect_list("id").alias("ids"), F.collect_list("line_no").alias("places")))  # one document's lines
    wanted = materialize(wanted.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"}), "wanted")
    here = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key("text") == F.col("__key"))
    found = _let(F.split("text", "\n"), lambda lines: F.zip_with("ids", "places", lambda i, at: F.struct(i.alias("id"), F.get(lines, at).alias("line"))))
    lines = docs.select("doc_id", "text").join(small_side(wanted), here).select(F.explode_outer(found).alias("l")).select("l.id", "l.line")
    return lines.select("id", _tokens(F.col("line")).alias("tokens"))


def _pair_sets(pairs: DataFrame, docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id, tokens) of the lines in (later, earlier) pairs."""
    ids = pairs.select(F.col("later").alias("id")).unionByName(pairs.select(F.col("earlier").alias("id"))).distinct()
    return materialize(_sets_of(ids, docs, distinct), "line-sets")


def _bucket_sizes(lines: DataFrame, order: int) -> DataFrame:
    """(token, id, n, at, size) of each row of ``lines`` (id, n, prefix) in a bucket of at least two; buckets of other orders are others."""
    rows = lines.select("id", "n", F.posexplode_outer("prefix").alias("at", "x")).select(
        F.col("x").alias("token"), "id", F.shiftleft(F.col("n").cast("long"), 31).bitwiseOR(F.col("at")).alias("n_at"))
    return rows.withColumn("size", F.count("*").over(Window.partitionBy("token"))).where("size > 1").select(
        (F.col("token").cast("long") + F.lit(order << 32)).alias("token"), "id", F.shiftright("n_at", 31).cast("int").alias("n"),
        F.col("n_at").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("at"), "size")


def _shared(distinct: DataFrame, docs: DataFrame, num: int, den: int, few: int) -> DataFrame:
    """(token, id, n, at) in buckets that bring together all lines which may match."""
    met = materialize(_bucket_sizes(distinct, 0), "shared")
    hot = materialize(met.where(F.col("size") > few).select("id").distinct(), "hot")
    shared = met.where(F.col("size") <= few).drop("size")
    if not hot.take(1):
        return shared
    # prefixes under the order of rarity: class in the upper half of a number, token in the lower one
    sets = _sets_of(hot, docs, distinct).select("id", _halves(F.col("tokens")).alias("tokens")).dropDuplicates(["id"])
    sets = materialize(sets.withColumn("n", F.size("tokens")), "hot-sets")
    ranked = F.sort_array(F.transform("tokens", lambda x: F.shiftleft(F.get(F.col("classes"), _counter(x)).cast("long"), 32)
                                      .bitwiseOR(x.cast("long").bitwiseAND(F.lit((1 << 32) - 1)))))
    prefix = F.transform(F.slice(ranked, 1, _prefix_size(F.col("n"), num, den)), lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))
    rare = materialize(_bucket_sizes(sets.withColumn("classes", _rarity(sets).scalar()).select("id", "n", prefix.alias("prefix")), 1), "rare")
    return shared.unionByName(rare.drop("size"))


def repeated_lines(docs: DataFrame, num: int = NUM, den: int = DEN, leaders: int = LEADERS, few: int = FEW) -> DataFrame:
    """(doc_id, text_key, line_no) of every line of ``docs`` (doc_id, text) that equals or matches an earlier one."""
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text_key", "line_no", "set"))
    distinct = (_line_table(docs, num, den).groupBy("h1", "h2").agg(first.alias("f"), F.count("*").alias("lines"))
                .select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "lines", "f.doc_id", "f.text_key", "f.line_no", "f.set.n", "f.set.prefix")
                .where("n > 0"))
    distinct = materialize(distinct, "distinct")  # from here on the ids are fixed

    placed = _shared(distinct, docs, num, den, few).join(distinct.select("id", "h1", "doc_id", "text_key", "line_no"), "id")
    by_place = Window.partitionBy("token").orderBy(F.col("doc_id").isNotNull(), "doc_id", "text_key", "line_no", "h1")
    placed = materialize(placed.withColumn("order", F.row_number().over(by_place)), "placed")

    def candidates(later: DataFrame, earlier: DataFrame) -> DataFrame:
        x, y = later.alias("x"), earlier.alias("y")
        least = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))  # tokens that can still be shared
        return materialize(
            x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("y.order") < F.col("x.order")) & _earlier("y", "x")
                   & (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num)
                   & (least * (num + den) >= (F.col("x.n") + F.col("y.n")) * num))
            .select(F.col("x.id").alias("later"), F.col("y.id").alias("earlier")).distinct(), "pairs")

    first_pairs = candidates(placed, placed.where(F.col("order") <= leaders))
    first_round = materialize(_matches(first_pairs, _pair_sets(first_pairs, docs, distinct), num, den), "matched")
    open_lines = placed.where(F.col("order") > leaders).join(first_round, "id", "left_anti")
    second_pairs = candidates(open_lines, placed.where(F.col("order") > leaders))
    second = _matches(second_pairs, _pair_sets(second_pairs, docs, distinct), num, den)
    matched = first_round.unionByName(second).distinct().withColumn("gone", F.lit(True))

    # lines that stand once are gone only if they match; the others are found again by name
    places = distinct.select("id", "lines", "h1", "h2", "doc_id", "text_key", "line_no").join(matched, "id", "left")
    v = materialize(places.where("gone or lines > 1").drop("id"), "repeated")
    again = small_side(v.where("lines > 1").drop("lines")).alias("v")
    l = _named(document_lines(docs)).drop("line").alias("l")
    first_here = F.col("l.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.col("l.text_key") == F.col("v.text_key")) \
        & (F.col("l.line_no") == F.col("v.line_no"))
    others = (l.join(again, (F.col("l.h1") == F.col("v.h1")) & (F.col("l.h2") == F.col("v.h2"))).where(~first_here)
              .select("l.doc_id", "l.text_key", "l.line_no"))
    return v.where("gone").select("doc_id", "text_key", "line_no").unionByName(others)


def dedup_lines(docs: DataFrame, num: int = NUM, den: int = DEN, leaders: int = LEADERS,
                counts: tuple[str, str] = ("n_lines", "n_removed"), few: int = FEW) -> DataFrame:
    """``docs`` with text without its repeated lines, and the numbers of lines and of removed lines.

    Lines are cut at "\\n"; kept lines are joined by it again, so a text without a repeated line is unchanged.  Blank lines
    are never judged.  A null text stays null and has no lines.  Rows with the same id and text are one document: each loses
    the same lines, and the first copy of a line stays in all of them.  Rows that share only their id, null ids too, are
    documents of their own, in the order of their texts' MD5.  All other columns are kept; columns of the two new names are
    replaced.
    """
    rest = [c for c in docs.columns if c not in counts]
    gone = (repeated_lines(docs.select("doc_id", "text"), num, den, leaders, few).distinct()
            .groupBy("doc_id", "text_key").agg(F.collect_list("line_no").alias("__gone")))  # one document's lines
    gone = materialize(gone.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"}), "gone")
    here = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key("text") == F.col("__key"))
    d = docs.select(*rest).join(small_side(gone), here, "left")
    lines = F.split("text", "\n")
    keep = F.filter(lines, lambda x, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n"))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    left = F.when(F.col("__gone").isNull() | F.col("text").isNull(), n).otherwise(F.size(keep))
    return d.select(*[(text if c == "text" else F.col(c)).alias(c) for c in rest], n.alias(counts[0]), (n - left).alias(counts[1]))
