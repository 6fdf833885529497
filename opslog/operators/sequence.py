"""Ordered work within a run or file (operators G1-G7) and ordering helpers (H1-H5).

Whole-group facts (first failure, group size, first timestamp) are computed
with ``groupBy`` + join rather than a window over the whole group: the
aggregate combines map-side and the join back is split by AQE when one key
is hot.  Running positions (row numbers, running byte totals) come from
``ordered_scan``, which always range-partitions on (key, order) so a hot key
is spread over many tasks instead of one window task.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.operators.scan import ordered_scan


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- G1 ---------------------------------------------------------------------------------------

def executed_prefix(df: DataFrame, key: str, order: str, ok: str = "ok", out: str = "executed") -> DataFrame:
    """G1: rows up to and including the first failure of each group; later rows never ran."""
    first_fail = (df.where(~F.coalesce(F.col(ok), F.lit(False)))
                  .groupBy(key).agg(F.min(order).alias("_first_fail")))
    j = df.join(first_fail.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return j.withColumn(out, F.col("_first_fail").isNull() | (F.col(order) <= F.col("_first_fail"))) \
            .drop("_first_fail")


# --- G2-G4 ------------------------------------------------------------------------------------

def index_of_total(df: DataFrame, key, order, out: str = "label") -> DataFrame:
    """``[i/n]`` labels, 1-based, in sort order within each group."""
    d = ordered_scan(df, key, order, rn_col="_i", count_col="_n")
    return d.withColumn(out, F.concat(F.lit("["), F.col("_i").cast("string"), F.lit("/"),
                                      F.col("_n").cast("string"), F.lit("]"))).drop("_n", "_i")


def arrival_index(df: DataFrame, key, order, out: str = "label") -> DataFrame:
    """0-based arrival number with at least two digits and a dot (``00. ``)."""
    d = ordered_scan(df, key, order, rn_col="_i")
    return d.withColumn(out, F.concat(F.format_string("%02d", F.col("_i") - 1), F.lit(". "))).drop("_i")


def list_labels(df: DataFrame, key, order, style: str | None = "number", out: str = "label") -> DataFrame:
    """``- `` bullets, or ``1. `` numbers (``01. `` once a list has 10 or more entries)."""
    if style == "bullet":
        return df.withColumn(out, F.lit("- "))
    if style != "number":
        return df.withColumn(out, F.lit(""))
    d = ordered_scan(df, key, order, rn_col="_i", count_col="_n")
    num = F.when(F.col("_n") < 10, F.col("_i").cast("string")).otherwise(F.format_string("%02d", F.col("_i")))
    return d.withColumn(out, F.concat(num, F.lit(". "))).drop("_n", "_i")


# --- G5-G7: upload progress -------------------------------------------------------------------

def cumulative_pct(chunks: DataFrame, file: str = "file", seq: str = "seq", nbytes: str = "bytes",
                   filesize: str = "filesize") -> DataFrame:
    """Running uploaded bytes and ``min(int(uploaded / size * 100), 100)`` (double arithmetic)."""
    d = ordered_scan(chunks, file, seq, value=nbytes, rn_col="_i", cum_col="uploaded").drop("_i")
    pct = F.least(F.try_divide(F.col("uploaded").cast("double"), F.col(filesize).cast("double")) * 100, F.lit(100.0)).cast("int")  # an empty file is all there: 100
    return d.withColumn("pct", pct)


THROTTLE_STEP = 10


def throttle_progress(progress: DataFrame, file: str = "file", seq: str = "seq", pct: str = "pct",
                      step: int = THROTTLE_STEP) -> DataFrame:
    """The progress rows a throttled reporter emits.

    A row is emitted when its percentage is at least the last emitted one plus
    ``step`` (starting from 0), or once when 100 is reached.  Percentages only
    grow along a file, so only the first row of each percentage value can be
    emitted: each file reduces to at most 101 candidates (a map-side partial
    aggregate), and the sequential rule folds over that bounded list.
    """
    rest = [c for c in progress.columns if c not in (file, pct)]
    # first row of each percentage value, whole (no join back onto the progress rows later)
    cand = progress.groupBy(file, pct).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_row"))
    per_file = cand.groupBy(file).agg(F.array_sort(F.collect_list(
        F.struct(F.col(pct).alias("p"), F.col(f"_row.{seq}").alias("s"), F.col("_row").alias("r")))).alias("_c"))
    elem_type = per_file.schema["_c"].dataType.simpleString()
    init = F.struct(F.lit(0).alias("last"), F.array().cast(elem_type).alias("out"))

    def step_fn(acc, x):
        emit = (x["p"] >= acc["last"] + step) | ((x["p"] == 100) & (acc["last"] != 100))
        return F.when(emit, F.struct(x["p"].alias("last"),
                                     F.array_append(acc["out"], x).alias("out"))).otherwise(acc)

    folded = per_file.select(file, F.explode(F.aggregate("_c", init, step_fn)["out"]).alias("_e"))
    return folded.select(*[F.col(file) if c == file else F.col("_e.p").alias(pct) if c == pct
                           else F.col(f"_e.r.{c}").alias(c) for c in progress.columns])


def progress_rate(emitted: DataFrame, firsts: DataFrame, file: str = "file", ts: str = "ts",
                  uploaded: str = "uploaded") -> DataFrame:
    """At each emission, elapsed since the upload began (at least 1 s) and floored bytes/s."""
    from opslog.operators.measures import elapsed_us, speed_bps
    begun = firsts.select(F.col(file).alias("_file"), "_start")
    d = emitted.join(begun, F.col(file).eqNullSafe(F.col("_file"))).drop("_file")
    el = elapsed_us("_start", ts, mode="upload")
    return (d.withColumn("elapsed_us", el)
             .withColumn("speed", speed_bps(uploaded, "elapsed_us", F.lit(True)))
             .drop("_start"))


def upload_starts(chunks: DataFrame, file: str = "file", ts: str = "ts") -> DataFrame:
    return chunks.groupBy(file).agg(F.min(ts).alias("_start"))


# --- H ----------------------------------------------------------------------------------------

def sort_by_name(df: DataFrame, name: str = "name", *tiebreak: str) -> DataFrame:
    """H1: ascending by name (UTF-8 byte order = code-point order), ties broken by the given columns."""
    return df.orderBy(name, *tiebreak)


def sort_multi(df: DataFrame, *cols) -> DataFrame:
    """H2: multi-column ascending sort."""
    return df.orderBy(*cols)


def first_match(df: DataFrame, key, order: str, predicate: Column, out: str = "first") -> DataFrame:
    """H3: per key, the first row (by ``order``) satisfying ``predicate``; keys without one give null."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    firsts = (df.where(F.coalesce(predicate, F.lit(False)))
              .groupBy(*keys).agg(F.min_by(F.struct(*payload), F.col(order)).alias(out)))
    firsts = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], out)
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.select(*keys).distinct().join(firsts, same, "left").select(*keys, out)


def union_sections(sections: list[DataFrame]) -> DataFrame:
    """H4: sections stacked in the given order; rows carry ``(section_no, line_no)``."""
    out = None
    for i, s in enumerate(sections):
        s = s.withColumn("section_no", F.lit(i))
        out = s if out is None else out.unionByName(s)
    return out


def split_outcome(df: DataFrame, col: str = "success") -> tuple[DataFrame, DataFrame]:
    """H5: complementary (ok, failed) views of one input."""
    from opslog.operators.select import where_failed, where_success
    return where_success(df, col), where_failed(df, col)
