"""Ordered scans that stay parallel when one key holds a large share of the rows.

A window ``row_number() / sum() OVER (PARTITION BY key ORDER BY o)`` runs each
key in one task, so a key holding a third of the data is a third of the job
in one sequential task, and AQE cannot split it.  ``ordered_scan`` computes
the same running row number and running total without that limit.  One
aggregate counts the rows of each key; keys of at most ``WHOLE`` rows are
scanned by such a window after one shuffle into tasks of about ``PER_TASK``
rows, and the others, if there are any, are split:

1. ``repartitionByRange(key, order)``: the sampled range bounds split a hot key
   across as many partitions as its share of the data needs.  The rows are
   written once with the number of their range as a column.  The bounds are
   sampled anew each time a plan runs, so the rows and their totals have to
   come from one stored split.
2. A window per (range, key) numbers and sums the rows inside each range.
3. A grouped aggregate gives the totals per (range, key); a window over those
   few rows (one per key, and one more per range that a key crosses) gives what
   lies before each range, and one join on (range, key) adds it.

Keys compare as one struct, so null keys form a group like any other, and all
numbers stay exact 64-bit integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.session import materialize


WHOLE = 100_000  # rows of a key that one task may scan
PER_TASK = 250_000  # rows of a task that scans whole keys


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def ordered_scan(df: DataFrame, key, order, value: str | None = None, rn_col: str = "_rn",
                 cum_col: str | None = None, num_partitions: int | None = None, count_col: str | None = None,
                 key_sums: dict[str, Column] | None = None, key_maxima: dict[str, Column] | None = None,
                 together: str | None = None, whole: int | None = None, placed: bool = False) -> DataFrame:
    """Add the 1-based position of each row within its key (by ``order``) and, if ``cum_col`` is
    given, the running total of ``value`` up to and including the row.

    ``order`` should make rows of a key distinct for positions to be
    deterministic.  Null keys are one key, null values add nothing.
    ``count_col`` also adds the number of rows of the key, ``key_sums`` and ``key_maxima`` add totals of
    expressions over the key's rows, taken from the same split.  ``together`` names a column of the key
    whose values stay in one task each as long as they have at most ``whole`` rows, so that grouping by it
    afterwards needs no other shuffle.  ``placed`` says that the caller has put the rows of each key into one task.
    """
    keys, orders = _as_list(key), _as_list(order)
    by = [together] if together else keys
    whole = WHOLE if whole is None else whole
    more = {**{n: (F.sum, e) for n, e in (key_sums or {}).items()}, **{n: (F.max, e) for n, e in (key_maxima or {}).items()}}
    amount = F.col(value).cast("bigint") if cum_col else F.lit(0).cast("bigint")
    out = (keys, orders, amount, rn_col, cum_col, count_col, more)

    if placed:
        return _scan_whole(df, *out)
    if whole == 0:  # every key is large
        return _scan_split(df, num_partitions, *out)
    tasks, large = key_layout(df, by, whole)
    if large is None:
        return _scan_whole(df.repartition(num_partitions or tasks, *by), *out)
    small_keys, large_keys = split_keys(df, by, large)
    return _scan_whole(small_keys.repartition(num_partitions or tasks, *by), *out).unionByName(_scan_split(large_keys, num_partitions, *out))


def key_layout(df: DataFrame, by: list[str], whole: int, per_task: int = PER_TASK) -> tuple[int, DataFrame | None]:
    """How many tasks of about ``per_task`` rows ``df`` fills, and its keys of more than ``whole`` rows (None if there are none)."""
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    n_rows, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    given = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-n_rows // per_task), min(given, -(-n_rows // (per_task // 10))), 1)
    if most <= whole:
        return tasks, None
    return tasks, materialize(counts.where(F.col("_n") > whole).select(F.struct(*by).alias("_by")), "large-keys")


def split_keys(df: DataFrame, by: list[str], large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose key is not among the ``large`` ones (at most rows / whole of them), and those whose key is."""
    named = df.withColumn("_by", F.struct(*by))
    return tuple(named.join(F.broadcast(large), "_by", how).select(*df.columns) for how in ("left_anti", "left_semi"))


def _scan_whole(df: DataFrame, keys, orders, amount: Column, rn_col, cum_col, count_col, more) -> DataFrame:
    """Rows that are spread by key: one sort."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(*orders)
    rows = df.withColumn("_at", F.row_number().over(upto))
    if cum_col:
        rows = rows.withColumn("_upto", F.coalesce(F.sum(amount).over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)))
    return rows.select(*df.columns, F.col("_at").cast("bigint").alias(rn_col), *([F.col("_upto").cast("bigint").alias(cum_col)] if cum_col else []),
                       *([F.count("*").over(group).cast("bigint").alias(count_col)] if count_col else []),
                       *[f(e).over(group).alias(n) for n, (f, e) in more.items()])


def _scan_split(df: DataFrame, num_partitions, keys, orders, amount: Column, rn_col, cum_col, count_col, more) -> DataFrame:
    """Keys cut into ranges of their rows."""
    spread = df.repartitionByRange(*([num_partitions] if num_partitions else []), *keys, *orders)
    local = materialize(spread.withColumn("_range", F.spark_partition_id()), "scan").withColumn("_key", F.struct(*keys))

    here = Window.partitionBy("_range", "_key")
    upto = here.orderBy(*orders).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = local.withColumn("_at", F.row_number().over(here.orderBy(*orders)))
    if cum_col:
        rows = rows.withColumn("_upto", F.coalesce(F.sum(amount).over(upto), F.lit(0)))

    totals = local.groupBy("_range", "_key").agg(F.count("*").alias("_n"), F.coalesce(F.sum(amount), F.lit(0)).alias("_sum"),
                                                 *[f(e).alias(n) for n, (f, e) in more.items()])
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", "_key", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
                            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
                            F.sum("_n").over(Window.partitionBy("_key")).alias("_n_key"),
                            *[f(n).over(Window.partitionBy("_key")).alias(n) for n, (f, _) in more.items()])
    found = rows.join(offsets, ["_range", "_key"])
    return found.select(*df.columns, (F.col("_at") + F.col("_n_before")).cast("bigint").alias(rn_col),
                        *([(F.col("_upto") + F.col("_sum_before")).cast("bigint").alias(cum_col)] if cum_col else []),
                        *([F.col("_n_key").cast("bigint").alias(count_col)] if count_col else []), *more)
