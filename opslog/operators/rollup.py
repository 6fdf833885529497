"""Group-level outcomes of runs (operators F1-F8).

All of these are plain ``groupBy().agg()`` so Spark does a map-side partial
aggregation before the shuffle: a group holding a third of all rows costs one
partial row per input partition, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def any_success(col="success") -> Column:
    """an action that passes when any entry does; no entries fails."""
    return F.coalesce(F.bool_or(F.coalesce(_c(col), F.lit(False))), F.lit(False))


def all_success(col="success") -> Column:
    """passes only when all entries do; no entries passes."""
    return F.coalesce(F.bool_and(F.coalesce(_c(col), F.lit(False))), F.lit(True))


def total_size(size="size", success="success") -> Column:
    """bytes of the successful entries, 0 when none."""
    return F.coalesce(F.sum(F.when(F.coalesce(_c(success), F.lit(False)), _c(size))), F.lit(0)).cast("bigint")


def outcome_counts(success="success") -> list[Column]:
    """total, ok and failed counts."""
    ok = F.coalesce(_c(success), F.lit(False))
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(ok).alias("ok"),
            F.count_if(~ok).alias("failed")]


def sum_elapsed(elapsed="elapsed_us", success=None, wide: bool = False) -> Column:
    """summed elapsed microseconds (0 for none); optionally over successes only.

    ``wide`` sums as DECIMAL(38,0), for groups whose total may pass 2^63 (about 292,000 years).
    """
    e = _c(elapsed)
    if success is not None:
        e = F.when(F.coalesce(_c(success), F.lit(False)), e)
    if wide:
        return F.coalesce(F.sum(e.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
    return F.coalesce(F.sum(e), F.lit(0)).cast("bigint")


def narrowed(df: DataFrame, col: str) -> DataFrame:
    """``df`` (a written table) with the whole numbers of ``col`` as BIGINT, or still as DECIMAL where one does not fit."""
    least, most = df.agg(F.min(col), F.max(col)).first()
    fits = least is None or (least >= -2 ** 63 and most < 2 ** 63)
    return df.withColumn(col, F.col(col).cast("bigint")) if fits else df


def time_span(started="started", completed="completed") -> list[Column]:
    """earliest start and latest completion."""
    return [F.min(_c(started)).alias("first_started"), F.max(_c(completed)).alias("last_completed")]


def group_list(col) -> Column:
    """distinct names, sorted, joined with ', '; ``[none]`` when empty."""
    s = F.array_sort(F.collect_set(_c(col)))
    return F.when(F.size(s) == 0, F.lit("[none]")).otherwise(F.array_join(s, ", "))


def with_children(parents: DataFrame, summary: DataFrame, keys: list[str], defaults: dict) -> DataFrame:
    """Keep parents that have no children, filling the empty-group values (F2 empty = pass)."""
    out = parents.join(summary, keys, "left")
    return out.fillna(defaults)


def run_rollup(processes: DataFrame, run_key: str = "run_id", op_key: str = "directory",
               success: str = "success", elapsed: str = "elapsed_us", size: str = "size", tasks: int | None = None) -> DataFrame:
    """F8: process -> operation -> run.

    An operation passes when all its processes pass and spans the sum of their
    elapsed times; a run passes when all its operations pass and counts them,
    the bytes of successful processes and the elapsed time of its operations.
    Runs with few processes each leave nothing for a partial aggregate to do: it would hold one group per process.
    ``tasks`` spreads the operations over that many tasks first, so that each holds its share only.
    """
    if tasks:
        processes = processes.select(run_key, op_key, success, elapsed, size).repartition(tasks, run_key, op_key)
    ops = (processes.groupBy(run_key, op_key)
           .agg(all_success(success).alias("op_success"),
                F.count(F.lit(1)).alias("n_proc"),
                sum_elapsed(elapsed).alias("op_elapsed_us"),
                total_size(size, success).alias("op_bytes")))
    return (ops.groupBy(run_key)
            .agg(all_success("op_success").alias("run_success"),
                 F.count(F.lit(1)).alias("n_ops"),
                 F.count_if("op_success").alias("n_ops_ok"),
                 F.sum("n_proc").cast("bigint").alias("n_proc"),
                 F.sum("op_bytes").cast("bigint").alias("run_bytes"),
                 F.sum("op_elapsed_us").cast("bigint").alias("run_elapsed_us")))


# How an action passes, by its kind; other kinds need all of their operations.
ACTION_RULES = {"mapping": "always", "backup": "any", "upload": "any", "deploy": "all"}


def outcome_levels(processes: DataFrame, run_key: str = "run_id", action: str = "action", operation: str = "operation",
                   rules: dict[str, str] | None = None) -> DataFrame:
    """One row for every operation, action and run, each by the rule of its level.

    ``processes``: run, action (its kind), operation, success, size, elapsed_us, started, completed.  An operation passes
    with all its processes, an action by its kind's rule, a run with all its actions; sizes count successes only, an
    operation's elapsed time is the sum of its processes, an action's and a run's their span.  ``scope_started`` and
    ``scope_completed`` of an operation are those of its whole action, of other rows their own.  Each level is
    aggregated from the rows of the one below, so a large run arrives as partial totals.
    """
    from opslog.session import materialize
    rules = ACTION_RULES if rules is None else rules
    kinds = lambda rule: [k for k, r in rules.items() if r == rule]
    span = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("completed"))
    inner = [F.sum("n").cast("bigint").alias("n"), F.sum("bytes").cast("bigint").alias("bytes"), F.min("started").alias("started"),
             F.max("completed").alias("completed")]
    ops = materialize(processes.groupBy(run_key, action, operation).agg(
        all_success().alias("success"), F.count("*").alias("n"), total_size().alias("bytes"), sum_elapsed().alias("elapsed_us"),
        F.min("started").alias("started"), F.max("completed").alias("completed")), "operations")
    acts = ops.groupBy(run_key, action).agg(any_success().alias("_any"), all_success().alias("_all"), *inner)
    acts = materialize(acts.withColumn("success", F.when(F.col(action).isin(kinds("always")), True)
                                       .when(F.col(action).isin(kinds("any")), F.col("_any")).otherwise(F.col("_all")))
                       .withColumn("elapsed_us", span).drop("_any", "_all"), "actions")
    runs = acts.groupBy(run_key).agg(all_success().alias("success"), *inner).withColumn("elapsed_us", span)
    scope = acts.select(F.col(run_key).alias("_r"), F.col(action).alias("_a"), F.col("started").alias("scope_started"), F.col("completed").alias("scope_completed"))
    scoped = ops.join(scope, F.col(run_key).eqNullSafe(F.col("_r")) & F.col(action).eqNullSafe(F.col("_a"))).drop("_r", "_a")
    own = {"scope_started": F.col("started"), "scope_completed": F.col("completed")}
    none = F.lit(None).cast("string")
    out = None
    for level, df in (("operation", scoped), ("action", acts.withColumn(operation, none).withColumns(own)),
                      ("run", runs.withColumns({action: none, operation: none}).withColumns(own))):
        df = df.withColumn("level", F.lit(level))
        out = df if out is None else out.unionByName(df)
    return out.select(run_key, "level", action, operation, "success", "n", "bytes", "elapsed_us", "started", "completed", "scope_started", "scope_completed")
