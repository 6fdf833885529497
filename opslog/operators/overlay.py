"""Layered settings (operators D1, D2) and map merge (J1 lives in functions.paths).

D1 resolves which overlays apply to a name by glob, then keeps the latest
value per key.  The per-name result is a map built from at most one entry per
configured key, so the only collected group is bounded by the configuration,
never by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.operators.select import glob_pairs


def overlay_rows(overlays: DataFrame) -> DataFrame:
    """Accept overlays as (ord, pattern, env MAP) or already as (ord, pattern, k, v)."""
    if "env" in overlays.columns:
        return overlays.select("ord", "pattern", F.explode("env").alias("k", "v"))
    return overlays.select("ord", "pattern", "k", "v")


def env_overlay(names: DataFrame, overlays: DataFrame, name_col: str = "name") -> DataFrame:
    """``(name, env)``; every overlay whose glob matches contributes, later ``ord`` wins per key.

    A name no overlay matches gets an empty map.
    """
    distinct = names.select(name_col).where(F.col(name_col).isNotNull()).distinct()
    rows = overlay_rows(overlays)
    patterns = overlays.select("pattern").where(F.col("pattern").isNotNull()).distinct()
    pairs = glob_pairs(distinct, name_col, patterns, "pattern").join(rows, "pattern")
    per_key = (pairs.where(F.col("k").isNotNull())
               .groupBy(name_col, "k").agg(F.max_by("v", "ord").alias("v")))
    env = per_key.groupBy(name_col).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("env"))
    return (distinct.join(env, name_col, "left")
            .select(name_col, F.coalesce("env", F.create_map().cast("map<string,string>")).alias("env")))


def env_text(env_col: str = "env"):
    """A map as ``k=v,k=v`` in key order (stable text for reports and comparisons)."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(F.col(env_col))),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def profile_lookup(requests: DataFrame, custom: DataFrame, defaults: DataFrame, name_col: str = "name",
                   ord_col: str = "ord") -> DataFrame:
    """For each requested name, the first custom profile with that name, else the built-in
    default, else null.  The whole profile is replaced, never merged field by field."""
    fields = [c for c in custom.columns if c not in (name_col, ord_col)]
    first_custom = custom.groupBy(name_col).agg(
        F.min_by(F.struct(*fields), F.col(ord_col)).alias("_custom"))
    dflt = defaults.select(name_col, F.struct(*[F.col(c) for c in fields]).alias("_default"))
    j = requests.select(name_col).join(first_custom, name_col, "left").join(dflt, name_col, "left")
    return j.select(
        name_col,
        F.coalesce("_custom", "_default").alias("profile"),
        F.when(F.col("_custom").isNotNull(), F.lit("custom"))
         .when(F.col("_default").isNotNull(), F.lit("default")).alias("source"),
    )
