"""Flattening and table layout operators.

B1 and B11 turn maps into ordered rows with ``explode``/``posexplode``; I7
pads the fields of a row set to the widest value of each column within a key,
taking the widths from a grouped ``max`` joined back (partial aggregation, no
whole-group window).
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from opslog.functions import fmt


def explode_groups(df, map_col="groups"):
    """B1: map of group -> directories as rows; a group without directories keeps one null row."""
    g = df.select("*", F.explode(map_col).alias("grp", "_dirs")).drop(map_col)
    return g.select(*[c for c in g.columns if c != "_dirs"], F.posexplode_outer("_dirs").alias("pos", "directory"))


def config_rows(df, map_col="config"):
    """Parameters as ordered ``(pos, key, value)`` rows."""
    return df.select(*[c for c in df.columns if c != map_col],
                     F.posexplode(F.map_entries(map_col)).alias("pos", "_e")) \
             .select("*", F.col("_e.key").alias("key"), F.col("_e.value").alias("value")).drop("_e")


def map_text(col):
    """A map as ``k=v;k=v`` in its own key order (stable text for reports and checks)."""
    return F.array_join(F.transform(F.map_entries(col), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def align(df, key, cols: list[str], spec: str, out_prefix: str = "a_"):
    """Strip fields and pad each to the widest value of its column within ``key``.

    An unusable spec (empty, unknown letter, too short) returns the fields untouched.
    Widths come from a grouped ``max`` joined back (partial aggregation, no whole-group window).
    """
    keys = [key] if isinstance(key, str) else list(key)
    spec2 = fmt.valid_alignment(spec, len(cols))
    if spec2 is None:
        return df.select("*", *[F.col(c).alias(out_prefix + c) for c in cols])
    stripped = df.select("*", *[fmt.strip(c).alias(f"_s_{c}") for c in cols])
    widths = stripped.groupBy(*keys).agg(*[F.max(F.length(f"_s_{c}")).alias(f"_w_{c}") for c in cols])
    widths = widths.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_w_{c}" for c in cols])
    j = stripped.join(widths, functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]))
    outs = [fmt.ALIGNERS[a](f"_s_{c}", F.col(f"_w_{c}")).alias(out_prefix + c) for a, c in zip(spec2, cols)]
    return j.select(*df.columns, *outs)
