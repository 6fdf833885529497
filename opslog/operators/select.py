"""Selecting rows by glob selectors and by outcome (operators C2-C6).

Selectors held as data (C3) are matched by one equi-join: a selector is keyed
by some literal text that each of its matches must hold (the whole name, its
first or last characters, or some inside), a name by all such texts it holds,
and the compiled regex is the residual condition.  No selector is compared
with names that do not share its key, and nothing is counted or broadcast by
the plan's author.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslog.functions.globs import any_glob, glob_to_regex


@F.pandas_udf(T.StringType())
def glob_regex(patterns: pd.Series) -> pd.Series:
    """Per-row helper: the anchored regex of each glob selector."""
    return patterns.map(lambda p: None if p is None else glob_to_regex(p))


def is_plain(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return ~c.rlike(r"[*?\[]")


def select_by_globs(df: DataFrame, name_col: str, patterns: list[str], sort: bool = False) -> DataFrame:
    """Rows whose name matches any selector; no selectors selects everything."""
    out = df.where(any_glob(name_col, list(patterns)))
    return out.orderBy(name_col) if sort else out


# A selector is keyed by up to this many characters of its literal text.
KEY_CHARS = 3


def _keyed(patterns: DataFrame, pattern_col: str) -> DataFrame:
    """Each selector with its anchored regex and one join key, a (kind, text) pair.

    The key is the best literal text that every match must hold: the whole name,
    the first characters, the last ones, or some inside.  A selector without any
    literal text has the key of all names.
    """
    p = F.col(pattern_col)
    open_text = F.regexp_replace(p, r"\[!?\]?[^\]]*\]", "*")  # a character set is no literal text
    head = F.regexp_extract(open_text, r"^([^*?\[]*)", 1)
    tail = F.regexp_extract(open_text, r"([^*?\[]*)$", 1)
    inner = F.regexp_extract(open_text, r"([^*?\[]+)", 1)

    def key(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    best = (F.when(is_plain(p), key("whole", p))
            .when(head != "", key("head", F.substring(head, 1, KEY_CHARS)))
            .when(tail != "", key("tail", F.reverse(F.substring(F.reverse(tail), 1, KEY_CHARS))))
            .when(inner != "", key("inner", F.substring(inner, 1, KEY_CHARS)))
            .otherwise(key("all", F.lit(""))))
    return patterns.select("*", glob_regex(p).alias("_regex"), best.alias("_key"))


def _name_keys(name: Column) -> Column:
    """All keys under which a selector can find a name; their number is bounded by the name's length."""
    def keys(kind: str, texts: Column) -> Column:
        return F.transform(texts, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("text")))

    sizes = range(1, KEY_CHARS + 1)
    back = F.reverse(name)
    starts = F.when(F.length(name) > 0, F.sequence(F.lit(1), F.length(name))).otherwise(F.array().cast("array<int>"))
    inner = F.flatten(F.transform(starts, lambda i: F.array(*[F.substr(name, i, F.lit(n)) for n in sizes])))
    return F.array_distinct(F.concat(
        keys("whole", F.array(name)), keys("head", F.array(*[F.substring(name, 1, n) for n in sizes])),
        keys("tail", F.array(*[F.reverse(F.substring(back, 1, n)) for n in sizes])),
        keys("inner", inner), keys("all", F.array(F.lit("")))))


def glob_pairs(names: DataFrame, name_col: str, patterns: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """Every (name row, selector row) pair where the selector matches the name.

    One equi-join on the keys of names and selectors, with the regex as the
    residual condition: a selector has one key and a name holds each key once,
    so every pair comes up at most once.
    """
    extra = [c for c in patterns.columns if c not in names.columns]
    sel = _keyed(patterns.withColumn("_pattern", F.col(pattern_col)), "_pattern").select(*extra, "_regex", "_key")
    exploded = names.select("*", F.explode(_name_keys(F.col(name_col))).alias("_name_key"))
    found = exploded.join(sel, (F.col("_name_key") == F.col("_key")) & F.regexp_like(F.col(name_col), F.col("_regex")))
    return found.select(*names.columns, *extra)


def select_by_glob_table(df: DataFrame, name_col: str, patterns: DataFrame, pattern_col: str = "pattern") -> DataFrame:
    """Rows matched by any selector held in ``patterns``; each row at most once.

    Matching runs on the distinct names; the rows are then kept by one equi
    semi-join, so a row matched by several selectors is still returned once.
    An empty selector table selects everything, as an empty selector list does.
    """
    given = patterns.select(F.col(pattern_col).alias("_pattern")).where(F.col("_pattern").isNotNull()).distinct()
    everything = given.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("*").alias("_pattern"))
    names = df.select(F.col(name_col).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    matched = glob_pairs(names, "_name", given.unionByName(everything), "_pattern").select("_name").distinct()
    return df.join(matched, F.col(name_col) == F.col("_name"), "left_semi")


def where_success(df: DataFrame, col: str = "success") -> DataFrame:
    """C4: successful entries only (a null flag is not a success)."""
    return df.where(F.coalesce(F.col(col), F.lit(False)))


def where_failed(df: DataFrame, col: str = "success") -> DataFrame:
    """The complement of C4; a null flag counts as failed."""
    return df.where(~F.coalesce(F.col(col), F.lit(False)))


# Log levels in ascending severity.
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]


def level_rank(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[x for i, lv in enumerate(LEVELS) for x in (F.lit(lv), F.lit(i))])
    return F.try_element_at(m, c)


def min_level(df: DataFrame, level: str, col: str = "level") -> DataFrame:
    """Keep records at or above a level threshold."""
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}")
    return df.where(level_rank(col) >= LEVELS.index(level))
