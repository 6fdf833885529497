"""Strict record validation (operators K1-K7).

Records arrive as JSON text.  ``from_json`` into a typed struct would drop
unknown keys silently, so each record is read as ``MAP<STRING,STRING>`` (every
value kept as its JSON text) and checked by rules that are plain Column
expressions.  Each rule yields reason strings; a record is valid when it has
none.  Rules never throw (``try_cast`` instead of ``cast`` under ANSI).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_map(js) -> Column:
    """JSON object text -> map of key to value text, repeated keys kept; anything but one whole object gives null.

    The parser stops after the first value, so text after the object would pass unseen.  Inside a list or an object of
    one member such text is a syntax error, except a closing bracket of that same kind, which the other wrapping finds.
    """
    text = _c(js)
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>")
    member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "map<string,map<string,string>>")
    whole = (F.size(listed) == 1) & (F.size(member) == 1)
    return F.when(whole, F.get(listed, F.lit(0)))


def _str_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _tag(arr: Column, tag: str) -> Column:
    return F.transform(arr, lambda x: F.concat(F.lit(tag + ":"), x))


def require_fields(m, required: list[str]) -> Column:
    """K1: one ``missing:<key>`` reason per mandatory key that is absent or null."""
    given = F.map_keys(F.map_filter(_c(m), lambda k, v: v.isNotNull()))
    return _tag(F.array_except(_str_array(required), F.coalesce(given, _str_array([]))), "missing")


def forbid_unexpected(m, allowed: list[str]) -> Column:
    """K2: one ``unexpected:<key>`` reason per key outside the schema."""
    return _tag(F.array_except(F.coalesce(F.map_keys(_c(m)), _str_array([])), _str_array(allowed)), "unexpected")


def unique_keys(m) -> Column:
    """K2: one ``duplicate:<key>`` reason per key given more than once."""
    keys = F.coalesce(F.map_keys(_c(m)), _str_array([]))
    twice = F.filter(keys, lambda k, i: F.array_position(keys, k) <= i)
    return _tag(F.array_distinct(twice), "duplicate")


def _one(cond: Column, reason: str) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.array(F.lit(reason))).otherwise(_str_array([]))


def enum_rule(m, key: str, values: list[str]) -> Column:
    """K3: a present value must be one of a closed list."""
    v = F.try_element_at(_c(m), F.lit(key))
    return _one(v.isNotNull() & ~v.isin(values), f"enum:{key}")


def is_int(v: Column) -> Column:
    return v.rlike(r"^[+-]?[0-9]+$")


def typed_rule(m, key: str, kind: str, enum_values: list[str] | None = None) -> Column:
    """K4: ``int``, ``bool``, ``str`` or ``enum|int`` typed values."""
    v = F.try_element_at(_c(m), F.lit(key))
    if kind == "int":
        ok = is_int(v)
    elif kind == "bool":
        ok = F.lower(v).isin("true", "false", "yes", "no", "on", "off", "1", "0")
    elif kind == "str":
        ok = F.lit(True)
    elif kind == "enum|int":
        ok = v.isin(enum_values or []) | is_int(v)
    else:
        raise ValueError(kind)
    return _one(v.isNotNull() & ~ok, f"type:{key}")


def range_rule(m, key: str, lo: int, hi: int) -> Column:
    """K5: an integer value, when present, lies in ``[lo, hi]`` (null allowed)."""
    v = F.try_element_at(_c(m), F.lit(key))
    n = v.try_cast("decimal(38,0)")  # null for an integer of more digits: out of any range
    return _one(is_int(v) & (n.isNull() | (n < lo) | (n > hi)), f"range:{key}")


def nonempty_rule(m, key: str) -> Column:
    """K5: an optional string, when present, is not empty (e.g. a password)."""
    v = F.try_element_at(_c(m), F.lit(key))
    return _one(v.isNotNull() & (v == ""), f"empty:{key}")


def nested_rule(groups, key_ok=None, item_ok=None, tag: str = "nested") -> Column:
    """K6: rules inside an open-keyed map of sequences: every key and every item must pass."""
    g = _c(groups)
    key_ok = key_ok or (lambda k: F.length(k) > 0)
    item_ok = item_ok or (lambda x: x.isNotNull() & (F.length(x) > 0))
    bad_keys = F.map_keys(F.map_filter(g, lambda k, v: ~key_ok(k)))
    bad_items = F.map_keys(F.map_filter(g, lambda k, v: ~F.forall(v, item_ok)))
    return F.concat(_tag(bad_keys, f"{tag}-key"), _tag(bad_items, f"{tag}-item"))


@dataclass
class RecordSchema:
    required: list[str]
    optional: list[str] = field(default_factory=list)
    enums: dict[str, list[str]] = field(default_factory=dict)
    types: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    nonempty: list[str] = field(default_factory=list)

    def reasons(self, m) -> Column:
        parts = [require_fields(m, self.required), forbid_unexpected(m, self.required + self.optional),
                 unique_keys(m)]
        parts += [enum_rule(m, k, v) for k, v in self.enums.items()]
        parts += [typed_rule(m, k, *spec) for k, spec in self.types.items()]
        parts += [range_rule(m, k, lo, hi) for k, (lo, hi) in self.ranges.items()]
        parts += [nonempty_rule(m, k) for k in self.nonempty]
        return F.array_sort(F.concat(*parts))


# The archive profile schema (keys, providers, codecs, ranges).
ARCHIVE_PROFILE = RecordSchema(
    required=["name", "provider"],
    optional=["compress", "recovery", "password"],
    enums={"provider": ["rar", "tar", "zip"]},
    types={"compress": ("enum|int", ["gz", "xz", "bz2"]), "recovery": ("int",)},
    ranges={"compress": (0, 5), "recovery": (0, 1000)},
    nonempty=["password"],
)


def tag_valid(df: DataFrame, js_col: str, schema: RecordSchema) -> DataFrame:
    """Every record with its sorted ``reasons`` (empty when valid), in one pass."""
    # parse once into a column; every rule then reads the map instead of re-parsing the text
    parsed = df.withColumn("_m", as_map(js_col))
    m = F.col("_m")
    r = F.when(m.isNull(), F.array(F.lit("not-an-object"))).otherwise(schema.reasons(m))
    return parsed.withColumn("reasons", r).drop("_m")


def split_valid(df: DataFrame, js_col: str, schema: RecordSchema) -> tuple[DataFrame, DataFrame]:
    """K7: (valid rows, rejected rows with ``reasons``)."""
    tagged = tag_valid(df, js_col, schema)
    return tagged.where(F.size("reasons") == 0).drop("reasons"), tagged.where(F.size("reasons") > 0)
