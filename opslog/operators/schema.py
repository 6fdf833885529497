"""Nested record schemas (operators K1-K6), compiled to Column expressions over VARIANT.

A schema is a small tree: ``Rec`` (a closed record with required and optional
fields), ``Open`` (a map with any keys), ``Seq`` (a list) and the scalars
``Str``, ``Int``, ``Bool`` and ``Enum``.  ``check_records`` parses the text once
and gives every record the sorted list of reasons against it, each with the
path of the value it is about; a record without reasons is valid.

Scalars follow configuration files, in which every scalar is text: any scalar
is a string, ``"7"`` is an integer (so is the number 7.0) and ``"yes"`` a boolean.  A null stands for a
field that is not given; lists and maps must not be empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Schema:
    pass


@dataclass(frozen=True)
class Str(Schema):
    pass


@dataclass(frozen=True)
class Int(Schema):
    pass


@dataclass(frozen=True)
class Bool(Schema):
    pass


@dataclass(frozen=True)
class Enum(Schema):
    values: tuple[str, ...]
    or_int: bool = False


@dataclass(frozen=True)
class Seq(Schema):
    item: Schema


@dataclass(frozen=True)
class Open(Schema):
    value: Schema


@dataclass(frozen=True)
class Rec(Schema):
    required: dict[str, Schema] = field(default_factory=dict)
    optional: dict[str, Schema] = field(default_factory=dict)


BOOL_WORDS = ("true", "false", "yes", "no", "on", "off", "1", "0")
INTEGER = r"^[+-]?[0-9]+$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _list(*values: Column) -> Column:
    return F.array(*values).cast("array<string>")


def _none() -> Column:
    return F.array().cast("array<string>")


def _join(path: Column, key: Column) -> Column:
    return F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))


def _tagged(tag: str, keys: Column, path: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(tag + ":"), _join(path, k)))


def _given(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


def _scalar_rule(schema: Schema, text: Column) -> tuple[str, Column]:
    """The reason's tag and whether the text of a scalar obeys."""
    if isinstance(schema, Int):
        return "type", text.rlike(INTEGER)
    if isinstance(schema, Bool):
        return "type", F.lower(text).isin(*BOOL_WORDS)
    if isinstance(schema, Enum):
        ok = text.isin(*schema.values)
        return "enum", ok | text.rlike(INTEGER) if schema.or_int else ok
    return "type", F.lit(True)


def _if_given(schema: Schema, path: Column) -> Callable[[Column], Column]:
    return lambda v: F.when(_given(v), reasons(schema, v, path)).otherwise(_none())


def reasons(schema: Schema, v: Column, path: Column) -> Column:
    """Reasons against the variant ``v``, which is given (not null), at ``path`` ('' for the whole record)."""
    wrong = _list(F.concat(F.lit("type:"), path))
    if isinstance(schema, Rec):
        allowed = [F.lit(k) for k in (*schema.required, *schema.optional)]

        def check(m):
            given = F.map_keys(F.map_filter(m, lambda k, x: _given(x)))
            parts = [_tagged("missing", F.array_except(_list(*map(F.lit, schema.required)), given), path),
                     _tagged("unexpected", F.array_except(F.map_keys(m), _list(*allowed)), path)]
            for key, inner in {**schema.required, **schema.optional}.items():
                parts.append(_let(F.try_element_at(m, F.lit(key)), _if_given(inner, _join(path, F.lit(key)))))
            return F.when(m.isNull(), wrong).otherwise(F.concat(*parts))
        return _let(F.try_variant_get(v, "$", "map<string,variant>"), check)
    if isinstance(schema, Open):
        def each(e):
            at = _join(path, e["key"])
            return F.when(_given(e["value"]), reasons(schema.value, e["value"], at)).otherwise(_list(F.concat(F.lit("missing:"), at)))

        def check_map(m):
            return (F.when(m.isNull(), wrong).when(F.size(m) == 0, _list(F.concat(F.lit("empty:"), path)))
                    .otherwise(F.flatten(F.transform(F.map_entries(m), each))))
        return _let(F.try_variant_get(v, "$", "map<string,variant>"), check_map)
    if isinstance(schema, Seq):
        def item(x, i):
            at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            return F.when(_given(x), reasons(schema.item, x, at)).otherwise(_list(F.concat(F.lit("missing:"), at)))

        def check_list(a):
            return (F.when(a.isNull(), wrong).when(F.size(a) == 0, _list(F.concat(F.lit("empty:"), path)))
                    .otherwise(F.flatten(F.transform(a, item))))
        return _let(F.try_variant_get(v, "$", "array<variant>"), check_list)

    def check_scalar(text):
        tag, ok = _scalar_rule(schema, text)
        return F.when(text.isNull(), wrong).when(ok, _none()).otherwise(_list(F.concat(F.lit(tag + ":"), path)))
    nested = F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
    return _let(F.when(~nested, F.try_variant_get(v, "$", "string")), check_scalar)


def check_records(df: DataFrame, js: str, schema: Schema, out: str = "reasons") -> DataFrame:
    """``df`` with ``out``: the sorted reasons against the JSON text in ``js``.

    Text that is no JSON value, repeats a key or is null has the only reason ``syntax``.
    """
    text = F.col(js)
    # the parser stops after the first value; what follows it is an error in a list or as a field's end
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    parsed = F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))
    body = _let(parsed, lambda v: F.when(~_given(v), _list(F.lit("syntax"))).otherwise(reasons(schema, v, F.lit(""))))
    return df.withColumn(out, F.array_sort(body))


def split_records(df: DataFrame, js: str, schema: Schema) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``reasons``)."""
    tagged = check_records(df, js, schema)
    return tagged.where(F.size("reasons") == 0).drop("reasons"), tagged.where(F.size("reasons") > 0)


# --- fixed values: the application's configuration records, their fields, enumerations and optional parts ---

REPORTS = Rec({"format": Enum(("txt",)), "directory": Str()})
LOGS = Rec({"level": Enum(("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")), "stdout": Bool(), "directory": Str()})
NOTIFICATIONS = Rec({}, {"discord": Rec({"webhook": Str()}, {"username": Str(), "avatar_url": Str()})})
OBSERVABILITY = Rec({}, {"reports": REPORTS, "logs": LOGS, "notifications": NOTIFICATIONS})
ARCHIVE = Seq(Rec({"name": Str(), "provider": Enum(("rar", "tar", "zip"))},
                  {"compress": Enum(("gz", "xz", "bz2"), or_int=True), "recovery": Int(), "password": Str()}))
UPLOAD = Seq(Rec({"name": Str(), "provider": Enum(("aws",)), "access_key": Str(), "secret_key": Str(), "bucket": Str(),
                  "storage": Enum(("STANDARD", "STANDARD_IA", "ONEZONE_IA ", "INTELLIGENT_TIERING", "DEEP_ARCHIVE"))}))
PROFILES = Rec({}, {"archive": ARCHIVE, "upload": UPLOAD})
DEPLOY = Rec({"services": Seq(Str())}, {"secrets": Seq(Rec({"service": Str(), "environment": Open(Str())}))})
BACKUP = Rec({"destination": Str(), "archive": Str(), "directories": Open(Seq(Str()))}, {"upload": Str()})
COMMANDS = Rec({"deploy": DEPLOY, "backup": BACKUP})
CONFIGURATION = Rec({"commands": COMMANDS}, {"observability": OBSERVABILITY, "profiles": PROFILES})

SCHEMAS: dict[str, Schema] = {
    "reports": REPORTS, "logs": LOGS, "notifications": NOTIFICATIONS, "observability": OBSERVABILITY, "archive": ARCHIVE,
    "upload": UPLOAD, "profiles": PROFILES, "deploy": DEPLOY, "backup": BACKUP, "commands": COMMANDS, "configuration": CONFIGURATION,
}
