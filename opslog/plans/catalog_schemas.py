"""Registered queries of the nested record schemas: one for each kind of configuration record.

Records are made of the rows of ``part``: a text per variant, some of them
faulty, with the part's name put in where a value may vary.  Spark and the
oracle read the same texts; the oracle checks them with DuckDB's JSON functions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from opslog.operators import schema as N
from opslog.plans.registry import query
from opslog.sources import bindings as B

_ARCHIVES = ['[{"name":"$n","provider":"zip"}]', '[{"name":"$n","provider":"rar","compress":3,"recovery":"10","password":"x"},{"name":"b","provider":"tar","compress":"gz"}]',
             '[{"name":"$n","provider":"7z"},{"provider":"zip","level":1}]', '[{"name":"$n","provider":"tar","compress":"lz","recovery":"much"}]', '[]',
             '{"name":"$n","provider":"zip"}', '[["$n"]]', '[{"name":{"a":1},"provider":"zip","compress":"-2"}]']
_UPLOADS = ['[{"name":"$n","provider":"aws","access_key":"k","secret_key":"s","bucket":"b","storage":"STANDARD"}]',
            '[{"name":"$n","provider":"aws","access_key":1,"secret_key":2.5,"bucket":true,"storage":"ONEZONE_IA "}]',
            '[{"name":"$n","provider":"gcs","access_key":"k","secret_key":null,"bucket":"b","storage":"ONEZONE_IA"}]', '["$n"]', '[null]']
_REPORTS = ['{"format":"txt","directory":"/r/$n"}', '{"format":"html","directory":"/r/$n"}', '{"directory":"$n"}', '{"format":"txt","directory":["$n"]}', '"$n"']
_LOGS = ['{"level":"INFO","stdout":true,"directory":"/l/$n"}', '{"level":"DEBUG","stdout":"Yes","directory":"$n"}', '{"level":"info","stdout":"maybe","directory":"$n"}',
         '{"level":"ERROR","stdout":0}', '{"level":"ERROR","stdout":2,"directory":{},"file":"$n"}', '{}']
_NOTES = ['{"discord":{"webhook":"https://$n"}}', '{"discord":{"webhook":"w","username":"$n","avatar_url":"u"}}', '{"discord":{"username":"$n"}}', '{}',
          '{"discord":"$n"}', '{"slack":{"webhook":"$n"}}', '{"discord":{"webhook":"w","color":1}}']
_DEPLOYS = ['{"services":["$n","b"]}', '{"services":["a"],"secrets":[{"service":"$n","environment":{"UID":"1001","GID":7}}]}', '{"services":[]}',
            '{"services":["a",["$n"]],"secrets":[{"service":"s","environment":{}},{"environment":{"K":["v"],"L":null}}]}', '{"secrets":"$n"}']
_BACKUPS = ['{"destination":"~/b","archive":"$n","directories":{"photos":["~/p","/mnt/$n"],"docs":["d"]}}', '{"destination":"/b","archive":"a","upload":"$n","directories":{"g":["x"]}}',
            '{"destination":"/b","directories":{"$n":[],"g":["x",null],"h":"y"}}', '{"destination":"/b","archive":"a","upload":[],"directories":{}}',
            '{"destination":["$n"],"archive":"a","directories":["d"],"extra":{"k":1}}']


def _cross(parts: dict[str, list[str]], step: int) -> list[str]:
    """Records that hold one variant of each part, in different combinations; every third one lacks a part."""
    n, out = max(map(len, parts.values())), []
    for i in range(2 * n):
        kept = [(k, v[(i * (1 + step * j)) % len(v)]) for j, (k, v) in enumerate(parts.items()) if (i + j) % 3 or i < n // 2]
        out.append("{" + ",".join(f'"{k}":{v}' for k, v in kept) + "}")
    return out


_OBSERVED = _cross({"reports": _REPORTS, "logs": _LOGS, "notifications": _NOTES}, 1)
_PROFILES = _cross({"archive": _ARCHIVES, "upload": _UPLOADS}, 2)
_COMMANDS = _cross({"deploy": _DEPLOYS, "backup": _BACKUPS}, 1)
_BROKEN = ['{"name":"$n"', "", "null", '{"a":1} $n']

VARIANTS: dict[str, list[str]] = {
    "reports": _REPORTS, "logs": _LOGS, "notifications": _NOTES, "observability": _OBSERVED, "archive": _ARCHIVES, "upload": _UPLOADS,
    "profiles": _PROFILES, "deploy": _DEPLOYS, "backup": _BACKUPS, "commands": _COMMANDS,
    "configuration": _cross({"commands": _COMMANDS, "observability": _OBSERVED, "profiles": _PROFILES}, 1),
}


def _records_sql(kind: str) -> str:
    texts = VARIANTS[kind] + _BROKEN
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"replace(CASE p_partkey % {len(texts)} {cases} END, '$n', p_name)"


# --- the same rules for DuckDB ---

def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"


def _sql_reasons(s: N.Schema, v: str, path: str, depth: int = 0) -> str:
    """SQL for the list of reasons against the JSON ``v`` at the text ``path``."""
    wrong, x, i = f"['type:' || {path}]", f"x{depth}", f"i{depth}"

    def join(key):
        return f"(CASE WHEN {path} = '' THEN '' ELSE {path} || '.' END || {key})"

    def present(value):
        return f"({value} IS NOT NULL AND json_type({value}) <> 'NULL')"
    if isinstance(s, N.Rec):
        keys, allowed = f"json_keys({v})", _sql_list([*s.required, *s.optional])
        parts = [f"list_transform(list_filter({keys}, lambda {x}: NOT list_contains({allowed}, {x})), lambda {x}: 'unexpected:' || {join(x)})"]
        for name, inner in {**s.required, **s.optional}.items():
            at, value = join(f"'{name}'"), f"json_extract({v}, '$.\"{name}\"')"
            absent = f"['missing:' || {at}]" if name in s.required else "[]::VARCHAR[]"
            parts.append(f"CASE WHEN {present(value)} THEN {_sql_reasons(inner, value, at, depth + 1)} ELSE {absent} END")
        return f"CASE WHEN json_type({v}) <> 'OBJECT' THEN {wrong} ELSE flatten([{', '.join(parts)}]) END"
    if isinstance(s, N.Open):
        value, at = f"json_extract({v}, '$.\"' || {x} || '\"')", join(x)
        one = f"CASE WHEN {present(value)} THEN {_sql_reasons(s.value, value, at, depth + 1)} ELSE ['missing:' || {at}] END"
        return (f"CASE WHEN json_type({v}) <> 'OBJECT' THEN {wrong} WHEN len(json_keys({v})) = 0 THEN ['empty:' || {path}] "
                f"ELSE flatten(list_transform(json_keys({v}), lambda {x}: {one})) END")
    if isinstance(s, N.Seq):
        at = f"({path} || '[' || CAST({i} - 1 AS VARCHAR) || ']')"
        one = f"CASE WHEN {present(x)} THEN {_sql_reasons(s.item, x, at, depth + 1)} ELSE ['missing:' || {at}] END"
        return (f"CASE WHEN json_type({v}) <> 'ARRAY' THEN {wrong} WHEN json_array_length({v}) = 0 THEN ['empty:' || {path}] "
                f"ELSE flatten(list_transform(json_extract({v}, '$[*]'), lambda {x}, {i}: {one})) END")
    text, tag, ok = f"({v} ->> '$')", "type", "true"
    whole = f"regexp_matches({text}, '^[+-]?[0-9]+$')"
    if isinstance(s, N.Int):
        ok = whole
    elif isinstance(s, N.Bool):
        ok = f"lower({text}) IN ('true', 'false', 'yes', 'no', 'on', 'off', '1', '0')"
    elif isinstance(s, N.Enum):
        tag, ok = "enum", f"list_contains({_sql_list(s.values)}, {text})" + (f" OR {whole}" if s.or_int else "")
    return f"CASE WHEN json_type({v}) IN ('OBJECT', 'ARRAY') THEN {wrong} WHEN {ok} THEN []::VARCHAR[] ELSE ['{tag}:' || {path}] END"


def _oracle(kind: str) -> str:
    rules = _sql_reasons(N.SCHEMAS[kind], "v", "''")
    return f"""
WITH r AS (SELECT p_partkey AS id, {_records_sql(kind)} AS js FROM part),
p AS (SELECT id, js, CASE WHEN json_valid(js) AND json_type(js) <> 'NULL' THEN CAST(js AS JSON) END AS v FROM r)
SELECT id, array_to_string(list_sort(CASE WHEN v IS NULL THEN ['syntax'] ELSE {rules} END), '|') AS reasons FROM p"""


def _register(kind: str) -> None:
    @query(f"k6_schema_{kind}", _oracle(kind))
    def check(spark, d):
        records = B.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(_records_sql(kind)).alias("js"))
        return N.check_records(records, "js", N.SCHEMAS[kind]).select("id", F.array_join("reasons", "|").alias("reasons"))


for _kind in N.SCHEMAS:
    _register(_kind)
