"""Nested record schemas: own records, with the reasons that a reader of the rules expects."""
import json

import pytest

from opslog.operators import schema as N

SERVICES = {"services": ["a"]}
BACKUP = {"destination": "/b", "archive": "rar", "directories": {"g": ["x", "y"]}}

CASES = [
    ("reports", {"format": "txt", "directory": "/r"}, []),
    ("reports", {"format": "txt", "directory": None}, ["missing:directory"]),
    ("reports", [], ["type:"]),
    ("reports", "txt", ["type:"]),
    ("logs", {"level": "INFO", "stdout": "ON", "directory": 7}, []),
    ("logs", {"level": "LOUD", "stdout": "si", "directory": []}, ["enum:level", "type:directory", "type:stdout"]),
    ("notifications", {}, []),
    ("notifications", {"discord": {}}, ["missing:discord.webhook"]),
    ("notifications", {"discord": None}, []),
    ("archive", [], ["empty:"]),
    ("archive", [{"name": "a", "provider": "zip", "compress": "xz"}, {"name": "b", "provider": "rar", "compress": "+5", "recovery": 1.5}], ["type:[1].recovery"]),
    ("archive", [{"name": "a", "provider": "zip", "compress": True}], ["enum:[0].compress"]),
    ("archive", [None, 3], ["missing:[0]", "type:[1]"]),
    ("upload", [{"name": "a", "provider": "aws", "access_key": "k", "secret_key": "s", "bucket": "b", "storage": "ONEZONE_IA "}], []),
    ("upload", [{"name": "a", "provider": "aws", "access_key": "k", "secret_key": "s", "bucket": "b", "storage": "ONEZONE_IA"}], ["enum:[0].storage"]),
    ("deploy", {"services": ["a", ""], "secrets": [{"service": "s", "environment": {"A.B c": "1"}}]}, []),
    ("deploy", {"services": [["a"]], "secrets": [{"service": "s", "environment": {"K": {}}}]}, ["type:secrets[0].environment.K", "type:services[0]"]),
    ("backup", BACKUP, []),
    ("backup", {**BACKUP, "directories": {}}, ["empty:directories"]),
    ("backup", {**BACKUP, "directories": {"g": [], "h": ["x", None]}, "level": 1}, ["empty:directories.g", "missing:directories.h[1]", "unexpected:level"]),
    ("commands", {"deploy": SERVICES}, ["missing:backup"]),
    ("configuration", {"commands": {"deploy": SERVICES, "backup": BACKUP}}, []),
    ("configuration", {"commands": {"deploy": {}, "backup": BACKUP}, "observability": {"logs": {"level": "INFO", "stdout": "y", "directory": "d"}}, "x": None},
     ["missing:commands.deploy.services", "type:observability.logs.stdout", "unexpected:x"]),
    ("configuration", {"profiles": {"upload": [{"provider": "gcs"}]}},
     ["enum:profiles.upload[0].provider", "missing:commands", "missing:profiles.upload[0].access_key", "missing:profiles.upload[0].bucket",
      "missing:profiles.upload[0].name", "missing:profiles.upload[0].secret_key", "missing:profiles.upload[0].storage"]),
]


@pytest.mark.parametrize("kind", list(N.SCHEMAS))
def test_reasons(spark, kind):
    cases = [(i, json.dumps(v), want) for i, (k, v, want) in enumerate(CASES) if k == kind]
    df = spark.createDataFrame([c[:2] for c in cases], "id int, js string")
    got = {r.id: r.reasons for r in N.check_records(df, "js", N.SCHEMAS[kind]).collect()}
    assert got == {i: want for i, _, want in cases}


def test_texts_that_are_no_record(spark):
    texts = [None, "", " ", "null", "{", "{} {}", "{},{}", "{}]", '{"a":1,"a":2}', '{"discord":{"webhook":"w"}} # more', '{"discord":{"webhook":"w","webhook":"w"}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, js string")
    assert all(r.reasons == ["syntax"] for r in N.check_records(df, "js", N.NOTIFICATIONS).collect())


def test_split(spark):
    df = spark.createDataFrame([(1, '{"format":"txt","directory":"d"}'), (2, "{}"), (3, ' {"directory":"d","format":"txt"}\n')], "id int, js string")
    ok, bad = N.split_records(df, "js", N.REPORTS)
    assert sorted(r.id for r in ok.collect()) == [1, 3] and [(r.id, r.reasons) for r in bad.collect()] == [(2, ["missing:directory", "missing:format"])]
    assert ok.columns == ["id", "js"]


def test_scalar_kinds(spark):
    rows = [("1", "7"), ("2", '"-07"'), ("3", "7.0"), ("4", '""'), ("5", "true"), ("6", '"Off"'), ("7", "[1]"), ("8", "12345678901234567890123")]
    df = spark.createDataFrame(rows, "id string, js string")
    bad = lambda schema: {r.id for r in N.check_records(df, "js", schema).collect() if r.reasons}
    assert bad(N.Str()) == {"7"}
    assert bad(N.Int()) == {"4", "5", "6", "7"}
    assert bad(N.Bool()) == {"1", "2", "3", "4", "7", "8"}
    assert bad(N.Enum(("Off",), or_int=True)) == {"4", "5", "7"}
