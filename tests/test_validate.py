"""K1-K7 on archive-profile records; B3 dotted access; B-family helpers."""

import pytest
from pyspark.sql import functions as F

from opslog.functions.paths import argv, base_name, expand_home, nested_get, output_lines, strip_base, upload_key
from opslog.operators import validate as K

RECORDS = [
    ('{"name":"a","provider":"tar","compress":"xz"}', []),
    ('{"name":"a","provider":"rar","compress":3,"recovery":5,"password":"p"}', []),
    ('{"name":"a"}', ["missing:provider"]),
    ('{"provider":"zip","other":1}', ["missing:name", "unexpected:other"]),
    ('{"name":"a","provider":"7z"}', ["enum:provider"]),
    ('{"name":"a","provider":"rar","compress":9}', ["range:compress"]),
    ('{"name":"a","provider":"tar","compress":"lz"}', ["type:compress"]),
    ('{"name":"a","provider":"rar","recovery":1001,"password":""}', ["empty:password", "range:recovery"]),
    ('[1,2]', ["not-an-object"]),
    ('{"name":null,"provider":"tar"}', ["missing:name"]),
    ('{"name":"a","name":"b","provider":"tar"}', ["duplicate:name"]),
    ('{"name":"a","provider":"tar"} x', ["not-an-object"]),
    ('{"name":"a","provider":"tar"}] x', ["not-an-object"]),
    ('{"name":"a","provider":"tar"}} x', ["not-an-object"]),
    ('{"name":"a","provider":"tar"}, {}', ["not-an-object"]),
    ('{"name":"a","provider":"rar","compress":99999999999999999999}', ["range:compress"]),
    ('{"name":"a","provider":"rar","compress":%s}' % ("9" * 50), ["range:compress"]),
    (None, ["not-an-object"]),
]


def test_split_valid(spark):
    df = spark.createDataFrame([(i, js) for i, (js, _) in enumerate(RECORDS)], "id long, js string")
    valid, rejects = K.split_valid(df, "js", K.ARCHIVE_PROFILE)
    ok_ids = {r.id for r in valid.collect()}
    rej = {r.id: list(r.reasons) for r in rejects.collect()}
    for i, (_, reasons) in enumerate(RECORDS):
        if reasons:
            assert rej[i] == sorted(reasons), RECORDS[i]
        else:
            assert i in ok_ids


def test_nested_rule(spark):
    df = spark.createDataFrame([({"apps": ["/a", ""], "": ["/x"], "ok": []},)], "g map<string,array<string>>")
    assert sorted(df.select(K.nested_rule("g").alias("r")).first().r) == ["nested-item:apps", "nested-key:"]


NESTED = [
    ("{}", "", None), ("{}", "a.b.c.d", None), ('{"foo":{"bar":{"baz":17}}}', "foo.bar.foo", None),
    ('{"foo":{"bar":{"baz":17}}}', "foo.foo.baz", None), ('{"foo":{"bar":{"baz":17}}}', "baz.foo.baz", None),
    ('{"foo":{"bar":{"baz":17}}}', "foo.bar.baz", "17"),
    ('{"foo":{"bar":{"baz":17,"buz":22}}}', "foo.bar", '{"baz":17,"buz":22}'),
    ('{"foo":{"bar":{"bur":{"baz":17,"buz":22}}}}', "foo.bar.bur.biz.fix", None),
    ('{"foo":{"bar":{"bur":{"baz":17,"buz":["a","b","c"]}}}}', "foo.bar.bur.buz", '["a","b","c"]'),
]


@pytest.mark.parametrize("js,path,expected", NESTED)
def test_nested_get(spark, js, path, expected):
    df = spark.createDataFrame([(js,)], "js string")
    assert df.select(nested_get("js", path).alias("v")).first().v == expected


def test_path_helpers(spark):
    df = spark.createDataFrame([("~/docs/", "  rar\u00a0 a\u2003-r\tx  ", "\n  one\ntwo  \n", "")],
                               "d string, cmd string, out string, empty string")
    r = df.select(expand_home("d", "/home/u").alias("h"), base_name("d").alias("b"), argv("cmd").alias("a"),
                  output_lines("out").alias("l"), output_lines("empty").alias("e"),
                  upload_key(F.lit("g"), "d", F.lit("/x/y/arc.rar")).alias("k"),
                  strip_base(F.lit("/dest/g/docs/docs_1.rar"), "/dest").alias("s")).first()
    assert r.h == "/home/u/docs/" and r.b == "docs" and r.a == ["rar", "a", "-r", "x"]
    assert r.l == ["one", "two"] and r.e == [] and r.k == "g/docs/arc.rar" and r.s == "g/docs/docs_1.rar"
