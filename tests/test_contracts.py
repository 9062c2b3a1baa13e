"""Schemas, compatibility, lineage, decoding, suites' edge cases."""

import json
import struct

import pytest

from accordium.operators import quality as q
from accordium.plans import contracts, lineage
from accordium.sources import avro


def record(*fields):
    return json.dumps({"type": "record", "name": "R", "fields": [{"name": "id", "type": "string"}, *fields]})


ENUM = lambda *s, **k: {"name": "e", "type": {"type": "enum", "name": "E", "symbols": list(s), **k}}
X, Y, OPT = {"name": "x", "type": "int"}, {"name": "x", "type": "long"}, {"name": "o", "type": ["null", "string"], "default": None}
#: (change, history, new schema, verdicts for BACKWARD_TRANSITIVE, BACKWARD, FORWARD)
CASES = [
    ("add nullable with default", [record()], record(OPT), "111"), ("add without default", [record()], record(X), "001"), ("remove with default", [record(OPT)], record(), "111"), ("remove without default", [record(X)], record(), "110"),
    ("rename", [record(X)], record({"name": "z", "type": "int"}), "000"), ("rename with alias", [record(X)], record({"name": "z", "type": "int", "aliases": ["x"]}), "110"), ("widen", [record(X)], record(Y), "110"), ("narrow", [record(Y)], record(X), "001"),
    ("add symbol", [record(ENUM("A"))], record(ENUM("A", "B")), "110"), ("remove symbol", [record(ENUM("A", "B"))], record(ENUM("A")), "001"), ("add symbol, default", [record(ENUM("A", default="A"))], record(ENUM("A", "B", default="A")), "111"),
    ("default dropped from version 2", [record(), record(OPT)], record({"name": "o", "type": ["null", "string"]}), "011"),
]


@pytest.mark.parametrize("case", CASES, ids=lambda c: c[0])
def test_matrix(spark, case):
    _, history, new, want = case
    assert "".join(str(int(not contracts.check(spark, m, new, history))) for m in ("BACKWARD_TRANSITIVE", "BACKWARD", "FORWARD")) == want


def test_types():
    s = contracts.struct_type(record(X, OPT, {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}}))
    assert [f.dataType.simpleString() for f in s] == ["string", "int", "string", "bigint"] and s["o"].nullable and not s["x"].nullable
    for bad in ("bytes", {"type": "array", "items": "int"}, ["null", "int", "string"]):
        with pytest.raises(ValueError):
            contracts.spark_type(bad)


def test_lint():
    good = {"subject": "a-value", "schema": "a.avsc", "owner": "x", "compatibility": "BACKWARD", "delta_path": "s3a://l/a"}
    assert contracts.lint({"a": good}) == []
    assert len(contracts.lint({"a": good, "b": good | {"compatibility": "NONE"}})) == 4


def test_avro_frames(spark):
    def long(n):
        n, out = (n << 1) ^ (n >> 63), b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    data = b"\0\0\0\0\7" + long(2) + b"hi" + long(-300) + long(1) + long(1) + b"z"
    schema = record(X, OPT)
    got = avro.decode(spark.createDataFrame([(bytearray(data),)], "v binary"), "v", schema).first()
    assert tuple(got) == ("hi", -300, "z")
    assert struct.calcsize("<d") == 8


def test_lineage(spark):
    source = 'df = spark.table("t")\ndf.select("a", F.col("b"), *cols)\ndf["c"]\ndf.groupBy("*")\n'
    got = {(r.line, r.kind, r.name) for r in lineage.scan(spark.createDataFrame([("c", "x.py", source), ("c", "y.py", "def (")], "consumer string, path string, source string")).collect()}
    assert {(1, "literal", "t"), (2, "field", "a"), (2, "field", "b"), (2, "dynamic", ""), (3, "field", "c"), (4, "wildcard", "*")} <= got
    assert any(k == "error" for _, k, _ in got)
    assert lineage.sql_columns(spark, "a + coalesce(b, 1)") == {"a", "b"}


def test_suite_edges(spark):
    with pytest.raises(ValueError):
        q.load_suite({"expectations": [1]})
    with pytest.raises(ValueError):
        q.load_suite({"expectation_suite_name": "s", "expectations": []})
    rules = q.load_suite({"expectation_suite_name": "s", "expectations": [{"expectation_type": f"expect_{k}", "kwargs": a} for k, a in (("column_values_to_be_between", {"column": "v", "max_value": 1}), ("column_values_to_not_be_null", {"column": "v"}), ("column_values_to_be_unique", {"column": "v"}), ("nonsense", {"column": "v"}))]})
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,), (2.0,), (1.0,)], "v double")
    got = {r.ordinal: (r.success, r.unexpected_count, r.error is None) for r in q.summary(df, rules).collect()}
    assert got == {0: (False, 2, True), 1: (False, 2, True), 2: (False, 2, True), 3: (False, 0, False)}
    assert q.summary(df.limit(0), rules[:3]).where("success").count() == 3
    assert q.suite_columns(rules) == {"v"}
