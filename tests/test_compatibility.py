"""Schema resolution in tasks against Avro's own on the driver."""

import json
import random

import pytest

from accordium.operators import compatibility as compat
from accordium.plans import contracts
from tests.test_contracts import CASES, record


def rows(spark, history, new, mode):
    h = spark.createDataFrame([("s", v, t, 1) for v, t in enumerate(history, 1)], "subject string, version int, schema string, found int")
    return sorted((r.version, r.direction, r.problem, r.place) for r in compat.incompatible(h, spark.createDataFrame([("s", new, mode)], "subject string, schema string, mode string")).collect())


def test_cases_in_all_modes(spark):
    """All cases at once: a subject for each case and mode."""
    history, offers, want = [], [], {}
    for i, (_, old, new, _) in enumerate(CASES):
        for mode in compat.MODES:
            s = f"{i}/{mode}"
            history += [(s, v, t) for v, t in enumerate(old, 1)]
            offers.append((s, new, mode))
            want[s] = {(v, d) for v, d, _ in contracts.check(spark, mode, new, old)}
    h = spark.createDataFrame(history, "subject string, version int, schema string")
    o = spark.createDataFrame(offers, "subject string, schema string, mode string")
    got = {s: set() for s in want}
    for r in compat.incompatible(h, o).collect():
        got[r.subject].add((r.version, r.direction))
    assert got == want and any(want.values())
    passed = {r.subject: r.passed for r in compat.verdicts(h, o).collect()}
    assert passed == {s: not w for s, w in want.items()}


def any_type(rng, depth, names):
    kind = rng.choice(["int", "long", "float", "double", "string", "bytes", "boolean", "null", "array", "map", "union", "enum", "fixed", "record"][: 8 if depth > 2 else 14])
    fresh = lambda: f"N{next(names)}"
    if kind in ("array", "map"):
        return {"type": kind, "items" if kind == "array" else "values": any_type(rng, depth + 1, names)}
    if kind == "union":
        return rng.sample(["null", "int", "long", "string", "double", "bytes"], rng.randrange(1, 4))
    if kind == "enum":
        return {"type": "enum", "name": fresh(), "symbols": rng.sample("ABCD", rng.randrange(1, 4))}
    if kind == "fixed":
        return {"type": "fixed", "name": fresh(), "size": rng.randrange(1, 3)}
    if kind == "record":
        return {"type": "record", "name": fresh(), "fields": [{"name": n, "type": any_type(rng, depth + 1, names)} for n in rng.sample("xyz", rng.randrange(0, 3))]}
    return kind


def changed(rng, fields):
    """A record's fields with some dropped, retyped, given defaults or aliases."""
    out = []
    for f in fields:
        if rng.random() < 0.2:
            continue
        f = dict(f)
        if rng.random() < 0.3:
            f["type"] = rng.choice(["int", "long", "double", "string", "bytes", ["null", "int"], ["null", "long", "string"]])
        if rng.random() < 0.2:
            f["aliases"], f["name"] = [f["name"]], f["name"] + "2"
        if f["type"] in ("int", "long") and rng.random() < 0.5:
            f["default"] = 1
        out.append(f)
    return out


def test_random_schemas(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(250):
        names = iter(range(1000))
        fields = [{"name": n, "type": any_type(rng, 0, names)} for n in "abcd"]
        pairs.append(tuple(json.dumps({"type": "record", "name": "R", "fields": changed(rng, fields)}) for _ in range(2)))
    found = {(r.reader, r.writer): r.found for r in compat.resolve(spark.createDataFrame(pairs, "reader string, writer string")).collect()}
    kinds = set()
    for r, w in pairs:
        assert bool(found[r, w]) == (contracts._reads(spark, r, w) is not None), (r, w, found[r, w])
        kinds |= {f.problem for f in found[r, w]}
    assert {"MISSING_DEFAULT", "TYPE_MISMATCH", "MISSING_BRANCH"} <= kinds


def test_findings_name_the_place(spark):
    inner = {"type": "record", "name": "I", "fields": [{"name": "u", "type": "int"}]}
    old = record({"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}, {"name": "i", "type": inner})
    new = record({"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A"]}}, {"name": "i", "type": {**inner, "fields": [{"name": "v", "type": "int"}]}})
    assert rows(spark, [old], new, "BACKWARD") == [(1, "BACKWARD", "MISSING_DEFAULT", "i.v"), (1, "BACKWARD", "MISSING_SYMBOLS", "e")]
    assert rows(spark, [old, new], old, "full") == [(2, d, *x) for d, x in [("BACKWARD", ("MISSING_DEFAULT", "i.u")), ("FORWARD", ("MISSING_DEFAULT", "i.v")), ("FORWARD", ("MISSING_SYMBOLS", "e"))]]


def test_recursive_types(spark):
    node = lambda *f: json.dumps({"type": "record", "name": "T", "fields": [{"name": "next", "type": ["null", "T"]}, *f]})
    assert rows(spark, [node()], node({"name": "x", "type": "int", "default": 0}), "FULL_TRANSITIVE") == []
    assert rows(spark, [node()], node({"name": "x", "type": "int"}), "FULL_TRANSITIVE") == [(1, "BACKWARD", "MISSING_DEFAULT", "x")]


@pytest.mark.parametrize("bad", ["{not json", '{"type": "record"}', '"nothing"', '{"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}, {"name": "a", "type": "int"}]}', '{"type": "record", "name": "R", "fields": [{"name": "a", "type": ["string", "null"], "default": null}]}', "", None, "[]", '{"type": "enum", "name": "E", "symbols": ["A", "A"]}'])
def test_invalid_schemas(spark, bad):
    assert [x[2] for x in rows(spark, [record()], bad, "BACKWARD")] == ["INVALID_READER"]
    assert [x[2] for x in rows(spark, [bad], record(), "BACKWARD")] == ["INVALID_WRITER"]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "subject string, version int, schema string")
    offer = spark.createDataFrame([("s", record(), "FULL"), (None, record(), "FULL"), ("t", record(), "NONE"), ("u", record(), None)], "subject string, schema string, mode string")
    assert sorted((r.subject, r.problem, r.place) for r in compat.incompatible(empty, offer).collect()) == [("t", "BAD_MODE", "NONE"), ("u", "BAD_MODE", "")]
    assert compat.incompatible(empty, offer.limit(0)).count() == 0
