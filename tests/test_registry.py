"""Registry operators over small hand-made tables: nulls, ties, repeated rows and bad JSON."""

from accordium.operators import registry as reg


def test_leaf_diff(spark):
    rows = [(1, '{"a": "{\\"k\\": 1, \\"m\\": [1]}", "b": null}', '{"a": {"k": 2, "m": [1]}, "c": 3}'), (2, "{bad", '{"a": 1}'), (3, None, "x"), (4, "same", "same"), (5, '{"a": {}}', '{"a": {"z": "1"}}')]
    got = reg.leaf_diff(spark.createDataFrame(rows, "id int, before string, after string"))
    assert {tuple(r) for r in got.collect()} == {(1, "a.k", "1", "2"), (1, "c", None, "3"), (2, "", "{bad", '{"a": 1}'), (3, "", None, "x"), (5, "a.z", None, "1")}


def test_leaf_diff_deep(spark):
    """Against a plain recursion, with texts deeper than one pass, a null id, repeated rows and clashing names."""
    import json
    import random

    draw = random.Random(3)

    def tree(depth):
        return {k: tree(depth - 1) if depth and draw.random() < 0.85 else draw.choice([1, "1", None, [1, 2], {}, "x"]) for k in draw.sample("abc", 2)}

    def leaves(x, y, at=""):
        if isinstance(x, dict) and isinstance(y, dict):
            return [d for k in x.keys() | y.keys() for d in leaves(x.get(k), y.get(k), f"{at}.{k}" if at else k)]
        x, y = (v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":")) for v in (x, y))
        return [] if x == y else [(at, x, y)]

    pairs = [(i if i else None, tree(9), tree(9)) for i in range(12)]
    pairs += pairs[:3]
    df = spark.createDataFrame([(i, json.dumps(x, separators=(",", ":")), json.dumps(y, separators=(",", ":")), "p") for i, x, y in pairs], "id int, before string, after string, path string")
    got = sorted(map(tuple, reg.leaf_diff(df).collect()), key=str)
    assert got == sorted(((i, *d) for i, x, y in pairs for d in leaves(x, y)), key=str) and max(r[1].count(".") for r in got) >= reg.LEVELS + 1
    assert reg.leaf_diff(df.limit(0)).isEmpty()


def test_registered(spark):
    rows = [("s", 5, '{"b": 1, "a": 2}'), ("s", 3, '{"a":2,"b":1}'), ("s", 4, '{"a": 3}'), ("s", 1, "{oops"), ("s", 2, None), ("t", 9, '{"a": 3}')]
    got = reg.registered(spark.createDataFrame(rows, "subject string, at int, schema string"))
    assert {tuple(r) for r in got.collect()} == {("s", '{"a":2,"b":1}', 1), ("s", '{"a":3}', 2), ("t", '{"a":3}', 1)}


def test_references(spark):
    literals = [(1, "x, pay-value ,pay"), (2, "pay"), (3, "s3n://lake/pay/part/"), (4, "lake/payments"), (5, None), (6, "s3://lake/pay")]
    got = reg.references(spark.createDataFrame(literals, "id int, literal string"), spark.createDataFrame([("pay", "pay-value", "pay", "s3a://lake/pay/")], "dataset string, subject string, topic string, delta_path string"))
    assert {tuple(r) for r in got.collect()} == {(1, "pay", "subject"), (2, "pay", "topic"), (3, "pay", "delta_path"), (6, "pay", "delta_path")}


def test_gate_plan(spark):
    kind = "dataset string, subject string, schema string, mode string"
    base = spark.createDataFrame([("a", "a-value", "a.avsc", "FULL"), ("gone", "g", "g.avsc", "FULL")], kind)
    head = spark.createDataFrame([("a", "a-value", "b.avsc", "BACKWARD"), ("new", "n", "n.avsc", "FORWARD")], kind)
    changed = spark.createDataFrame([("a.avsc",), ("a.avsc",), ("b.avsc",)], "path string")
    assert [tuple(r) for r in reg.gate_plan(base, head, changed).collect()] == [("a", "FULL", "schema changed", True, False)]
    assert {tuple(r)[:3] for r in reg.gate_plan(base, head, changed, infra=True).collect()} == {("a", "FULL", "schema changed"), ("new", "FORWARD", "self-test")}
    assert [r.dataset for r in reg.removed_datasets(base, head).collect()] == ["gone"]


def test_catalog_findings(spark):
    rows = [("t", "a", None, None, None, None), ("t", "b", "NOT_PII", "NONE", None, " "), ("t", "c", "DIRECT_IDENTIFIER", "TOKENIZE_HMAC", "PLATFORM", None), ("u", "x", "OTHER", "NONE", None, None), ("t", "ok", "QUASI_IDENTIFIER", "TOKENIZE_HMAC", "PLATFORM", None)]
    catalog = spark.createDataFrame(rows, "table string, name string, class string, treatment string, key_scope string, reason string")
    fields = spark.createDataFrame([("t", n) for n in ("a", "b", "c", "ok", "ok")], "table string, name string")
    want = {("t", "a", "BAD_CLASS"), ("t", "a", "BAD_TREATMENT"), ("t", "b", "NO_REASON"), ("t", "c", "SURVIVES_ERASURE"), ("u", "x", "UNKNOWN_TABLE"), ("t", "id", "NO_SUBJECT_KEY")}
    got = [tuple(r) for r in reg.catalog_findings(catalog, fields, "id").collect()]
    assert set(got) == want and len(got) == len(want)
