"""Panels, gate runs, listings, days, paths; records of erasures held against what is there."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from accordium.functions import scalars as fn
from accordium.operators import governance as gov
from accordium.operators import reports as rep
from accordium.operators.crypto import KeyStore, SubjectErased, protect
from accordium.plans.erasure import Erasure, verify_record, view_from_backup
from accordium.sources import lake

KEY = bytes(range(32))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_panels(spark):
    rows = [("ge_checkpoint_pass", {"ds": "a"}, 0.0), ("ge_checkpoint_pass", {"ds": "b"}, 1.0), ("ge_checkpoint_pass", {"ds": "c"}, None), ("schema_gate_rejections_total", {"gate": "x", "pod": "1"}, 2.0), ("schema_gate_rejections_total", {"gate": "x", "pod": "2"}, 3.0), ("schema_gate_rejections_total", None, 1.0), ("gate_latency_seconds", {"gate": "x", "quantile": "0.9"}, 9.0), ("gate_latency_seconds", {"gate": "x", "quantile": "0.5"}, 5.0), ("unknown", {}, 1.0)]
    metrics = spark.createDataFrame(rows, "name string, labels map<string,string>, value double").withColumn("panel", F.lit("clash"))
    assert found(rep.panels(metrics)) == sorted([("checkpoints", "ds=a", 0.0), ("checkpoints", "ds=b", 1.0), ("failing checkpoints", "", 1.0), ("drifted workspaces", "", 0.0), ("rejected changes", "", 6.0), ("rejections by gate", "gate=x", 3.0), ("rejections by gate", "gate=", 1.0), ("median latency by gate", "gate=x", 5.0)])
    assert found(rep.panels(metrics.limit(0))) == [(p.title, "", 0.0) for p in sorted(rep.PANELS, key=lambda p: p.title) if p.orelse is not None]


def test_gate_runs(spark):
    t = lambda s: f"2024-01-01 00:00:{s:02d}"
    step = [("fast path: docs only", "success")]
    rows = [("g", "completed", "success", t(0), t(10), []), ("g", "completed", "failure", t(0), t(30), [("fast path", "skipped")]), ("g", "completed", "success", t(0), t(1), step), ("g", "completed", "cancelled", t(0), t(1), []), ("g", "queued", None, t(0), None, []), ("g", "completed", "success", None, t(1), None), ("h", "completed", "failure", t(0), t(2), step)]
    runs = spark.createDataFrame(rows, "gate string, status string, conclusion string, started string, completed string, steps array<struct<name string, conclusion string>>").withColumns({c: F.to_timestamp(c) for c in ("started", "completed")})
    assert found(rep.gate_runs(runs)) == [("g", 4, 1, 2, 20.0, 30.0), ("h", 1, 1, 0, None, None)]
    assert rep.gate_runs(runs.limit(0)).count() == 0


def test_days(spark):
    df = spark.createDataFrame([(1, "2024-02-29 00:00:00"), (2, "2024-02-29 23:59:59"), (3, "2024-03-01 00:00:00"), (4, None)], "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("ms", F.unix_millis(F.col("t").cast("timestamp")))
    for c in (rep.on_day(F.col("t"), date(2024, 2, 29)), rep.ms_on_day(F.col("ms"), date(2024, 2, 29))):
        assert found(df.where(c).select("id")) == [(1,), (2,)]


def test_day_reaches_the_scan(spark, sf):
    from accordium.session import table

    plan = table(spark, sf, "orders").where(rep.on_day(F.col("o_orderdate"), date(1995, 3, 15)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_listings(spark):
    rows = spark.createDataFrame([("b", 2, 1, "c", ["expect_column_values_to_be_unique(b)"]), ("a", 2, 1, "c", ["x"]), ("z", 1, 1, "c", []), (None, None, 1, "c", None)], "k string, run_ts long, source_version long, checkpoint_id string, expectation array<string>")
    assert [(r.k, r.broken) for r in rep.quarantine_listing(rows, "k").collect()] == [(None, None), ("z", ""), ("a", "x"), ("b", "values_to_be_unique(b)")]
    audit = spark.createDataFrame([("r2", 5, "r1", 0, True, None), ("r1", 3, None, 7, True, True)], "request_id string, completed_ts long, rerun_of string, rows_deleted long, verified_lake boolean, verified_crypto boolean")
    assert [tuple(r) for r in rep.audit_listing(audit).collect()] == [("r1", 3, "primary", 7, True), ("r2", 5, "rerun of r1", 0, False)]


def test_universe_and_drift(spark):
    schema = "dataset string, subject string, topic string, delta_path string, names array<string>"
    base = spark.createDataFrame([("a", "s0", "t0", "p0", ["x", "y"]), ("gone", "s", "t", "p", None), (None, "s", "t", "p", ["q"])], schema)
    head = spark.createDataFrame([("a", "s1", "t1", "p1", ["y", "z"]), ("new", "s", "t", "p", ["n"])], schema)
    assert found(gov.scan_universe(base, head)) == [("a", "s1", "t1", "p1", ["x", "y", "z"]), ("gone", "s", "t", "p", []), ("new", "s", "t", "p", ["n"])]
    changes = spark.createDataFrame([("w", "a", "p", "1", "2"), ("w", "a", "p", "1", "3"), ("w", "a", "q", None, None), ("w", "b", "p", None, "1"), ("w", "b", "q", "1", "1")], "workspace string, address string, path string, before string, after string")
    assert found(gov.drift_changes(changes)) == [("w", "a", "p"), ("w", "b", "p")]


def test_paths(spark):
    df = spark.createDataFrame([("s3a://b/x/y/",), ("s3n://b",), ("/tmp/z",), (None,)], "p string")
    b = fn.bucket_and_key("p")
    got = df.select(b.bucket, b.key, fn.placed_path("p"), fn.placed_path("p", "/l/"), fn.table_path("p", "r/")).collect()
    assert [tuple(r)[:4] for r in got] == [("b", "x/y", "s3://b/x/y", "/l/b/x/y"), ("b", "", "s3://b", "/l/b"), ("", "tmp/z", "/tmp/z", "/tmp/z"), (None, None, None, None)]
    assert spark.range(1).select(fn.table_path(F.lit("shop.eu.sales"), "s3://q/")).first()[0] == "s3://q/sales"


def test_numbers_and_places(spark):
    df = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("t", 9, "c")], "s string, at long, k string")
    assert found(rep.numbered(df, "s", "at").select("k", "n", "file")) == [("a", 1, "v0001"), ("b", 2, "v0002"), ("c", 1, "v0001")]
    uses = spark.createDataFrame([("f", "b.py", 3), ("f", "a.py", 10), ("f", "a.py", 9), ("f", "a.py", 9), ("f", "c.py", 1)], "name string, path string, line int")
    assert found(rep.first_places(uses, "name", "path", "line")) == [("f", "a.py:9,a.py:10,b.py:3")]


def test_records_and_backups(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), KEY)
    catalog = {"name": {"class": "DIRECT_IDENTIFIER", "treatment": "ENCRYPT_AESGCM"}}
    people = spark.createDataFrame([("S1", "ann"), ("S2", "bob"), ("S1", None)], "id string, name string")
    t = lake.VersionedTable(spark, str(tmp_path / "lake/people"))
    t.append(protect(people, catalog, "id", store, KEY, "people"))
    lake.freeze(spark, str(tmp_path / "lake"), str(tmp_path / "backups"), "one")
    view = lambda: view_from_backup(store, str(tmp_path / "backups"), "one", "people", catalog, "id", "S1")
    assert sorted(map(str, (r.name for r in view().collect()))) == ["None", "ann"]
    e = Erasure(spark, {"people": t.path}, "id", store, str(tmp_path / "audit"), KEY)
    e.run("S1", "r1")
    checks = lambda *a: {(r.check, r.passed) for r in verify_record(e, *a).collect()}
    assert checks("r1", "S1") == {("subject", True), ("rows", True), ("version", True), ("key", True)}
    assert checks("r1", "S2") == {("subject", False)}
    with pytest.raises(KeyError):
        verify_record(e, "r9", "S1")
    with pytest.raises(SubjectErased):
        view()
    t.append(spark.createDataFrame([("S1", "back")], "id string, name string"))
    assert ("rows", False) in checks("r1", "S1")


@pytest.mark.parametrize("entry", [{"treatment": "MASK"}, {"treatment": "TOKENIZE_HMAC", "key_scope": "TEAM"}])
def test_protect_refuses_what_it_does_not_know(spark, tmp_path, entry):
    store = KeyStore(spark, str(tmp_path / "keys"), KEY)
    with pytest.raises(ValueError, match="other"):
        protect(spark.createDataFrame([("S1", "x")], "id string, name string"), {"other": entry}, "id", store, KEY, "t")
    assert not store.table.versions()


def test_key_counts(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), KEY)
    assert tuple(store.counts().first()) == (0, 0)
    store.get_or_create(spark.createDataFrame([("a",), ("b",), (None,)], "id string"))
    store.destroy("b")
    store.destroy("never")
    assert tuple(store.counts().first()) == (1, 2)


def test_evidence_names_may_not_clash(spark):
    from accordium.operators.quarantine import evidence

    rows = spark.createDataFrame([(1, "s", ["x"])], "id int, suite string, expectation array<string>")
    with pytest.raises(ValueError, match="suite"):
        evidence(rows, {})


def test_exposition(spark):
    rows = spark.createDataFrame([("up", {"b": 'q"\\', "a": "x\ny"}, 1), ("up", {}, 2), ("up", None, 3), (None, {}, 4), ("up", {}, None)], "name string, labels map<string,string>, value long")
    assert [r[0] for r in gov.exposition(rows).collect()] == ['up{a="x\\ny",b="q\\"\\\\"} 1', "up 2", "up 3"]
    one = spark.createDataFrame([("up", "x", 1)], "name string, label string, value long")
    assert [r[0] for r in gov.exposition(one).collect()] == ['up{label="x"} 1']


def test_digest_of_a_backup(spark, tmp_path):
    rows = [("b", 2, "y"), ("a", 1, "x")]
    of = lambda rows: tuple(lake.digest(spark.createDataFrame(rows, "key string, size long, sha256 string")).first())
    assert of(rows) == of(rows[::-1]) != of([("b", 2, "z"), ("a", 1, "x")]) and of(rows)[0] == 2
