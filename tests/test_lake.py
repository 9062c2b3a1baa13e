"""Versioned tables, backups, keys and erasure."""

import pytest
from pyspark.sql import functions as F

from accordium.operators.crypto import KeyStore, SubjectErased, decrypt_view, nonce_reuse, protect, reveal
from accordium.plans.erasure import Erasure, notification, probes
from accordium.sources import lake

KEK, PLATFORM = bytes(range(32)), bytes(range(32, 64))
CATALOG = {"name": {"treatment": "ENCRYPT_AESGCM"}, "ssn": {"treatment": "TOKENIZE_HMAC"}, "shop": {"treatment": "TOKENIZE_HMAC", "key_scope": "PLATFORM"}}


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(f"S{i % 5}", f"name {i}" if i else None, f"ssn {i % 5}", f"shop {i % 2}", i) for i in range(20)], "id string, name string, ssn string, shop string, n long")


def test_versions_delete_vacuum(spark, people, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"))
    t.append(people)
    t.append(people.withColumn("extra", F.lit(1)))
    assert t.read().count() == 40 and "extra" in t.read().columns and t.read(0).count() == 20
    assert t.delete(F.col("id") == "S1").rows_changed == 8
    assert t.read().count() == 32 and t.read(1).count() == 40
    assert t.delete(F.col("id") == "nobody").version == 2
    assert t.update(F.col("id") == "S2", {"n": F.lit(-1).cast("long")}).rows_changed == 8
    assert t.read().where("n = -1").count() == 8
    with pytest.raises(lake.RetentionGuard):
        t.vacuum(0)
    t.vacuum(0, enforce=False)
    assert t.readable(3) and not t.readable(1) and t.read().count() == 32
    assert t.log_residue("S1") == 0
    t.overwrite(people.limit(3))
    assert t.read().count() == 3


def test_commits_exclude_each_other(spark, people, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"))
    t.append(people)
    last = t.commit_of()
    t._commit(last, "append", last.schema, last.files, 0)
    with pytest.raises(lake.ConcurrentCommit):
        t._commit(last, "append", last.schema, last.files, 0)


def test_append_only(spark, people, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"))
    t.append(people, properties={"appendOnly": "true"})
    with pytest.raises(lake.AppendOnly):
        t.delete(F.col("n") == 1)


def test_backup(spark, people, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"))
    t.append(people)
    manifest = lake.freeze(spark, str(tmp_path / "t"), str(tmp_path / "b"), "one")
    assert manifest.count() >= 2 and lake.verify(spark, str(tmp_path / "b"), "one").isEmpty()
    with pytest.raises(FileExistsError):
        lake.freeze(spark, str(tmp_path / "t"), str(tmp_path / "b"), "one")
    victim = next((tmp_path / "b/one/objects/log").glob("*.json"))
    victim.write_text("changed")
    (victim.parent / f".{victim.name}.crc").unlink(missing_ok=True)
    assert [r.problem for r in lake.verify(spark, str(tmp_path / "b"), "one").collect()] == ["changed"]


def test_keys_protect_reveal(spark, people, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), KEK)
    safe = protect(people, CATALOG, "id", store, PLATFORM, "people")
    safe.write.parquet(str(tmp_path / "safe"))
    safe = spark.read.parquet(str(tmp_path / "safe"))
    rows = safe.collect()
    assert all((r.name is None) == (r.n == 0) and len(r.ssn) == 64 for r in rows)
    assert len({r.ssn for r in rows}) == 5 and len({r.shop for r in rows}) == 2
    assert nonce_reuse(safe, "name", "id").isEmpty()
    back = reveal(safe, CATALOG, "id", store, "people")
    assert sorted(r.name or "" for r in back.collect()) == sorted(r.name or "" for r in people.collect())
    own = decrypt_view(safe, CATALOG, "id", store, "people", "S1").collect()
    assert sorted(r.name or "" for r in own) == sorted(r.name or "" for r in people.where("id = 'S1'").collect())
    first = store.get("S1")
    assert len(first) == 32 and store.get_or_create(people.select("id")).count() == 5 and store.get("S1") == first
    stamp = store.destroy("S1")
    assert store.destroy("S1") == stamp and store.history_exposure("S1") == []
    with pytest.raises(SubjectErased):
        store.get("S1")
    with pytest.raises(SubjectErased):
        store.get_or_create(people.select("id"))
    with pytest.raises(KeyError):
        store.get("unknown")
    with pytest.raises(SubjectErased):
        decrypt_view(safe, CATALOG, "id", store, "people", "S1")
    lost = reveal(safe, CATALOG, "id", store, "people").where("id = 'S1'").collect()
    assert all(r.name is None for r in lost)
    with pytest.raises(ValueError):
        protect(people.withColumn("id", F.lit(None).cast("string")), CATALOG, "id", store, PLATFORM, "people")


def test_token_is_hmac(spark):
    import hashlib
    import hmac

    from accordium.functions.scalars import token

    got = spark.createDataFrame([("Ærø",)], "v string").select(token("v", PLATFORM)).first()[0]
    assert got == hmac.new(PLATFORM, "Ærø".encode(), hashlib.sha256).hexdigest()


def test_erasure(spark, people, tmp_path):
    store = KeyStore(spark, str(tmp_path / "keys"), KEK)
    store.get_or_create(people.select("id"))
    paths = {n: str(tmp_path / n) for n in ("a", "b")}
    for p in paths.values():
        lake.VersionedTable(spark, p).append(people)
    e = Erasure(spark, paths, "id", store, str(tmp_path / "audit"), PLATFORM)
    assert e.default_control("S0") == "S1" and e.run("S1", "r0", "S2", dry_run=True)["dry_run"] and len(e.intake("S1")) == 2
    done = e.run("S1", "r1", "S2")
    assert done["verified"] and done["rows_deleted"] == 8 and done["rerun_of"] is None
    again = e.run("S1", "r2", "S2")
    assert again["verified"] and again["rows_deleted"] == 0 and again["rerun_of"] == "r1"
    assert e.audit.log_residue("S1") == 0
    with pytest.raises(lake.AppendOnly):
        e.audit.delete(F.lit(True))


def test_erasure_finds_everything(spark, people, tmp_path):
    """A table that the catalog doesn't list, a frozen backup and the readers of the subject key end up in the audit row."""
    store = KeyStore(spark, str(tmp_path / "keys"), KEK)
    root = tmp_path / "lake"
    for name in ("known", "deep/forgotten", "plain"):
        lake.VersionedTable(spark, str(root / name)).append(people if name != "plain" else people.select("n"))
    lake.freeze(spark, str(root), str(tmp_path / "backups"), "2024-01-01")
    assert lake.latest(spark, str(tmp_path / "backups")) == "2024-01-01" and lake.tables_below(spark, str(root)) == ["deep/forgotten", "known", "plain"]
    sizes = {r.table: r.objects for r in lake.objects_by_table(lake.manifest(spark, str(tmp_path / "backups"), "2024-01-01")).collect()}
    assert set(sizes) == {"known", "deep/forgotten", "plain"} and min(sizes.values()) >= 2
    usage = spark.createDataFrame([("bi", "known", "id"), ("ml", "known", "*"), ("x", "known", "n")], "consumer string, dataset string, name string")
    e = Erasure(spark, {"known": str(root / "known")}, "id", store, str(tmp_path / "audit"), PLATFORM, roots=[str(root)], backups=str(tmp_path / "backups"), usage=usage)
    assert [(h.name, h.source, h.rows) for h in e.intake("S1")] == [("deep/forgotten", "sweep", 4), ("known", "catalog", 4)]
    done = e.run("S1", "r1")
    assert done["verified"] and done["rows_deleted"] == 8 and done["control"] == "S0"
    row = e.audit.read().first()
    assert row.uncatalogued_tables == ["deep/forgotten"] and row.backups_covered == ["2024-01-01/deep/forgotten", "2024-01-01/known"] and row.downstream_to_notify == ["bi (known)", "ml (known)"]
    assert [r.readable for r in probes(spark, e.audit.read(), {"known": str(root / "known"), "deep/forgotten": str(root / "deep/forgotten")}).collect()] == [False, False]
    text = notification(e.audit.read()).first().message
    assert "8 record(s) of 2 dataset(s)" in text and "1 backup set(s)" in text and "2 team(s)" in text and "S1" not in text
    e.run("S1", "r2")
    assert "under request r1" in notification(e.audit.read().where("request_id = 'r2'")).first().message


def test_no_key_in_plans(spark, people, tmp_path):
    from accordium.functions.scalars import hmac_pads

    store = KeyStore(spark, str(tmp_path / "keys"), KEK)
    plans = [df._jdf.queryExecution().toString() for df in (protect(people, CATALOG, "id", store, PLATFORM, "people"), store.deks(), reveal(people, CATALOG, "id", store, "people"))]
    for secret in (KEK, PLATFORM, *hmac_pads(PLATFORM), bytes(store.get("S1"))):
        for plan in plans:
            assert secret.hex() not in plan.lower() and " ".join(f"{b:02X}" for b in secret[:8]) not in plan and "uuid" not in plan
    deks = {bytes(r.dek) for r in store.deks().collect()}
    assert len(deks) == 5 and all(len(d) == 32 for d in deks)
    many = spark.range(2000).selectExpr("'one' as id", "'name' as name", "cast(null as string) as ssn", "cast(null as string) as shop", "id as n")
    sealed = protect(many, CATALOG, "id", store, PLATFORM, "people").select("name").distinct()
    assert sealed.count() == 2000  # a nonce for each value


def test_half_a_commit_is_not_seen(spark, people, tmp_path):
    t = lake.VersionedTable(spark, str(tmp_path / "t"))
    t.append(people)
    (tmp_path / "t/log/.aside").write_text("{")
    assert t.versions() == [0] and t.append(people).version == 1 and t.read().count() == 40
