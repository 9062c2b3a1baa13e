"""Erasure of a subject: holdings (catalog and sweep), delete, vacuum, proofs, key destruction, backups, audit; restartable."""

from __future__ import annotations

import hashlib
import hmac
import json
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.crypto import KeyStore, SubjectErased, decrypt_view
from ..sources.lake import VersionedTable, VersionUnreadable, backups_holding, tables_below

AUDIT = "request_id string, subject_hash string, tables_touched array<string>, rows_deleted long, rows_deleted_by_table array<long>, pre_delete_versions array<long>, vacuum_versions array<long>, key_destroyed_ts long, verified_lake boolean, verified_crypto boolean, completed_ts long, operator string, rerun_of string, uncatalogued_tables array<string>, backups_covered array<string>, downstream_to_notify array<string>"


@dataclass
class Holding:
    name: str
    path: str
    source: str
    rows: int
    version: int


def sweep(spark: SparkSession, roots: Sequence[str], key: str) -> dict[str, str]:
    """Path by name of every table below the roots whose schema has the subject key. An unreadable one is an error."""
    found = {}
    for root in roots:
        for name in tables_below(spark, root):
            path = f"{root.rstrip('/')}/{name}"
            if key in VersionedTable(spark, path).read().columns:
                found[path] = name
    return found


def readers_of(usage: DataFrame, key: str) -> list[str]:
    """consumer (dataset) of the uses (consumer, dataset, name) of a subject key, or of whatever there is (`*`, or a null name)."""
    hits = usage.where(F.col("name").isin(key, "*") | F.col("name").isNull()).select(F.format_string("%s (%s)", F.col("consumer").cast("string"), F.col("dataset").cast("string")).alias("r")).distinct()
    return sorted(r.r for r in hits.collect())  # one row for each team that is to be notified


class Erasure:
    """catalog: path by name of the tables that are known to hold subjects. roots: folders whose tables are swept as well.
    backups: folder of frozen copies. usage: uses of columns by consumers (consumer, dataset, name)."""

    def __init__(self, spark: SparkSession, catalog: dict[str, str], subject_key: str, store: KeyStore, audit_path: str, hash_key: bytes, roots: Sequence[str] = (), backups: str | None = None, usage: DataFrame | None = None):
        self.spark, self.catalog, self.key, self.store = spark, {n: p.rstrip("/") for n, p in catalog.items()}, subject_key, store
        self.audit, self.intent, self.hash_key = VersionedTable(spark, audit_path), VersionedTable(spark, audit_path + "_intent"), hash_key
        self.roots, self.backups, self.usage = roots, backups, usage

    def subject_hash(self, subject: str) -> str:
        return hmac.new(self.hash_key, f"erasure-subject|{subject}".encode(), hashlib.sha256).hexdigest()

    def tables(self) -> dict[str, tuple[str, str]]:
        """(name, where it is known from) by path; the catalog's entry wins over the sweep's."""
        own = {self.audit.path, self.intent.path, self.store.table.path}
        found = {p: (n, "sweep") for p, n in sweep(self.spark, self.roots, self.key).items() if p not in own}
        return found | {p: (n, "catalog") for n, p in self.catalog.items()}

    def _rows(self, path: str, subject: str) -> DataFrame:
        return VersionedTable(self.spark, path).read().where(F.col(self.key).cast("string") == subject)

    def intake(self, subject: str) -> list[Holding]:
        """Tables that hold rows of the subject. An unreadable table is an error, not an empty holding."""
        out = []
        for path, (name, source) in self.tables().items():
            t = VersionedTable(self.spark, path)
            if self.key in t.read().columns and (n := self._rows(path, subject).count()):
                out.append(Holding(name, path, source, n, t.commit_of().version))
        return sorted(out, key=lambda h: h.path)

    def default_control(self, subject: str) -> str | None:
        """The least other subject of any table: its rows must not change."""
        least = [VersionedTable(self.spark, p).read().select(F.col(self.key).cast("string").alias("s")).where(F.col("s") != subject).agg(F.min("s")).first()[0] for p in self.tables() if self.key in VersionedTable(self.spark, p).read().columns]
        return min((x for x in least if x is not None), default=None)

    def _counts(self, subject: str | None) -> dict[str, int]:
        return {} if subject is None else {p: self._rows(p, subject).count() for p in self.tables() if self.key in VersionedTable(self.spark, p).read().columns}

    def run(self, subject: str, request_id: str, control: str | None = None, operator: str = "", dry_run: bool = False) -> dict:
        held, hashed = self.intake(subject), self.subject_hash(subject)
        covered = backups_holding(self.spark, self.backups, self.key, subject) if self.backups else []
        notify = readers_of(self.usage, self.key) if self.usage is not None else []
        if dry_run:
            return {"holdings": held, "backups": covered, "downstream": notify, "dry_run": True}
        control = control if control is not None else self.default_control(subject)
        before = self._counts(control)
        # versions are kept before anything is deleted, so that a rerun after a crash still proves that they are gone
        if held:
            self.intent.append(self.spark.createDataFrame([(request_id, hashed, json.dumps({h.path: [h.name, h.source, h.version] for h in held}))], "request_id string, subject_hash string, versions string"))
        old: dict[str, tuple[str, str, int]] = {}
        if self.intent.versions():
            for r in self.intent.read().where(F.col("subject_hash") == hashed).collect():  # the requests of one subject
                for p, (n, source, v) in json.loads(r.versions).items():
                    old[p] = (n, source, max(v, old[p][2] if p in old else -1))
        deleted = {h.path: VersionedTable(self.spark, h.path).delete(F.col(self.key).cast("string") == subject).rows_changed for h in held}
        vacuumed = {}
        for p in old:
            t = VersionedTable(self.spark, p)
            t.vacuum(0, enforce=False)
            vacuumed[p] = t.commit_of().version
        lake = all(not VersionedTable(self.spark, p).readable(v) for p, (_, _, v) in old.items()) and not self.intake(subject)
        lake = lake and self._counts(control) == before
        destroyed = self.store.destroy(subject)
        try:
            self.store.get(subject)
            crypto = False
        except SubjectErased:
            crypto = not self.store.history_exposure(subject)
        earlier = self.audit.read().where((F.col("subject_hash") == hashed) & F.col("rerun_of").isNull()).agg(F.min_by("request_id", "completed_ts")).first()[0] if self.audit.versions() else None
        paths = sorted(old, key=lambda p: (old[p][0], p))
        row = (request_id, hashed, [old[p][0] for p in paths], sum(deleted.values()), [deleted.get(p, 0) for p in paths], [old[p][2] for p in paths], [vacuumed[p] for p in paths], destroyed, lake, crypto, int(time.time() * 1000), operator, earlier, [old[p][0] for p in paths if old[p][1] == "sweep"], covered, notify)
        self.audit.append(self.spark.createDataFrame([row], AUDIT), properties={"appendOnly": "true"})
        return {"verified": lake and crypto, "rows_deleted": sum(deleted.values()), "rerun_of": earlier, "holdings": held, "control": control, "backups": covered, "downstream": notify}


def completed(audit: DataFrame) -> DataFrame:
    """Primary requests that are verified in lake and keys, and reruns."""
    done = F.col("rerun_of").isNull() & F.col("verified_lake") & F.col("verified_crypto")
    return audit.agg(F.count_if(done).alias("completed"), F.count_if(F.col("rerun_of").isNotNull()).alias("reruns"))


def backup_sets(covered: str = "backups_covered"):
    """How many backups (the part before the slash) an audit row covers."""
    return F.size(F.array_distinct(F.transform(covered, lambda b: F.substring_index(b, "/", 1)))).cast("long")


def notification(audit: DataFrame) -> DataFrame:
    """request_id, message: what a requester is told."""
    when = F.date_format(F.timestamp_millis("completed_ts"), "yyyy-MM-dd HH:mm")
    tables = F.size(F.filter("rows_deleted_by_table", lambda n: n > 0))
    first = F.format_string("Request %s to erase your data was completed on %s UTC.", "request_id", when)
    new = F.format_string("%d record(s) of %d dataset(s) were deleted; their history can't be restored.", F.coalesce("rows_deleted", F.lit(0).cast("long")), tables)
    again = F.format_string("The data had been erased under request %s before; that was verified again.", "rerun_of")
    keys = F.format_string("The key of your personal data is destroyed, so encrypted copies in %d backup set(s) can't be read.", backup_sets())
    teams = F.when(F.size("downstream_to_notify") > 0, F.format_string("%d team(s) that work with copies are notified.", F.size("downstream_to_notify")))
    return audit.select("request_id", F.concat_ws("\n", first, F.when(F.col("rerun_of").isNull(), new).otherwise(again), keys, teams).alias("message"))


def probes(spark: SparkSession, audit: DataFrame, paths: dict[str, str]) -> DataFrame:
    """request_id, table, version, readable: whether versions before a delete can still be read, for tables whose path is given."""
    rows = audit.select("request_id", F.explode(F.arrays_zip("tables_touched", "pre_delete_versions")).alias("t")).select("request_id", F.col("t.tables_touched").alias("table"), F.col("t.pre_delete_versions").alias("version"))
    asked = [(r.table, r.version) for r in rows.select("table", "version").distinct().collect() if r.table in paths]  # tables and versions, not rows of theirs
    known = spark.createDataFrame([(t, v, VersionedTable(spark, paths[t]).readable(v)) for t, v in asked], "table string, version long, readable boolean")
    return rows.join(F.broadcast(known), ["table", "version"], "left").select("request_id", "table", "version", "readable")


def verify_record(erasure: Erasure, request_id: str, subject: str) -> DataFrame:
    """check, place, passed: an audit record held against what is there now, reading only.

    subject: its hash is the record's; where it isn't, nothing else is looked at. rows: a touched table has none of the subject. version:
    the version before a delete can't be read any more. key: the subject's key is destroyed. An unknown request is an error.
    """
    spark = erasure.spark
    record = erasure.audit.read().where(F.col("request_id") == request_id).orderBy("completed_ts").first()
    if record is None:
        raise KeyError(request_id)
    schema = "check string, place string, passed boolean"
    if erasure.subject_hash(subject) != record.subject_hash:
        return spark.createDataFrame([("subject", request_id, False)], schema)
    paths, rows = {name: path for path, (name, _) in erasure.tables().items()}, [("subject", request_id, True)]
    for name, version, deleted in zip(record.tables_touched, record.pre_delete_versions, record.rows_deleted_by_table, strict=True):
        there = name in paths
        rows.append(("rows", name, there and erasure._rows(paths[name], subject).isEmpty()))
        if deleted:
            rows.append(("version", f"{name}@{version}", there and not VersionedTable(spark, paths[name]).readable(version)))
    try:
        erasure.store.get(subject)
        rows.append(("key", subject, False))
    except SubjectErased:
        rows.append(("key", subject, True))
    except KeyError:  # there never was one
        rows.append(("key", subject, False))
    return spark.createDataFrame(rows, schema)


def view_from_backup(store: KeyStore, backups: str, label: str, table: str, catalog: dict[str, dict], subject_key: str, subject: str) -> DataFrame:
    """One subject's rows of a backup's table in plain text, with the keys of today: SubjectErased once the key is destroyed."""
    copy = VersionedTable(store.spark, f"{backups.rstrip('/')}/{label}/objects/{table}").read()
    return decrypt_view(copy, catalog, subject_key, store, table, subject)


__all__ = ["AUDIT", "Erasure", "Holding", "VersionUnreadable", "backup_sets", "completed", "notification", "probes", "readers_of", "sweep", "verify_record", "view_from_backup"]
