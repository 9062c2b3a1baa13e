"""Per-subject keys in a restricted versioned table, and catalog-driven protection of columns.

No key is a literal of a plan: plans are shown in the UI and kept in event logs. New keys are drawn in tasks from the system's
random source, and the keys of the caller come from a row that is joined by broadcast.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import decrypt, encrypt, hmac_pads, hmac_sha256
from ..sources.lake import VersionedTable

SCHEMA = "subject_id string, created_ts long, destroyed_ts long, wrapped_dek string"
ZEROED = "0" * 120
#: Treatments and key scopes of a catalog.
TREATMENTS, SCOPES = ("NONE", "TOKENIZE_HMAC", "ENCRYPT_AESGCM"), ("SUBJECT", "PLATFORM")
#: No statistics of the wrapped key get into file footers.
NO_STATS = {"parquet.column.statistics.enabled#wrapped_dek": "false", "parquet.enable.dictionary#wrapped_dek": "false"}
#: Keys are broadcast up to so many; beyond that Spark shuffles both sides.
BROADCAST_KEYS = 200_000


class SubjectErased(RuntimeError):
    pass


def key_aad(subject: Column) -> Column:
    return F.concat(F.lit("keystore|"), subject)


def with_secrets(df: DataFrame, **secrets: bytes) -> DataFrame:
    """df with binary columns of the given names and values, which no plan shows: they come from an RDD's row."""
    spark = df.sparkSession
    row = spark.createDataFrame(spark.sparkContext.parallelize([(0, *map(bytearray, secrets.values()))], 1), ", ".join(["__one int", *(f"{k} binary" for k in secrets)]))
    return df.withColumn("__one", F.pmod(F.monotonically_increasing_id(), F.lit(1)).cast("int")).join(F.broadcast(row), "__one").drop("__one")  # one row


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A new key of 256 bits for each row."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([os.urandom(32) for _ in range(batch.num_rows)], pa.binary())], names=["subject_id", "dek"])


class KeyStore:
    def __init__(self, spark: SparkSession, path: str, kek: bytes):
        self.spark, self.kek, self.table = spark, kek, VersionedTable(spark, path)

    def _rows(self) -> DataFrame:
        return self.table.read() if self.table.versions() else self.spark.createDataFrame([], SCHEMA)

    def get_or_create(self, subjects: DataFrame) -> DataFrame:
        """(subject_id, dek) for a batch of ids; nothing is written if any of them is erased."""
        ids = subjects.select(F.col(subjects.columns[0]).cast("string").alias("subject_id")).dropna().distinct()
        known = self._rows()
        if not ids.join(known.where("destroyed_ts is not null"), "subject_id", "left_semi").isEmpty():
            raise SubjectErased("a subject of the batch is erased")
        fresh = ids.join(known, "subject_id", "left_anti")
        drawn = with_secrets(fresh.select("subject_id").mapInArrow(_drawn, "subject_id string, dek binary"), __kek=self.kek)
        wrapped = F.hex(F.aes_encrypt("dek", F.col("__kek"), F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), key_aad(F.col("subject_id"))))
        rows = drawn.select("subject_id", F.lit(int(time.time() * 1000)).cast("long").alias("created_ts"), F.lit(None).cast("long").alias("destroyed_ts"), wrapped.alias("wrapped_dek"))
        if not fresh.isEmpty():
            self.table.append(rows, options=NO_STATS)
        return self.deks(ids)

    def deks(self, ids: DataFrame | None = None) -> DataFrame:
        live = self._rows().where("destroyed_ts is null")
        if ids is not None:
            live = live.join(ids, "subject_id", "left_semi")
        return with_secrets(live, __kek=self.kek).select("subject_id", F.aes_decrypt(F.unhex("wrapped_dek"), F.col("__kek"), F.lit("GCM"), F.lit("DEFAULT"), key_aad(F.col("subject_id"))).alias("dek"))

    def status(self, subject: str) -> str:
        r = self._rows().where(F.col("subject_id") == subject).select("destroyed_ts").first()
        if r is None:
            raise KeyError(subject)
        return "destroyed" if r.destroyed_ts is not None else "live"

    def get(self, subject: str) -> bytes:
        if self.status(subject) == "destroyed":
            raise SubjectErased(subject)
        return bytes(self.deks().where(F.col("subject_id") == subject).first().dek)

    def destroy(self, subject: str, vacuum: bool = True) -> int:
        """Zeroes the wrapped key and keeps a tombstone, for unknown subjects too; a second call changes nothing."""
        r = self._rows().where(F.col("subject_id") == subject).select("destroyed_ts").first()
        now = int(time.time() * 1000)
        if r is None:
            self.table.append(self.spark.createDataFrame([(subject, now, now, ZEROED)], SCHEMA), options=NO_STATS)
        elif r.destroyed_ts is not None:
            return r.destroyed_ts
        else:
            self.table.update(F.col("subject_id") == subject, {"destroyed_ts": F.lit(now).cast("long"), "wrapped_dek": F.lit(ZEROED)}, options=NO_STATS)
        if vacuum:
            self.table.vacuum(0, enforce=False)
        return now

    def counts(self) -> DataFrame:
        return self._rows().agg(F.count_if(F.col("destroyed_ts").isNull()).alias("live"), F.count_if(F.col("destroyed_ts").isNotNull()).alias("destroyed"))

    def history_exposure(self, subject: str) -> list[int]:
        """Versions from which the real wrapped key can still be read."""
        out = []
        for v in self.table.versions():
            if self.table.readable(v) and not self.table.read(v).where((F.col("subject_id") == subject) & (F.col("wrapped_dek") != ZEROED)).isEmpty():
                out.append(v)
        return out


def protect(df: DataFrame, catalog: dict[str, dict], subject: str, store: KeyStore, platform_key: bytes, table: str) -> DataFrame:
    """Columns treated as the catalog says; nulls stay null, columns outside it are untouched.

    A row with a subject-scoped value but no subject fails the whole call before anything is written, and so does a treatment or
    key scope that isn't known, whether the table has the column or not. Columns that start with two underscores are reserved.
    """
    wrong = [c for c, e in catalog.items() if e.get("treatment", "NONE") not in TREATMENTS or e.get("key_scope", "SUBJECT") not in SCOPES]
    if wrong:
        raise ValueError(f"unknown treatment or key scope: {sorted(wrong)}")
    known = {c: e for c, e in catalog.items() if c in df.columns and e.get("treatment", "NONE") != "NONE"}
    scoped = [c for c, e in known.items() if e.get("key_scope", "SUBJECT") == "SUBJECT"]
    if scoped:
        if subject not in df.columns:
            raise ValueError(f"no subject column {subject}")
        loose = F.col(subject).isNull() & F.greatest(*(F.col(c).isNotNull() for c in scoped), F.lit(False))
        if not df.where(loose).isEmpty():
            raise ValueError("a subject-scoped value has no subject")
        deks = store.get_or_create(df.select(subject)).select(F.col("subject_id").alias("__s"), F.col("dek").alias("__dek"))
        deks = F.broadcast(deks) if deks.count() <= BROADCAST_KEYS else deks
        df_ = df.join(deks, F.col(subject).cast("string") == F.col("__s"), "left")
    else:
        df_ = df
    inner, outer = hmac_pads(platform_key)
    df_ = with_secrets(df_, __inner=inner, __outer=outer)
    own_inner = F.transform(F.array("__dek"), lambda k: _xor(k, 0x36))[0] if scoped else None
    own_outer = F.transform(F.array("__dek"), lambda k: _xor(k, 0x5C))[0] if scoped else None

    def treated(c: str) -> Column:
        if c not in known:
            return F.col(c)
        if known[c]["treatment"] == "ENCRYPT_AESGCM":
            return encrypt(F.col(c).cast("string"), F.col("__dek"), aad(F.col(subject), table, c)).alias(c)
        platform = known[c].get("key_scope") == "PLATFORM"
        return hmac_sha256(F.col(c).cast("string"), F.col("__inner") if platform else own_inner, F.col("__outer") if platform else own_outer).alias(c)

    return df_.select(*(treated(c) for c in df.columns))


def _xor(key: Column, pad: int) -> Column:
    """A 32-byte key as a 64-byte HMAC pad."""
    digits = F.hex(key)
    body = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.lpad(F.hex(F.conv(F.substr(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("long").bitwiseXOR(F.lit(pad).cast("long"))), 2, "0")), "")
    return F.unhex(F.concat(body, F.lit(f"{pad:02X}" * 32)))


def aad(subject: Column, table: str, column: str) -> Column:
    return F.concat(subject.cast("string"), F.lit(f"|{table}.{column}"))


def reveal(df: DataFrame, catalog: dict[str, dict], subject: str, store: KeyStore, table: str) -> DataFrame:
    """Encrypted columns in plain text; tokens stay, plain values pass, values of erased subjects are null."""
    known = [c for c, e in catalog.items() if c in df.columns and e["treatment"] == "ENCRYPT_AESGCM"]
    deks = store.deks().select(F.col("subject_id").alias("__s"), F.col("dek").alias("__dek"))
    out = df.join(deks, F.col(subject).cast("string") == F.col("__s"), "left")
    return out.select(*(F.when(F.col(c).startswith("enc:v1:"), decrypt(c, F.col("__dek"), aad(F.col(subject), table, c))).otherwise(F.col(c)).alias(c) if c in known else F.col(c) for c in df.columns))


def decrypt_view(df: DataFrame, catalog: dict[str, dict], subject: str, store: KeyStore, table: str, subject_id: str) -> DataFrame:
    """One subject's rows in plain text; SubjectErased where the key is gone, KeyError where there never was one."""
    store.get(subject_id)
    return reveal(df.where(F.col(subject).cast("string") == subject_id), catalog, subject, store, table)


def nonce_reuse(df: DataFrame, column: str, scope: str) -> DataFrame:
    """(scope, nonce) pairs that occur more than once among encrypted values."""
    return df.where(F.col(column).startswith("enc:v1:")).groupBy(scope, F.split(column, ":")[2].alias("nonce")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def audited(df: DataFrame, column: str, scope: str) -> DataFrame:
    """n encrypted values, and how many of them share their nonce with another of the same scope."""
    n = df.where(F.col(column).startswith("enc:v1:")).agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(nonce_reuse(df, column, scope).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("reused")))  # one row each
