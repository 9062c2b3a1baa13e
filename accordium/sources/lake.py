"""Versioned Parquet tables: numbered commits that list files, copy-on-write changes, vacuum; backups with manifests.

Layout: <table>/data/*.parquet and <table>/log/<20 digits>.json. A commit is written aside and then renamed to the next log
file, which fails if another writer was first, so readers never see half of one. Logs hold no predicate and no statistics, so a deleted subject isn't named there. Paths are
opened through Hadoop's file systems, so a table can be in any store that Spark reaches.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

GUARD_HOURS = 168
MANIFEST = "key string, size long, sha256 string"


class ConcurrentCommit(RuntimeError):
    pass


class AppendOnly(RuntimeError):
    pass


class RetentionGuard(RuntimeError):
    pass


class VersionUnreadable(RuntimeError):
    pass


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def list_keys(spark: SparkSession, root: str) -> list[str]:
    """Relative names of all files below root, sorted."""
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    base = fs.makeQualified(path(root)).toString().rstrip("/") + "/"
    files, out = fs.listFiles(path(root), True), []
    while files.hasNext():
        out.append(files.next().getPath().toString().removeprefix(base))
    return sorted(out)


@dataclass
class Commit:
    version: int
    op: str
    schema: str
    files: list[str]
    properties: dict[str, str] = field(default_factory=dict)
    rows_changed: int = 0
    ts: int = 0


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return [int(k[:20]) for k in list_keys(self.spark, f"{self.path}/log") if k.endswith(".json")]

    def commit_of(self, version: int | None = None) -> Commit | None:
        found = self.versions()
        if not found:
            return None
        version = max(found) if version is None else version
        if version not in found:
            raise VersionUnreadable(f"no version {version}")
        text = self.spark.read.text(f"{self.path}/log/{version:020d}.json", wholetext=True).first()[0]
        return Commit(**json.loads(text))

    def _commit(self, last: Commit | None, op: str, schema: str, files: list[str], rows: int, properties: dict | None = None) -> Commit:
        new = Commit(last.version + 1 if last else 0, op, schema, files, properties if properties is not None else (last.properties if last else {}), rows, int(time.time() * 1000))
        target, aside = f"{self.path}/log/{new.version:020d}.json", f"{self.path}/log/.{uuid.uuid4().hex}"
        fs, path = _fs(self.spark, target)
        out = fs.create(path(aside), False)
        out.write(bytearray(json.dumps(asdict(new)).encode()))
        out.close()
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        plain = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # no overwriting
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(path(target)).toUri(), sc._jsc.hadoopConfiguration())
        try:
            files.rename(fs.makeQualified(path(aside)), fs.makeQualified(path(target)), plain)
        except Py4JJavaError as e:
            fs.delete(path(aside), False)
            raise ConcurrentCommit(f"version {new.version} exists") from e
        return new

    def _write(self, df: DataFrame, options: dict | None = None) -> list[str]:
        part = f"data/{uuid.uuid4().hex}"
        df.write.options(**(options or {})).parquet(f"{self.path}/{part}")
        return [f"{part}/{k}" for k in list_keys(self.spark, f"{self.path}/{part}") if k.endswith(".parquet")]

    def read(self, version: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """The table at a version; VersionUnreadable where its files are gone."""
        c = self.commit_of(version)
        if c is None:
            raise VersionUnreadable("no such table")
        schema = StructType.fromJson(json.loads(c.schema))
        if not c.files:
            df = self.spark.createDataFrame([], schema)
        else:
            there = {f"data/{k}" for k in list_keys(self.spark, f"{self.path}/data")}
            if gone := set(c.files) - there:
                raise VersionUnreadable(f"version {c.version}: {len(gone)} files are gone")
            df = self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in c.files))
        return df.select(*columns) if columns else df

    def append(self, df: DataFrame, properties: dict | None = None, options: dict | None = None) -> Commit:
        """Adds rows; new columns widen the schema, missing ones read as null."""
        last = self.commit_of()
        schema = df.schema
        if last:
            old = StructType.fromJson(json.loads(last.schema))
            schema = StructType(old.fields + [f for f in df.schema.fields if f.name not in old.fieldNames()])
        files = self._write(df, options)
        return self._commit(last, "append", schema.json(), (last.files if last else []) + files, 0, properties if last is None else None)

    def overwrite(self, df: DataFrame, properties: dict | None = None, options: dict | None = None) -> Commit:
        return self._commit(self.commit_of(), "overwrite", df.schema.json(), self._write(df, options), 0, properties)

    def _changed(self, op: str, hit: Column, new: dict[str, Column] | None, options: dict | None = None) -> Commit:
        last = self.commit_of()
        if last is None:
            raise VersionUnreadable("no such table")
        if last.properties.get("appendOnly") == "true":
            raise AppendOnly(f"{op} on an append-only table")
        df = self.read(last.version)
        found = df.where(hit).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect() if last.files else []  # one row for each file
        rows = sum(r.n for r in found)
        if not rows:
            return last
        names = {"/".join(unquote(r.f).split("/")[-3:]) for r in found}  # data/<write>/<file>
        touched = [f for f in last.files if f in names]
        part = self.spark.read.schema(df.schema).parquet(*(f"{self.path}/{f}" for f in touched))
        hit = F.coalesce(hit, F.lit(False))
        kept = part.where(~hit) if new is None else part.select(*(F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns))
        files = self._write(kept, options)
        return self._commit(last, op, last.schema, [f for f in last.files if f not in names] + files, rows)

    def delete(self, hit: Column) -> Commit:
        """Rewrites the files that hold matching rows; rows_changed of the commit says how many went."""
        return self._changed("delete", hit, None)

    def update(self, hit: Column, new: dict[str, Column], options: dict | None = None) -> Commit:
        return self._changed("update", hit, new, options)

    def vacuum(self, retention_hours: int = GUARD_HOURS, enforce: bool = True) -> int:
        """Removes files that the current version doesn't list; a short retention is refused unless enforce is off."""
        if enforce and retention_hours < GUARD_HOURS:
            raise RetentionGuard(f"retention below {GUARD_HOURS} hours")
        current, gone = self.commit_of(), 0
        keep = set(current.files) if current else set()
        cut = time.time() * 1000 - retention_hours * 3_600_000
        fs, path = _fs(self.spark, self.path)
        for k in list_keys(self.spark, f"{self.path}/data"):
            target = path(f"{self.path}/data/{k}")
            if f"data/{k}" not in keep and (not retention_hours or fs.getFileStatus(target).getModificationTime() < cut):
                fs.delete(target, False)
                gone += k.endswith(".parquet")
        return gone

    def readable(self, version: int) -> bool:
        try:
            self.read(version)
        except VersionUnreadable:
            return False
        return True

    def log_residue(self, subject: str) -> int:
        """Commit files that name a subject."""
        logs = self.spark.read.text(f"{self.path}/log", wholetext=True)
        return logs.where(F.contains("value", F.lit(subject))).count()


def tables_below(spark: SparkSession, root: str) -> list[str]:
    """Relative names of the tables below root: folders that hold a log of commits."""
    return sorted({m[1] for k in list_keys(spark, root) if (m := re.fullmatch(r"(.+)/log/\d{20}\.json", k))})


def _arrow(path: str):
    """A file system and a path in it, inside a task."""
    from pyarrow import fs

    path = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "/", path))
    return fs.FileSystem.from_uri(path)


def _streamed(source: str, target: str | None):
    """key, size, sha256 of objects below source, a piece at a time; copied to target on the way, where there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import_fs, base = _arrow(source)
        for pdf in batches:
            rows = []
            for key in pdf["key"]:
                digest, size, out = hashlib.sha256(), 0, None
                if target:
                    to, root = _arrow(target)
                    to.create_dir(f"{root}/{key}".rsplit("/", 1)[0], recursive=True)
                    out = to.open_output_stream(f"{root}/{key}")
                with import_fs.open_input_stream(f"{base}/{key}") as stream:
                    while piece := stream.read(1 << 20):
                        digest.update(piece)
                        size += len(piece)
                        if out:
                            out.write(piece)
                if out:
                    out.close()
                rows.append((key, size, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["key", "size", "sha256"])

    return run


def _keys(spark: SparkSession, root: str) -> DataFrame:
    names = [(k,) for k in list_keys(spark, root) if not k.rsplit("/", 1)[-1].startswith(".")]
    return spark.createDataFrame(names, "key string").repartition(max(1, min(len(names), 200)))


def freeze(spark: SparkSession, source: str, root: str, label: str) -> DataFrame:
    """Copies all objects below source to root/label, in tasks, and writes their manifest (key, size, sha256) last. Never overwrites."""
    target = f"{root}/{label}"
    fs, path = _fs(spark, target)
    if fs.exists(path(target)):
        raise FileExistsError(label)
    _keys(spark, source).mapInPandas(_streamed(source, f"{target}/objects"), MANIFEST).write.json(f"{target}/manifest")
    return manifest(spark, root, label)


def manifest(spark: SparkSession, root: str, label: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{root}/{label}/manifest")


def labels(spark: SparkSession, root: str) -> list[str]:
    """Backups that are complete: their manifest is there."""
    return sorted({k.split("/")[0] for k in list_keys(spark, root) if re.fullmatch(r"[^/]+/manifest/_SUCCESS", k)})


def latest(spark: SparkSession, root: str) -> str | None:
    return max(labels(spark, root), default=None)


def objects_by_table(manifest_rows: DataFrame) -> DataFrame:
    """table, objects, bytes of a manifest; objects outside any table are of an empty one."""
    owner = F.regexp_extract("key", "^(.+?)/(?:data|log)/", 1)
    return manifest_rows.groupBy(owner.alias("table")).agg(F.count(F.lit(1)).alias("objects"), F.sum("size").alias("bytes"))


def digest(manifest_rows: DataFrame) -> DataFrame:
    """n_rows and hash of a manifest: one digest of a whole backup, which any change of a key, size or content changes."""
    from ..operators.sampling import ordered_hash

    return ordered_hash(manifest_rows, ["key"], F.sha2(F.concat_ws("|", "key", F.col("size").cast("string"), "sha256"), 256))


def backups_holding(spark: SparkSession, root: str, key: str, subject: str) -> list[str]:
    """label/table of the backups that hold rows of a subject. An unreadable table is an error, not an empty one."""
    out = []
    for label in labels(spark, root):
        for name in tables_below(spark, f"{root}/{label}/objects"):
            df = VersionedTable(spark, f"{root}/{label}/objects/{name}").read()
            if key in df.columns and not df.where(F.col(key).cast("string") == subject).isEmpty():
                out.append(f"{label}/{name}")
    return out


def hashes(spark: SparkSession, root: str) -> DataFrame:
    """key, size, sha256 of all objects below root, read in tasks a piece at a time."""
    return _keys(spark, root).mapInPandas(_streamed(root, None), MANIFEST)


def verify(spark: SparkSession, root: str, label: str) -> DataFrame:
    """key, problem (missing, unlisted, changed) of a backup; empty where all is well."""
    want = manifest(spark, root, label)
    have = hashes(spark, f"{root}/{label}/objects").select("key", F.col("sha256").alias("now"))
    problem = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when(F.col("now") != F.col("sha256"), "changed")
    return want.join(have, "key", "full_outer").select("key", problem.alias("problem")).where("problem is not null")
