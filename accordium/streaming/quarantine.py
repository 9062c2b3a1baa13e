"""Quarantine of a stream, exactly once: a batch's number is the key of what it writes, so that a replayed batch replaces itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import Rule, offending, summary
from ..operators.quarantine import evidence, new_rows

RESULTS = "ordinal int, expectation string, target string, success boolean, unexpected_count long, error string"


def rows_schema(source: StructType) -> StructType:
    kinds = {"expectation": "array<string>", "run_ts": "long", "source_version": "long"}
    from ..operators.quarantine import EVIDENCE

    return StructType(source.fields + StructType.fromDDL(", ".join(f"{c} {kinds.get(c, 'string')}" for c in EVIDENCE)).fields)


def _folder(out: str, what: str, batch: int) -> str:
    return f"{out}/{what}/batch={batch}"


def kept(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All quarantined rows, with the number of the batch that brought them; empty where none was written yet."""
    try:
        return spark.read.schema(schema.add("batch", "long") if "batch" not in schema.names else schema).parquet(f"{out}/rows")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def results(spark: SparkSession, out: str) -> DataFrame:
    """The summary of each batch."""
    return spark.read.schema(f"{RESULTS}, batch long").parquet(f"{out}/results")


def judged(rules: list[Rule], out: str, meta: dict):
    """What a stream does with a batch. All rules are judged over the batch, those about uniqueness and the table too. Rows with a
    fingerprint that an earlier batch has stored are left out; equal rows of one batch stay, as in new_rows()."""

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            summary(batch, rules).select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in RESULTS.split(", "))).write.mode("overwrite").parquet(_folder(out, "results", number))
            rows = evidence(offending(batch, rules), meta)
            before = kept(spark, out, rows_schema(batch.schema)).where(F.col("batch") < number)
            new_rows(rows, before).select(rows.columns).write.mode("overwrite").parquet(_folder(out, "rows", number))
        finally:
            batch.unpersist()

    return handle


def quarantine_once(stream: DataFrame, rules: list[Rule], out: str, checkpoint: str, meta: dict) -> None:
    """Judges what is there now. A batch that is run again after a crash writes the same folders anew, so nothing is added twice;
    readers never see two versions of a batch, and an unfinished one only until its replay."""
    stream.writeStream.foreachBatch(judged(rules, out, meta)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def forget_commit(spark: SparkSession, checkpoint: str) -> int:
    """Removes the mark that a stream's last batch is done, as a crash right before it would leave things: the next run replays
    that batch. For drills. Returns the batch's number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(conf)
    last = max(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)
    return last
