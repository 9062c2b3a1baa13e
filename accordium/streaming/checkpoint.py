"""The compiled suite over a stream: each micro-batch is judged and its offenders are kept once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.scalars import frame_payload
from ..operators.quality import Rule, offending


def checked(stream: DataFrame, rules: list[Rule]) -> DataFrame:
    """Offending rows of a stream with their labels; row rules only."""
    return offending(stream, [r for r in rules if "unique" not in r.kind and "table" not in r.kind])


def framed_events(spark: SparkSession, source: str, options: dict[str, str], decode: Callable[[DataFrame], DataFrame], status: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A stream of framed messages (Kafka, or files with a binary `value`), decoded, with one status column held to a set.

    decode gets the column `payload`, the message without its frame; it may be any map of rows, as sources.avro.decoded().
    """
    reader = spark.readStream.format(source).options(**options)
    raw = (reader if source == "kafka" else reader.schema("value binary")).load()
    out = decode(raw.where("value is not null").select(frame_payload("value").alias("payload")))
    return out.where(F.col(status).isin(*keep)) if status else out


def run_once(spark: SparkSession, folder: str, schema, rules: list[Rule], out: str, checkpoint: str, key: str, name: str = "*.parquet", time: str | None = None, late: str = "1 day") -> DataFrame:
    """Everything that is there now, as a stream: offenders are appended to `out`, one for each key, exactly once.

    With a `time` column, keys are remembered for as long as rows may come `late`, so that the state is bounded; without one
    they are remembered for ever.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    found = checked(stream, rules)
    if time is None:
        once = found.dropDuplicates([key])
    else:
        at = found.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", late)
        once = at.dropDuplicatesWithinWatermark([key]).drop("__at")
    query = once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(StructType([*stream.schema.fields, StructField("expectation", ArrayType(StringType()))])).parquet(out)
