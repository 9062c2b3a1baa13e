"""What the text classifiers share: the bounded sample they are fitted on, and scoring every row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, lean, sliced_texts, written

#: Labelled rows that a classifier is fitted on at most, chosen by a hash of their id.
SAMPLE_ROWS = 20_000

Features = Callable[[list[bytes | None]], np.ndarray]


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, y): distinct labelled texts outside the held-out fold, `rows` at most; an id's labels are averaged and halves count as 1."""
    known = labels.select("doc_id", F.col(label).alias("y")).where("doc_id is not null and y is not null").where(fold_of("doc_id", 4) != 2)
    known = known.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").withColumn("print", F.xxhash64("text"))
    # copies count once, so that a group of them doesn't fill the sample
    once = found.groupBy("print").agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id", "y")).alias("r")).orderBy("r", "print").limit(rows).select("print", F.col("r.doc_id").alias("doc_id"), F.col("r.y").alias("y"))
    return written(found.select("doc_id", "text", "print").join(F.broadcast(once), ["print", "doc_id"]).dropDuplicates(["print"]).select("text", "y"), "sample")


def matrix(rows: DataFrame, features: Features, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample: SAMPLE_ROWS small rows at most reach the driver."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in sliced_texts(batch):
                x = features(texts)
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1).slice(a, b - a)], names=["x", "y"])

    got = rows.select("text", "y").mapInArrow(run, "x array<double>, y int").toPandas()
    if not len(got):
        return np.zeros((0, size)), np.zeros(0)
    x, y = np.array(got.x.tolist()), got.y.to_numpy(np.float64)
    order = np.lexsort((y, *x.T))  # whatever order the rows arrived in
    return x[order], y[order]


def scored(docs: DataFrame, score: Callable[[list[bytes | None]], np.ndarray]) -> DataFrame:
    """doc_id and score of every row."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in sliced_texts(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(score(texts), pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def filtered(docs: DataFrame, keeper: Callable[[], Callable[[list[bytes | None]], np.ndarray]]) -> DataFrame:
    """The rows, with all their columns, whose text is kept. Each task calls `keeper` once, for what tells texts to keep."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = keeper()
        for batch in batches:
            for a, b, texts in sliced_texts(batch):
                yield batch.slice(a, b - a).filter(pa.array(keep(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
