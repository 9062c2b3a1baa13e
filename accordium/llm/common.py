"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text is handled in slices of about so many bytes, so that a task's memory doesn't follow its input.
SLICE_BYTES = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session (tests) gets one of its own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir isn't set")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a table that written() gave, once what was made from it is written itself."""
    spark = df.sparkSession
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}  # one: all files of a table are in its folder
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fold_of(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id is in fold 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts, F.lit(0).cast("long"))


def row_key() -> Column:
    """A 64-bit key of a row by its doc_id, null or not, and its text; rows that repeat both have the same."""
    return F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), F.col("text"))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def freed() -> None:
    """Gives what Python no longer uses back to the system: Spark keeps a worker for other tasks, and its memory is the executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run) -> Run:
    """A function for mapInArrow that leaves no unused memory with its worker, nor begins with what others left."""

    @functools.wraps(run)
    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freed()
        yield from run(batches)
        freed()

    return lean_run


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `limit` bytes each; a longer text is a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def bytes_of(strings: pa.Array) -> list[bytes]:
    """Strings without nulls as UTF-8 bytes; far quicker than to_pylist()."""
    _, ends, data = strings.buffers()
    if data is None or not len(strings):
        return [b""] * len(strings)
    wide = np.int64 if pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type) else np.int32
    at = np.frombuffer(ends, wide)[strings.offset : strings.offset + len(strings) + 1].tolist()
    raw = data.slice(at[0], at[-1] - at[0]).to_pybytes()
    return [raw[a - at[0] : b - at[0]] for a, b in zip(at[:-1], at[1:], strict=True)]


def slices_of(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """The same over an Arrow column of strings; a null counts as no bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        held = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield start, end
        start = end


def sliced_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Ranges of rows and their texts as UTF-8 bytes; a batch's texts aren't all copied at once."""
    texts = batch.column(batch.schema.get_field_index(name))
    for a, b in slices_of(texts):
        yield a, b, texts.slice(a, b - a).cast(pa.binary()).to_pylist()


def one_list(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some texts, A-Z lower-cased, between ASCII blanks; each word's number among them, and how many a text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    real = pc.not_equal(flat, "")  # blanks at either end leave empty strings
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    coded = flat.filter(real).dictionary_encode()
    counts = np.bincount(text[real.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return bytes_of(coded.dictionary), coded.indices.to_numpy().astype(np.int64), counts


def offsets(counts: np.ndarray | list[int]) -> np.ndarray:
    """0 and the running sums."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ascii_lower() -> bytes:
    """A translation table that lower-cases A-Z and nothing else."""
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


LOWER = ascii_lower()
#: Lower-cases A-Z; what is neither a digit, a letter nor above ASCII becomes a blank.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
