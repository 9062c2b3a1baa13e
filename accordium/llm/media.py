"""Media columns: texts stored losslessly as progressive JPEG coefficients, decoded into full-resolution RGB tensors.

The codec is in jpeg.py. encode_media() makes the media column, decode_media() the payload and tensor columns; both work batch
by batch, so memory follows the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jpeg
from .common import slices, texts_of, written

#: Files are decoded together up to about so many bytes: wide arrays make a step of the entropy decoder cheap.
TOGETHER = 8_000_000


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for a, b in slices(texts):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(t or b"") for t in texts[a:b]], pa.int64()), pa.array(jpeg.encode(texts[a:b]), pa.binary())], names=["doc_id", "n_bytes", "media"])


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = batch.column(2).to_pylist()
        for a, b in slices(media, TOGETHER):
            coefs, layout, infos = jpeg.coefficients(media[a:b])
            kept = jpeg.payloads(coefs, layout, infos)
            at = 0
            for c, d in slices(media[a:b], 2_000_000):  # tensors are larger than files
                part = jpeg.Layout(layout.cols[c:d], layout.rows[c:d])
                n = int(part.base[-1])
                rgb = jpeg.tensors(coefs[at : at + n], part, infos[c:d])
                at += n
                cols = [batch.column(0).slice(a + c, d - c), batch.column(1).slice(a + c, d - c), batch.column(2).slice(a + c, d - c), pa.array(kept[c:d], pa.binary())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([x.shape[0] for x in rgb], pa.int32()), pa.array([x.shape[1] for x in rgb], pa.int32()), pa.array([np.ascontiguousarray(x).tobytes() for x in rgb], pa.binary())], names=["doc_id", "n_bytes", "media", "payload", "height", "width", "rgb"])


def encode_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, a progressive JPEG that holds the text's bytes; a null text counts as empty.

    docs needs doc_id and text; other columns are ignored, whatever their names. Every row gives a row, repeated ids too, and
    equal texts give equal files. Texts of any length are taken whole. An empty table gives an empty result.
    """
    return docs.select("doc_id", "text").mapInArrow(_encode, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, media binary")


def decode_media(media: DataFrame) -> DataFrame:
    """The columns of encode_media(), the payload read back (padded with bytes 255), and the tensor: height, width, rgb (height x width x 3 bytes)."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_decode, f"doc_id {dict(media.dtypes)['doc_id']}, n_bytes long, media binary, payload binary, height int, width int, rgb binary")


def stored_media(docs: DataFrame) -> DataFrame:
    """Documents encoded, written, read back and decoded: digests of the payload and the media, and a feature of the tensor."""
    spark = docs.sparkSession
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")  # headers repeat from file to file
    try:
        stored = written(encode_media(docs), "media")
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)
    back = decode_media(stored)
    return back.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.expr("substring(payload, length(payload) - 31, 32)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.concat_ws(":", F.concat_ws("x", "height", "width"), F.crc32("rgb")).alias("feature"),
    )
