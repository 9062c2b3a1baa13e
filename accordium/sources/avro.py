"""Decoding of framed Avro records of mapped primitive types, batch by batch."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..plans.contracts import struct_type


def _long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return (value >> 1) ^ -(value & 1), at


def _field(avro, data: bytes, at: int):
    if isinstance(avro, list):
        i, at = _long(data, at)
        return _field(avro[i], data, at)
    name = avro["type"] if isinstance(avro, dict) else avro
    if name == "null":
        return None, at
    if name in ("long", "int"):
        return _long(data, at)
    if name == "enum":
        i, at = _long(data, at)
        return avro["symbols"][i], at
    if name == "boolean":
        return data[at] == 1, at + 1
    if name in ("double", "float"):
        n = 8 if name == "double" else 4
        return struct.unpack_from("<d" if n == 8 else "<f", data, at)[0], at + n
    if name == "string":
        n, at = _long(data, at)
        return data[at : at + n].decode(), at + n
    return _field(name, data, at)


def decode(df: DataFrame, column: str, schema: str, framed: bool = True) -> DataFrame:
    """The records of a binary column; framed ones start with a magic byte and a four-byte schema id. Works on streams too."""
    fields = json.loads(schema)["fields"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data in pdf[column]:
                at, row = 5 if framed else 0, []
                for f in fields:
                    v, at = _field(f["type"], bytes(data), at)
                    row.append(v)
                rows.append(row)
            yield pd.DataFrame(rows, columns=[f["name"] for f in fields]).astype(object)

    return df.select(column).mapInPandas(run, struct_type(schema))
