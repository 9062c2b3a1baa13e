"""Contracts: Avro schemas and their Spark types, compatibility under six modes, registry lint."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Modes a subject may have.
MODES = ("BACKWARD", "BACKWARD_TRANSITIVE", "FORWARD", "FORWARD_TRANSITIVE", "FULL", "FULL_TRANSITIVE")
REQUIRED = ("subject", "schema", "owner", "compatibility", "delta_path")
_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType()}


def spark_type(avro) -> tuple[T.DataType, bool]:
    """Spark type and nullability of an Avro type; unmapped ones raise. Logical times stay longs."""
    if isinstance(avro, list):
        rest = [t for t in avro if t != "null"]
        if len(rest) != 1:
            raise ValueError(f"union with {len(rest)} branches besides null")
        return spark_type(rest[0])[0], "null" in avro
    name = avro.get("type") if isinstance(avro, dict) else avro
    if name == "enum":
        return T.StringType(), False
    if isinstance(name, dict | list):
        return spark_type(name)
    if name not in _TYPES:
        raise ValueError(f"type {name} isn't mapped")
    return _TYPES[name], False


def struct_type(schema: dict | str) -> T.StructType:
    schema = json.loads(schema) if isinstance(schema, str) else schema
    return T.StructType([T.StructField(f["name"], *spark_type(f["type"]), metadata={"avro_type": json.dumps(f["type"], sort_keys=True)}) for f in schema["fields"]])


def canonical(schema: str) -> str:
    return json.dumps(json.loads(schema), sort_keys=True, separators=(",", ":"))


def _reads(spark: SparkSession, reader: str, writer: str) -> str | None:
    """Why reader can't read writer's data; None if it can."""
    avro = spark.sparkContext._jvm.org.apache.avro
    parse = lambda s: avro.Schema.Parser().parse(s)
    result = avro.SchemaCompatibility.checkReaderWriterCompatibility(parse(reader), parse(writer))
    return None if str(result.getType()) == "COMPATIBLE" else str(result.getDescription())[:300]


def check(spark: SparkSession, mode: str, new: str, history: list[str]) -> list[tuple[int, str, str]]:
    """(version from 1, direction, problem) for each version that breaks; empty where the new schema is compatible."""
    if mode not in MODES:
        raise ValueError(f"mode {mode}")
    start = 0 if mode.endswith("_TRANSITIVE") else max(0, len(history) - 1)
    out = []
    for v, old in enumerate(history[start:], start + 1):
        if not mode.startswith("FORWARD") and (why := _reads(spark, new, old)):
            out.append((v, "BACKWARD", why))
        if not mode.startswith("BACKWARD") and (why := _reads(spark, old, new)):
            out.append((v, "FORWARD", why))
    return out


def lint(registry: dict[str, dict]) -> list[tuple[str, str]]:
    """(dataset, finding): missing keys, refused modes, subject and path forms, values used twice."""
    out, seen = [], {}
    for name, d in registry.items():
        out += [(name, f"{k} is missing") for k in REQUIRED if not d.get(k)]
        if d.get("compatibility") not in MODES:
            out.append((name, f"mode {d.get('compatibility')} is refused"))
        if not str(d.get("subject", "")).endswith(("-value", "-key")):
            out.append((name, "subject isn't named after a topic"))
        if not str(d.get("delta_path", "")).startswith("s3a://"):
            out.append((name, "path isn't s3a://"))
        for k in ("subject", "schema", "delta_path"):
            if d.get(k) and (other := seen.setdefault((k, d[k]), name)) != name:
                out.append((name, f"{k} is also that of {other}"))
    return out
