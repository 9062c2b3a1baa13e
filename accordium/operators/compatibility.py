"""Compatibility of schemas over a table of histories: which earlier versions an offered schema breaks, and how.

Pairs of schemas are joined in Spark, equal pairs once; each is resolved in a task by the rules of Avro's specification. Nothing
is parsed on the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Modes a subject may have.
MODES = ("BACKWARD", "BACKWARD_TRANSITIVE", "FORWARD", "FORWARD_TRANSITIVE", "FULL", "FULL_TRANSITIVE")
#: Types without a name, and what each may be read as besides itself.
PRIMITIVES = {"null": (), "boolean": (), "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "double": (), "bytes": ("string",), "string": ("bytes",)}
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
FINDINGS = "problem string, place string"
#: Offered schemas are broadcast up to so many; beyond that Spark shuffles both sides.
BROADCAST_OFFERS = 10_000


class Schema:
    """A parsed schema: kind, and by kind its name, aliases, fields (name, type, whether it has a default, aliases), symbols, size,
    items, or branches. Named types may refer to themselves."""

    def __init__(self, kind: str, name: str = "", space: str = "", aliases: tuple[str, ...] = ()):
        self.kind, self.name, self.space = kind, name, space
        self.full = f"{space}.{name}" if space else name
        self.aliases = aliases
        self.fields: list[tuple[str, Schema, bool, tuple[str, ...]]] = []
        self.symbols: tuple[str, ...] = ()
        self.default = None
        self.size = 0
        self.inner: list[Schema] = []

    def called(self, other: Schema) -> bool:
        return self.name == other.name or other.full in self.aliases


def _full(name: str, space: str) -> str:
    return name if "." in name or not space else f"{space}.{name}"


def parsed(text: str) -> Schema:
    """The schema of a JSON text; ValueError says what is wrong with it."""
    named: dict[str, Schema] = {}

    def fits(value, schema: Schema) -> bool:
        """Whether a default is a value of a type; of a union, of its first branch."""
        k = schema.kind
        if k == "union":
            return fits(value, schema.inner[0])
        if k in ("int", "long"):
            return isinstance(value, int) and not isinstance(value, bool) and -(2 ** (31 if k == "int" else 63)) <= value < 2 ** (31 if k == "int" else 63)
        if k in ("float", "double"):
            return isinstance(value, int | float) and not isinstance(value, bool)
        if k == "array":
            return isinstance(value, list) and all(fits(v, schema.inner[0]) for v in value)
        if k == "map":
            return isinstance(value, dict) and all(fits(v, schema.inner[0]) for v in value.values())
        if k == "record":
            return isinstance(value, dict) and all(fits(value[n], t) if n in value else has for n, t, has, _ in schema.fields)
        return value is None if k == "null" else isinstance(value, bool) if k == "boolean" else isinstance(value, str)

    def read(node, space: str) -> Schema:
        if isinstance(node, str):
            if node in PRIMITIVES:
                return Schema(node)
            found = named.get(_full(node, space)) or named.get(node)
            if found is None:
                raise ValueError(f"type {node} isn't defined")
            return found
        if isinstance(node, list):
            out = Schema("union")
            out.inner = [read(x, space) for x in node]
            marks = [x.full or x.kind for x in out.inner]
            if not node or len(set(marks)) < len(marks) or any(x.kind == "union" for x in out.inner):
                raise ValueError("a union is empty, nested, or repeats a branch")
            return out
        if not isinstance(node, dict) or "type" not in node:
            raise ValueError("a type is missing")
        kind = node["type"]
        if isinstance(kind, dict | list) or kind in PRIMITIVES:
            return read(kind, space)
        if kind in ("array", "map"):
            inner = node.get("items" if kind == "array" else "values")
            if inner is None:
                raise ValueError(f"an {kind} says nothing of its members")
            out = Schema(kind)
            out.inner = [read(inner, space)]
            return out
        if kind not in ("record", "enum", "fixed", "error"):
            return read(kind, space)
        name = node.get("name")
        if not isinstance(name, str) or not all(map(NAME.fullmatch, name.split("."))):
            raise ValueError(f"a {kind} has no valid name")
        space, name = name.rsplit(".", 1) if "." in name else (node.get("namespace", space), name)
        out = Schema(kind, name, space, tuple(_full(a, space) for a in node.get("aliases", ())))
        if out.full in named:
            raise ValueError(f"{out.full} is defined twice")
        named[out.full] = out
        if kind == "fixed":
            out.size = node.get("size")
            if not isinstance(out.size, int) or out.size < 0:
                raise ValueError("a fixed type has no size")
        elif kind == "enum":
            out.symbols, out.default = tuple(node.get("symbols") or ()), node.get("default")
            if not all(isinstance(s, str) and NAME.fullmatch(s) for s in out.symbols) or len(set(out.symbols)) < len(out.symbols) or out.default is not None and out.default not in out.symbols:
                raise ValueError(f"symbols of {name} aren't names, are repeated, or lack the default")
        else:
            fields = node.get("fields")
            if not isinstance(fields, list):
                raise ValueError(f"{name} has no fields")
            for f in fields:
                if not isinstance(f, dict) or not isinstance(f.get("name"), str) or not NAME.fullmatch(f["name"]) or f["name"] in [x[0] for x in out.fields]:
                    raise ValueError(f"a field of {name} has no name, or one that is taken")
                if "type" not in f:
                    raise ValueError(f"field {f['name']} has no type")
                kind_of = read(f["type"], space)
                if "default" in f and not fits(f["default"], kind_of):
                    raise ValueError(f"the default of {f['name']} isn't of its type")
                out.fields.append((f["name"], kind_of, "default" in f, tuple(f.get("aliases", ()))))
        return out

    try:
        return read(json.loads(text), "")
    except (TypeError, AttributeError, RecursionError) as e:
        raise ValueError(str(e)) from e


def problems(reader: Schema, writer: Schema) -> list[tuple[str, str]]:
    """(problem, place) for all that keeps a reader from reading what a writer wrote; empty where it can."""
    open_: set[tuple[int, int]] = set()

    def walk(r: Schema, w: Schema, place: str) -> list[tuple[str, str]]:
        if (id(r), id(w)) in open_:  # a recursive type: judged where it began
            return []
        if w.kind == "union":
            return [x for branch in w.inner for x in walk(r, branch, place)]
        if r.kind == "union":
            return [] if any(not walk(branch, w, place) for branch in r.inner) else [("MISSING_BRANCH", place)]
        if r.kind != w.kind:
            return [] if r.kind in PRIMITIVES.get(w.kind, ()) else [("TYPE_MISMATCH", place)]
        if r.kind in ("array", "map"):
            return walk(r.inner[0], w.inner[0], place)
        if r.kind in PRIMITIVES:
            return []
        if not r.called(w):
            return [("NAME_MISMATCH", place)]
        if r.kind == "fixed":
            return [] if r.size == w.size else [("SIZE_MISMATCH", place)]
        if r.kind == "enum":
            return [("MISSING_SYMBOLS", place)] if r.default is None and set(w.symbols) - set(r.symbols) else []
        open_.add((id(r), id(w)))
        theirs, out = {n: t for n, t, _, _ in w.fields}, []
        for name, kind, has_default, aliases in r.fields:
            at = f"{place}.{name}" if place else name
            found = next((theirs[n] for n in (name, *aliases) if n in theirs), None)
            if found is not None:
                out += walk(kind, found, at)
            elif not has_default:
                out.append(("MISSING_DEFAULT", at))
        open_.discard((id(r), id(w)))
        return out

    return list(dict.fromkeys(walk(reader, writer, "")))


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(reader, writer) to (reader, writer, found): invalid texts are a finding of their own."""
    kind = pa.list_(pa.struct([("problem", pa.string()), ("place", pa.string())]))
    for batch in batches:
        found, seen = [], {}
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            schemas, wrong = [], []
            for text, who in zip(pair, ("READER", "WRITER"), strict=True):
                if text not in seen:
                    try:
                        seen[text] = parsed(text or "")
                    except ValueError as e:
                        seen[text] = str(e)
                if isinstance(seen[text], str):
                    wrong.append((f"INVALID_{who}", seen[text][:200]))
                schemas.append(seen[text])
            found.append([{"problem": p, "place": at} for p, at in wrong or problems(*schemas)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], names=["reader", "writer", "found"])


def resolve(pairs: DataFrame) -> DataFrame:
    """reader, writer, found (array of problem, place) for the distinct pairs of schema texts; empty arrays where all can be read."""
    distinct = pairs.select("reader", "writer").distinct()
    return distinct.mapInArrow(_resolved, f"reader string, writer string, found array<struct<{FINDINGS.replace(' string', ':string')}>>")


def incompatible(history: DataFrame, offered: DataFrame) -> DataFrame:
    """subject, version, direction, problem, place: what offered(subject, schema, mode) breaks in history(subject, version, schema).

    A transitive mode minds every version, a plain one the last. BACKWARD: the offered schema can't read what that version wrote;
    FORWARD: the other way round; FULL minds both. A subject without a history has nothing to break. A mode that isn't one of
    MODES is a finding BAD_MODE without a version or direction, an unreadable text INVALID_READER or INVALID_WRITER. A null subject
    is none; other columns are ignored. Subjects that are offered twice are judged for each offer.
    """
    offers = offered.where("subject is not null").select("subject", F.col("schema").alias("new"), F.upper("mode").alias("mode")).distinct()
    bad = offers.where(F.coalesce(~F.col("mode").isin(*MODES), F.lit(True))).select("subject", F.lit(None).cast(dict(history.dtypes)["version"]).alias("version"), F.lit(None).cast("string").alias("direction"), F.lit("BAD_MODE").alias("problem"), F.coalesce("mode", F.lit("")).alias("place"))
    last = history.groupBy("subject").agg(F.max("version").alias("last"))
    good = offers.where(F.col("mode").isin(*MODES)).join(last, "subject")
    few = F.broadcast(good) if good.count() <= BROADCAST_OFFERS else good
    minded = history.select("subject", "version", F.col("schema").alias("old")).join(few, "subject").where(F.col("mode").endswith("_TRANSITIVE") | (F.col("version") == F.col("last")))
    ways = F.array_compact(F.array(F.when(~F.col("mode").startswith("FORWARD"), F.lit("BACKWARD")), F.when(~F.col("mode").startswith("BACKWARD"), F.lit("FORWARD"))))
    each = minded.select("subject", "version", "new", "old", F.explode(ways).alias("direction"))
    back = F.col("direction") == "BACKWARD"
    pairs = each.select("subject", "version", "direction", F.coalesce(F.when(back, F.col("new")).otherwise(F.col("old")), F.lit("")).alias("reader"), F.coalesce(F.when(back, F.col("old")).otherwise(F.col("new")), F.lit("")).alias("writer"))
    found = pairs.join(resolve(pairs), ["reader", "writer"]).select("subject", "version", "direction", F.inline("found"))
    return found.unionByName(bad)


def verdicts(history: DataFrame, offered: DataFrame) -> DataFrame:
    """subject, mode, passed, problems (how many), versions (how many of them break) for each offer of a subject."""
    per = incompatible(history, offered).groupBy("subject").agg(F.count(F.lit(1)).alias("problems"), F.count_distinct("version").alias("versions"))
    return offered.where("subject is not null").select("subject", F.upper("mode").alias("mode")).distinct().join(per, "subject", "left").select("subject", "mode", F.col("problems").isNull().alias("passed"), F.coalesce("problems", F.lit(0)).alias("problems"), F.coalesce("versions", F.lit(0)).alias("versions"))
