"""N-gram Jaccard join: a grouped prefix join over the documents' sets of word shingles.

1. Each text becomes a set of 64-bit shingle keys; documents with equal sets are one class.
2. A class can only be linked if at most a quarter of its shingles is its own. Over a fixed share of the key space, the same
   for all, that count is exact for the share and a lower bound for the whole, so it rules most classes out for good.
3. Of the classes left, all shingles are counted and ordered by rarity. A class's prefix is its first n - ceil(t n) + 1
   shingles: linked classes share one of them. Classes with the same prefix and size are one group.
4. Groups that meet in a prefix shingle are filtered by size and by position. First each bucket's members are held against
   one hub and the links found become components; then every pair of members of different components is verified, so no
   link that matters to a component is lost, while a bucket of near copies isn't expanded into all its pairs. Groups that
   meet in many shingles are paired in the first: where one of the shingles just before is common as well, a pair is left
   to that one, and the first common shingle has none before it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import discard, lean, offsets, slices_of, words_of, written
from .graph import components

#: Of eight parts of the key space, so many take part in the first step.
SHARE = 3
#: Keys that are held against each other in one group, about.
PART = 1_000_000
#: Ids of classes are broadcast up to so many (8 bytes each); beyond that Spark shuffles both sides.
BROADCAST_IDS = 2_000_000
#: Where groups meet in a shingle, so many that precede it in either prefix are looked through for an earlier meeting.
LOOK_BACK = 32


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle keys of each text."""
    names, of, counts = words_of(texts)
    hashes = np.fromiter(map(xxh3_64_intdigest, names), np.uint64, len(names)).take(of)
    # keys of all places; those of a text with fewer words than a shingle has are made apart
    key = np.full(max(0, len(hashes) - width + 1), width, np.uint64)
    for j in range(width):
        key = (key ^ hashes[j : j + len(key)]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    ends = np.cumsum(counts).tolist()
    for n, end in zip(counts.tolist(), ends, strict=True):
        own = key[end - n : max(end - n, end - width + 1)]
        if 0 < n < width:
            own = np.full(1, n, np.uint64)
            for h in hashes[end - n : end]:
                own = (own ^ h) * np.uint64(0x9E3779B97F4A7C15)
                own ^= own >> np.uint64(29)
        yield np.unique(own).view(np.int64)


def class_of(keys: np.ndarray) -> int | None:
    return (struct.unpack("<q", blake2b(keys.tobytes(), digest_size=8).digest())[0] or 1) if len(keys) else None  # 0 stands for several


def _list(arrays: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets([len(a) for a in arrays]).astype(np.int32)), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def _sets(width: int, only: bool, share: int):
    """only: the rows of wanted classes (a column tells), with all their keys; else every row, with the shared part of its keys."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b in slices_of(texts):
                sets = list(shingle_sets(texts.slice(a, b - a), width))
                cols = [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _list(sets if only else [s[(s & 7) < share] for s in sets])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *cols], names=["doc_id", "cls", "n", "keys"])

    return run


def _parted(parts: int):
    """For each part of the key space a row of this batch's keys, each once, with its class; 0 where two classes have it."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            keys = lists.flatten().to_numpy().view(np.uint64)
            cls = np.repeat(batch.column(0).to_numpy(), pc.list_value_length(lists).to_numpy())
            order = np.argsort(keys)
            keys, cls = keys[order], cls[order]
            if not len(keys):
                continue
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            one = np.where(np.minimum.reduceat(cls, first) == np.maximum.reduceat(cls, first), cls[first], 0)
            keys = keys[first]
            part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # ascending, as the keys are
            edges = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(np.diff(edges))
            # within a part 32 bits tell keys apart well enough: two that look alike only make a class's own keys fewer
            columns = [pa.array([v[edges[p] : edges[p + 1]].tobytes() for p in some], pa.binary()) for v in (keys.astype(np.uint32), one)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *columns], names=["part", "keys", "cls"])

    return run


def _own(rows: pa.Table) -> pa.Table:
    """cls of each key of this part that only one class has."""
    keys, cls = (np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in (("keys", np.uint32), ("cls", np.int64)))
    order = np.argsort(keys)
    keys, cls = keys[order], cls[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    low, high = np.minimum.reduceat(cls, first), np.maximum.reduceat(cls, first)
    return pa.table({"cls": low[(low == high) & (low != 0)]})


def _spare(n, percent: int):
    """So many of n shingles may be missing in a linked set."""
    return n - F.ceil(F.lit(percent) * n / 100)


def _may_link(percent: int):
    """Whether groups x and y that meet in a shingle can be linked: by their sizes, and by what can be common in front of it
    (no shingle of one's own) and from it on."""
    most = F.least(F.col("n_x") - F.col("own_x") - F.col("at_x"), F.col("n_y") - F.col("own_y") - F.col("at_y")) + F.least("at_x", "at_y")
    return (F.lit(100) * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & (100 * most >= percent * (F.col("n_x") + F.col("n_y") - most))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets are similar enough."""
    a, b = sets.select(F.col("cls").alias("a"), F.col("keys").alias("ka")), sets.select(F.col("cls").alias("b"), F.col("keys").alias("kb"))
    both = F.size(F.array_intersect("ka", "kb"))
    return pairs.join(a, "a").join(b, "b").where(100 * both >= percent * (F.size("ka") + F.size("kb") - both)).select("a", "b")


def _linked(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the classes that have links."""
    rows = sets.select("cls", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = rows.join(counts, "key").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("shared"))
    own = F.col("n") - F.size("shared")  # shingles that no other class has come first of all
    length = F.greatest(_spare(F.col("n"), percent) + 1 - own, F.lit(0)).cast("int")
    prefixes = sets.select("cls", "n").join(shared, "cls").select("cls", "n", own.alias("own"), F.slice("shared", F.lit(1), length).alias("prefix")).where(F.size("prefix") > 0)
    members = written(prefixes.withColumn("group", F.xxhash64("n", "own", "prefix")), "prefixes")
    groups = members.groupBy("group").agg(F.min("cls").alias("head"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("prefix").alias("prefix"))
    heads = groups.select("group", "head")
    tokens = written(groups.select("group", "head", "n", "own", F.posexplode("prefix").alias("at", "p")).select("group", "head", "n", "own", F.col("p.key").alias("key"), "at"), "tokens")

    # A hub for each bucket, the one with the fewest shingles of its own, and each group's head for its members.
    hubs = tokens.groupBy("key").agg(F.min(F.struct("own", "head", "n", "at")).alias("h"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", *(F.col(f"h.{c}").alias(f"{c}_x") for c in ("head", "n", "own", "at")))
    first = tokens.select("key", *(F.col(c).alias(f"{c}_y") for c in ("head", "n", "own", "at"))).join(hubs, "key").where(F.col("head_x") != F.col("head_y")).where(_may_link(percent)).select(F.col("head_x").alias("a"), F.col("head_y").alias("b"))
    first = first.union(members.join(heads, "group").where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))).distinct()
    edges = written(_verified(first, sets, percent), "links")
    found = written(components(edges), "components")

    # Whatever meets in a bucket and isn't in one component yet: filtered as groups, then expanded and verified.
    placed = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "group", F.coalesce("root", "cls").alias("root"))
    spread = placed.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    met = tokens.join(spread, "group")
    open_keys = met.groupBy("key").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("key")
    before = F.slice("prefix.key", F.greatest(F.col("at") + 1 - LOOK_BACK, F.lit(1)), F.least("at", F.lit(LOOK_BACK)))
    columns = ("group", "n", "own", "at", "low", "high", "before")
    met = met.join(open_keys, "key").join(groups.select("group", "prefix"), "group").withColumn("before", before)
    x, y = (met.select("key", *(F.col(c).alias(f"{c}_{s}") for c in columns)) for s in "xy")
    pairs = x.join(y, "key").where((F.col("group_x") <= F.col("group_y")) & ((F.col("low_x") != F.col("low_y")) | (F.col("high_x") != F.col("high_y")) | (F.col("low_x") != F.col("high_x"))) & _may_link(percent) & ~F.arrays_overlap("before_x", "before_y")).select("group_x", "group_y").distinct()
    left, right = (placed.select(F.col("group").alias(f"group_{s}"), F.col("cls").alias(c), F.col("root").alias(f"root_{s}")) for s, c in (("x", "a"), ("y", "b")))
    rest = pairs.join(left, "group_x").join(right, "group_y").where("root_x <> root_y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = written(_verified(rest, sets, percent), "links")
    if more.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def ngram_jaccard(docs: DataFrame, width: int = 5, percent: int = 75, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """doc_id, n_shingles, component_id; one row for each row of docs.

    docs needs doc_id and text; other columns are ignored, whatever their names. Texts with fewer than `width` words are one
    shingle, all their words; a null text, or one without words, has none and is linked with nothing, so its component is its
    own doc_id. Rows that repeat a doc_id are documents of their own; equal texts are always in one component. A component of
    which all ids are null has null. An empty table gives an empty result. Shingles and sets are compared by 64-bit hashes.
    """
    docs = docs.select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, cls long, n long, keys array<long>"
    sets = written(docs.mapInArrow(_sets(width, False, SHARE), schema), "sets")
    base = written(sets.select("doc_id", "cls", "n"), "classes")
    classes = base.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("doc_id").alias("ids"))
    many = sets.agg(F.sum(F.size("keys"))).first()[0] or 0
    parted = sets.where("n > 0").select("cls", "keys").mapInArrow(_parted(max(1, -(-int(many) // PART))), "part long, keys binary, cls binary")
    own = parted.groupBy("part").applyInArrow(_own, "cls long").groupBy("cls").agg(F.count(F.lit(1)).alias("own"))
    left = written(classes.join(own, "cls", "left").where(F.coalesce("own", F.lit(0)) <= _spare(F.col("n"), percent)).select("cls", "doc_id"), "left")
    discard(sets)
    count = left.count()
    wanted = left.select("doc_id").where("doc_id is not null").distinct()
    chosen = docs.join(F.broadcast(wanted) if count <= broadcast_ids else wanted, "doc_id", "left_semi")
    if not left.where("doc_id is null").isEmpty():
        chosen = chosen.union(docs.where("doc_id is null"))
    sets = chosen.mapInArrow(_sets(width, True, SHARE), schema).select("cls", "n", "keys")
    # a repeated id can bring other rows of a class, or classes that are ruled out
    sets = written(sets.join(left.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("keys").alias("keys")), "sets")
    roots = _linked(sets, percent)
    placed = classes.select("cls", "doc_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_class = placed.select("cls", "root").join(least, "root").select("cls", "component_id")
    out = base.select("doc_id", "n", "cls").join(by_class, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
