"""A Merkle manifest of a dataset: a tree of eight-fold nodes for each language, and one over their roots.

The log of a tree has its nodes in the order in which they are completed: leaves by key, each inner node right behind its last
child (postorder). Builders own aligned runs of 8**levels leaves, so that what one writes is a stretch of the log by itself: a table
row with its nodes in completion order. Where a node stands follows from sizes of subtrees alone (`positions`), and so siblings
are taken from the log by address; nothing but digests is shuffled. Above a builder's run the same is done with the runs' roots.

A digest is the sha256, in lowercase hex, of what it covers as text; in tables it is kept as 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FAN = 8
#: Levels of a builder's subtree: 4,096 leaves.
LEVELS = 4
#: Rows of bookkeeping (a tree in a partition, or a tree) are broadcast up to so many; beyond that Spark shuffles.
BROADCAST_ROWS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    h, n = 0, leaves
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def positions(level: int, index: np.ndarray, leaves: int, levels: int) -> np.ndarray:
    """Where nodes of a level stand in the log of a tree of so many leaves and levels.

    Before a node stand all that is completed when its last leaf is: every node of the levels below it up to that leaf, those
    before it on its own level, and those above it that end before that leaf.
    """
    index = np.asarray(index, np.int64)
    end = np.minimum((index + 1) * FAN**level, leaves)
    below = sum((-(-end // FAN**g) for g in range(level)), np.zeros_like(index))
    above = sum(((end - 1) // FAN**g for g in range(level + 1, levels + 1)), np.zeros_like(index))
    return below + index + above


def build(digests: list[bytes], levels: int) -> bytes:
    """The stretch of the log over some leaves, as hex text: nodes in completion order, up to so many levels above the leaves."""
    out: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(level: int, digest: bytes) -> None:
        out.append(digest)
        if level < levels:
            open_[level].append(digest)
            if len(open_[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        run, open_[level] = open_[level], []
        add(level + 1, hashlib.sha256(b"".join(run)).hexdigest().encode())

    for d in digests:
        add(0, d)
    for level in range(levels):  # the last runs are shorter
        if open_[level]:
            close(level)
    return b"".join(out)


def stretch(leaves: int, block: int, levels: int) -> tuple[int, int]:
    """Leaves of a builder in a tree with so many, and the levels that it adds: all of its own where other builders are there."""
    run = FAN**levels
    return min(run, leaves - block * run), levels if leaves > run else height(leaves)


def paths(log: bytes, n: int, levels: int) -> list[list[bytes]]:
    """For each of the n leaves of a stretch: what stands left and right of it and of its ancestors, level by level."""
    at = [positions(h, np.arange(-(-n // FAN**h)), n, levels) * 64 for h in range(levels + 1)]
    runs = [[b"".join(log[a : a + 64] for a in at[h][j : j + FAN].tolist()) for j in range(0, len(at[h]), FAN)] for h in range(levels)]
    out = []
    for i in range(n):
        path, k = [], i
        for h in range(levels):
            k, c = divmod(k, FAN)
            run = runs[h][k]
            path += [run[: 64 * c], run[64 * (c + 1) :]]
        out.append(path)
    return out


def fold(leaf: bytes, path: list[bytes]) -> bytes:
    """The root that a leaf and the siblings of its path give."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = hashlib.sha256(left + leaf + right).hexdigest().encode()
    return leaf


def field_text(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """32 bytes for a row: each value's length in bytes and the value, or `-` for a null, one behind the other."""
    return F.unhex(F.sha2(F.concat(*map(field_text, columns)), 256))


def lower_ascii(c: Column) -> Column:
    upper = "".join(chr(x) for x in range(65, 91))
    return F.translate(c, upper, upper.lower())


def _tree(lang: Column) -> Column:
    """A key of a language that is never null and sorts as languages do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("v"), lang.cast("string")), F.lit("n"))


def indexed(leaves: DataFrame) -> DataFrame:
    """leaves(tree, key, leaf, ...) with leaves (how many its tree has) and index (its place among them, by key, null first, then by
    leaf). One range shuffle of what is given; counts of partitions give each one's first index."""
    order = ("tree", "key", "leaf", "number")  # the number splits rows that are equal in all else over partitions
    dealt = leaves.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("number")
    placed = written(dealt.withColumn("at", F.monotonically_increasing_id()), "leaves").withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition of a tree
    starts = written(parts.select("tree", "part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("tree")).alias("leaves")), "starts")
    few = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    return placed.join(few, ["tree", "part"]).withColumn("index", F.col("base") + F.col("at") - F.col("low")).drop("part", "base", "low", "at")


def _built(key_type: pa.DataType, levels: int):
    def run(group: pa.Table) -> pa.Table:
        index = group.column("index").to_numpy()
        order = np.argsort(index)
        group = group.take(pa.array(order))
        leaves = group.column("leaves")[0].as_py()
        digests = [d.hex().encode() for d in group.column("leaf").to_pylist()]
        block = int(index[order[0]]) // FAN**levels
        log = build(digests, stretch(leaves, block, levels)[1])
        row = {"tree": group.column("tree")[:1].combine_chunks(), "block": pa.array([block], pa.int64()), "leaves": pa.array([leaves], pa.int64()), "log": pa.array([bytes.fromhex(log.decode())], pa.binary())}
        for name, kind in (("key", key_type), ("other", pa.binary())):
            row[name] = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), group.column(name).combine_chunks().cast(kind))
        return pa.table(row)

    return run


def _own_paths(r: dict, levels: int) -> list[list[bytes]]:
    """Paths of a stretch's leaves up to the root of all."""
    return [p + r["above"] for p in paths(r["log"].hex().encode(), *stretch(r["leaves"], r["block"], levels))]


def _extracted(levels: int):
    """(tree, block, leaves, log, above) to a row for each run below: tree, block, above."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, first = _own_paths(r, levels), r["block"] * FAN**levels
                yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * len(own), pa.string()), pa.array(range(first, first + len(own)), pa.int64()), pa.array(own, pa.list_(pa.binary()))], names=["tree", "block", "above"])

    return run


class Manifest:
    """The log of all trees: tiers[0] has the builders' stretches over leaves, tiers[1] those over their roots, and so on; trees
    has tree, subroot (32 bytes) and above (the siblings of that tree's root on the way to the dataset's), root the dataset's."""

    def __init__(self, leaves: DataFrame, levels: int = LEVELS, top: bool = True):
        self.levels, run = levels, FAN**levels
        self.key_type = leaves.schema["key"].dataType
        from pyspark.sql.pandas.types import to_arrow_type

        placed = indexed(leaves).withColumn("run", F.floor(F.col("index") / run))
        kind = self.key_type.simpleString()
        built = placed.groupBy("tree", "run").applyInArrow(_built(to_arrow_type(self.key_type), levels), f"tree string, block long, leaves long, log binary, key array<{kind}>, other array<binary>")
        self.tiers = [written(built, "log")]
        ends = F.substring("log", -32, 32)
        single = F.col("leaves") <= run
        subroots = self.tiers[0].where(single).select("tree", ends.alias("subroot"))
        most = self.tiers[0].agg(F.max("leaves")).first()[0] or 0
        while most > run:  # as many tiers as powers of a builder's run
            above = self.tiers[-1].where(~single).select("tree", F.lit(None).cast(self.key_type).alias("key"), ends.alias("leaf"), F.lit(None).cast("binary").alias("other"), F.col("block").alias("index"), F.ceil(F.col("leaves") / run).alias("leaves"))
            built = above.withColumn("run", F.floor(F.col("index") / run)).groupBy("tree", "run").applyInArrow(_built(to_arrow_type(self.key_type), levels), f"tree string, block long, leaves long, log binary, key array<{kind}>, other array<binary>")
            self.tiers.append(written(built.select("tree", "block", "leaves", "log"), "log"))
            subroots = subroots.union(self.tiers[-1].where(single).select("tree", ends.alias("subroot")))
            most = -(-most // run)
        self.root, self.few = None, None
        if not top:
            self.trees = subroots
            return
        over = Manifest(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("other")), levels, top=False)
        self.over = over
        found = over.trees.first()
        self.root = bytes(found.subroot) if found else None
        over.trees = over.trees.withColumn("above", F.array().cast("array<binary>"))
        own = over._with_paths(0).mapInArrow(_keyed_paths(levels), "tree string, above array<binary>")
        self.trees = written(subroots.join(own, "tree"), "trees")

    def _trees(self) -> DataFrame:
        if self.few is None:
            self.few = self.trees.count() <= BROADCAST_ROWS
        return F.broadcast(self.trees) if self.few else self.trees

    def _with_paths(self, tier: int) -> DataFrame:
        """A tier's stretches with the siblings above their own roots."""
        few, here = self._trees(), self.tiers[tier]
        done = here.where(F.col("leaves") <= FAN**self.levels).join(few.select("tree", "above"), "tree")
        if tier + 1 == len(self.tiers):
            return done
        below = self._with_paths(tier + 1).select("tree", "block", "leaves", "log", "above").mapInArrow(_extracted(self.levels), "tree string, block long, above array<binary>")
        return here.where(F.col("leaves") > FAN**self.levels).join(below, ["tree", "block"]).select(done.columns).unionByName(done)

    def members(self, run, schema: str) -> DataFrame:
        """What `run` makes of the stretches over leaves: rows of key, other, log, above, subroot."""
        few = self._trees()
        return self._with_paths(0).join(few.select("tree", "subroot"), "tree").mapInArrow(run, schema)

    def nodes(self) -> DataFrame:
        """tree, position, level, digest: the whole log of every language's tree, positions from 0."""
        levels = self.levels
        sizes = self.tiers[0].select("tree", F.col("leaves").alias("all")).distinct()
        out = None
        for t, tier in enumerate(self.tiers):

            def run(batches, t=t):
                for batch in batches:
                    for r in batch.to_pylist():
                        n, high = stretch(r["leaves"], r["block"], levels)
                        for h in range(0 if t == 0 else 1, high + 1):
                            local = np.arange(-(-n // FAN**h))
                            at = positions(h, local, n, high) * 32
                            index = r["block"] * FAN ** (levels - h) + local
                            digests = [r["log"][a : a + 32].hex() for a in at.tolist()]
                            where = positions(t * levels + h, index, r["all"], height(r["all"]))
                            yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * len(local), pa.string()), pa.array(where), pa.array([t * levels + h] * len(local), pa.int32()), pa.array(digests, pa.string())], names=["tree", "position", "level", "digest"])

            rows = tier.join(sizes, "tree").select("tree", "block", "leaves", "log", "all").mapInArrow(run, "tree string, position long, level int, digest string")
            out = rows if out is None else out.unionByName(rows)
        return out


def _keyed_paths(levels: int):
    """Keys of leaves as trees, with their siblings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.select(["block", "leaves", "log", "key", "above"]).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(r["key"], pa.string()), pa.array(_own_paths(r, levels), pa.list_(pa.binary()))], names=["tree", "above"])

    return run


def _verified(root: str, key_type: pa.DataType, levels: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key"))
            for i, r in enumerate(batch.select(["block", "leaves", "log", "other", "above", "subroot"]).to_pylist()):
                n, high = stretch(r["leaves"], r["block"], levels)
                log = r["log"].hex().encode()
                at = (positions(0, np.arange(n), n, high) * 64).tolist()
                leaves, proofs, roots = [], [], []
                for a, path, other in zip(at, _own_paths(r, levels), r["other"], strict=True):
                    leaf = log[a : a + 64]
                    leaves.append(leaf.decode())
                    proofs.append(hashlib.sha256(b"".join(path)).hexdigest())
                    roots.append(fold(leaf if other is None else other.hex().encode(), path).decode())
                same = [x == root for x in roots]
                subroot = r["subroot"].hex()
                yield pa.RecordBatch.from_arrays(
                    [keys[i].values.cast(key_type), pa.array(leaves, pa.string()), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(roots, pa.string()), pa.array(same, pa.bool_())],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return run


def manifest(docs: DataFrame, claimed: Column | None = None, fields: tuple[str, ...] = FIELDS, levels: int = LEVELS) -> Manifest:
    """The manifest of docs(doc_id, lang, and the other fields of a leaf). claimed: a column expression of a second leaf, kept beside."""
    other = F.lit(None).cast("binary") if claimed is None else claimed
    leaves = docs.select(_tree(F.col("lang")).alias("tree"), F.col("doc_id").alias("key"), leaf_digest(*map(F.col, fields)).alias("leaf"), other.alias("other"))
    return Manifest(written(leaves, "digests"), levels)  # texts are read once, not again for the ranges


def tampered_proofs(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs(doc_id, source, lang, n_chars, text).

    Where 3 divides the unsigned crc32 of the decimal doc_id, the text's A-Z are lower-cased before its leaf is folded again; a row
    whose text has none stays verified. A null doc_id comes first in its language and isn't tampered with; a null language is a
    tree of its own. Rows that repeat a doc_id are leaves of their own, by leaf; equal rows stand side by side. An empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    second = F.when(hit & F.col("text").isNotNull(), leaf_digest(*(lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS)))
    found = manifest(docs, second, levels=levels)
    kind = docs.schema["doc_id"].dataType
    run = _verified((found.root or b"").hex(), to_arrow_type(kind), levels)
    return found.members(run, f"doc_id {kind.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


#: Eight-fold levels by recursion; crc32 over the bits of an id's digits.
ORACLE = """with recursive d as (select doc_id, source, lang, n_chars, text, coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-') as head,
  list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: i::bigint)), lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)) as crc from documents),
 l as (select doc_id, coalesce('v' || lang, 'n') as tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf, case when xor(crc, 4294967295::bigint) % 3 = 0 then sha256(head || coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as other from d),
 i as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n from l),
 nodes as (select tree, 0 as level, i, leaf as digest, n from i union all select tree, level + 1, i // 8, sha256(string_agg(digest, '' order by i)), (any_value(n) + 7) // 8 from nodes where n > 1 group by tree, level, i // 8),
 subs as (select tree, digest as subroot, row_number() over (order by tree) - 1 as t, count(*) over () as n from nodes where n = 1),
 tops as (select 0 as level, t as i, subroot as digest, n from subs union all select level + 1, i // 8, sha256(string_agg(digest, '' order by i)), (any_value(n) + 7) // 8 from tops where n > 1 group by level, i // 8),
 steps as (select x.doc_id, x.leaf, x.other, x.tree, y.level, coalesce(string_agg(y.digest, '' order by y.i) filter (y.i < x.i // cast(pow(8, y.level) as bigint)), '') as a, coalesce(string_agg(y.digest, '' order by y.i) filter (y.i > x.i // cast(pow(8, y.level) as bigint)), '') as b
   from i x join nodes y on x.tree = y.tree and y.n > 1 and y.i // 8 = x.i // cast(pow(8, y.level + 1) as bigint) group by all),
 above as (select x.tree, 1000 + y.level as level, coalesce(string_agg(y.digest, '' order by y.i) filter (y.i < x.t // cast(pow(8, y.level) as bigint)), '') as a, coalesce(string_agg(y.digest, '' order by y.i) filter (y.i > x.t // cast(pow(8, y.level) as bigint)), '') as b
   from subs x join tops y on y.n > 1 and y.i // 8 = x.t // cast(pow(8, y.level + 1) as bigint) group by all),
 p as (select doc_id, leaf, list({'a': a, 'b': b} order by level) as path from (select doc_id, leaf, level, a, b from steps union all select x.doc_id, x.leaf, y.level, y.a, y.b from i x join above y on x.tree = y.tree) group by doc_id, leaf)
select i.doc_id, i.leaf, subroot, r.digest as root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.a || x.b), ''), '')) as proof_sha256,
 coalesce(list_reduce(list_prepend({'a': coalesce(other, i.leaf), 'b': ''}, path), lambda x, y: {'a': sha256(y.a || x.a || y.b), 'b': ''}).a, coalesce(other, i.leaf)) as folded_root, folded_root = r.digest as verified
from i join subs using (tree) join tops r on r.n = 1 left join p on p.doc_id = i.doc_id and p.leaf = i.leaf"""
