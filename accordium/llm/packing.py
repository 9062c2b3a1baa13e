"""Best-fit packing with conflicts: no bin holds two pieces of one source, or two of one duplicate cluster.

Pieces are dealt by a hash into groups of about GROUP, which are packed each on its own, so that work is spread and bounded.
Within a group, longer pieces come first; open bins are kept in order of what room they have left, with a bitmap of their
sources and one of their clusters. The search starts at the least room that is enough and goes on from successor to successor
until a bin is compatible, so a piece is always put in the tightest one that is; else it opens a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, written
from .jaccard import ngram_jaccard

CAPACITY = 8192
GROUP = 4096
MOST_TASKS = 20_000


def pack_group(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset in it) of each piece, in the given order. A missing source or cluster is in conflict with nothing."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(c for c in clusters if c is not None))}
    order: list[tuple[int, int]] = []  # (room left, bin)
    held: list[tuple[int, int]] = []  # bitmaps of sources and clusters
    out = []
    for size, s, c in zip(sizes, (source_bit.get(x, 0) for x in sources), (cluster_bit.get(x, 0) for x in clusters), strict=True):
        at = bisect_left(order, (size, -1))
        while at < len(order) and (held[order[at][1]][0] & s or held[order[at][1]][1] & c):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
            held[b] = (held[b][0] | s, held[b][1] | c)
        else:
            room, b = capacity, len(held)
            held.append((s, c))
        out.append((b, capacity - room))
        insort(order, (room - size, b))
    return out


def best_fit(docs: DataFrame, size: Column | None = None, cluster: Column | None = None, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, size, bin_id, bin_offset; one row for each piece of each row of docs.

    docs needs doc_id, text and source; other columns are ignored, whatever their names. size is a document's length (bytes
    of UTF-8 by default), cluster its class of duplicates (a 64-bit hash of the text by default). A document longer than
    `capacity` is cut into full pieces, which have bins of their own, and a rest. A null or empty text is one piece of size 0.
    A null source is in conflict with no other. Repeated rows are packed each, in different bins, as copies are. Ties in
    size go by doc_id (null first), then by a hash of the text. An empty table gives an empty result.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) if size is None else F.coalesce(size, F.lit(0))
    cluster = F.xxhash64("text") if cluster is None else cluster
    return _packed(docs.select("doc_id", "source", size.cast("long").alias("n"), cluster.alias("cluster"), F.xxhash64("text").alias("print")), capacity, group)


def _packed(rows: DataFrame, capacity: int, group: int) -> DataFrame:
    """best_fit of rows (doc_id, source, n, cluster, print)."""
    if capacity < 1 or group < 1:
        raise ValueError("capacity and group must be positive")
    many = rows.agg(F.sum(F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)))).first()[0] or 0
    # equal rows are counted, then numbered, so that they are dealt to many groups
    rows = rows.groupBy("doc_id", "source", "n", "cluster", "print").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    cuts = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0)).cast("long"))
    pieces = rows.select("doc_id", "source", "cluster", "print", "copy", "n", F.explode(cuts).alias("piece"))
    pieces = pieces.select("doc_id", "source", "cluster", "print", "copy", "piece", (F.col("piece") * capacity).alias("start"), F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).cast("long").alias("size"))
    groups = max(1, -(-int(many) // group))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "print", "piece", "copy"), F.lit(groups)))
    dealt = dealt.repartition(min(groups, MOST_TASKS), "part")  # by number: the rows are few bytes, but costly
    kind = dict(rows.dtypes)["doc_id"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "print", "piece", "copy"], ascending=[False, True, True, True, True], na_position="first", kind="stable")
        sources, clusters = ([None if pd.isna(x) else x for x in pdf[c]] for c in ("source", "cluster"))
        found = pack_group(pdf["size"].tolist(), sources, clusters, capacity)
        return pdf[["doc_id", "piece", "start", "size"]].assign(bin_id=[(int(key[0]) << 32) + b for b, _ in found], bin_offset=[o for _, o in found])

    return dealt.groupBy("part").applyInPandas(run, f"doc_id {kind}, piece long, start long, size long, bin_id long, bin_offset long")


def best_fit_apart(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """best_fit with the components of ngram_jaccard as clusters, so that near copies are in conflict too.

    Rows are found again by a key of doc_id and text. Texts without words are in a cluster with equal ones only.
    """
    found = ngram_jaccard(docs.select(row_key().alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "n_shingles", "component_id").distinct()
    # texts stay where they are: only their lengths and hashes are joined
    rows = docs.select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n"), F.xxhash64("text").alias("print"), row_key().alias("key")).join(found, "key")
    cluster = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("print"))
    # counted, then packed: the texts are hashed and the components looked up once
    return _packed(written(rows.select("doc_id", "source", "n", cluster.alias("cluster"), "print"), "rows"), capacity, group)
