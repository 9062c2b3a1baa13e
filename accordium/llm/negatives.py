"""Hard negatives: for each anchor and each of its positives the best rows of other labels whose score is just below the positive's.

A threshold join over blocks of rows, after L2AP. Chunks of anchors, bounded in rows and bytes, meet all rows. A block's dimensions
are ordered by weight; a row is entered in the lists of its leading dimensions only, as far as the norm of what follows could
still lift its score to the least threshold of the chunk. Partial scores are added up list by list, and a pair goes as soon as
its partial score and the product of the remaining norms stay below the anchor's threshold. What is left is scored exactly.
Thresholds start high and are lowered for the windows that aren't full yet; a window is full once five rows reach its threshold,
so that no row below it could belong to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Anchors of a chunk, in rows and in bytes of their vectors.
CHUNK_ROWS, CHUNK_BYTES = 16_384, 32_000_000
#: Anchors and rows that are scored together.
ANCHORS, ROWS = 64, 8_192
#: Dimensions of one list.
DIMENSIONS = 8
#: Thresholds of positives, as shares of the greatest score that the norms allow; then none.
POSITIVE = (0.7, 0.4, 0.2)
#: Thresholds of negatives, as shares of the positive's score; then the window's own end.
NEGATIVE = (0.95,)
LOWEST = -(2**62)


@dataclass
class Chunk:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


@dataclass
class Windows:
    """For each anchor up to k windows: scores from low to high, rows of the anchor's own label or of others. An anchor without
    open windows has high below low."""

    same: bool
    low: np.ndarray
    high: np.ndarray


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as a matrix of float64 or, where sums could pass 2**53, of whole numbers; missing ends are 0."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Block:
    """The lists of some rows for one chunk and its least threshold."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, least: float):
        """least: what the norm of a row's part must reach to lift any anchor to its threshold by itself."""
        weight = np.argsort(-np.square(vectors, dtype=np.float64).sum(0), kind="stable")
        squares = np.square(vectors[:, weight], dtype=np.float64)
        self.order = weight
        starts = np.arange(0, vectors.shape[1], DIMENSIONS)
        # norms of what follows each list's beginning, and none behind the last
        self.rest = np.sqrt(np.concatenate([np.cumsum(np.add.reduceat(squares, starts, axis=1)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(ids), 1))], axis=1))
        entered = (self.rest[:, :-1] * (1 + 1e-9) >= least).sum(1)  # norms fall, so these are the leading lists
        by = np.argsort(-entered, kind="stable")  # a list is then a first part of the rows
        self.ids, self.labels, self.rest = ids[by], labels[by], self.rest[by]
        self.vectors = vectors[by][:, weight]
        self.lists = [(a, int((entered > k).sum())) for k, a in enumerate(starts.tolist())]

    def pairs(self, chunk: Chunk, which: np.ndarray, low: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors (of `which`), rows and exact scores of the pairs that reach the anchor's `low`."""
        q = chunk.vectors[which][:, self.order]
        starts = [a for a, _ in self.lists]
        q_rest = np.sqrt(np.concatenate([np.cumsum(np.add.reduceat(np.square(q, dtype=np.float64), starts, axis=1)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(which), 1))], axis=1))
        floor = low - 1e-9 * np.abs(low) - 0.5
        score = np.zeros((len(which), len(self.ids)), q.dtype)
        alive = (chunk.labels[which][:, None] == self.labels[None, :]) == same
        alive &= chunk.ids[which][:, None] != self.ids[None, :]
        alive[:, self.lists[0][1] :] = False  # rows in no list can't reach any threshold
        a = None
        for k, (begin, upto) in enumerate(self.lists):
            end = begin + DIMENSIONS
            if a is None:  # rows that left the lists keep the bound they had then, which counts all that follows
                score[:, :upto] += q[:, begin:end] @ self.vectors[:upto, begin:end].T
                alive[:, :upto] &= score[:, :upto] + q_rest[:, k + 1][:, None] * self.rest[None, :upto, k + 1] >= floor[:, None]
                if np.count_nonzero(alive) <= alive.size // 8:
                    a, r = np.nonzero(alive)
                    partial = score[a, r]
                    late = r >= upto
                    partial[late] = (q[a[late], :end] * self.vectors[r[late], :end]).sum(1)
            else:
                partial = partial + (q[a, begin:end] * self.vectors[r, begin:end]).sum(1)
                left = partial + q_rest[a, k + 1] * self.rest[r, k + 1] >= floor[a]
                a, r, partial = a[left], r[left], partial[left]
        if a is None:
            for begin, upto in self.lists:
                score[:, upto:] += q[:, begin : begin + DIMENSIONS] @ self.vectors[upto:, begin : begin + DIMENSIONS].T
            a, r = np.nonzero(alive)
            partial = score[a, r]
        left = partial >= low[a]
        return a[left], r[left], partial[left]


def _best(slot: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each slot: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, slot))
    s = slot[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    place = np.arange(len(s)) - np.maximum.accumulate(np.where(first, np.arange(len(s)), 0)) if len(s) else np.zeros(0, np.int64)
    return order[place < k]


def _joined(shared, windows_of, k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The join of a chunk with all rows, as a map over batches: the k best of each window among a task's rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, windows = shared.value, windows_of.value
        low = windows.low.min(1)
        open_ = np.flatnonzero((windows.high >= windows.low).any(1))
        norms = np.sqrt(np.square(chunk.vectors, dtype=np.float64).sum(1))
        ratio = np.where(norms[open_] > 0, (low[open_] - 0.5) / np.maximum(norms[open_], 1e-300), np.where(low[open_] > 0, np.inf, -np.inf))
        least = float(ratio.min()) if len(open_) else np.inf
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            whole = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label", "vector")]
            for at in range(0, batch.num_rows, ROWS):
                ids, labels, vectors = (c.slice(at, ROWS) for c in whole)
                width = chunk.vectors.shape[1]
                block = Block(ids.to_numpy(), labels.to_numpy(), _matrix(vectors, width).astype(chunk.vectors.dtype), least)
                for b in range(0, len(open_), ANCHORS):
                    which = open_[b : b + ANCHORS]
                    a, r, score = block.pairs(chunk, which, low[which], windows.same)
                    score = score.astype(np.int64)
                    for w in range(windows.low.shape[1]):
                        fits = np.flatnonzero((score >= windows.low[which[a], w]) & (score <= windows.high[which[a], w]))
                        slot = which[a[fits]] * windows.low.shape[1] + w
                        best = fits[_best(slot, score[fits], block.ids[r[fits]], k)]
                        held = [np.concatenate([x, y]) for x, y in zip(held, (which[a[best]] * windows.low.shape[1] + w, score[best], block.ids[r[best]]), strict=True)]
            if len(held[0]) > 8 * k * windows.low.size // 2 + 10_000:
                best = _best(*held, k)
                held = [x[best] for x in held]
        best = _best(*held, k)
        yield pa.RecordBatch.from_arrays([pa.array(x[best], pa.int64()) for x in held], names=["slot", "score", "vec_id"])

    return run


def _round(rows: DataFrame, shared, windows: Windows, k: int, last: bool) -> tuple[DataFrame, np.ndarray]:
    """slot, rank, score, vec_id of the windows that are full at their threshold (all of them in the last round), and their slots.
    Both are bounded by the chunk."""
    spark = rows.sparkSession
    given = spark.sparkContext.broadcast(windows)
    found = rows.mapInArrow(_joined(shared, given, k), "slot long, score long, vec_id long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    top = written(ranked, "windows")
    full = top.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where(F.lit(last) | (F.col("n") >= k)).select("slot")
    slots = full.toArrow().column("slot").to_numpy()
    given.unpersist()
    return top.join(F.broadcast(full), "slot"), slots


def _filled(rows: DataFrame, shared, bounds: list[np.ndarray], high: np.ndarray, same: bool, k: int) -> DataFrame:
    """The k best of each window, with one threshold after the other (bounds, falling; the last is the windows' own end)."""
    out, open_ = None, high >= bounds[-1]
    for i, low in enumerate(bounds):
        if out is not None and not open_.any():
            break
        windows = Windows(same, np.where(open_, low, 2**62), np.where(open_, high, LOWEST))
        top, slots = _round(rows, shared, windows, k, i == len(bounds) - 1)
        out = top if out is None else out.unionByName(top)
        open_ = open_.copy()
        open_.flat[slots] = False
    return out


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows are (vec_id long, label, vector array<long>), without nulls; `anchor` says which of them are anchors. A score is the inner
    product; missing ends of shorter vectors count as 0. An anchor's positives are its best other rows of the same label, its
    negatives for a positive of score p the best rows of other labels with low * p <= 100 * score <= high * p. Ties go to the
    smaller vec_id; fewer rows are returned where there are no more. Rows that share an anchor's vec_id are never its partners;
    anchors that repeat an id are mined each. Scores beyond 64 bits are an error.
    """
    spark = rows.sparkSession
    rows = written(rows.select("vec_id", F.col("label").cast("long").alias("label"), "vector"), "rows")
    stats = rows.agg(F.max(F.size("vector")).alias("width"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("most"), F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("norm")).first()
    width, greatest = max(1, stats["width"] or 0), int(stats["most"] or 0)
    if width * greatest * greatest >= 2**62:
        raise OverflowError("scores don't fit in 64 bits")
    kind = np.float64 if width * greatest * greatest < 2**53 else np.int64
    anchors = rows.where(anchor)
    per = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (8 * width)))
    chunks = max(1, -(-anchors.count() // per))
    dealt = written(anchors.repartition(chunks).withColumn("chunk", F.spark_partition_id()), "anchors")
    out = None
    for c in range(chunks):
        held = dealt.where(F.col("chunk") == c).select("vec_id", "label", "vector").toArrow().combine_chunks()  # `per` rows
        if not held.num_rows and out is not None:
            continue
        columns = [held.column(n).combine_chunks() for n in ("vec_id", "label", "vector")]
        vectors = _matrix(columns[2], width).astype(kind)
        chunk = Chunk(columns[0].to_numpy(), columns[1].to_numpy(), vectors)
        shared = spark.sparkContext.broadcast(chunk)
        reach = np.sqrt(np.square(vectors, dtype=np.float64).sum(1)) * float(stats["norm"] or 0)
        bounds = [np.ceil(reach * share).astype(np.int64)[:, None] for share in POSITIVE] + [np.full((len(vectors), 1), LOWEST)]
        best = written(_filled(rows, shared, bounds, np.full((len(vectors), 1), 2**62), True, positives), "positives")
        table = best.select("slot", "rank", "score").toArrow()  # positives x the chunk's anchors at most
        p = np.full((len(vectors), positives), LOWEST)
        p[table.column("slot").to_numpy(), table.column("rank").to_numpy() - 1] = table.column("score").to_numpy()
        there = p > LOWEST
        same = np.zeros_like(there)  # equal scores of an anchor share a window
        same[:, 1:] = p[:, 1:] == p[:, :-1]
        ask = there & ~same
        safe = np.where(there, p, 0)
        whole, part = np.divmod(safe, 100)  # apart, as 100 * p may not fit
        end = np.where(ask, low * whole - (-(low * part) // 100), 2**62)  # 100 * score >= low * p
        top = np.where(ask, high * whole + high * part // 100, LOWEST)
        bounds = [np.maximum(end, np.ceil(share * top).astype(np.int64)) for share in NEGATIVE] + [end]
        bounds = [np.where(ask, b, 2**62) for b in bounds]
        found = _filled(rows, shared, bounds, top, False, negatives)
        names = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(len(vectors)), pa.int64()), "anchor_id": columns[0]}))
        pos = best.select(F.col("slot").alias("anchor"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        windows = spark.createDataFrame(pa.table({"slot": pa.array(np.flatnonzero(ask), pa.int64()), "anchor": pa.array(np.flatnonzero(ask) // positives, pa.int64()), "positive_score": pa.array(p[ask], pa.int64())}))
        neg = found.select("slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(F.broadcast(windows), "slot")
        one = written(pos.join(neg, ["anchor", "positive_score"]).join(F.broadcast(names), "anchor").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")
        shared.unpersist()
        out = one if out is None else out.unionByName(one)
    return out


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector: rows with an id, a label and whole vectors; every seventh id has the next label; components are
    floor(256 * x). An embedding without components takes part: its scores are 0."""
    x = F.col("embedding")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(x, lambda c: F.floor(256 * c.cast("double"))).alias("vector"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The query over embeddings(vec_id, embedding, label): anchors are the rows whose vec_id 100 divides. Rows with a null id, label,
    vector or component, or one that isn't finite, take no part; other columns are ignored; an empty table gives no rows."""
    return mine(prepared(embeddings.select("vec_id", "embedding", "label")), F.col("vec_id") % 100 == 0)


ORACLE = """with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
 s as (select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other, cast(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) as bigint) as score from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
 p as (select anchor_id, other as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, other) as integer) as rank, other as negative_id, positive_score, score as negative_score
 from p join s using (anchor_id) where not same and 80 * positive_score <= 100 * score and score <= positive_score qualify rank <= 5"""
