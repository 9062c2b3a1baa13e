"""Benchmark decontamination: a prefix-filtered set join over item-sized windows.

Each item is cut into windows of `size` consecutive words (an item with fewer words is one window). A window is a set of
short word shingles. For containment of the whole window one shingle is a sufficient prefix, so the window is indexed under
its rarest shingle only, rarity being the shingle's count over all documents. Documents give a candidate row for each place
whose shingle may be such a prefix (a bitmap of fixed size of the prefixes is tested first); Spark joins them with the index on the shingle,
drops those whose window would start before the first word or end after the last (positional and length bounds), and
compares the words themselves, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS, lean, offsets, sliced_texts, texts_of, written

BITS = 22
SHINGLE = 3
#: Rows of item shingles that a task holds at a time, about.
SLICE_ROWS = 50_000
#: The window index is broadcast up to so many windows (about 100 bytes each); beyond that Spark shuffles both sides.
BROADCAST_WINDOWS = 100_000
#: Spreads small numbers, up to 3 billion of them within 63 bits.
SPREAD = 0x9E3779B9


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS).split() if text else []


def shingle_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key for each k consecutive words; equal words, equal keys."""
    n = max(0, len(hashes) - k + 1)
    key = np.full(n, k, np.uint64)
    for i in range(k):
        key = (key ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def _item_shingles(size: int, most: int = SLICE_ROWS):
    names, types = ("item_id", "gram", "len", "k", "at", "key"), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        out: list[tuple] = []
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                words = split_words(text)
                length = min(size, len(words))
                k = min(SHINGLE, length)
                keys = shingle_keys(hashed(words), k).view(np.int64).tolist() if k else []
                for start in range(len(words) - length + 1 if words else 0):
                    gram = b" ".join(words[start : start + length]).decode()
                    out += [(item, gram, length, k, at, keys[start + at]) for at in range(length - k + 1)]
                    if len(out) >= most:
                        yield table(out)
                        out = []
        if out:
            yield table(out)

    return run


def _bitmap(keys: DataFrame) -> tuple[np.ndarray, list[int]]:
    """2^BITS bits, whatever the number of keys, and the shingle lengths in use (three at most)."""
    slots = keys.select("k", F.shiftrightunsigned("key", 64 - BITS).alias("slot"))
    rows = slots.groupBy(F.shiftright("slot", 5).alias("word"), "k").agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int))) as bits")).collect()
    words = np.zeros(1 << (BITS - 5), np.uint32)
    for r in rows:
        words[r.word] |= np.uint32(r.bits)
    return words, sorted({r.k for r in rows})


def _places(words: list[bytes], counts: list[int], bitmap: np.ndarray, ks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions whose shingle may be indexed, and the shingles' keys; shingles don't reach over the end of a text."""
    hashes = hashed(words)
    ends = np.repeat(offsets(counts)[1:], counts)
    for k in ks:
        key = shingle_keys(hashes, k)
        slot = (key >> np.uint64(64 - BITS)).astype(np.int64)
        at = np.flatnonzero((bitmap[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1)
        at = at[at + k <= ends[at]]
        yield at, key[at].view(np.int64)


def _count(bitmap, ks):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, lengths = bitmap.value, ks
        for batch in batches:
            for _, _, texts in sliced_texts(batch):
                split = [split_words(t) for t in texts]
                words, counts = [w for s in split for w in s], [len(s) for s in split]
                for _, keys in _places(words, counts, bits, lengths):
                    found, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["key", "n"])

    return run


def _candidates(bitmap, ks, reach: int):
    """One row for each text with its number of words, and one for each candidate place with the words around it."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            ids, prints = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, _, texts in sliced_texts(batch):
                split = [split_words(t) for t in texts]
                words, counts = [w for s in split for w in s], [len(s) for s in split]
                starts = offsets(counts)
                # a text's own row matches no window; its key only spreads such rows over the join's tasks
                out = [(ids[a + i], prints[a + i], n, 1, (a + i) * SPREAD, None, None, None) for i, n in enumerate(counts)]
                for at, keys in _places(words, counts, bits, ks):
                    docs = np.searchsorted(starts, at, side="right") - 1
                    for p, key, d in zip(at.tolist(), keys.tolist(), docs.tolist(), strict=True):
                        own = p - int(starts[d])
                        low = max(0, own - reach)
                        base = int(starts[d])
                        around = b" ".join(words[base + low : min(base + own + reach + 1, int(starts[d + 1]))]).decode()
                        out.append((ids[a + d], prints[a + d], counts[d], 0, key, own, low, around))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (batch.schema.types[0], pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "print", "n_words", "base", "key", "at", "low", "around"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; one row for each row of docs.

    docs needs doc_id and text, benchmark item_id and text; other columns are ignored, whatever their names. A null or empty
    text has no words, so it is never hit; an item without words has no window. Rows that repeat a doc_id are judged each by
    its own text; equal rows give equal results. An item with a null id marks words, but isn't counted or listed. With an
    empty benchmark nothing is hit; with no documents the result is empty.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    shingles = written(items.mapInArrow(_item_shingles(size), "item_id string, gram string, len int, k int, at int, key long"), "shingles")
    bits, ks = _bitmap(shingles)
    bitmap = spark.sparkContext.broadcast(bits)
    seen = docs.select("text").mapInArrow(_count(bitmap, ks), "key long, n long").groupBy("key").agg(F.sum("n").alias("seen"))
    # The rarest shingle of each window is its prefix.
    index = (
        shingles.select("gram", "len", "k", "at", "key").distinct().join(seen, "key", "left")
        .groupBy("gram").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "key", "at", "len", "k")).alias("p"))
        .select("gram", F.col("p.key").alias("key"), F.col("p.at").alias("shift"), F.col("p.len").alias("len"), F.col("p.k").alias("k"), F.split("gram", " ").alias("want"))
    )
    owners = shingles.select("gram", "item_id").distinct()
    index = written(index.join(owners, "gram").select("key", "shift", "len", "k", "want", "item_id"), "windows")
    bits, ks = _bitmap(index)  # only prefixes from here on
    bitmap = spark.sparkContext.broadcast(bits)
    index = index.select(F.col("key").alias("prefix"), "shift", "len", "want", "item_id")
    if index.count() <= broadcast_windows:
        index = F.broadcast(index)
    rows = docs.mapInArrow(_candidates(bitmap, ks, size - 1), f"doc_id {dict(docs.dtypes)['doc_id']}, print long, n_words long, base long, key long, at long, low long, around string")
    start = F.col("at") - F.col("shift")
    met = rows.join(index, (F.col("key") == F.col("prefix")) & (F.col("base") == 0), "left").where((F.col("base") == 1) | ((start >= 0) & (start + F.col("len") <= F.col("n_words")) & (F.slice(F.split("around", " "), (start - F.col("low") + 1).cast("int"), F.col("len")) == F.col("want"))))
    hit = F.col("base") == 0
    by = met.groupBy("doc_id", "print").agg(F.sum("base").alias("rows"), F.max("n_words").alias("n_words"), F.collect_set(F.when(hit, F.struct(start.alias("a"), (start + F.col("len")).alias("b")))).alias("spans"), F.collect_set("item_id").alias("items"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(F.array_sort("spans"), zero, lambda s, x: F.struct((s.n + F.greatest(F.lit(0), x.b - F.greatest(x.a, s.end))).cast("long").alias("n"), F.greatest(s.end, x.b).cast("long").alias("end")), lambda s: s.n)
    return by.select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_"), "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
i as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
g as (select item_id, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p, w from i where len(w) > 0),
grams as (select distinct item_id, n, array_to_string(w[p : p + n - 1], ' ') as gram from g),
lens as (select distinct n from grams),
places as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as p, w from d, lens where len(w) >= n),
cand as (select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as gram from places),
hits as (select c.doc_id, c.n, c.p, g.item_id from cand c join grams g on c.gram = g.gram and c.n = g.n),
words as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(words.n_hit, 0) as bigint) as n_hit, cast(coalesce(items.n_items, 0) as bigint) as n_items,
       sha256(coalesce(items.ids, '')) as items_sha256, coalesce(words.n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""
