"""Token-ID output: texts become ids of a public tokenizer and are kept as framed, range-coded blocks in Parquet.

Documents are dealt by ranges of doc_id and sorted, so that partitions, segments and blocks follow the ids' order. A row of the
output is a segment: whole documents with about SEGMENT ids, their lengths, and one frame of coder.py. Frames are written by
Spark's own writer, so the files can be in any store, and an attempt of a lost executor leaves nothing behind.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import coder
from .common import LOWER, bytes_of, offsets, one_list, slices_of, written

SEGMENT = 6_000_000
END = 1
#: Pieces of text, and words in them, whose ids a worker remembers; it starts anew beyond that.
REMEMBERED = 1_300_000
#: Letters that a word must consist of to be given to the tokenizer's merges at once: lower case, one byte in Latin-1, so that
#: no normalisation changes them; then signs that are never part of a word. Used only where probes show that it changes nothing.
_PLAIN = "^(?P<word>[a-z\u00df-\u00f6\u00f8-\u00ff]+)(?P<signs>[!-&(-/:-@\\[-^`{-~]*)$"
_PROBES = ("Probe, of  Words:\n\there's (some) text; it isn't LONG...", "don't stop-here a1b22c e-mail x_y 3.14 ---- $$$ r\u00e9sum\u00e9, \u00c4rger na\u00efve stra\u00dfe caf\u00e9!!")
#: Bytes of text that are looked up together.
TOGETHER = 5_000_000
_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of slices of texts. Where the tokenizer drops white space and no token reaches over it, which probes show on loading,
    pieces between ASCII blanks are encoded once and remembered; else texts are encoded whole. Where it lower-cases, pieces of
    ASCII are remembered in lower case, but not those that hold a special token's text in any case: it is matched as it stands."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = self.fast = True
        self.forget()
        pieces = [p for t in _PROBES for p in t.split()]
        whole = [i for t in _PROBES for i in self._plain([t])[0]]
        self.apart = whole == [i for ids in self._plain(pieces) for i in ids]
        if self.apart:
            lowered = [p.encode().translate(LOWER).decode() for p in pieces]
            self.lower = self._plain(pieces) == self._plain(lowered)
            self.fast = self.lower and self._remembered(lowered) == self._plain(lowered)
            self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for a in range(0, len(texts), 10_000):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[a : a + 10_000], add_special_tokens=False)]
        return out

    def _remembered(self, pieces: list[str]) -> list[list[int]]:
        names = [p.encode() for p in pieces]
        self._learn(list(dict.fromkeys(names)))
        found = [self.number[p] for p in names]
        return [self.flat[self.begin[k] : self.begin[k] + self.size[k]].tolist() for k in found]

    def _merged(self, words: list[bytes]) -> list[list[int]]:
        merge = self.tokenizer.model.tokenize
        return [[t.id for t in merge(w.decode() if w.isascii() else w.decode("latin-1").translate(_BYTE_LEVEL))] for w in words]

    def _keep(self, pieces: list[bytes], size: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        while len(self.size) < first + len(pieces):
            self.begin, self.size = (np.concatenate([v, np.zeros_like(v)]) for v in (self.begin, self.size))
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.size[first : first + len(pieces)] = size
        self.begin[first : first + len(pieces)] = self.used + offsets(size)[:-1]
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _keep_lists(self, pieces: list[bytes], encode: Callable[[list], list[list[int]]], texts: list) -> None:
        gc.disable()  # many small lists
        try:
            found = encode(texts)
            size = np.fromiter(map(len, found), np.int64, len(found))
            self._keep(pieces, size, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())))
        finally:
            gc.enable()

    def _learn(self, pieces: list[bytes]) -> None:
        """Remembers new pieces, without repeats. A plain word goes to the merges directly, once with whatever signs it stands; other pieces are encoded as they are."""
        if not self.fast:
            return self._keep_lists(pieces, self._plain, [p.decode() for p in pieces])
        named = pa.array(pieces, pa.binary()).cast(pa.string())
        parts = pc.extract_regex(named, _PLAIN)
        plain = parts.is_valid()
        rest = bytes_of(named.filter(pc.invert(plain)))
        self._keep_lists(rest, self._plain, [p.decode() for p in rest])
        words, signs = (pc.struct_field(parts, k).filter(plain).dictionary_encode() for k in (0, 1))
        names, tails = bytes_of(words.dictionary), bytes_of(signs.dictionary)
        new = [w for w in names if w not in self.number]
        self._keep_lists(new, self._merged, new)
        new = [t for t in tails if t not in self.number]
        self._keep_lists(new, self._plain, [t.decode() for t in new])
        tail = signs.indices.to_numpy()
        both = np.flatnonzero(np.array([len(t) > 0 for t in tails], bool)[tail])
        if len(both):
            ends = [np.array([self.number[n] for n in known], np.int64)[v.indices.to_numpy()[both]] for known, v in ((names, words), (tails, signs))]
            size = self.size.take(np.stack(ends, axis=1).reshape(-1))
            self._keep(bytes_of(named.filter(plain).take(pa.array(both))), size.reshape(-1, 2).sum(axis=1), self._ids(np.stack(ends, axis=1).reshape(-1), size))
        return None

    def _ids(self, number: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ids of some remembered pieces, one after the other."""
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        at += np.repeat(self.begin.take(number) - (ends - size), size)
        return self.flat.take(at)

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self._plain([t or "" for t in texts.to_pylist()])
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())), n

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.number) > REMEMBERED:
            self.forget()
        texts = pc.fill_null(texts, "")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        names = bytes_of(self._lowered(coded.dictionary) if self.lower else coded.dictionary)
        found = list(map(self.number.get, names))
        if None in found:
            self._learn(list(dict.fromkeys(p for p, k in zip(names, found, strict=True) if k is None)))
            found = list(map(self.number.__getitem__, names))
        number = np.array(found, np.int64).take(coded.indices.to_numpy())
        size = self.size.take(number)
        edges = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        return self._ids(number, size), np.diff(offsets(size)[edges])

    def _lowered(self, pieces: pa.Array) -> pa.Array:
        """Pieces in lower case where that can't change their ids: letters with marks may be composed in one case only."""
        low = pc.ascii_lower(pieces)
        apart = pc.not_equal(pc.binary_length(pieces), pc.utf8_length(pieces))
        for m in self.marks:
            apart = pc.or_(apart, pc.match_substring(low, m))
        return pc.if_else(apart, pieces, low)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with END behind, and their numbers; a null text is an empty one."""
        ids, n = (self._by_pieces if self.apart else self._whole)(texts)
        out = np.full(len(ids) + len(n), END, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
        return out, n + 1


def _byte_level() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {b: chr(b if b in own else 256 + b - sum(x < b for x in own)) for b in range(256)}


_BYTE_LEVEL = _byte_level()


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


SEGMENTS = "part long, first long, n_ids long, doc_ids array<{id}>, lengths array<long>, frame binary"


def _segments(path: str, segment: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, first = _encoder(path), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs: list[pa.Array] = []
        lengths: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            nonlocal first
            flat = np.concatenate(ids)
            row = [pa.array([part], pa.int64()), pa.array([first], pa.int64()), pa.array([len(flat)], pa.int64()), one_list(pa.concat_arrays(docs).cast(id_type)), one_list(pa.array(np.concatenate(lengths))), pa.array([coder.encode(flat)], pa.binary())]
            first += len(flat)
            ids.clear(), docs.clear(), lengths.clear()
            return pa.RecordBatch.from_arrays(row, names=["part", "first", "n_ids", "doc_ids", "lengths", "frame"])

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b in slices_of(texts, TOGETHER):
                got, n = encode(texts.slice(a, b - a))
                ids.append(got)
                lengths.append(n)
                docs.append(batch.column(0).slice(a, b - a))
                if sum(map(len, ids)) >= segment:
                    yield done()
        if docs:
            yield done()

    return run


def encode_documents(docs: DataFrame, tokenizer: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """Segments of the documents in ascending order of doc_id (null first; then by a hash of the text, for repeated ids)."""
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    # the row's number only serves to split rows that repeat both id and text over several ranges
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("print"), F.monotonically_increasing_id().alias("number"))
    dealt = rows.repartitionByRange("doc_id", "print", "number").sortWithinPartitions("doc_id", "print", "number").select("doc_id", "text")
    return dealt.mapInArrow(_segments(tokenizer or default_tokenizer(), segment, to_arrow_type(kind)), SEGMENTS.format(id=kind.simpleString()))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i] for k, n in enumerate(batch.schema.names)}
            ids = coder.decode(row["frame"].as_py()).astype("<u4")
            lengths = row["lengths"].values.to_numpy()
            ends = offsets(lengths)
            raw = ids.tobytes()
            sums = [crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([row["doc_ids"].values, pa.array(ends[:-1] + row["base"].as_py() + row["first"].as_py()), pa.array(lengths), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded frames."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    # one row for each partition of the writing job: as few as the driver itself keeps tasks
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return segments.join(F.broadcast(parts), "part").select("base", "first", "doc_ids", "lengths", "frame").mapInArrow(_read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: each document's place in the id stream, its length with the end id, and a checksum of the ids read back.

    docs needs doc_id and text; other columns are ignored, whatever their names. A null text counts as empty: its only id is
    the end id. Rows that repeat a doc_id are documents of their own, in order of a hash of their text;
    equal rows stand side by side. An empty table gives an empty result. A null doc_id comes first.
    """
    return read_documents(written(encode_documents(docs, tokenizer, segment), "segments"))
