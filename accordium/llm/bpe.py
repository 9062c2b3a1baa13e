"""Byte-pair encoding and decoding with the vocabulary and merges of a byte-level tokenizer's file.

Texts are cut into pieces as the file's pre-tokenizer does; the distinct pieces of a batch that a worker hasn't met yet become one
array of symbols. An index maps each pair of neighbours to all its positions in that array. Active ranks are applied in ascending
order: all positions of a rank are merged at once, and the lists of the pairs that this makes are extended; those of the pairs
that it ends are checked when their turn comes.

A merge's result is of a higher rank than the merges that made its parts (checked on loading), so that one ascending pass over
all pieces does what merging the least rank of each piece again and again does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bytes_of, offsets

#: Characters of text that are cut into pieces together; longer texts are cut before a blank that follows a sign.
TOGETHER = 2_000_000
#: Bytes of text whose new pieces are encoded together.
BATCH_BYTES = 32_000_000
#: Pieces whose ids a worker remembers; it starts anew beyond that.
REMEMBERED = 1_000_000
#: Endings that are pieces of their own.
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
LETTER, NUMBER, BLANK, OTHER = range(4)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_signs() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)}


class Vocabulary:
    """What a file of a byte-level tokenizer says: the bytes of ids, ids of single bytes, ranks of pairs, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, cutter = said["model"], said["pre_tokenizer"]
        if model["type"] != "BPE" or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter.get("use_regex", True) or said["normalizer"] or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError(f"{path} isn't a plain byte-level tokenizer")
        special = {t["content"]: t for t in said["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special.values()):
            raise ValueError("special tokens that take blanks or need whole words aren't handled")
        self.special = {t: x["id"] for t, x in special.items()}
        back = {c: b for b, c in byte_signs().items()}
        ids = model["vocab"]
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.array([ids[c] for _, c in sorted(byte_signs().items())], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.left, self.right, self.made = (np.array([ids[x] for x in side], np.int64) for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        born = np.full(len(self.bytes), -1, np.int64)
        born[self.made] = np.arange(len(pairs))
        if len(set(self.made.tolist())) < len(pairs) or (np.maximum(born[self.left], born[self.right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge comes before those that make its parts")
        keys = (self.left << 32) | self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.order[at], -1)


class Pieces:
    """Cuts texts as the tokenizer file's own library does: characters are classed by that library, each once, when first met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes: tuple[set[str], ...] = (set(), set(), set(), set())
        self.known: set[str] = set()
        self._learn({chr(c) for c in range(0x180)})

    def _learn(self, signs: set[str]) -> None:
        for c in signs:
            which = next((k for k, x in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.cut(x + c)) == 1), BLANK)
            self.classes[which].add(c)
        self.known |= signs
        inside = ["".join(map(re.escape, sorted(s))) for s in self.classes]
        letters, numbers, blanks = f"[{inside[LETTER]}]", f"[{inside[NUMBER]}]", f"[{inside[BLANK]}]"
        other = f"[^{inside[LETTER]}{inside[NUMBER]}{inside[BLANK]}]"
        seen = f"[^{inside[BLANK]}]"
        self.find = re.compile("|".join([*ENDINGS, f" ?{letters}+", f" ?{numbers}+", f" ?{other}+", f"{blanks}+(?!{seen})", f"{blanks}+"])).findall
        self.edge = re.compile(f"(?<={seen}){blanks}")

    def __call__(self, text: str) -> list[str]:
        if new := set(text) - self.known:
            self._learn(new)
        if len(text) <= TOGETHER:
            return self.find(text)
        out, start = [], 0
        while start < len(text):  # between a sign and a blank there is always an end of a piece
            m = self.edge.search(text, start + TOGETHER)
            end = m.start() if m else len(text)
            out += self.find(text[start:end])
            start = end
        return out


def merge(symbols: np.ndarray, first: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces, and how many each has. symbols holds the pieces' bytes as ids; first is True where a piece begins."""
    n = len(symbols)
    sym = symbols.astype(np.int64)
    after = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    begins = np.flatnonzero(first)
    after[begins[1:] - 1] = -1
    before[begins] = -1
    if n:
        after[-1] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(at: np.ndarray) -> None:
        """Enters the pairs that begin at some positions into the index."""
        rank = vocabulary.ranks(sym[at], sym[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, positions in zip(rank[np.concatenate([[0], cuts])].tolist() if len(rank) else [], np.split(at, cuts), strict=False):
            if r in index:
                index[r].append(positions)
            else:
                index[r] = [positions]
                heapq.heappush(active, r)

    note(np.flatnonzero(after >= 0))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b = vocabulary.left[r], vocabulary.right[r]
        at = at[(sym[at] == a) & (after[at] >= 0)]
        right = after[at]
        fits = sym[right] == b
        at, right = at[fits], right[fits]
        if a == b and len(at) > 1:  # of overlapping pairs every other one, from the left
            joined = np.concatenate([[False], right[:-1] == at[1:]])
            place = np.arange(len(at))
            odd = (place - np.maximum.accumulate(np.where(joined, 0, place))) % 2 == 1
            at, right = at[~odd], right[~odd]
        if not len(at):
            continue
        sym[at] = vocabulary.made[r]
        sym[right] = -1
        beyond = after[right]
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        ahead = before[at]
        note(np.unique(np.concatenate([ahead[ahead >= 0], at[inner]])))
    left = sym >= 0
    return sym[left].astype(np.uint32), np.add.reduceat(left, begins) if len(begins) else np.zeros(0, np.int64)


class Encoder:
    """Ids of texts; the ids of pieces are remembered."""

    def __init__(self, path: str):
        self.vocabulary, self.pieces = Vocabulary(path), Pieces(path)
        special = self.vocabulary.special
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _keep(self, names: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(names, range(first, first + len(names)), strict=True))
        while len(self.size) < first + len(names):
            self.begin, self.size = (np.concatenate([v, np.zeros_like(v)]) for v in (self.begin, self.size))
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.size[first : first + len(names)] = size
        self.begin[first : first + len(names)] = self.used + offsets(size)[:-1]
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _learn(self, names: list[str]) -> None:
        marks = [x for x in names if x in self.vocabulary.special]  # cut out whole, so never parts of a text's other pieces
        self._keep(marks, np.array([self.vocabulary.special[x] for x in marks], np.uint32), np.ones(len(marks), np.int64))
        names = [x for x in names if x not in self.vocabulary.special]
        raw = [x.encode() for x in names]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.vocabulary.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        first = np.zeros(len(symbols), bool)
        first[offsets(lengths)[:-1]] = True
        self._keep(names, *merge(symbols, first, self.vocabulary))

    def _cut(self, text: str) -> list[str]:
        if self.marks is None or not any(x in text for x in self.vocabulary.special):
            return self.pieces(text)
        return [p for k, part in enumerate(self.marks.split(text)) for p in ([part] if k % 2 else self.pieces(part) if part else [])]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their numbers."""
        if len(self.number) > REMEMBERED:
            self.forget()
        found: list[np.ndarray] = []
        counts, names, known = [], [], self.number
        provisional: dict[str, int] = {}
        for text in texts:
            pieces = self._cut(text)
            counts.append(len(pieces))
            numbers = list(map(known.get, pieces))
            if None in numbers:
                for k, x in enumerate(numbers):
                    if x is None:
                        p = pieces[k]
                        x = provisional.get(p)
                        if x is None:
                            x = provisional[p] = -1 - len(names)
                            names.append(p)
                        numbers[k] = x
            found.append(np.array(numbers, np.int32))
        self._learn(names)
        placed = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        number = np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int64)
        fresh = number < 0
        number[fresh] = placed[-1 - number[fresh]]
        size = self.size[number]
        ends = offsets(size)
        at = np.repeat(self.begin[number] - ends[:-1], size) + np.arange(ends[-1])
        return self.flat[at], np.diff(ends[offsets(counts)])


_encoders: dict[str, Encoder] = {}
_vocabularies: dict[str, Vocabulary] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = _encoders[path].vocabulary if path in _encoders else Vocabulary(path)
    return _vocabularies[path]


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BATCH_BYTES:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def encoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, ids)."""
    encode = encoder_of(path)
    for batch in batches:
        doc, text = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        raw = bytes_of(text.fill_null(""))
        for a, b in _groups(raw):
            ids, n = encode([t.decode() for t in raw[a:b]])
            lists = pa.ListArray.from_arrays(pa.array(offsets(n), pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([doc.slice(a, b - a), lists], names=["doc_id", "ids"])


def decoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) to (doc_id, ids, text): bytes that aren't UTF-8 become replacement characters; an id that isn't in the
    vocabulary adds nothing."""
    table = vocabulary_of(path).bytes
    for batch in batches:
        doc, lists = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "ids"))
        ends = lists.offsets.to_numpy().tolist()
        flat, n, texts = lists.values.to_numpy(zero_copy_only=False), len(table), []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            ids = flat[a:b]
            if len(ids) and (ids.min() < 0 or ids.max() >= n):
                ids = ids[(ids >= 0) & (ids < n)]
            texts.append(b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([doc, lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        ends, raw = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist(), lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ids = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        texts = [hashlib.sha256(t).hexdigest() for t in bytes_of(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends) // 4, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>) of every text; a null text has no ids, as an empty one. Other columns are ignored, whatever their
    names; rows that repeat an id are encoded each; an empty table gives no rows. Special tokens in a text become their ids."""
    path, kind = tokenizer or default_tokenizer(), docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: encoded(batches, path), f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids, text of (doc_id, ids); null ids give an empty text."""
    from pyspark.sql import functions as F

    path, kind = tokenizer or default_tokenizer(), tokens.schema["doc_id"].dataType.simpleString()
    given = tokens.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return given.mapInArrow(lambda batches: decoded(batches, path), f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what encode() and decode() give, made in the same task.

    The same rules as encode(): null texts are empty (0 ids, digests of nothing), every row counts, whatever its id.
    """
    path, kind = tokenizer or default_tokenizer(), docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _digests(decoded(encoded(batches, path), path)), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
