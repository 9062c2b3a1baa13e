"""Language ID by words first: a known word counts by its log frequency in each language; an unknown one backs off, place by
place, to the longest known character n-gram that starts there, and to ever shorter ones. Words of any length are learned and
scored whole, so texts without blanks are judged by all their n-grams. Words and n-grams are compared by 64-bit hashes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import fold_of, lean, offsets, sliced_texts
from .labelled import filtered

#: Documents that the model is fitted on at most, chosen by a hash of their text, so that the choice doesn't follow partitions.
SAMPLE_ROWS = 8_000
#: Bytes of their texts at most; a text that would go beyond is left out of the sample, so that the model, which goes through the
#: driver and to every worker, is bounded however long texts are.
SAMPLE_BYTES = 64_000_000
LONGEST = 5
#: Characters that are handled at once; longer words go piece by piece, and no n-gram is lost between two.
PIECE = 1 << 18
#: Words whose scores a task remembers; it starts anew beyond that.
REMEMBERED = 200_000
UNDETERMINED = "und"
#: Lower-cases A-Z; what is ASCII and no letter becomes a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def _has_letter(text: bytes | None, words: list[bytes]) -> bool:
    return any(97 <= w[0] <= 122 for w in words[:50]) or bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text.decode(errors="replace")))


def _pieces(words: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For all characters of the words, each between two blanks: the word's number, the character, and how many characters an
    n-gram that starts there can have at most; 0 for those that only end n-grams of this piece."""
    held, of, size, firsts = [], [], [], []

    def done() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        chars = np.frombuffer("".join(held).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = np.array(size, np.int64)
        begin, word = offsets(n)[:-1], np.repeat(np.arange(len(n)), n)
        place = np.arange(len(chars)) - begin[word]
        room = np.where(place < np.array(firsts, np.int64)[word], n[word] - place, 0)
        out = np.array(of, np.int64)[word], chars, room
        for v in (held, of, size, firsts):
            v.clear()
        return out

    total = 0
    for i, w in enumerate(words):
        marked = f" {w.decode(errors='replace')} "
        for a in range(0, len(marked), PIECE):
            part = marked[a : a + PIECE + LONGEST - 1]
            held.append(part), of.append(i), size.append(len(part)), firsts.append(min(PIECE, len(marked) - a))
            total += len(part)
            if total >= PIECE:
                total = 0
                yield done()
    if held:
        yield done()


def _grams(chars: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The keys of the n-grams of 1 to LONGEST characters that start at each place; near the end there are fewer."""
    h = np.zeros(len(chars), np.uint64)
    for k in range(1, min(LONGEST, len(chars)) + 1):
        h = (h[: len(chars) - k + 1] ^ chars[k - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        yield k, h


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _keyed(words: list[bytes], counts: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(characters, keys, counts) of the words' n-grams; 0 characters stand for the words themselves."""
    n = np.array(counts, np.float64)
    yield 0, _hashed(words), n
    for of, chars, room in _pieces(words):
        for k, h in _grams(chars):
            fits = room[: len(h)] >= k
            keys, at = np.unique(h[fits], return_inverse=True)
            yield k, keys, np.bincount(at, n[of[: len(h)][fits]], len(keys))


@lean
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for a, b, texts in sliced_texts(batch):
            by: dict[str, Counter] = {}
            for t, lang in zip(texts, langs[a:b], strict=True):
                by.setdefault(lang, Counter()).update(words_of(t))
            for lang, counts in by.items():
                for k, keys, n in _keyed(list(counts), list(counts.values())):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "k", "key", "n"])


class Model:
    """Log frequencies of words and of n-grams by language."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        parts = [(lang, *part) for lang in sorted({r[0] for r in rows}) for part in _keyed([r[1].encode() for r in rows if r[0] == lang], [r[2] for r in rows if r[0] == lang])]
        self._fit(sorted({r[0] for r in rows}), *(np.concatenate(v) if v else np.zeros(0, np.int64) for v in ([np.full(len(p[2]), p[0], object) for p in parts], [np.full(len(p[2]), p[1]) for p in parts], [p[2] for p in parts], [p[3] for p in parts])))

    @classmethod
    def of(cls, counts: pa.Table) -> Model:
        """From (lang, k, key, n)."""
        self = cls.__new__(cls)
        coded = counts["lang"].combine_chunks().dictionary_encode()
        names = coded.dictionary.to_pylist()
        self._fit(sorted(names), np.array(names, object)[coded.indices.to_numpy()] if names else np.zeros(0, object), counts["k"].to_numpy(), counts["key"].to_numpy().view(np.uint64), counts["n"].to_numpy())
        return self

    def _fit(self, langs: list[str], lang: np.ndarray, k: np.ndarray, key: np.ndarray, n: np.ndarray) -> None:
        self.langs = langs
        column = np.zeros(len(lang), np.int64)
        for i, name in enumerate(langs):
            column[lang == name] = i
        self.tables = [self._logged(key[k == j], column[k == j], n[k == j], 0.5) for j in range(LONGEST + 1)]

    def _logged(self, key: np.ndarray, column: np.ndarray, n: np.ndarray, add: float) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and a row of logs for each."""
        keys, at = np.unique(key, return_inverse=True)
        all_ = np.bincount(at * len(self.langs) + column, n, len(keys) * len(self.langs)).reshape(len(keys), len(self.langs))
        logs = np.log((all_ + add) / (all_.sum(0) + add * len(all_))) if len(keys) else all_
        return keys, (logs - logs.mean(1, keepdims=True)).astype(np.float32) if len(keys) else logs  # only differences between languages count

    def _found(self, k: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are known, and the rows of logs of those."""
        held, logs = self.tables[k]
        if not len(held):
            return np.zeros(len(keys), bool), np.zeros((0, len(self.langs)))
        at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        known = held[at] == keys
        return known, logs[at[known]]

    def score(self, words: list[bytes]) -> np.ndarray:
        """A row for each word."""
        out = np.zeros((len(words), len(self.langs)))
        known, logs = self._found(0, _hashed(words))
        out[known] = logs
        rest = np.flatnonzero(~known)
        total, n = np.zeros((len(rest), len(self.langs))), np.zeros(len(rest))
        for of, chars, room in _pieces(words[i] for i in rest):
            at = np.flatnonzero(room)
            for k, h in reversed(list(_grams(chars))):
                fits = at[room[at] >= k]
                seen, logs = self._found(k, h[fits])
                hit = fits[seen]
                n += np.bincount(of[hit], minlength=len(rest))
                for j in range(len(self.langs)):
                    total[:, j] += np.bincount(of[hit], logs[:, j], len(rest))
                room[hit] = 0
                at = at[room[at] > 0]
        out[rest] = total / np.sqrt(np.maximum(1, n))[:, None]
        return out

    def word(self, w: bytes) -> np.ndarray:
        return self.score([w])[0]


class Scorer:
    """Scores of texts by a model; remembers words."""

    def __init__(self, model: Model):
        self.model, self.known, self.rows = model, {}, np.zeros((1024, max(1, len(model.langs))))

    def __call__(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        langs = self.model.langs
        split = [words_of(t) for t in texts]
        if not langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list({w for own in split for w in own if w not in known})
        while len(self.rows) < len(known) + len(new):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[len(known) : len(known) + len(new)] = self.model.score(new)
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        names, scores = [], np.zeros(len(texts))
        for i, own in enumerate(split):
            if not _has_letter(texts[i], own):
                names.append(UNDETERMINED)
                continue
            total = self.rows[np.fromiter(map(known.__getitem__, own), np.int64, len(own))].sum(0) if own else np.zeros(len(langs))
            z = total / max(1, len(own)) ** 0.5
            p = np.exp(z - z.max())
            best = int(total.argmax())
            names.append(langs[best])
            scores[i] = p[best] / p.sum()
        return names, scores


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """The model of all words of the sample and of all their n-grams; other words are left to the n-grams."""
    known = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null").where(fold_of("doc_id", 4) != 2)
    sizes = known.groupBy(F.xxhash64("text").alias("print")).agg(F.max(F.octet_length("text")).alias("n"))
    chosen, left = [], sample_bytes
    for r in sizes.orderBy(F.xxhash64("print"), "print").limit(sample_rows).collect():  # two numbers for each row of the sample
        if r.n <= left:
            chosen.append((r.print,))
            left -= r.n
    chosen = docs.sparkSession.createDataFrame(chosen, "print long")
    sample = known.withColumn("print", F.xxhash64("text")).join(F.broadcast(chosen), "print").select("text", "lang", "print")
    counts = sample.dropDuplicates(["print", "lang"]).select("text", "lang").mapInArrow(_count, "lang string, k int, key long, n long")
    return Model.of(counts.groupBy("lang", "k", "key").agg(F.sum("n").alias("n")).toArrow())


def language(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row for each row of docs.

    docs needs doc_id, text and lang; other columns are ignored, whatever their names. The model is fitted on `sample_rows`
    distinct texts and SAMPLE_BYTES at most, outside the held-out fold, with a lang; only the text is an input of a prediction. A null text, or
    one without letters, is `und` with score 0, as is every text where nothing could be learned. Ties go to the first language
    in order. Equal texts have equal predictions, whatever their ids. A null doc_id isn't held out. An empty table gives an
    empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample_rows))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model.value)
        for batch in batches:
            for a, b, texts in sliced_texts(batch):
                names, p = score(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names, pa.string()), pa.array(p, pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")
    return out.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of docs, all columns, whose language could be told: not `und`, and with a score of `least` or more. Where no
    language or one only could be learned, all that have letters."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def keeper():
        score = Scorer(model.value)

        def keep(texts: list[bytes | None]) -> np.ndarray:
            if len(model.value.langs) < 2:
                return np.array([_has_letter(t, words_of(t)) for t in texts], bool)
            names, p = score(texts)
            return (p >= least) & np.array([n != UNDETERMINED for n in names], bool)

        return keep

    return filtered(docs, keeper)
