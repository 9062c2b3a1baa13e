"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words that are far more common in toxic texts of the training sample than in others. Features are the
lexicon's density, how near it is to the second person, capitals, punctuation, and words that only match once undisguised.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Isotonic, Trees
from .common import WORDS, slices, texts_of
from .labelled import SAMPLE_ROWS, judged, matrix, sample, scored

NAMES = ("hits", "kinds", "density", "weight", "near_you", "you", "capitals", "hit_capitals", "exclaims", "marks", "disguised", "disguised_rate", "log_words")
#: Second-person words.
YOU = frozenset(b"you your yours yourself u ur du dich dir dein deine ihr euch tu te toi vous votre vos ton ta tes usted ustedes vosotros tuyo".split())
#: Signs that stand for letters.
SIGNS = str.maketrans("013457@$!|", "oieastasil")
NEAR = 5
_SIGN = re.compile(rb"[A-Za-z][0-9@$!|*._-]+[A-Za-z]|[0-9@$][A-Za-z]")
_DISGUISED = re.compile(rb"(?<![^\s])[A-Za-z0-9@$!|*._-]+(?![^\s])")


def undisguised(token: str) -> str:
    """Letters only, after signs are read as letters; runs of a letter are kept."""
    return "".join(c for c in token.lower().translate(SIGNS) if c.isalpha())


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ys = texts_of(batch), batch.column(1).to_pylist()
        for a, b in slices(texts):
            bad, all_ = Counter(), Counter()
            for t, y in zip(texts[a:b], ys[a:b], strict=True):
                own = set((t or b"").translate(WORDS).split())
                all_.update(own)
                if y:
                    bad.update(own)
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in all_], pa.string()), pa.array([bad[w] for w in all_], pa.int64()), pa.array(list(all_.values()), pa.int64())], names=["word", "bad", "n"])


def lexicon(rows: DataFrame) -> dict[bytes, float]:
    """Words and their log odds ratios: all that are in one of 200 toxic texts of the sample at least (and in three), and twenty times
    as frequent there as elsewhere. The sample bounds them."""
    total = rows.agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = total.bad or 0, total.n - (total.bad or 0)
    if not bad or not good:
        return {}
    ratio = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("n") - F.col("bad") + 0.5) / (good + 1.0))
    words = rows.select("text", "y").mapInArrow(_word_counts, "word string, bad long, n long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    found = words.where(F.col("bad") >= max(3, bad / 200)).withColumn("weight", ratio).where(F.col("weight") >= np.log(20)).collect()
    return {r.word.encode(): float(r.weight) for r in found}


def features(texts: list[bytes | None], words: dict[bytes, float]) -> np.ndarray:
    """One row for each text; all zeros for a null or empty one."""
    out = np.zeros((len(texts), len(NAMES)))
    plain = {w.decode() for w in words}
    for i, text in enumerate(texts):
        if not text:
            continue
        own = text.translate(WORDS).split()
        n = max(1, len(own))
        hits = [k for k, w in enumerate(own) if w in words]
        you = [k for k, w in enumerate(own) if w in YOU]
        near = 0
        if hits and you:
            at = np.searchsorted(you, hits)
            near = sum(min(abs(h - you[max(k - 1, 0)]), abs(h - you[min(k, len(you) - 1)])) <= NEAR for h, k in zip(hits, at.tolist(), strict=True))
        disguised = 0
        if _SIGN.search(text):
            for m in _DISGUISED.finditer(text):
                piece = m[0].decode(errors="ignore")
                disguised += undisguised(piece) in plain and piece.strip("!?.,;:*#$%&\"'()").lower() not in plain
        raw = np.frombuffer(text, np.uint8)
        capitals = int(((raw >= 65) & (raw <= 90)).sum())
        kinds = {own[k] for k in hits}
        shouted = sum(text.count(w.upper()) for w in kinds)
        out[i] = (len(hits), len(kinds), len(hits) / n, sum(words[w] for w in kinds), near, len(you) / n, capitals / len(text), shouted, text.count(b"!") / n, sum(map(text.count, (b"?", b"*", b"#"))) / n, disguised, disguised / n, np.log1p(n))
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[bytes, float], Trees, Isotonic]:
    """The lexicon, trees fitted on two thirds of the sample, and their calibration on the rest."""
    rows = sample(docs, labels, "toxic", sample_rows)
    words = lexicon(rows)
    x, y = matrix(rows, lambda texts: features(texts, words), len(NAMES))
    rest = np.arange(len(y)) % 3 == 0
    trees = Trees().fit(x[~rest], y[~rest])
    return words, trees, Isotonic().fit(trees.raw(x[rest]), y[rest])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; one row for each row of docs.

    docs needs doc_id and text, labels doc_id and toxic; other columns are ignored, whatever their names. The model is
    fitted on `sample_rows` labelled texts at most, outside the held-out fold; only the text is an input of a score. A null
    text is scored as an empty one. Rows that repeat a doc_id are scored each by its own text; equal texts have equal scores.
    Without labels, or with one label only, every score is the smoothed share of label 1 (one half without any). A null
    doc_id isn't held out. An empty table gives an empty result.
    """
    words, trees, calibrated = train(docs, labels, sample_rows)
    return judged(scored(docs, lambda texts: calibrated(trees.raw(features(texts, words)))), threshold)
