"""Quality classifier: a generalised additive model with pairwise interactions over measures of a text's form."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from .boosting import Additive, sigmoid
from .common import LOWER
from .labelled import SAMPLE_ROWS, filtered, judged, matrix, sample, scored

NAMES = ("log_bytes", "log_words", "word_length", "repeats", "top_word", "distinct", "symbols", "digits", "capitals", "line_length", "short_lines", "same_lines", "stops", "bars", "marked_words", "high_bytes", "same_bytes")
_CLASS = np.zeros((256, 7))
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-"], 0] = 1
_CLASS[48:58, 1] = 1
_CLASS[65:91, 2] = 1
_CLASS[[*range(65, 91), *range(97, 123)], 3] = 1
_CLASS[46, 4] = 1
_CLASS[124, 5] = 1
_CLASS[128:, 6] = 1


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row for each text; all zeros for a null or empty one."""
    out = np.zeros((len(texts), len(NAMES)))
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text, np.uint8)
        n = len(raw)
        symbols, digits, capitals, letters, stops, bars, high = np.bincount(raw, minlength=256) @ _CLASS
        words = text.translate(LOWER).split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        many = max(1, len(words))
        counts = Counter(words)
        repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
        marked = sum(w[-1] in b"!#$%&*|" for w in words)
        short = sum(len(x) < 30 for x in lines)
        out[i] = (np.log1p(n), np.log1p(len(words)), letters / many, repeats / many, max(counts.values(), default=0) / many, len(counts) / many**0.8, symbols / n, digits / n, capitals / max(1.0, letters), np.log1p(n / max(1, len(lines))), short / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)), stops / many, bars / many, marked / many, high / n, float((raw[1:] == raw[:-1]).mean()) if n > 1 else 0.0)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Additive:
    x, y = matrix(sample(docs, labels, label, sample_rows), features, len(NAMES))
    return Additive().fit(x, y)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; one row for each row of docs.

    docs needs doc_id and text, labels doc_id and quality; other columns are ignored, whatever their names. The model is
    fitted on `sample_rows` labelled texts at most, outside the held-out fold; only the text is an input of a score. A null
    text is scored as an empty one. Rows that repeat a doc_id are scored each by its own text; equal texts have equal scores.
    Without labels, or with one label only, every score is the smoothed share of label 1. A null doc_id isn't held out. An
    empty table gives an empty result.
    """
    model = train(docs, labels, sample_rows=sample_rows)
    return judged(scored(docs, lambda texts: sigmoid(model.raw(features(texts)))), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all columns, whose predicted label is 1; all of them where nothing could be learned, without labels or
    with one label only."""
    model = train(docs, labels)
    if not model.learned:
        return docs
    return filtered(docs, lambda: lambda texts: sigmoid(model.raw(features(texts))) >= threshold)
