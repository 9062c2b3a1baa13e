"""Scores of the text classifiers against plain loops, through their queries' operators."""

import math
import zlib
from collections import Counter

import pytest

from accordium.llm import language, quality, toxicity
from accordium.session import table

LETTERS = {ord(c) for c in "abcdefghijklmnopqrstuvwxyz"}


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_bin(edges, value: float) -> int:
    return sum(e < value for e in edges)


def test_language_by_brute_force(spark, sf):
    docs = table(spark, sf, "documents").limit(80).select("doc_id", "text", "lang")
    extra = [(-1, "unseenword the garten", None), (-2, None, "en"), (-3, "", "fr"), (-4, "12 ¾", "en"), (-5, "Ünseen 中文字 x", None), (None, "the house is small", "en"), (-7, "the house is small", "fr"), (-7, "the house is small", "fr")]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    rows = docs.collect()

    def words(text):
        small = (text or "").encode()
        small = bytes(b + 32 if 65 <= b <= 90 else b for b in small)
        return [w.decode() for w in bytes(b if b in LETTERS or b >= 128 else 32 for b in small).split()]

    learned = {(r.text, r.lang) for r in rows if r.text is not None and r.lang is not None and not held_out(r.doc_id)}
    langs = sorted({lang for _, lang in learned})
    tables = [{lang: Counter() for lang in langs} for _ in range(6)]
    for text, lang in learned:
        for w in words(text):
            tables[0][lang][w] += 1
            for k in range(1, 6):
                for i in range(len(w) + 2 - k + 1):
                    tables[k][lang][f" {w} "[i : i + k]] += 1
    keys = [set().union(*t.values()) for t in tables]

    def logs(k, key):
        own = [math.log((tables[k][lang][key] + 0.5) / (sum(tables[k][lang].values()) + 0.5 * len(keys[k]))) for lang in langs]
        return [v - sum(own) / len(own) for v in own]

    known: dict = {}

    def score(w):
        if w not in known:
            if w in keys[0]:
                known[w] = logs(0, w)
            else:
                found = [logs(k, g) for i in range(len(w) + 2) for k, g in [next(((k, f" {w} "[i : i + k]) for k in range(5, 0, -1) if i + k <= len(w) + 2 and f" {w} "[i : i + k] in keys[k]), (0, None))] if k]
                known[w] = [sum(v) / max(1, len(found)) ** 0.5 for v in zip(*found, strict=True)] if found else [0.0] * len(langs)
        return known[w]

    want = Counter()
    for r in rows:
        if any(c.isalpha() for c in r.text or ""):
            own = words(r.text)
            total = [sum(v) for v in zip(*map(score, own), strict=True)]
            z = [v / len(own) ** 0.5 for v in total]
            best = max(range(len(langs)), key=lambda j: total[j])
            want[(r.doc_id, held_out(r.doc_id), langs[best], round(1 / sum(math.exp(v - z[best]) for v in z), 4))] += 1
        else:
            want[(r.doc_id, held_out(r.doc_id), "und", 0.0)] += 1
    assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 4)) for r in language.language(docs).collect()) == want


def test_language_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, t * (1 + i), lang) for i in range(40) for t, lang in (("the house ", "en"), ("la maison ", "fr"))], "doc_id long, text string, lang string")
    assert language.train(docs, sample_bytes=5).langs == []
    assert 0 < language.train(docs, sample_bytes=2_000).tables[0][1].shape[0] <= language.train(docs).tables[0][1].shape[0] == 4
    assert language.train(docs.limit(0)).langs == []


@pytest.fixture(scope="module")
def labelled(spark):
    d = "/root/testdata/sf0.001"
    extra = spark.createDataFrame([(None, "you idiot", "x", "en", 1), (-1, None, "x", "en", 1), (-2, "", "x", "en", 1)], "doc_id long, text string, source string, lang string, n_chars long")
    return table(spark, d, "documents").select("doc_id", "text").union(extra.select("doc_id", "text")), table(spark, d, "labels")


def test_toxicity_by_plain_walks(labelled):
    """Each text by itself: walks of the trees from their root, then the line between two points of the calibration."""
    docs, labels = labelled
    words, trees, calibrated = toxicity.train(docs, labels)
    assert trees.rounds and len(calibrated.at)

    def plain(text):
        x = toxicity.features([None if text is None else text.encode()], words)[0]
        z = trees.base
        for t in range(trees.rounds):
            node = 0
            while node < 2**trees.depth - 1:
                j = trees.feature[t][node]
                node = 2 * node + 1 + (plain_bin(trees.edges[j], x[j]) > trees.cut[t][node])
            z += trees.leaf[t][node - (2**trees.depth - 1)]
        at, to = calibrated.at, calibrated.to
        after = next((i for i, v in enumerate(at) if v > z), len(at))
        if after in (0, len(at)):
            return to[0] if after == 0 else to[-1]
        a, b = at[after - 1], at[after]
        return to[after - 1] + (to[after] - to[after - 1]) * (z - a) / (b - a)

    want = Counter((r.doc_id, held_out(r.doc_id), round(p, 6), int(p >= 0.3)) for r in docs.collect() for p in [plain(r.text)])
    assert Counter((r.doc_id, r.held_out, round(r.score, 6), r.predicted) for r in toxicity.toxicity(docs, labels).collect()) == want


def test_quality_by_plain_sums(labelled):
    """Each text by itself: one entry of each feature's table and of each pair's."""
    docs, labels = labelled
    model = quality.train(docs, labels)
    assert model.learned and len(model.chosen) == model.pairs

    def plain(text):
        x = quality.features([None if text is None else text.encode()])[0]
        z = model.base + sum(model.tables[j][plain_bin(model.edges[j], x[j])] for j in range(len(x)))
        for (j, k), t in zip(model.chosen, model.pair_tables, strict=True):
            z += t[plain_bin(model.coarse[j], x[j]) * (model.pair_bins + 1) + plain_bin(model.coarse[k], x[k])]
        return 1 / (1 + math.exp(-max(-30, min(30, z))))

    want = Counter((r.doc_id, held_out(r.doc_id), round(p, 6), int(p >= 0.7)) for r in docs.collect() for p in [plain(r.text)])
    assert Counter((r.doc_id, r.held_out, round(r.score, 6), r.predicted) for r in quality.quality(docs, labels).collect()) == want


def test_short_words_are_learned(spark):
    """Words of one letter or two belong to the lexicon like others, and are found in disguise."""
    docs = spark.createDataFrame([(i, "you zx there" if i % 2 else "you are there") for i in range(400)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "concat(text, ' ', doc_id) as text")
    words = toxicity.lexicon(docs.selectExpr("text", "cast(doc_id % 2 as int) as y"))
    assert b"zx" in words and b"you" not in words and b"are" not in words
    x = toxicity.features([b"a 0i b"], {b"oi": 3.0})[0]
    assert x[toxicity.NAMES.index("disguised")] == 1
