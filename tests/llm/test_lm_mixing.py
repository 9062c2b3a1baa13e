import numpy as np
import pyarrow as pa

from accordium.llm import lm


def test_spelling_is_mixed_in_single_precision(monkeypatch):
    kinds, learn = set(), lm.Mixer.learn
    monkeypatch.setattr(lm.Mixer, "learn", lambda self, x, gate, bits: (kinds.add((x.dtype, bits.dtype)), learn(self, x, gate, bits)))
    words = [b"word%d" % i for i in range(3000)]
    speller = lm.Speller()
    first, then = speller.all(words, True), speller.all(words, False)
    assert kinds == {(np.dtype(np.float32), np.dtype(np.float32))}
    assert np.isfinite(first).all() and 0 < then.sum() < first.sum()


def test_words_are_hashed_as_they_are_cut(monkeypatch):
    texts = ["  One two\tTWO\x0bthree", "", "one", " \n", "été ÉTÉ one two", "x" * 90 + " end", "two\x00 two", "e n d", "end"]
    column = pa.array(["left", "out", *texts, "too"]).slice(2, len(texts))
    want = [t.encode().lower().split() for t in texts]
    for together in (1 << 18, 16):
        monkeypatch.setattr(lm, "HASHED", together)
        hashes, counts = lm.word_hashes(column)
        assert counts.tolist() == [len(w) for w in want]
        names = [w for t in want for w in t]
        assert len({(w, h) for w, h in zip(names, hashes.tolist(), strict=True)}) == len(set(names)) == len(set(hashes.tolist()))
    assert [len(v) for v in lm.word_hashes(pa.array([], pa.string()))] == [0, 0]


def test_nodes_are_counted_up_their_trees():
    corpus = np.arange(40, 3, -1)
    codes = lm._codes([5, 4, 3, 6, 2, 1, 1, 1])
    nodes, bits, begin, size = lm._paths(len(corpus), codes)
    zeros, ones = lm._node_counts(corpus, codes, [int(corpus.sum()), 7, 2])
    weight = np.repeat([*corpus, 7, 2], size)
    assert np.array_equal(begin, np.cumsum(size) - size)
    for bit, found in enumerate((zeros, ones)):
        assert np.allclose(np.bincount(nodes, weight * (bits == bit), len(found)), found)
