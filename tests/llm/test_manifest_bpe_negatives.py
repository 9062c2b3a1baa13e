"""Merkle manifest, byte-pair encoding and hard negatives against plain loops, and on odd tables."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from accordium.llm import bpe, merkle, negatives

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, ids string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def rows_of(n, seed=0):
    rng = random.Random(seed)
    rows = [(i, "Aa" * rng.randrange(5) + "ß", rng.choice(["en", "en", "en", "de", None, "ÿ"]), rng.choice(["s", None]), rng.choice([None, 7])) for i in range(n)]
    rows += [(3, "Twice", "en", "s", 1), (3, "Twice", "en", "s", 1), (3, "Once", "en", "s", 1), (None, "Null", "en", "s", 1), (999, None, "xx", None, None), (1000, "", "yy", "s", 0), (1001, "A" * 200_000, "en", "s", 1)]
    return [(i, t, lang, s, n, "leaf", 1, "x") for i, t, lang, s, n in rows]


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return out


def plain_proofs(rows):
    def leaf(r, text):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    trees = {k: sorted(v, key=lambda x: x[:3]) for k, v in sorted(trees.items(), key=lambda x: (x[0] is not None, (x[0] or "").encode()))}
    levels = {k: levels_of([x[2] for x in v]) for k, v in trees.items()}
    top = levels_of([x[-1][0] for x in levels.values()])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for t, (lang, members) in enumerate(trees.items()):
        for i, (_, _, own, r) in enumerate(members):
            path = siblings(levels[lang], i) + siblings(top, t)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            node = leaf(r, r[1].translate(lower)) if hit else own
            for a, b in path:
                node = sha(*a, node, *b)
            yield (r[0], own, levels[lang][-1][0], top[-1][0], sha(*(x for a, b in path for x in a + b)), node, node == top[-1][0])


@pytest.mark.parametrize(("n", "levels"), [(0, 4), (1, 1), (40, 1), (900, 1), (900, 2), (300, 4)])
def test_merkle(spark, n, levels):
    rows = rows_of(n, n) if n else []
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in merkle.tampered_proofs(docs, levels).collect()]
    assert sorted(got, key=str) == sorted(plain_proofs(rows), key=str)
    assert sorted(tuple(r) for r in merkle.tampered_proofs(docs.repartition(3), levels).collect() if r[0] != 3) == sorted(r for r in got if r[0] != 3) if n == 40 and None not in [r[0] for r in got] else True


def test_merkle_log(spark):
    """Positions of the log are those of a walk that writes a node when it is complete."""
    rows = rows_of(700, 1)
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), levels=1)
    sizes = {}
    for tree in [r.tree for r in found.trees.collect()]:
        log = found.nodes().where(F.col("tree") == tree).orderBy("position").collect()
        leaves = [r.digest for r in log if r.level == 0]
        want, levels = [], levels_of(leaves)

        def walk(level, i, want=want, levels=levels):
            if level:
                for j in range(8 * i, min(8 * i + 8, len(levels[level - 1]))):
                    walk(level - 1, j)
            want.append((level, levels[level][i]))

        walk(len(levels) - 1, 0)
        assert [(r.level, r.digest) for r in log] == want and [r.position for r in log] == list(range(len(want)))
        sizes[tree] = len(leaves)
    assert sum(sizes.values()) == len(rows)


def test_merkle_oracle(spark, sf):
    from accordium.llm.queries import op11_merkle_manifest

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(merkle.ORACLE).fetchall()
    names = [x[0] for x in con.description]
    got = op11_merkle_manifest(spark, sf).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want) and {r.verified for r in got} == {True, False}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def odd_texts():
    rng = random.Random(5)
    pool = "aaabbc   \n\t'sdlrvetm019.,!?-éßüñ中文日本€½¾Ⅷ٣  ​\u0085\x1c\x1f\U0001f600\U0002ebf0꟎՘"
    bits = ["<|endoftext|>", "'ll", " 're", "aaaa", "  \n ", "<|ENDOFTEXT|>"]
    out = [None, "", " ", "a" * 500, "ab" * 300, " " * 70, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "it's we'LL they're"]
    out += ["".join(rng.choice(bits) if rng.random() < 0.1 else rng.choice(pool) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x30000)])) if rng.random() < 0.7 else rng.choice(" a1!") for _ in range(20)) for _ in range(500)]
    return [*out, " ".join(out[9:400]) * 30]


def test_bpe_is_the_librarys(spark, library):
    texts = odd_texts()
    docs = spark.createDataFrame([(i % 1900, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = sorted((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs).collect())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got == sorted((i % 1900, tuple(w)) for i, w in enumerate(want))
    digests = sorted(map(tuple, bpe.round_trip(docs).collect()))
    texts_back = [library.decode(w, skip_special_tokens=False) for w in want]
    assert digests == sorted((i % 1900, len(w), hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest(), sha(t)) for i, (w, t) in enumerate(zip(want, texts_back, strict=True)))
    assert bpe.round_trip(docs.limit(0)).count() == 0 and bpe.encode(docs.limit(0)).count() == 0


def test_bpe_cuts_long_texts(library, monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER", 40)
    encode = bpe.Encoder(bpe.default_tokenizer())
    texts = [t or "" for t in odd_texts()]
    ids, n = encode(texts)
    ends = np.concatenate([[0], np.cumsum(n)]).tolist()
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_decodes_any_ids(spark, library):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(50_257) for _ in range(rng.randrange(12))]) for i in range(400)]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame([*rows, (900, None), (901, [-1, 60_000, 64])], "doc_id long, ids array<int>")).collect()}
    assert got == {i: library.decode(ids, skip_special_tokens=False) for i, ids in rows} | {900: "", 901: library.decode([64])}


def plain_negatives(rows, key=100, k=5):
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for ai, al, av in rows:
        if ai % key:
            continue
        all_ = [(score(av, v), i, label) for i, label, v in rows if i != ai]
        for p, pi in [(s, i) for s, i, _ in sorted((-s, i, 0) for s, i, label in all_ if label == al)[:k]]:
            fit = sorted((-s, i) for s, i, label in all_ if label != al and 80 * -p <= 100 * s <= 100 * -p)[:k]
            out += [(ai, pi, n, i, -p, -s) for n, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def test_hard_negatives_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    base = rng.normal(size=(6, 19))
    for i in range(900):
        v = base[i % 6] + rng.normal(size=19) * (0.3 if i % 5 else 2)
        rows.append((i, i % 4 if i % 6 else None, [float(x) for x in (v * (0 if i % 97 == 0 else 1))]))
    rows += [(2000 + i, 1, [float(x) for x in base[0]]) for i in range(300)] + [(3000 + i, 2, [float(x) for x in base[0]]) for i in range(300)]  # copies, and their ties
    rows += [(4000, 1, None), (4001, 1, [1.0, None]), (4002, 1, [float("nan")]), (4003, 2, [float("inf")]), (4004, 3, []), (4100, 3, [2.0, 1.0]), (None, 1, [1.0] * 19)]
    table = spark.createDataFrame([(i, v, label, "x", 1) for i, label, v in rows], "vec_id long, embedding array<double>, label int, score string, slot int")
    plain = [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = plain_negatives(plain)
    assert len(want) > 50
    for given in (table, table.repartition(5)):
        assert sorted(tuple(r) for r in negatives.hard_negatives(given).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == want


def test_hard_negatives_in_chunks(spark, monkeypatch):
    """Anchors in several chunks, whole numbers beyond 2**53, and other windows."""
    rng = random.Random(4)
    rows = [(i, i % 3, [rng.randrange(-(2**28), 2**28) for _ in range(5)]) for i in range(60)]
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 4)
    got = negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, vector array<long>"), F.col("vec_id") % 5 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 5)
    with pytest.raises(OverflowError):
        negatives.mine(spark.createDataFrame([(0, 1, [2**40])], "vec_id long, label int, vector array<long>"), F.lit(True))


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert negatives.hard_negatives(spark.createDataFrame([], schema)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], schema)).count() == 0


def test_negatives_oracle(spark, sf):
    from accordium.llm.queries import op13_hard_negatives

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = con.execute(negatives.ORACLE).fetchall()
    got = op13_hard_negatives(spark, sf).select(*(x[0] for x in con.description)).collect()
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_lists_leave_out_what_norms_cover():
    """At a high threshold a row is in few lists; what is found is the same as by scoring all."""
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(size=(500, 64)) * np.geomspace(60, 1, 64)).astype(np.float64)
    chunk = negatives.Chunk(np.arange(20), np.zeros(20, np.int64), vectors[:20])
    norms = np.sqrt((vectors[:20] ** 2).sum(1))
    low = np.floor(0.3 * norms**2)
    block = negatives.Block(np.arange(500), np.arange(500) % 2, vectors, float(((low - 0.5) / norms).min()))
    assert sum(n for _, n in block.lists) < 0.5 * 500 * len(block.lists)
    a, r, s = block.pairs(chunk, np.arange(20), low, True)
    got = {(int(x), int(block.ids[y]), int(z)) for x, y, z in zip(a, r, s, strict=True)}
    scores = vectors[:20] @ vectors.T
    assert got == {(i, j, int(scores[i, j])) for i in range(20) for j in range(500) if i != j and j % 2 == 0 and scores[i, j] >= low[i]}
