"""Results that must be exact: ids of the tokenizer, the rule of `und`, the rows that the pipeline keeps."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from accordium.llm import language, tokens


def test_ids_are_the_librarys():
    """Special tokens in any case, letters whose marks are composed in one case only, blanks of all kinds."""
    encode = tokens.Encoder(tokens.default_tokenizer())
    assert encode.apart and encode.lower and encode.fast
    rng = random.Random(1)
    pool = "aAbBhHtTwWyYjJ̱̈̊̌́̇IİéßÅ 中.,!'<|>Kſ   \t\n\x1c\x850"
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|startoftext|>", " "]
    texts = ["", "hello <|ENDOFTEXT|> x zz", "X<|StartOfText|> y", "H̱ x"] + ["".join(rng.choice(bits) if rng.random() < 0.15 else rng.choice(pool) for _ in range(rng.randrange(1, 30))) for _ in range(8_000)]
    want = [x.ids + [tokens.END] for x in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for order in (range(len(texts)), range(len(texts) - 1, -1, -1)):  # results don't depend on what came before
        ids, n = encode(pa.array([texts[i] for i in order]))
        ends = np.concatenate([[0], np.cumsum(n)]).tolist()
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [want[i] for i in order]


def test_und_is_for_texts_without_letters(spark):
    texts = [None, "", "123 ¾", "Ⅷ", "٣ 4", "_ - !", "a", "¾ ß", "中", "ª", "12x", "\U0001f600", "1" * 100_000 + "é"]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else "fr") for i, t in enumerate([*texts, *["the house and the garden", "la maison et le jardin"] * 20])], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred == "und" for r in language.language(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [not any(c.isalpha() for c in t or "") for t in texts]


@pytest.mark.parametrize("name", ["_key", "key", "KEY"])
def test_pipeline_with_clashing_names(spark, sf, name):
    """No column name breaks a stage; of rows that repeat id and text the first by the other columns stays."""
    from accordium.session import table

    docs = table(spark, sf, "documents").limit(60)
    docs = docs.union(docs.selectExpr("doc_id", "text", "lang", "'!' as source", "n_chars")).selectExpr("*", f"source as `{name}`")
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.decontaminated):
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        docs = kept
    rows = docs.collect()
    assert rows and all(r.source == "!" == r[name] for r in rows) and len({r.doc_id for r in rows}) == len(rows)


def test_pipeline_of_empty_tables(spark, sf):
    from accordium.session import table

    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_words_are_merged_once_with_whatever_signs(monkeypatch):
    encode = tokens.Encoder(tokens.default_tokenizer())
    merged, merge = [], encode._merged
    monkeypatch.setattr(encode, "_merged", lambda words: (merged.extend(words), merge(words))[1])
    texts = ["Wordless, wordless. (wordless) wordless!!", None, "straße, straße; naïve", " , 12ab wordless.", "WORDLESS --", ""]
    for column in (pa.array(texts), pa.array(texts[::-1]), pa.array([], pa.string())):
        ids, n = encode(column)
        want = [[*encode.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in column.to_pylist()]
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]
    assert encode.fast and sorted(merged) == sorted(w.encode() for w in ("wordless", "straße", "naïve"))
