"""Language identification: held-out accuracy, decoding against a plain version, and edge cases."""

import math
import zlib

import numpy as np
import pytest
from edge import frame

from lodestone.llm import language, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_op13_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    out = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert sum(out) / len(out) >= 0.98
    short = [r.lang_pred == docs[r.doc_id].lang for r in got if len(docs[r.doc_id].text.split()) < 30]
    assert sum(short) / len(short) >= 0.9


def plain_grams(text):
    words, out = "".join(c if "a" <= c <= "z" or ord(c) > 127 else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)), {}
    for word in words.encode().split(b" "):
        if word:
            padded = b" " + word + b" "
            for n in language.GRAMS:
                for i in range(len(padded) - n + 1):
                    if n > 1 or padded[i : i + 1] != b" ":
                        out[padded[i : i + n]] = out.get(padded[i : i + n], 0) + 1
    return out


def test_op13_grams():
    for text in ["", " ", "a", "It's  ÉTÉ 12 x", "word\nword", "—", "a b", "ß"]:
        want = plain_grams(text)
        got = language.grams(text.encode())
        assert got.sum() == sum(v for k, v in want.items()), text
        assert (got > 0).sum() <= len(want)


def test_op13_decoding(model):
    x = language.table_of([b"the thing is", "é à la que".encode(), b"", b"x"])
    share = model.scores(x)
    for row, found in zip(x, share, strict=True):
        loss = []
        for word in model.code:
            margins = [float(sum(float(a) * float(b) for a, b in zip(row, model.weights[:-1, k])) + model.weights[-1, k]) for k in range(len(word))]
            loss.append(sum(t * math.log1p(math.exp(-w * m)) for t, w, m in zip(model.trust, word, margins, strict=True)))
        want = np.exp(min(loss) - np.array(loss))
        assert np.allclose(found, want / want.sum(), atol=1e-3)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 12, 40])
def test_op13_codewords(k):
    code = language.codewords(k)
    assert code.shape[0] == k and code.shape[1] <= language.BITS
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert min(apart, default=9) >= (1 if k == 2 else 2 if k == 3 else 4 if k < 6 else 5)


def test_op13_many_languages(spark):
    rng = np.random.default_rng(2)
    syllables = {f"l{k:02}": ["".join(rng.choice(list("bcdfgklmnprstvz")) + rng.choice(list("aeiou"))) for _ in range(12)] for k in range(9)}
    text = lambda s: " ".join("".join(rng.choice(s) for _ in range(rng.integers(1, 4))) for _ in range(40))
    data = [(i, text(syllables[f"l{i % 9:02}"]), f"l{i % 9:02}", "s", 1, "", "", "", "") for i in range(900)]
    docs = frame(spark, data)
    got = language.languages(docs, language.train(docs)).where("held_out").collect()
    assert np.mean([r.lang_pred == f"l{r.doc_id % 9:02}" for r in got]) >= 0.95


def test_op13_edge(spark, model):
    docs = frame(spark)
    got = language.languages(docs, model).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None and r.doc_id < 3:
            assert (r.lang_pred, r.score, r.second) == ("und", 0.0, None) and r.ambiguous
        elif r.doc_id is not None and texts[r.doc_id]:
            assert r.lang_pred in model.languages
    marks = frame(spark, [(1, "12 -- 3.4", "en", None, 1, "", "", "", ""), (2, "漢字", None, None, 1, "", "", "", ""), (3, "a", "en", None, 1, "", "", "", "")])
    assert {r.doc_id: r.lang_pred == "und" for r in language.languages(marks, model).collect()} == {1: True, 2: False, 3: False}
    one = language.train(marks)
    assert one.languages in (["en"], [])
    assert {r.lang_pred for r in language.languages(marks, one).collect()} <= {"en", "und"}
    none = language.train(frame(spark, []))
    assert {(r.lang_pred, r.score) for r in language.languages(marks, none).collect()} == {("und", 0.0)}
    assert language.languages(frame(spark, []), model).count() == 0
    hot = frame(spark, [(7, "same text again", "en", None, 1, "", "", "", "")] * 300 + [(k, f"otra cosa {k}", "es", None, 1, "", "", "", "") for k in range(100)])
    assert set(language.train(hot, max_train=20).languages) <= {"en", "es"}
