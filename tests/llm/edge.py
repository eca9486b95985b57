"""A small table with the cases that every operator must survive."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, row string, block string"


def rows():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("an", "ther", "io", "be", "mu", "sil") for b in ("ta", "or", "en", "lu", "quis")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    long_, shared = prose(6000), prose(40)
    texts = [None, "", " \n\t ", "one", "two words", prose(30), prose(80), long_, long_, f"{prose(30)} {shared} {prose(25)}", f"{prose(31)}\n{shared}\n{prose(20)}", "x" * 30000, "ünï " * 60]
    texts += [texts[6], texts[6].replace("an", "AN", 1), texts[6] + " more"]
    out = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or ""), "a", "b", "c", "d") for i, t in enumerate(texts)]
    out += [out[6], out[6], out[9], (None, None, None, None, None, None, None, None, None), (None, texts[9], "en", "s1", 1, None, None, None, None), (9, prose(60), "en", "s0", 1, None, None, None, None)]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
