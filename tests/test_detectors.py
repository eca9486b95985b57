"""Rules by hand-made cases."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import dictionaries as D
from lodestone.functions import predicates as P
from lodestone.functions.text import byte_view
from lodestone.operators import archive, detect, fingerprint, kb


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, text string")


def ids(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


TAG = "SPDX-License-Identifier: "


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(0, "md5", "MD5", 128), (1, "zz", "Short", 1), (2, "aaa", "A", 1), (3, "bbb", "B", 1), (4, "ccc", "C", 1), (5, "ddd", "D", 1), (6, "MD5", "Other", 9)], "ord int, keyword string, algorithm string, strength int")


def test_spdx(spark):
    cases = {
        f"// {TAG}MIT\n": ["MIT"],
        f"/* {TAG}(GPL-2.0-only OR BSD-3-Clause) */\n": ["GPL-2.0-only", "BSD-3-Clause"],
        f"{TAG}A OR (B AND C)\n": ["A", "(B", "C"],
        f"{TAG}MIT": [],
        "\n" * 30 + f"{TAG}MIT\n": ["MIT"],
        "\n" * 31 + f"{TAG}MIT\n": [],
        f"{TAG}GPL-2.0+ \n": ["GPL-2.0+"],
        f"{TAG}Apache-2.0 WITH LLVM-exception and MIT\n": ["Apache-2.0 WITH LLVM-exception", "MIT"],
        f"{TAG}\nMIT\n": [],
        "é" * 2000 + "\n" + f"{TAG}MIT\n": ["MIT"],
        "é" * 2100 + "\n" + f"{TAG}MIT\n": [],
    }
    got = texts(spark, *cases).select("text", detect.spdx_ids(byte_view(F.col("text"))).alias("x")).collect()
    assert {r.text: r.x for r in got} == cases


def test_license_text(spark):
    dictionary = spark.createDataFrame([(0, "Late", "zulu"), (1, "Early", "alpha"), (2, "Longer", "alphabeta"), (3, "MIT", "mitlicense")], "ord int, spdx_id string, phrase string")
    cases = {"zulu is after ALPHA": "Late", "alpha, then zulu": "Early", "al-pha beta": "Early", "x" * 1020 + "zulu": None, "limit license": "MIT", "": None}
    got = texts(spark, *cases).select("text", detect.license_text(byte_view(F.col("text")), dictionary).alias("x")).collect()
    assert {r.text: r.x for r in got} == cases


def test_many_wordings_by_automaton(spark, monkeypatch):
    """A dictionary of hundreds gives what one search for each entry gives."""
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(3, 7)))
    dictionary = spark.createDataFrame([(i, f"L-{i}", word()) for i in range(300)], "ord int, spdx_id string, phrase string")
    df = texts(spark, *[" ".join(word() for _ in range(rng.randrange(0, 4))) for _ in range(300)])
    many = df.select("id", detect.license_text(byte_view(F.col("text")), dictionary).alias("x")).collect()
    monkeypatch.setattr(detect, "MAX_LITERAL", 10_000)
    assert many == df.select("id", detect.license_text(byte_view(F.col("text")), dictionary).alias("x")).collect() and len({r.x for r in many}) > 20


def test_scancode(spark):
    report = '{"files": [{"path": "a", "license_expressions": ["mit", "mit"], "detected_license_expression_spdx": "MIT"}, {"path": "b", "license_expressions": null}]}'
    df = spark.createDataFrame([("x", report), ("y", '{"files": []}'), ("z", None)], "id string, report string")
    assert ids(detect.scancode_licenses(df), "id", "source", "spdx_id") == [("x", 5, "MIT"), ("x", 5, "mit")]


def test_gram_hashes():
    import zlib

    assert fingerprint.HASHES["crc32c"](b"123456789", 9).tolist() == [0xE3069283]  # the published check value
    assert fingerprint.HASHES["crc32"](b"hello world", 5).tolist() == [zlib.crc32(b"hello world"[i : i + 5]) for i in range(7)]


def test_copyright(spark):
    cases = {
        "Copyright (c) 2019-2021, X\n": "Copyright (c) 2019-2021; X",
        "// this copyright notice stays\n(C) 2020 Some Body\n": "(C) 2020 Some Body",
        "{ Copyright 2020 Body\n": None,
        "\n" * 20 + "Copyright 2020 Body": "Copyright 2020 Body",
        "\n" * 21 + "Copyright 2020 Body": None,
        "Copyright 2020 Body !!!!!!!!!!!\n": None,
        "/* @author Jane Doe */\n": "Jane Doe */",
        "Copyright 2001 One Co\nCopyright 2002 Two Co\n": "Copyright 2001 One Co",
        "é (c) 2020 Jürgen\n": "(c) 2020 Jürgen",
        "f(c) + abc\n": "(c) + abc",
        "Copyright 20" + "x" * 300: None,
    }
    got = texts(spark, *cases).select("text", detect.copyright_statement(byte_view(F.col("text"))).alias("x")).collect()
    assert {r.text: r.x for r in got} == cases


def test_cryptography(spark, words):
    df = texts(spark, "md5. (md5) MD5", "md5.", "zz", "aaa ccc ddd bbb")
    assert ids(detect.algorithms(df, words), "id", "algorithm", "strength") == [(0, "MD5", 128), (3, "A", 1), (3, "B", 1), (3, "C", 1), (3, "D", 1)]


def test_quality(spark):
    pad = "int value = 0;\n" * 20
    cases = ["x" * 255, "a\0" + pad, "x" * 300, pad, "x\n" * 420 + pad[:0], "int x = 1;\n" * 421, "y" * 73 + "\n" + ("y" * 73 + "\n") * 5, "// c\n" * 54 + pad, "// c\n" * 55 + pad, "\ta\n b\n" + pad, f"// {TAG}MIT\n" + pad]
    got = dict(ids(detect.quality(texts(spark, *cases)), "id", "score"))
    assert got == {3: 4, 4: 4, 5: 3, 6: 3, 7: 4, 8: 3, 9: 3, 10: 5}


def test_predicates(spark):
    df = spark.createDataFrame([(n,) for n in ["x/y.JSON", "myREADME", "o", "", "a.py"]], "n string")
    assert [r[0] for r in df.select(P.ignored_ending(F.col("n"))).collect()] == [True, True, True, True, False]
    df = spark.createDataFrame([(n,) for n in ["./a", "../a", ".a", "a/.git/b", "a/../b", "a/venv/b", "."]], "n string")
    assert [r[0] for r in df.select(P.unwanted_path(F.col("n"))).collect()] == [False, False, True, True, False, True, True]
    df = spark.createDataFrame([(n,) for n in ["<HTML", "<h", "", "x{"]], "n string")
    assert [r[0] for r in df.select(P.unwanted_start(byte_view(F.col("n")))).collect()] == [True, True, True, False]
    df = spark.createDataFrame([("aaaa,bbbb\n" * 600,), ("aaaa,bbbb\n" * 400,), ("",), ("a\n" * 600,)], "n string")
    assert [r[0] for r in df.select(P.too_square(byte_view(F.col("n")))).collect()] == [True, False, False, False]
    df = spark.createDataFrame([("a,b,c.c",), ("ab",)], "n string")
    assert [r[0] for r in df.select(P.first_comma_replaced(F.col("n"))).collect()] == ["a-b,c.c", "ab"]
    df = spark.createDataFrame([("PK\3\4",), ("PKa",), ("a\0b",), ("abc",)], "n string")
    assert [r[0] for r in df.select(P.is_binary(byte_view(F.col("n")))).collect()] == [True, False, True, False]


def test_file_load_keeps_the_least_path_before_it_is_judged(spark):
    f = "0" * 29 + "1"
    lines = spark.createDataFrame([(f"{f},u,b.c", "aa"), (f"{f},u,a.json", "aa"), (f"{f},v,b.c", "aa")], "line string, shard string")
    assert ids(kb.load_files(lines), "file_id", "url_id", "path") == [("aa" + f, "v", "b.c")]


def test_archive_counts_once(spark):
    big = "line of code here\n" * 20
    import hashlib

    key = hashlib.md5(big.encode()).hexdigest()
    rows = [(key, big), (key, big), (key, "bad"), (hashlib.md5(b"s").hexdigest(), "s")]
    got = dict(ids(archive.report(archive.verdicts(spark.createDataFrame(rows, "file_id string, content string"))), "verdict", "n"))
    assert got == {"corrupted": 1, "small": 1, "duplicate": 1, "keep": 1}
    once = archive.optimised(spark.createDataFrame(rows, "file_id string, content string"))
    assert ids(archive.optimised(once), "file_id") == ids(once, "file_id")


def test_winnowing_moves_with_the_text():
    import numpy as np

    rng = np.random.default_rng(1)
    text = bytes(rng.choice(list(b"abcdefghij \n"), 3000))
    h, lines = fingerprint.winnow(text, 12, 16, fingerprint.HASHES["crc32"])
    assert len(h) and (np.diff(lines) >= 0).all() and lines.max() <= text.count(b"\n") + 1
    other, _ = fingerprint.winnow(b"something else entirely " * 3 + text, 12, 16, fingerprint.HASHES["crc32"])
    assert len(set(h) & set(other)) > 0.9 * len(set(h))
    assert len(fingerprint.winnow(b"short", 12, 16, fingerprint.HASHES["crc32"])[0]) == 0


def test_dictionaries(spark, tmp_path):
    (tmp_path / "l" / "MIT").mkdir(parents=True)
    (tmp_path / "l" / "MIT" / "01.txt").write_text("MIT License, or so!")
    assert ids(D.build_license_dictionary(spark, str(tmp_path / "l")), "ord", "spdx_id", "phrase") == [(0, "MIT", "mitlicenseorso")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "X.txt").write_text("name=XX\nCODING=96\nxx_init\nbad word\nxx.h\n")
    assert ids(D.build_crypto_dictionary(spark, str(tmp_path / "c")), "ord", "keyword", "algorithm", "strength") == [(0, "xx_init", "XX", 96), (1, "xx.h", "XX", 96)]


def test_blank_lines_are_counted_not_written(spark):
    """What texts written after so many empty lines give, without such texts in the plan."""
    prose = "Some words of a text that is long enough to have a few fingerprints,\nwith lines that differ in length.\n" * 4
    texts = [prose, "{ a start }\n" + prose, prose.replace("\n", " "), prose + "\0", "aaaa,bbbb,cccc\n" * 600, "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "file_id long, text string")
    for blank in (3, 300, 65530):
        written = rows.withColumn("text", F.concat(F.repeat(F.lit("\n"), F.lit(blank)), "text"))
        want = fingerprint.fingerprints(written, 12, 16).collect()
        assert sorted(fingerprint.fingerprints(rows, 12, 16, blank_lines=blank).collect()) == sorted(want)
        assert {r.file_id for r in want} == ({0, 1, 2} if blank == 3 else {0, 1, 2, 4})
    from lodestone import catalogue

    plan = catalogue.queries()["wfp_line_saturate"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "repeat" not in plan and len(plan) < 30_000


def test_extract_of_many_keys(spark):
    from lodestone import catalogue

    held = spark.createDataFrame([("ab", "x"), ("ab", "x"), ("ab", "y"), ("cd", "z"), ("ef", "w")], "file_id string, content string")
    asked = spark.createDataFrame([("AB",), ("ab",), ("cd",), ("00",), (None,)], "file_id string")
    assert ids(archive.extract(held, asked), "file_id", "content") == [("ab", "x"), ("ab", "x"), ("ab", "y"), ("cd", "z")]
    assert ids(archive.extract(held, "CD"), "file_id", "content") == [("cd", "z")]
    sf = "/root/testdata/sf0.001"
    assert catalogue.queries()["archive_cat"](spark, sf).select("file_id").distinct().count() == catalogue.queries()["archive_keys"](spark, sf).count()


@pytest.mark.parametrize("gram", [1, 3, 4, 30, 55, 56, 59, 60, 64, 119, 120])
def test_md5_of_grams(gram, monkeypatch):
    import hashlib
    import random

    monkeypatch.setattr(fingerprint, "_GRAMS", 100)
    text = random.Random(gram).randbytes(450)
    want = [hashlib.md5(text[i : i + gram]).hexdigest()[:8] for i in range(len(text) - gram + 1)]
    assert [f"{h:08x}" for h in fingerprint.gram_md5(text, gram).tolist()] == want


def test_texts_of_a_group_are_apart():
    import random

    rng = random.Random(5)
    some = [bytes(rng.choices(b"abAB01 \n\xc3.", k=n)) for n in (0, 400, 20, 27, 28, 3000, 0, 500)]
    at, h, lines = fingerprint.winnow_all(some, 12, 16, fingerprint.HASHES["md5"])
    alone = [(k, *x) for k, text in enumerate(some) for x in zip(*(a.tolist() for a in fingerprint.winnow(text, 12, 16, fingerprint.HASHES["md5"])), strict=True)]
    assert list(zip(at.tolist(), h.tolist(), lines.tolist(), strict=True)) == alone and len(set(at.tolist())) == 3
