"""Readers, writers, the plan of a component, streaming."""

import gzip
import hashlib
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestone.operators import archive, kb, store
from lodestone.plans import mining
from lodestone.sources import readers, writers
from lodestone.streaming import ingest

CODE = "// SPDX-License-Identifier: MIT\n" + "int main(void) { return md5(0); }\n" * 20


def test_expand(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.jar", "w") as z:
        z.writestr("src/a.c", CODE)
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("b.c")
        info.size = len(CODE)
        t.addfile(info, io.BytesIO(CODE.encode()))
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress(b"hello"))
    (tmp_path / "d.7z").write_bytes(b"7z")
    (tmp_path / "e.zip").write_bytes(b"torn")
    (tmp_path / "f.c").write_bytes(b"int x;")
    (tmp_path / ".hidden").write_bytes(b"no")
    got = {(r.path, bytes(r.content)) for r in readers.expand(readers.read_folder(spark, str(tmp_path))).collect()}
    assert got == {("src/a.c", CODE.encode()), ("b.c", CODE.encode()), ("c.txt", b"hello"), ("f.c", b"int x;")}


def test_unreadable_archives_are_reported(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("a.c", CODE)
    data = bytearray((tmp_path / "good.zip").read_bytes())
    for at in (data.find(b"PK\3\4") + 6, data.find(b"PK\1\2") + 8):
        data[at] |= 1  # the flag of an encrypted member
    (tmp_path / "locked.zip").write_bytes(data)
    (tmp_path / "torn.tar.gz").write_bytes(b"torn")
    got = readers.expand(readers.read_folder(spark, str(tmp_path)), report=True).collect()
    assert {(r.archive.rpartition("/")[2], r.path, r.error is None) for r in got} == {("good.zip", "a.c", True), ("locked.zip", None, False), ("torn.tar.gz", None, False)}


def test_bytes_from_archives_to_facts(spark, tmp_path):
    """Latin-1 files are mined byte for byte, null texts are empty files."""
    plain = "// Copyright 2020 Jürgen Müller GmbH\n".encode("latin-1") + b"int a;\n" * 60
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("src/a.c", plain)
        z.writestr("src/b.c", "// Copyright 2020 Jürgen Müller GmbH\n" + "int b;\n" * 60)
        z.writestr("src/c.c", b"")
    files = mining.files_of(readers.expand(readers.read_folder(spark, str(tmp_path))))
    comp = mining.component(spark, "me,thing,1.0,20240101,MIT,pkg:generic/thing", archive_id=files.first().url_id)
    tables = mining.mine(files, comp)
    assert {r.file_id for r in tables["file"].collect()} >= {hashlib.md5(plain).hexdigest()}
    assert [r.statement for r in tables["copyright"].collect()] == ["Copyright 2020 Jürgen Müller GmbH"] * 2
    assert tables["file"].count() == 2 and {len(r.content) for r in tables["sources"].collect()} == {len(plain), len(plain) + 2}
    none = mining.judged(spark.createDataFrame([("u", "a.c", None)], "url_id string, path string, text string")).first()
    assert (none.file_id, none.outcome) == ("d41d8cd98f00b204e9800998ecf8427e", "too_small")
    local = mining.local_facts(files, *(f(spark) for f in (mining.license_dictionary, mining.crypto_dictionary)))
    assert {r.id for r in local["copyright"].collect()} == {"src/a.c", "src/b.c"} and local["quality"].count() == 2


def test_load_of_a_dataset(spark, tmp_path):
    a, b = hashlib.md5(b"a").hexdigest(), hashlib.md5(b"b").hexdigest()
    files = spark.createDataFrame([(a, "u" * 32, "x.c"), (b, "u" * 32, "y.c"), (b, "u" * 32, "y.json")], "file_id string, url_id string, path string")
    lic = spark.createDataFrame([(a, "1", "MIT"), (a, "1", "MIT"), (b, "2", "ISC")], "id string, source string, spdx_id string")
    writers.write_lines(files, str(tmp_path / "m" / "file"), "file_id")
    writers.write_lines(lic, str(tmp_path / "m" / "license"), "id")
    assert mining.load(spark, str(tmp_path / "m"), str(tmp_path / "kb1")) == ["file", "license"]
    assert sorted(map(tuple, store.open_table(spark, str(tmp_path / "kb1"), "license").collect())) == sorted([(a, "1", "MIT"), (b, "2", "ISC")])
    assert sorted((r.file_id, r.path) for r in store.open_table(spark, str(tmp_path / "kb1"), "file").collect()) == sorted([(a, "x.c"), (b, "y.c")])


def test_torn_line_is_dropped(spark, tmp_path):
    (tmp_path / "cc.csv").write_text("one,1\nthr\ntwo,2\nthr")
    assert sorted(r.line for r in readers.read_lines(spark, str(tmp_path)).collect()) == ["one,1", "thr", "two,2"]
    (tmp_path / "cc.csv").unlink()
    (tmp_path / "aa.csv").write_text("one,1\ntwo,2\nthr")
    (tmp_path / "bb.csv").write_text("four,4\n")
    got = {(r.line, r.shard) for r in readers.read_lines(spark, str(tmp_path)).collect()}
    assert got == {("one,1", "aa"), ("two,2", "aa"), ("four,4", "bb")}


def test_wfp_round_trip(spark, tmp_path):
    rows = [(0xDEADBEEF, hashlib.md5(b"a").hexdigest(), 7), (0x00000001, hashlib.md5(b"b").hexdigest(), 65535), (0xDE000000, hashlib.md5(b"a").hexdigest(), 258)]
    writers.write_wfp(spark.createDataFrame(rows, "wfp long, file_id string, line int"), str(tmp_path / "w"))
    assert len(list((tmp_path / "w").glob("*.bin"))) == 2
    assert (tmp_path / "w" / "de.bin").stat().st_size == 42
    assert sorted(map(tuple, readers.read_wfp(spark, str(tmp_path / "w")).collect())) == sorted(rows)


def test_mz_round_trip(spark, tmp_path):
    rows = [(hashlib.md5(c.encode()).hexdigest(), c) for c in ("one\n", "two\n", "")]
    writers.write_mz(spark.createDataFrame(rows, "file_id string, content string"), str(tmp_path / "m"))
    got = sorted((r.file_id, bytes(r.content).decode()) for r in readers.read_mz(spark, str(tmp_path / "m")).collect())
    assert got == sorted(rows)


def test_mz_damaged_record(spark, tmp_path):
    good = hashlib.md5(b"one\n").hexdigest()
    writers.write_mz(spark.createDataFrame([(good, "one\n")], "file_id string, content string"), str(tmp_path / "m"))
    shard = tmp_path / "m" / f"{good[:4]}.mz"
    shard.write_bytes(shard.read_bytes()[:14] + b"\x04\0\0\0junk" + shard.read_bytes()[:-3])
    got = readers.read_mz(spark, str(tmp_path / "m"))
    assert [r.content for r in got.collect()] == [None, None]
    assert {r.verdict for r in archive.verdicts(got).collect()} == {"corrupted"}


def test_version(spark, tmp_path):
    (tmp_path / "version.json").write_text('{"monthly":"22.01", "daily":"N/A"}')
    got = kb.version(readers.read_version(spark, str(tmp_path / "version.json")), spark.createDataFrame([("21.12", "22.01.24")], "monthly string, daily string")).first()
    assert tuple(got) == ("22.01", "22.01.24")


def test_version_is_written_and_read_back(spark, tmp_path):
    frame = spark.createDataFrame([("22.01", "22.01.24")], "monthly string, daily string")
    writers.write_version(frame, str(tmp_path / "v"))
    assert [tuple(r) for r in readers.read_version(spark, str(tmp_path / "v")).collect()] == [("22.01", "22.01.24")]


def test_encoded_fields_with_a_decoder_of_ones_own(spark):
    rows = spark.createDataFrame([("a", "b2xsZWg=")], "id string, data string")
    assert readers.decode_field(rows, "data", lambda c: F.reverse(F.decode(F.unbase64(c), "UTF-8"))).first().data == "hello"


def test_facts_of_a_folder(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.c").write_text(CODE)
    (tmp_path / "b.json").write_text("{" + CODE)
    got = mining.local_folder(spark, str(tmp_path))
    assert [tuple(r) for r in got["license"].collect()] == [("src/a.c", 1, "MIT")]
    assert [(r.id, r.algorithm) for r in got["cryptography"].collect()] == [("src/a.c", "MD5")]
    assert [r.id for r in got["quality"].collect()] == ["src/a.c"] and got["copyright"].count() == 0


def test_mine_save_and_stream(spark, tmp_path):
    comp = mining.component(spark, "me,thing,1.0,20240101,MIT,pkg:generic/thing")
    url = comp.first().url_id
    files = spark.createDataFrame([(url, "src/a.c", CODE), (url, "LICENSE", "Copyright 2020 Some Body\n" * 20), (url, "README", "x"), (url, "b.s", CODE + "x")], "url_id string, path string, text string")
    tables = mining.mine(files, comp)
    assert {r.path for r in tables["file"].collect()} == {"src/a.c", "b.s"}
    assert {(r.source, r.spdx_id) for r in tables["license"].collect()} == {(0, "MIT"), (1, "MIT")}
    assert tables["sources"].count() == 1 and tables["attribution"].count() == 1
    assert [r.statement for r in tables["copyright"].collect()] == ["Copyright 2020 Some Body"]
    mining.save(tables, str(tmp_path / "kb"), only=["file", "license"])
    assert store.open_table(spark, str(tmp_path / "kb"), "file").count() == 2
    files.withColumn("seen", F.current_timestamp()).unionByName(files.withColumn("seen", F.current_timestamp())).write.parquet(str(tmp_path / "in"))
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "stream"), str(tmp_path / "ck"), comp, only=["file"]).awaitTermination()
    assert store.open_table(spark, str(tmp_path / "stream"), "file").count() == 2
    seen = store.snapshot(spark, str(tmp_path / "stream"))
    mining.save({"file": tables["file"]}, str(tmp_path / "stream"), batch=("ck", 0))  # that batch again
    assert "ck" in seen.batches and store.snapshot(spark, str(tmp_path / "stream")) == seen
