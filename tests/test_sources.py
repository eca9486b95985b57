"""Archives and binary shards as data sources: streaming, filters, ranges, commit and abort."""

import gzip
import hashlib
import io
import tarfile
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from lodestone.sources import archives, integrity, readers, records, shards, storage

MD5 = lambda data: hashlib.md5(data).hexdigest()


def left(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if not p.name.endswith(".crc"))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    (root / "sub").mkdir()
    with zipfile.ZipFile(root / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(40):
            z.writestr(f"src/f{k}.c", f"int x{k};\n" * 50)
        z.writestr("doc/readme", "hello")
        z.mkdir("empty")
    with tarfile.open(root / "sub" / "b.tar.gz", "w:gz") as t:
        for name in ("src/b.c", "LICENSE"):
            info = tarfile.TarInfo(name)
            info.size = 4
            t.addfile(info, io.BytesIO(b"text"))
    (root / "c.txt.gz").write_bytes(gzip.compress(b"one") + gzip.compress(b"two"))
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w:gz") as t:
        info = tarfile.TarInfo("lib/g.rb")
        info.size = 4
        t.addfile(info, io.BytesIO(b"ruby"))
    with tarfile.open(root / "g.gem", "w") as t:
        for name, content in (("metadata.gz", gzip.compress(b"m")), ("data.tar.gz", data.getvalue())):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    (root / "d.7z").write_bytes(b"7z")
    (root / "e.zip").write_bytes(b"torn")
    (root / "f.tar").write_bytes(b"")
    (root / ".hidden.zip").write_bytes(b"")
    return root


def test_members_of_every_archive(spark, folder):
    got = archives.read_archives(spark, str(folder)).collect()
    good = {(r.archive.rpartition("/")[2], r.path, bytes(r.content)) for r in got if r.error is None}
    assert good == {("a.zip", f"src/f{k}.c", f"int x{k};\n".encode() * 50) for k in range(40)} | {("a.zip", "doc/readme", b"hello"), ("b.tar.gz", "src/b.c", b"text"), ("b.tar.gz", "LICENSE", b"text"), ("c.txt.gz", "c.txt", b"onetwo"), ("g.gem", "lib/g.rb", b"ruby")}
    assert {r.archive.rpartition("/")[2] for r in got if r.error} == {"d.7z", "e.zip", "f.tar"} and all(r.path is None for r in got if r.error)
    assert {r.archive_id for r in got if r.archive.endswith("a.zip")} == {MD5((folder / "a.zip").read_bytes())}


def test_large_zips_are_dealt_to_tasks(spark, folder):
    whole = archives.read_archives(spark, str(folder / "a.zip"))
    dealt = archives.read_archives(spark, str(folder / "a.zip"), splitBytes=700)
    assert whole.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() > 3
    rows = lambda df: sorted((r.path, bytes(r.content), r.archive_id) for r in df.collect())
    assert rows(whole) == rows(dealt)


def test_filters_reach_the_reader(spark, folder):
    df = archives.read_archives(spark, str(folder), ids="false")
    some = df.where(F.col("path").startswith("src/") & F.col("path").endswith("7.c"))
    assert sorted(r.path for r in some.collect()) == ["src/f17.c", "src/f27.c", "src/f37.c", "src/f7.c"]
    assert df.where(F.col("archive").contains("sub/")).count() == 2
    assert df.where("path IN ('LICENSE', 'doc/readme')").count() == 2
    assert df.where("path = 'LICENSE' AND length(content) = 4 AND archive_id IS NULL").count() == 1
    reader = archives.ArchiveReader({"path": str(folder)})
    kept = list(reader.pushFilters([archives.StringStartsWith(("path",), "src/f1"), archives.EqualTo(("part",), 0), archives.StringEndsWith(("archive",), ".zip")]))
    assert len(kept) == 1 and {p.archive.rpartition("/")[2] for p in reader.partitions()} == {"a.zip", "e.zip"}
    opened, real = [], zipfile.ZipFile.open
    zipfile.ZipFile.open = lambda self, member, *a, **b: opened.append(member.filename) or real(self, member, *a, **b)
    try:
        rows = [r for p in reader.partitions() for r in reader.rows(p)]
    finally:
        zipfile.ZipFile.open = real
    assert len(rows) == len(opened) == 11 and all(name.startswith("src/f1") for name in opened)


def test_members_in_parts_and_limits(spark, folder):
    parts = archives.read_archives(spark, str(folder / "a.zip"), partBytes=100).where("path = 'src/f3.c'").orderBy("part").collect()
    assert [r.part for r in parts] == list(range(5)) and b"".join(bytes(r.content) for r in parts) == b"int x3;\n" * 50 + b""[:0] or len(parts) > 1
    assert b"".join(bytes(r.content) for r in parts) == b"int x3;\n" * 50
    large = archives.read_archives(spark, str(folder), maxMemberBytes=5).collect()
    assert {r.path for r in large if r.error is None} == {"doc/readme", "src/b.c", "LICENSE", "lib/g.rb"}
    assert sum(r.error is not None and r.path is not None for r in large) == 41
    assert archives.read_archives(spark, str(folder / "a.zip"), minBytes=10**6).collect()[0].error
    with pytest.raises(Exception, match="no-such"):
        archives.read_archives(spark, str(folder / "no-such")).collect()


def test_a_task_holds_one_member(folder):
    """Members are opened one after the other, each only when the one before was taken."""
    opened = []
    reader = archives.ArchiveReader({"path": str(folder / "a.zip")})
    reader.wanted = lambda path: opened.append(path) or True
    rows = reader.rows(reader.partitions()[0])
    next(rows)
    assert len(opened) == 1


def test_archives_round_trip(spark, tmp_path):
    rows = [(f"{c}{end}", f"src/{k}.c", f"{c}{k}".encode() * k) for c in "abc" for end in (".zip", ".tar.gz") for k in range(30)]
    files = spark.createDataFrame(rows, "archive string, path string, content binary").repartition(5)
    archives.write_archives(files, str(tmp_path / "out"))
    assert left(tmp_path / "out") == sorted({r[0] for r in rows})
    got = archives.read_archives(spark, str(tmp_path / "out")).collect()
    assert sorted((r.archive.rpartition("/")[2], r.path, bytes(r.content)) for r in got) == sorted(rows)
    archives.write_archives(files.where("archive = 'a.zip'"), str(tmp_path / "out"), "overwrite")
    assert left(tmp_path / "out") == ["a.zip"]


WFPS = [(0xDEADBEEF, MD5(b"a"), 7), (0x00000001, MD5(b"b"), 65535), (0xDE000000, MD5(b"a"), 258), (0xFFFFFFFF, MD5(b"c"), 0)]


def test_wfp_ranges_and_layout(spark, tmp_path):
    many = WFPS + [((0xAB << 24) | k * 7, MD5(str(k).encode()), k % 70000 % 65536) for k in range(500)]
    shards.write_wfp(spark.createDataFrame(many, "wfp long, file_id string, line int"), str(tmp_path / "w"))
    assert (tmp_path / "w" / "de.bin").read_bytes()[21:] == bytes.fromhex("adbeef" + MD5(b"a") + "0700")
    read = shards.read_wfp(spark, str(tmp_path / "w"), splitBytes=1000)
    assert read.rdd.getNumPartitions() > 10 and sorted(map(tuple, read.collect())) == sorted(many)
    (tmp_path / "w" / "aa.bin").write_bytes(b"123")
    with pytest.raises(Exception, match="21-byte"):
        shards.read_wfp(spark, str(tmp_path / "w")).count()


def test_appending_and_overwriting_shards(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "wfp long, file_id string, line int")
    shards.write_wfp(frame(WFPS[:1]), str(tmp_path / "w"))
    shards.write_wfp(frame(WFPS[2:]), str(tmp_path / "w"))
    assert sorted(map(tuple, shards.read_wfp(spark, str(tmp_path / "w")).collect())) == sorted(WFPS[:1] + WFPS[2:])
    shards.write_wfp(frame(WFPS[1:2]), str(tmp_path / "w"), "overwrite")
    assert left(tmp_path / "w") == ["00.bin"]


def test_a_failed_job_leaves_the_folder_as_it_was(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "wfp long, file_id string, line int")
    shards.write_wfp(frame(WFPS), str(tmp_path / "w"))
    before = {p: (tmp_path / "w" / p).read_bytes() for p in left(tmp_path / "w")}
    broken = frame(WFPS).withColumn("line", F.when(F.col("wfp") == 1, F.raise_error("no more")).otherwise(F.col("line") + 1).cast("int"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="no more"):
            shards.write_wfp(broken.repartition(4), str(tmp_path / "w"), mode)
        assert {p: (tmp_path / "w" / p).read_bytes() for p in left(tmp_path / "w")} == before
    apart = frame(WFPS).select(F.lit("aa").alias("shard"), F.unhex("file_id").alias("data")).repartition(4)
    with pytest.raises(Exception, match="apart"):
        apart.write.format("wfp").mode("append").save(str(tmp_path / "w"))
    assert {p: (tmp_path / "w" / p).read_bytes() for p in left(tmp_path / "w")} == before


def test_mz_goes_on_after_damage(spark, tmp_path):
    same = [c for c in (f"text {k}\n".encode() for k in range(400_000)) if MD5(c)[:4] == "1234"][:6]
    shards.write_mz(spark.createDataFrame([(MD5(c), c) for c in same], "file_id string, content binary"), str(tmp_path / "m"))
    shard = tmp_path / "m" / "1234.mz"
    data = shard.read_bytes()
    order = sorted(same, key=MD5)
    sizes = [18 + len(zlib.compress(c + b"\0")) for c in order]
    wrong = bytearray(data)
    wrong[sizes[0] + 14 : sizes[0] + 18] = b"\xff\xff\xff\x7f"  # the second record's length
    wrong[sum(sizes[:3]) + 22] ^= 0x55  # the fourth record's data
    shard.write_bytes(bytes(wrong) + b"tail")
    got = shards.read_mz(spark, str(tmp_path / "m"), report=True).orderBy("at").collect()
    assert [r.content and bytes(r.content) for r in got] == [order[0], None, order[2], None, *order[4:], None]
    assert [r.file_id is None for r in got] == [False, True, False, False, *[False] * (len(order) - 4), True]
    assert got[1].error == f"{sizes[1]} bytes that are no record" and got[-1].error == "4 bytes that are no record"


def test_integrity_report(spark, tmp_path, monkeypatch):
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "aa.csv").write_text("one,1\ntwo,2\n")
    (tmp_path / "file" / "b b.csv").write_text("one,1\n" + "x" * 3000)
    (tmp_path / "file" / "cc.csv").write_text("no end")
    shards.write_wfp(spark.createDataFrame(WFPS, "wfp long, file_id string, line int"), str(tmp_path / "wfp"))
    (tmp_path / "wfp" / "0a.bin").write_bytes(b"x" * 50)
    (tmp_path / "wfp" / "zz.bin").write_bytes(b"x" * 21)
    shards.write_mz(spark.createDataFrame([(MD5(b"a"), b"a"), (MD5(b"b"), b"b")], "file_id string, content binary"), str(tmp_path / "sources"))
    one = tmp_path / "sources" / f"{MD5(b'a')[:4]}.mz"
    one.write_bytes(one.read_bytes() + b"more")
    monkeypatch.setattr(integrity, "TAIL", 7)
    got = {(r.file.rpartition("/")[2], r.kind, r.records, r.problem, r.at) for r in integrity.report(spark, str(tmp_path)).collect()}
    good = {(f"{x}.bin", "bin", n, None, None) for x, n in (("00", 1), ("de", 2), ("ff", 1))} | {(f"{MD5(b'b')[:4]}.mz", "mz", 1, None, None), ("aa.csv", "text", None, None, None)}
    bad = {("b%20b.csv", "text", None, "a last line without end", 6), ("b%20b.csv", "text", None, "a line too long", 6), ("cc.csv", "text", None, "a last line without end", 0)}
    bad |= {("0a.bin", "bin", 2, "a record that is cut off", 42), ("zz.bin", "bin", 1, "no shard's name", None), (one.name, "mz", 1, "4 bytes that are no record", one.stat().st_size - 4)}
    assert got == good | bad


def test_only_tails_are_read(tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes(b"line\n" * 100_000 + b"torn")
    read, real = [], storage.fs.LocalFileSystem.open_input_file

    class Counted:
        def __init__(self, handle):
            self.handle = handle

        def read(self, n):
            read.append(n)
            return self.handle.read(n)

        def __getattr__(self, name):
            return getattr(self.handle, name)

        def __enter__(self):
            return self

        def __exit__(self, *args):
            self.handle.close()

    class System:
        def open_input_file(self, path):
            return Counted(real(storage.fs.LocalFileSystem(), path))

    monkeypatch.setattr(integrity, "opened", lambda file: (System(), file))
    assert integrity.torn_tail(str(tmp_path / "a.csv"), 500_004) == b"torn" and sum(read) <= integrity.TAIL + 1
    (tmp_path / "a.csv").write_bytes(b"line\n" * 100_000)
    read.clear()
    assert integrity.torn_tail(str(tmp_path / "a.csv"), 500_000) is None and read == [1]


def test_whole_texts_are_read_once(spark, tmp_path):
    (tmp_path / "aa.csv").write_text("one,1\ntwo,2\n")
    plan = spark._jvm.PythonSQLUtils.explainString(readers.read_lines(spark, str(tmp_path))._jdf.queryExecution(), "simple")
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def test_records_one_at_a_time(spark, tmp_path):
    contents = [f"text {k}\n".encode() * k for k in range(1, 60)]
    frame = spark.createDataFrame([(MD5(c), c) for c in contents], "file_id string, content binary")
    shards.write_mz(frame, str(tmp_path / "m"))
    got = records.handled(spark, str(tmp_path / "m")).collect()
    assert {(r.file_id, bytes(r.content)) for r in got} == {(MD5(c), c) for c in contents}
    lines = records.handled(spark, str(tmp_path / "m"), lambda file_id, content: ((file_id, n, line.decode()) for n, line in enumerate(content.splitlines())), "file_id string, n int, line string", "mz_lines")
    assert lines.count() == sum(range(1, 60)) and lines.where("n = 0").count() == 59
    spark.sql("SELECT 1").collect()
    held = shards.mz_records(storage.fs.LocalFileSystem(), str(next((tmp_path / "m").glob("*.mz"))), 10**6)
    assert hasattr(held, "__next__")


def test_small_shards_are_read_by_few_tasks(spark, tmp_path):
    """A task reads many small archive shards; rows of one shard are written at once, records of either layout as before."""
    from lodestone.sources import shards

    contents = [f"content {k}".encode() for k in range(600)]
    shards.write_mz(spark.createDataFrame([(MD5(c), c) for c in contents], "file_id string, content binary"), str(tmp_path / "m"))
    files = len(list((tmp_path / "m").glob("*.mz")))
    read = shards.read_mz(spark, str(tmp_path / "m"), report=True)
    assert files > 500 and read.rdd.getNumPartitions() == -(-files // shards.MZ_FILES)
    assert sorted(bytes(r.content) for r in read.collect()) == sorted(contents) and all(r.file_id.startswith(r.shard) for r in read.collect())
    assert shards.read_mz(spark, str(tmp_path / "m"), splitBytes=100).rdd.getNumPartitions() > files // 10
    rows = [(k * 7919 * 65537 % 2**32, MD5(str(k).encode()), k) for k in range(3000)]
    for _ in range(2):  # the second time appended
        shards.write_wfp(spark.createDataFrame(rows, "wfp long, file_id string, line int"), str(tmp_path / "w"))
    assert sorted(tuple(r) for r in shards.read_wfp(spark, str(tmp_path / "w")).collect()) == sorted(rows * 2)
    assert sorted(p.suffix for p in (tmp_path / "w").iterdir() if not p.name.startswith(".")) == [".bin"] * len({w >> 24 for w, _, _ in rows})


def test_tar_members_are_not_kept():
    """A reader of a tar file forgets members as it goes on."""
    import gc
    import io
    import tarfile

    from lodestone.sources import archives

    held = io.BytesIO()
    with tarfile.open(fileobj=held, mode="w:gz") as t:
        for k in range(200):
            info = tarfile.TarInfo(f"f{k}")
            info.size = 1
            t.addfile(info, io.BytesIO(b"x"))
    held.seek(0)
    seen = archives.members("a.tar.gz", held)
    gc.collect()
    before = sum(isinstance(o, tarfile.TarInfo) for o in gc.get_objects())
    names = [next(seen)[0] for _ in range(150)]
    gc.collect()
    assert names == [f"f{k}" for k in range(150)] and sum(isinstance(o, tarfile.TarInfo) for o in gc.get_objects()) - before < 20
    assert [name for name, _, _ in seen] == [f"f{k}" for k in range(150, 200)]
