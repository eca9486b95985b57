"""The store: snapshots, loads one after the other, plans without exchanges, merging."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.operators import store
from lodestone.plans import mining
from lodestone.sources import writers

MD5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanged_scans(df, table_part):
    """Numbers of bucketed scans of a table with and without an Exchange between them and the next join above, or the top."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    df.sparkSession.conf.unset("spark.sql.adaptive.enabled")
    stack, free, dealt = [], 0, 0
    for line in plan.splitlines()[1:]:
        depth = len(re.match(r"[\s:+\-|]*(\*\(\d+\) )?", line).group(0).replace("*", "")) if line.strip() else 0
        depth = len(line) - len(line.lstrip(" :+-|"))
        stack = [x for x in stack if x[0] < depth] + [(depth, line)]
        if "FileScan" in line and "Bucketed: true" in line and re.search(table_part, line):
            above = []
            for _, text in reversed(stack[:-1]):
                if "Join" in text:
                    break
                above.append(text)
            if any("Exchange" in text for text in above):
                dealt += 1
            else:
                free += 1
    return free, dealt


FILE = "file_id string, url_id string, path string"


def files(spark, seed, n=400):
    rng = random.Random(seed)
    names = ["a.json", "b.c", "src/x.py", "z,z.c", "readme.c", "q.java"]
    rows = [(MD5(rng.randrange(60)), MD5(f"u{rng.randrange(4)}"), rng.choice(names)) for _ in range(n)]
    return spark.createDataFrame(rows, FILE)


def dataset(spark, path, *, seeds, wfps=(), contents=(), version=None):
    rows = files(spark, seeds[0])
    for s in seeds[1:]:
        rows = rows.unionByName(files(spark, s))
    writers.write_lines(rows, f"{path}/file", "file_id")
    writers.write_lines(rows.select("url_id", "file_id").distinct(), f"{path}/pivot", "url_id")
    if wfps:
        writers.write_wfp(spark.createDataFrame(wfps, "wfp long, file_id string, line int"), f"{path}/wfp")
    if contents:
        writers.write_mz(spark.createDataFrame([(MD5(c), c) for c in contents], "file_id string, content string"), f"{path}/sources")
    if version:
        with open(f"{path}/version.json", "w") as f:
            json.dump(version, f)
    return str(path)


def rows_of(df):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect())


def test_two_loads_equal_one_of_both(spark, tmp_path):
    one = [(7, MD5(1), 9), (7, MD5(1), 4), (7, MD5(2), 70), (2**32 - 1, MD5(2), 1)]
    two = [(7, MD5(1), 2), (7, MD5(2), 80), (8, MD5(3), 5)]
    a = dataset(spark, tmp_path / "a", seeds=[1], wfps=one, contents=["x", "y"], version={"monthly": "22.01", "daily": "22.01.24"})
    b = dataset(spark, tmp_path / "b", seeds=[2], wfps=two, contents=["y", "z"], version={"monthly": "22.02", "daily": "N/A"})
    both = dataset(spark, tmp_path / "c", seeds=[1, 2], wfps=one + two, contents=["x", "y", "z"])
    kb, joint = str(tmp_path / "kb"), str(tmp_path / "joint")
    assert mining.load(spark, a, kb)[0] == "version"
    mining.load(spark, b, kb)
    mining.load(spark, both, joint)
    for name in ("file", "pivot", "wfp", "sources"):
        assert rows_of(store.open_table(spark, kb, name)) == rows_of(store.open_table(spark, joint, name)), name
    assert store.snapshot(spark, kb).version == {"monthly": "22.02", "daily": "22.01.24"}
    assert len(store.snapshot(spark, kb).tables["file"].runs) == 2
    # A least path that is rejected takes the pair's row along, though an earlier load had another.
    assert not any(r.path.endswith(".json") for r in store.open_table(spark, kb, "file").collect())
    store.compact(spark, kb)
    assert all(len(t.runs) == 1 for t in store.snapshot(spark, kb).tables.values())
    for name in ("file", "wfp", "sources"):
        assert rows_of(store.open_table(spark, kb, name)) == rows_of(store.open_table(spark, joint, name)), name
    mining.load(spark, a, kb, ["file"], overwrite=True)
    assert rows_of(store.open_table(spark, kb, "file")) != rows_of(store.open_table(spark, joint, "file"))
    assert rows_of(store.open_table(spark, kb, "file", 2)) == rows_of(store.open_table(spark, joint, "file"))


def test_a_killed_load_is_not_seen(spark, tmp_path, monkeypatch):
    kb = str(tmp_path / "kb")
    mining.load(spark, dataset(spark, tmp_path / "a", seeds=[1]), kb)
    before = {n: rows_of(store.open_table(spark, kb, n)) for n in ("file", "pivot")}
    b, made, real = dataset(spark, tmp_path / "b", seeds=[2]), [], store.write_run

    def killed(rows, path, name, *rest, **more):
        if name == "pivot":
            raise RuntimeError("killed")
        made.append(real(rows, path, name, *rest, **more))
        return made[-1]

    monkeypatch.setattr(store, "write_run", killed)
    with pytest.raises(RuntimeError, match="killed"):
        mining.load(spark, b, kb)
    monkeypatch.undo()
    assert made and store.snapshots(spark, kb) == [1]
    assert {n: rows_of(store.open_table(spark, kb, n)) for n in ("file", "pivot")} == before
    assert store.vacuum(spark, kb) == made
    mining.load(spark, b, kb)
    assert store.snapshots(spark, kb) == [1, 2] and rows_of(store.open_table(spark, kb, "file")) != before["file"]


def test_of_two_loads_at_once_one_is_told(spark, tmp_path):
    kb = str(tmp_path / "kb")
    seen = store.snapshot(spark, kb)
    runs = [store.add(spark, kb, seen, "file", files(spark, k)) for k in (1, 2)]
    store.publish(spark, kb, seen.next({"file": runs[0]}))
    with pytest.raises(store.SnapshotTaken):
        store.publish(spark, kb, seen.next({"file": runs[1]}))
    assert store.snapshot(spark, kb).tables["file"] == runs[0]
    assert not [p for p in (tmp_path / "kb" / "_snapshots").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]
    with pytest.raises(ValueError, match="has the columns"):
        store.add(spark, kb, store.snapshot(spark, kb), "file", files(spark, 1).drop("path"))
    with pytest.raises(KeyError):
        store.open_table(spark, kb, "wfp")


def test_many_runs_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MAX_RUNS", 2)
    kb, everything = str(tmp_path / "kb"), None
    for k in range(4):
        part = files(spark, k, 60)
        mining.save({"file": part}, kb)
        everything = part if everything is None else everything.unionByName(part)
    assert len(store.snapshot(spark, kb).tables["file"].runs) == 2
    want = everything.groupBy("file_id", "url_id").agg(F.min("path").alias("path"))
    assert rows_of(store.stored(spark, kb, store.snapshot(spark, kb).tables["file"], "file")) == rows_of(want)


def test_joins_leave_the_store_where_it_lies(spark, tmp_path, no_broadcast):
    kb = str(tmp_path / "kb")
    for seed in (1, 2):
        parts = files(spark, seed)
        urls = spark.createDataFrame([(MD5(f"u{k}"), f"v{k}") for k in range(4)], "url_id string, vendor string")
        wfps = parts.select(F.crc32("path").alias("wfp"), "file_id", F.lit(seed).alias("line")).distinct()
        lic = parts.select(F.col("file_id").alias("id"), F.lit("1").alias("source"), F.lit("MIT").alias("spdx_id")).distinct()
        mining.save({"file": parts, "url": urls, "wfp": wfps, "license": lic}, kb)
    asked = files(spark, 1).limit(30)
    got = store.urls_of_files(spark, kb, asked)
    assert exchanged_scans(got, r"\[file_id#") == (1, 0) and exchanged_scans(got, r"\[url_id#\d+,vendor") == (1, 0)
    held = store.open_table(spark, kb, "file")
    want = held.join(asked.select("file_id").distinct(), "file_id").select("file_id", "url_id").distinct()
    assert rows_of(got.select("file_id", "url_id")) == rows_of(want) and "vendor" in got.columns
    query = files(spark, 3).select("file_id", F.crc32("path").alias("wfp"))
    hits = store.snippet_matches(spark, kb, query)
    assert exchanged_scans(hits, r"\[wfp#") == (1, 0)
    pairs = query.distinct().alias("q").join(store.open_table(spark, kb, "wfp").select("wfp", F.col("file_id").alias("f")), "wfp")
    assert rows_of(hits) == rows_of(pairs.groupBy("file_id", "f").agg(F.count("*")))
    facts = store.facts_of_files(spark, kb, "license", asked)
    assert exchanged_scans(facts, r"\[id#") == (1, 0) and facts.count() == asked.select("file_id").distinct().count()


def test_merge(spark, tmp_path, no_broadcast, monkeypatch):
    a, b, out = (str(tmp_path / n) for n in ("a", "b", "out"))
    mining.load(spark, dataset(spark, tmp_path / "da", seeds=[1], contents=["x", "y"], version={"monthly": "22.01", "daily": "N/A"}), a)
    mining.load(spark, dataset(spark, tmp_path / "db", seeds=[2], contents=["y", "z"], wfps=[(1, MD5(1), 1)], version={"monthly": "N/A", "daily": "22.01.24"}), b)
    mining.load(spark, dataset(spark, tmp_path / "dc", seeds=[1, 2], contents=["x", "y", "z"], wfps=[(1, MD5(1), 1)]), str(tmp_path / "joint"))
    plans, real = {}, store.write_run
    monkeypatch.setattr(store, "write_run", lambda rows, path, name, *rest: plans.setdefault(name, exchanged_scans(rows, "")) and real(rows, path, name, *rest))
    assert set(mining.merge(spark, a, b, out)) == {"file", "pivot", "sources", "wfp"}
    assert plans["file"] == (1, 0) and plans["sources"] == (1, 0)
    for name in ("file", "pivot", "wfp", "sources"):
        assert rows_of(store.open_table(spark, out, name)) == rows_of(store.open_table(spark, str(tmp_path / "joint"), name)), name
    assert store.snapshot(spark, out).version == {"monthly": "22.01", "daily": "22.01.24"}
    for bad in ((a, a, str(tmp_path / "o")), (a, b, b), (a, b, out), (a, str(tmp_path / "none"), str(tmp_path / "o"))):
        with pytest.raises(ValueError):
            mining.merge(spark, *bad)
    mining.save({"pivot": spark.createDataFrame([(1,)], "url_id int")}, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="different columns"):
        mining.merge(spark, a, str(tmp_path / "other"), str(tmp_path / "o"))
    assert store.snapshots(spark, str(tmp_path / "o")) == []


def test_denied_fingerprints(spark, tmp_path):
    from lodestone.operators import fingerprint

    (tmp_path / "list.txt").write_text("# denied\n0000002a, 0xDEADBEEF\nffffffff 12345\n0000002A\n")
    denied = fingerprint.read_denied(spark, str(tmp_path / "list.txt"))
    assert rows_of(denied) == [(42,), (0xDEADBEEF,), (0xFFFFFFFF,)]
    wfps = spark.range(5000).select((F.col("id") * 859433 % 2**32).alias("wfp"), F.col("id").cast("string").alias("file_id"), F.lit(1).alias("line"))
    wfps = wfps.unionByName(spark.createDataFrame([(42, "x", 1), (0xDEADBEEF, "y", 2), (0xFFFFFFFF, "z", 3), (43, "k", 4), (None, "n", 5)], wfps.schema))
    listed = denied.unionByName(wfps.where("wfp % 3 = 0").select("wfp"))
    want = rows_of(wfps.join(listed, "wfp", "left_anti").select("file_id"))
    for most in (10**6, 1):
        got = fingerprint.without_denied(wfps, listed, most)
        assert rows_of(got.select("file_id")) == want and got.columns == wfps.columns
    plan = spark._jvm.PythonSQLUtils.explainString(fingerprint.without_denied(wfps, denied)._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert fingerprint.without_denied(wfps, denied.limit(0)).count() == 5005


def test_matches_of_classes(spark, tmp_path, monkeypatch):
    """Hits of all pairs, which no aggregate over pairs counts; files of large classes in blocks."""
    import random
    from collections import Counter

    from lodestone import catalogue
    from lodestone.operators import fingerprint

    monkeypatch.setattr(fingerprint, "CLASS_BLOCK", 3)
    rng = random.Random(3)
    files = {f: {rng.choice((1, 1, 2, 3, rng.randrange(500))) for _ in range(rng.randrange(5))} for f in range(300)}
    rows = [(f, w) for f, ws in files.items() for w in ws]
    wfps = spark.createDataFrame([*rows, *rows[:50], (1, None), (50, None)], "file_id long, wfp long")
    want = Counter((q, f) for q in files if q % 50 == 0 for f in files for _ in files[q] & files[f])
    got = fingerprint.snippet_matches(wfps.where("file_id % 50 = 0"), wfps)
    assert {(r.query_id, r.file_id): r.hits for r in got.collect()} == want and got.count() == len(want) > 100
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [query_id" not in plan
    for name in ("snippet_match", "wfp_ignored", "wfp_ignored_by_filter"):  # fingerprints are made once
        assert "MapInArrow" not in catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
