"""Each operator against a brute-force version, on the smallest tables and on the edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import frame, rows
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, mixing, near_dedup, quality_model, quality_rules, queries, secret_scan, sharding, substring_dedup, token_count, token_output

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def local(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def pairs(data):
    return [(r[0], r[1]) for r in data]


# -- 1


def brute_tokens(data):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for doc_id, text in sorted(data, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), start))
        start += len(ids)
    return out


def test_op1_digest(spark, local):
    got = [(r.doc_id, r.n_tokens, r.ids_crc32, r.start) for r in queries.op1_token_output(spark, SF).orderBy("doc_id").collect()]
    assert got == brute_tokens(local)


def test_op1_edge_and_keyed_access(spark, tmp_path):
    path = str(tmp_path / "shards")
    token_output.write_token_shards(frame(spark), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    got = token_output.token_digest(spark, path).collect()
    want = brute_tokens(pairs(rows()))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(w[:3] for w in want)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert len(token_output.read_document(spark, path, 6)) == 3
    assert token_output.read_document(spark, path, 1) == [[2]]
    assert token_output.read_document(spark, path, 4711) == []
    empty = str(tmp_path / "none")
    token_output.write_token_shards(frame(spark, []), empty, public_tokenizers.path("word_bpe_49k.json"), 2)
    assert token_output.token_digest(spark, empty).count() == 0


def test_op1_words_as_the_library_encodes_them():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = token_output.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ["It's we'LL 3rd x2y--z", "É́té ǅ İstanbul ſs", "a b\u0085c\x1cd\x00e", "ΑΣ ας ﬁ ½ 漢字", "<|endoftext|>x <|startoftext|>", "x" * 500, "é ́e", "'s'T ''d", "ªº²³ µ-x", "_^~`", "a­b"]:
        assert np.frombuffer(next(enc.encode(pa.array([text]))), enc.dtype).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_op1_one_shard_for_a_key_in_any_order(spark, tmp_path, monkeypatch):
    """Rows in an order of their own, so that every shard spans all ids: the directory still names the shards of a key alone."""
    import random

    monkeypatch.setattr(token_output, "SHARD_IDS", 400)
    monkeypatch.setattr(token_output, "BUCKET_DOCS", 64)
    ids = [k * 7 - 300 for k in range(500)] + [14] * 40 + [None] * 3
    random.Random(2).shuffle(ids)
    texts = {k: f"text {k} of a document" for k in ids}
    rows = [(k, texts[k], None, None, None, None, None, None, None) for k in ids]
    frame(spark, rows).repartition(4).write.parquet(str(tmp_path / "docs"))
    path = str(tmp_path / "tokens")
    token_output.write_token_shards(spark.read.parquet(str(tmp_path / "docs")), path, public_tokenizers.path("word_bpe_49k.json"), 2, as_stored=True)
    shards = token_output.read_token_shards(spark, path)
    assert shards.count() > 8 and shards.where("first_id < 0 AND last_id > 2000").count() > 4
    want = {k: n for k, _, n, *_ in [(r[0], r[3], [r[1]]) for r in brute_tokens([(k, texts[k]) for k in ids])]}
    for k in (14, -300, 22, 2101):
        assert len(token_output.shards_of(spark, path, k)) == 1 or k == 14
        got = token_output.read_document(spark, path, k)
        assert len(got) == ids.count(k) and all([len(g)] == want[k] for g in got)
    for k in (2, 10**12, -(2**63)):
        assert token_output.shards_of(spark, path, k) == []
    assert spark.read.parquet(f"{path}/_directory").select("bucket").distinct().count() > 3


def test_op1_lookup_time_is_constant():
    import time

    took = {}
    for n in (5_000, 500_000):
        keys = np.arange(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        index = token_output.build_index(keys, np.arange(n), np.arange(n))
        some = [np.array([keys[k * 31 % n]]) for k in range(300)]
        token_output.lookup(index, some[0])
        start = time.process_time()
        found = [token_output.lookup(index, k) for k in some]
        took[n] = time.process_time() - start
        assert all(f[0] and a[0] == k * 31 % n for k, (f, a, _) in enumerate(found))
    assert took[500_000] < 3 * took[5_000] + 0.01, took


def test_minimal_perfect_hash():
    keys = token_output.key_hash(np.arange(5000), np.zeros(5000, np.uint8), np.zeros(5000, np.int64))
    index = token_output.build_index(keys, np.arange(5000) * 3, np.full(5000, 3))
    found, first, size = token_output.lookup(index, keys)
    assert found.all() and (first == np.arange(5000) * 3).all() and (size == 3).all()
    strange = token_output.key_hash(np.arange(5000, 9000), np.zeros(4000, np.uint8), np.zeros(4000, np.int64))
    assert token_output.lookup(index, strange)[0].mean() < 0.01


# -- 2


def test_op2_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op2_quality_model(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.97
    assert ((got.doc_id.astype(str).map(lambda s: zlib.crc32(s.encode()) % 3) == 1) == got.held_out).all()


def test_op2_edge(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(14)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    forest = quality_model.train(frame(spark), labels)
    got = quality_model.quality_scores(frame(spark), forest).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    none = quality_model.train(frame(spark, []), labels.limit(0))
    assert {r.score for r in quality_model.quality_scores(frame(spark), none).collect()} == {0.5}
    assert quality_model.quality_scores(frame(spark, []), none).count() == 0


def test_op2_scores_as_trees_walked_one_by_one(spark, docs, local):
    forest = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    data = [*local, *pairs(rows())]
    got = quality_model.quality_scores(spark.createDataFrame(data, "doc_id long, text string"), forest).collect()

    def score(text):
        x, total = quality_model.statistics(None if text is None else text.encode()), forest.start
        for t in range(len(forest.feature)):
            node = 0
            while forest.feature[t][node] >= 0:
                node = forest.left[t][node] if x[forest.feature[t][node]] <= forest.threshold[t][node] else forest.right[t][node]
            total += forest.value[t][node]
        return round(1 / (1 + np.exp(-total)), 9)

    want = Counter((i, i is not None and zlib.crc32(str(i).encode()) % 3 == 1, s := score(t), int(s >= 0.5)) for i, t in data)
    assert Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in got) == want and len({w[2] for w in want}) > 20


def test_op2_flat_trees_fit():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 5))
    y = ((x[:, 1] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    forest = quality_model.fit(x[:1500], y[:1500])
    assert ((forest.predict(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.95


# -- 3


def test_op3_repetition_limit_and_budget(docs):
    base = docs.select("doc_id", "text", "source")
    got = mixing.mixed(base, max_repeats=2.0).select("doc_id", "source", "__mix.*").toPandas()
    tokens = docs.select("source", F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).alias("n")).toPandas().groupby("source").n.sum()
    assert set(got.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert got.repeats.max() <= 2 + 1e-9
    share = tokens / tokens.sum()
    a = np.log(got.groupby("source").weight.first() / got.groupby("source").weight.first().loc[share.idxmax()]) / np.log(share / share.max())
    assert a.dropna().std() < 1e-6  # one exponent for all
    took = got.groupby("source").n_tokens.sum()
    longest = docs.select(F.max(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")))).first()[0]
    for s in tokens.index:
        want = got[got.source == s].repeats.iloc[0] * tokens[s]
        assert want - longest - 1e-6 <= took[s] <= want + 1e-6
    whole = got.groupby(["doc_id", "epoch"]).size()
    assert (whole == 1).all()


def brute_mix(spark, units, plan):
    """How often each unit (hash, source, block, tokens) is taken: whole epochs, then blocks of the next permutation, then rows of the cut block by hash."""
    taken = Counter()
    for source in {u.source for u in units}:
        mine = [u for u in units if u.source == source]
        p = next(r for r in plan if r.source == source)
        epochs, total = int(p.repeats + 1e-9), sum(u.n_tokens for u in mine)
        quota = max(p.repeats - epochs, 0) * total if p.repeats - epochs >= 1e-9 else 0
        blocks = Counter()
        for u in mine:
            blocks[u.block] += u.n_tokens
        frame = spark.createDataFrame([(source, epochs, b) for b in blocks], "source string, epochs int, block int")
        order = [r.block for r in frame.orderBy(mixing._order(1, "source", "epochs", "block"), "block").collect()]
        extra, left = set(), quota
        for b in order if quota else []:
            inside = sorted((u for u in mine if u.block == b), key=lambda u: u.h)
            if blocks[b] <= left:
                extra |= {u.h for u in inside}
                left -= blocks[b]
                continue
            for h in sorted({u.h for u in inside}):
                left -= sum(u.n_tokens for u in inside if u.h == h)
                if left < 0:
                    break
                extra.add(h)
            break
        for u in mine:
            taken[u.source, u.h] += epochs + (u.h in extra)
    return +taken


def test_op3_takes_what_brute_force_takes(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 4)
    monkeypatch.setattr(mixing, "CUT_BITS", 3)
    for data, options in ((docs, {"max_repeats": 2.0}), (docs, {"entropy": 0.999, "budget": 50_000.0}), (frame(spark), {"max_repeats": 3.0})):
        base = data.select("doc_id", "text", "source")
        units = mixing._rows(base, "doc_id", "text", "source")
        plan = mixing.mixing_plan(units, options.get("entropy"), options.get("max_repeats"), options.get("budget")).collect()
        got = mixing.mixed(base, **options).select("source", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h")).collect()
        assert Counter((r.source, r.h) for r in got) == brute_mix(spark, units.collect(), plan)


def test_op3_entropy(docs):
    got = mixing.mixed(docs.select("doc_id", "text", "source"), entropy=0.999, budget=50_000.0).select("source", "__mix.*").toPandas()
    w = got.groupby("source").weight.first()
    n = docs.select("source").distinct().count()
    missing = 1 - w.sum()
    assert missing < 0.2
    if len(w) == n:
        assert abs(-(w * np.log(w)).sum() / np.log(n) - 0.999) < 1e-6
    assert got.n_tokens.sum() <= 50_000


def test_op3_map_columns_ride_along(spark, docs):
    rows = docs.limit(50).withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))
    mix = mixing.in_order(mixing.mixed(rows, max_repeats=2.0))
    assert all(r.tags == {"k": r.doc_id} for r in mix.collect()) and mix.count() > 0


def test_op3_edge(spark):
    out = mixing.mixed(frame(spark), max_repeats=3.0)
    assert out.columns[:-1] == frame(spark).columns
    assert {r.doc_id for r in out.collect()} == {r[0] for r in rows()}
    assert mixing.mixed(frame(spark, []), max_repeats=3.0).count() == 0


# -- 4


def brute_stats(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_op4_base_counts(spark, local):
    for data, got in ((local, queries.op4_quality_rules(spark, SF)), (pairs(rows()), quality_rules.quality_verdicts(frame(spark)))):
        want = Counter((i, *brute_stats(t)) for i, t in data)
        got = got.collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.quality_verdicts(frame(spark, [])).count() == 0
    assert quality_rules.keep_good(frame(spark, [])).count() == 0


def brute_fences(stats):
    """Exact fences from bucketed values, level by level."""

    def floor(v):
        cut = max(v.bit_length() - 6, 0)
        return v >> cut << cut

    def of(values, rate):
        v = sorted(map(floor, values))
        (lower, upper), n = quality_rules.TAILS[rate], quality_rules.FENCE
        at = lambda share: v[max(-(-len(v) * share // 100), 1) - 1]
        low = max(at(lower) - n * (at(50) - at(lower)), 0) if lower else 0
        return low, at(upper) + n * (at(upper) - at(50)), len(v)

    levels = [defaultdict(list) for _ in range(3)]
    for lang, source, rate, v in stats:
        for level, key in zip(levels, ((lang, source), lang, None)):
            level[key, rate].append(v)
    out = {}
    for (key, rate), v in levels[0].items():
        prior, drawn = quality_rules.PRIOR_DOCS, of(levels[2][None, rate], rate)[:2]
        for values in (levels[1][key[0], rate], v):
            *own, n = of(values, rate)
            drawn = [(n * a + prior * b) // (n + prior) for a, b in zip(own, drawn)]
        out[key, rate] = tuple(drawn)
    return out


def test_op4_verdicts(spark):
    sf = "/root/testdata/sf0.01"
    rates = list(quality_rules.TAILS)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source")
    got = queries.op4_quality_rules(spark, sf).join(docs, "doc_id").collect()
    fences = brute_fences([(r.lang, r.source, k, r[k]) for r in got if not r.base_failed for k in rates])
    assert len({v for (_, rate), v in fences.items() if rate != "symbol_rate"}) > len(fences) / 3  # groups have fences of their own
    for r in got:
        inside = r.base_failed or all(fences[(r.lang, r.source), k][0] <= r[k] <= fences[(r.lang, r.source), k][1] for k in rates)
        assert r.kept == (not r.base_failed and inside), r
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    verdict = {r.doc_id: r for r in got if r.doc_id in labels.index and not r.base_failed}
    good = [v.kept for i, v in verdict.items() if labels[i] == 1]
    assert np.mean(good) > 0.99
    bad = [v.kept for i, v in verdict.items() if labels[i] == 0]
    assert np.mean(bad) < 0.2


# -- 5


def brute_near(data, percent, size=5):
    sets = []
    for _, text in data:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and data[i][0] is not None and data[j][0] is not None and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k)), i is None or i == least[find(k)]) for k, (i, _) in enumerate(data)]


def test_op5(spark, local):
    got = queries.op5_near_dedup(spark, SF)
    assert Counter(map(tuple, got.collect())) == Counter(brute_near(local, 85))
    assert len({r[2] for r in brute_near(local, 85)}) < len(local)
    edge = near_dedup.near_duplicates(frame(spark), 80)
    assert Counter(map(tuple, edge.collect())) == Counter(brute_near(pairs(rows()), 80))
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    kept = near_dedup.drop_near_duplicates(frame(spark), 80).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and sum(r.doc_id is None for r in kept) == 2


def test_op5_chains_within_one_bucket(spark):
    """Near copies of near copies: ends are unlike, neighbours are linked."""
    import random

    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    data = []
    for i in range(60):
        data.append((1000 - i, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(200)] = f"w{rng.randrange(10**6)}"
    rng.shuffle(data)
    got = near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 85)
    assert Counter(map(tuple, got.collect())) == Counter(brute_near(data, 85))


def test_op5_block_tasks(spark, local, monkeypatch):
    """Buckets of many blocks give what whole buckets give."""
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 3)
    got = near_dedup.near_duplicates(spark.createDataFrame(local, "doc_id long, text string"), 60)
    want = near_dedup.near_duplicates(spark.createDataFrame(local, "doc_id long, text string"), 60).collect()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))
    import random

    rng, data = random.Random(4), []
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(80):  # copies of one text, of which some are linked to each other alone
        copy = list(words)
        for _ in range(rng.randrange(1, 5)):
            copy[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
        data.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 85)
    assert Counter(map(tuple, got.collect())) == Counter(brute_near(data, 85))


def test_components(spark):
    import random

    from lodestone.llm.components import components

    rng = random.Random(1)
    cases = [[], [(1, 1), (None, 3)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 200)] + [(200, i) for i in range(199, 220)], [(rng.randrange(60), rng.randrange(60)) for _ in range(50)]]
    for links in cases:
        root = {x: x for a, b in links if None not in (a, b) and a != b for x in (a, b)}
        for _ in root:
            for a, b in links:
                if a in root and b in root:
                    root[a] = root[b] = min(root[a], root[b])
        assert {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()} == root


# -- 6


def brute_base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_op6_base(spark):
    sf = "/root/testdata/sf0.01"
    data = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in queries.op6_secret_scan(spark, sf).collect():
        base = brute_base(data[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base)
        kinds = Counter(b[3] for b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        found += len(base)
    assert found
    assert secret_scan.secret_spans(frame(spark)).count() == len(rows())
    assert secret_scan.secret_spans(frame(spark, [])).count() == 0


def test_op6_layers():
    import base64
    import gzip
    from urllib.parse import quote

    plain = 'x = {"api_key": "abcdef123456"}'
    wrap = base64.b64encode(gzip.compress(base64.b64encode(plain.encode()))).decode()
    text = f"héad {wrap} tail"
    _, spans, _ = secret_scan.scan_layers(text)
    assert spans == [(5, 5 + len(wrap), "assign")]
    text = "go ?q=" + quote(quote('token="zzzzzz99"', safe="")) + " end"
    _, spans, _ = secret_scan.scan_layers(text)
    assert [text[s:e] for s, e, _ in spans] == ["token%253D%2522zzzzzz99"]
    text = r"password=\x68unter22"
    _, spans, _ = secret_scan.scan_layers(text)
    assert [text[s:e] for s, e, _ in spans] == [text]
    assert secret_scan.scan_layers("token=token:abcdefg")[1] == []


def test_op6_large_payloads_are_scanned_in_pieces(monkeypatch):
    import base64
    import bz2
    import gzip

    n = 1 << 21
    monkeypatch.setattr(secret_scan, "MAX_LAYER", n)
    inner = base64.b64encode(b"token=zyxwvuts").decode()
    for at in (0, n - 10, n + 6, 2 * n + 12346):
        for secret in ("password = hunter2222", inner):
            plain = ("a " * (3 * n // 2)).encode()
            plain = plain[:at] + secret.encode() + plain[at:]
            for pack in (gzip.compress, bz2.compress):
                run = base64.b64encode(pack(plain)).decode()
                assert secret_scan.scan_layers(f"x {run}")[1:] == ([(2, 2 + len(run), "assign")], 1), (at, secret)


def test_op6_long_runs_in_large_payloads_are_whole(monkeypatch):
    """A base64 run across the end of a piece, longer than the overlap, with a payload that is only read whole."""
    import base64
    import gzip
    import random

    rng, n = random.Random(4), 1 << 20
    monkeypatch.setattr(secret_scan, "MAX_LAYER", n)
    noise = bytes(rng.randrange(33, 127) for _ in range(200_000)) + b" password = hunter2222 "
    for run in (base64.b64encode(gzip.compress(noise)), base64.encodebytes(gzip.compress(noise)).rstrip()):
        for at in (n - 100_000, n - 12, n + 4):
            plain = (b"no. " * n)[:at] + run + b". " + b"no. " * 50_000
            outer = base64.b64encode(gzip.compress(plain)).decode()
            assert secret_scan.scan_layers(f"x {outer}")[1] == [(2, 2 + len(outer), "assign")], at


def test_op6_time_follows_the_text():
    import base64
    import random
    import time

    noise = base64.b64encode(random.Random(1).randbytes(3 << 20)).decode()
    wrapped = "\n".join(noise[i : i + 76] for i in range(0, len(noise), 76))
    for make in (lambda n: "/eA" * (n // 3), lambda n: noise[:n], lambda n: wrapped[:n], lambda n: "/H4sIAAAA" * (n // 9), lambda n: "_-/" * (n // 3)):
        took = []
        for n in (250_000, 1_000_000):
            start = time.process_time()
            secret_scan.scan_layers(make(n))
            took.append(time.process_time() - start)
        assert took[1] < 8 * took[0] + 0.2 and took[1] < 5, took


def _wrappers():
    import base64
    import bz2
    import gzip
    import lzma
    import zlib
    from urllib.parse import quote

    import zstandard

    raw = zlib.compressobj(9, zlib.DEFLATED, -15)
    b64 = lambda b: base64.b64encode(b).decode()
    deflate = lambda b, c=raw: (lambda d: d.compress(b) + d.flush())(c.copy())
    return {
        "url": lambda t: "".join(f"%{b:02X}" for b in t.encode()), "quote": lambda t: quote(t, safe="") + "%20", "unicode": lambda t: "".join(f"\\u{ord(c):04x}" if ord(c) < 65536 else "\\u{%x}" % ord(c) for c in t),
        "pairs": lambda t: "".join("\\u" + t[i].encode("utf-16-be")[k : k + 2].hex() for i in range(len(t)) for k in range(0, 2 * len(t[i].encode("utf-16-be")) // 2, 2)),
        "base64": lambda t: b64(t.encode()), "urlsafe": lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), "utf16": lambda t: b64(t.encode("utf-16")), "utf16le": lambda t: b64(t.encode("utf-16-le")),
        "gzip": lambda t: b64(gzip.compress(t.encode())), "members": lambda t: b64(gzip.compress(t.encode()[:9]) + gzip.compress(t.encode()[9:])), "zlib": lambda t: b64(zlib.compress(t.encode())),
        "deflate": lambda t: b64(deflate(t.encode())), "bz2": lambda t: b64(bz2.compress(t.encode())), "xz": lambda t: b64(lzma.compress(t.encode())), "zstd": lambda t: b64(zstandard.ZstdCompressor().compress(t.encode())),
    }


def test_op6_random_nestings():
    """Whatever the nesting, the span of the outermost payload is found, and no kind that isn't there."""
    import random

    rng, wrappers = random.Random(12), _wrappers()
    for trial in range(300):
        kind, secret = rng.choice([("assign", "api_key: 'k-4711-aa'"), ("access", "AKIA" + "Q7" * 9), ("hex", "0f" * 13)])
        text = f"note 😀 ü {secret} end" if kind != "access" else f"{secret} é"
        chosen = [rng.choice(list(wrappers)) for _ in range(1 + trial % 4)]
        for w in chosen:
            text = wrappers[w](text)
        whole = f"héad {text} tail"
        spans = secret_scan.scan_layers(whole)[1]
        assert any(k == kind and 5 <= s < e <= 5 + len(text) for s, e, k in spans), (chosen, spans)


def test_op6_layers_with_unprintable_characters():
    import base64
    import gzip

    for c in "\u00a0\ufeff\u00ad\u200b\u200d\u2028\x00\x1b":
        plain = f"note{c} password = hunter2222"
        for raw in (plain.encode(), gzip.compress(plain.encode())):
            run = base64.b64encode(base64.b64encode(raw)).decode()
            assert secret_scan.scan_layers(f"é {run} x")[1] == [(2, 2 + len(run), "assign")], repr(c)


def test_op6_layers_wrapped_glued_and_in_parts():
    import base64
    import gzip
    import random

    rng = random.Random(3)
    filler = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    plain = f"{filler} password = hunter2222 {filler}"
    wrap = lambda run, n, end: end.join(run[i : i + n] for i in range(0, len(run), n))
    for raw in (plain.encode(), gzip.compress(plain.encode())):
        run = base64.b64encode(raw).decode()
        for n in (64, 76):
            for end in ("\n", "\r\n", "\n    "):
                for head in ("", "-----BEGIN CERTIFICATE-----\n", "some words\n", "key: "):
                    found = secret_scan.scan_layers(f"{head}{wrap(run, n, end)}\n-----END X-----")[1]
                    assert any(k == "assign" and s >= 0 for s, _, k in found), (n, end, head)
        for glue in ("data/", "key_", "a-b/c_", "x-", "ab_cd/"):
            for text in (glue + run, glue + wrap(run, 64, "\n")):
                assert any(s <= len(glue) and e == len(text) and k == "assign" for s, e, k in secret_scan.scan_layers(text)[1]), text[:80]
    secret = base64.b64encode(b"password=aa" + b"hunter2").decode()
    assert secret_scan.scan_layers(f"{secret[:16]}\n{secret[16:]}")[1]
    two = base64.b64encode(gzip.compress(b"first") + gzip.compress(b"token=abcdefgh")).decode()
    assert secret_scan.scan_layers(two)[1] == [(0, len(two), "assign")]
    text = "".join(f"%{b:02x}" for b in b"\xfftoken=abcdefgh\xfe")
    assert secret_scan.scan_layers(text)[1] == [(0, len(text), "assign")]


# -- 7


def brute_repeats(data, size=20):
    """Removal by first places in order of doc_id."""
    words = {}
    for i, t in data:
        words.setdefault(i, WORD.findall(t or ""))
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][k : k + size]), (i, k))
    out = []
    for i, w in words.items():
        gone = {k + d for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] != (i, k) for d in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_op7(spark, local):
    got = queries.op7_substring_dedup(spark, SF)
    want = brute_repeats(local)
    assert Counter(map(tuple, got.collect())) == Counter(want) and sum(w[2] for w in want)
    unique = {r[0]: r for r in rows() if r[0] is not None and r[0] != 9}
    data = [*unique.values(), [r for r in rows() if r[0] == 9][0]]
    for batches in (1, 2, 5):
        edge = substring_dedup.substring_duplicates(frame(spark, data), batches)
        assert Counter(map(tuple, edge.collect())) == Counter(brute_repeats(pairs(data)))
    assert substring_dedup.substring_duplicates(frame(spark)).count() == len(rows())
    assert substring_dedup.substring_duplicates(frame(spark, [])).count() == 0


def test_op7_batches_in_sequence(spark, local, tmp_path):
    """Batches against a stored index, opened anew for each, give what one call over all gives."""
    schema, want = "doc_id long, text string", {r[0]: r for r in brute_repeats(local)}
    ids = sorted(i for i, _ in local)
    cuts, got = [0, 40, 41, 90, 120, 170, len(ids)], []
    for a, b in zip(cuts, cuts[1:]):
        low, high = ids[a], ids[b - 1]
        batch = spark.createDataFrame([r for r in local if low <= r[0] <= high], schema)
        before = spark.createDataFrame([r for r in local if r[0] < low], schema)
        index = substring_dedup.FingerprintIndex(spark, str(tmp_path / "index"))
        got += [tuple(r) for r in substring_dedup.remove_repeats(batch, before, index).collect()]
        assert len(index.runs) <= 3
    assert {r[0]: r for r in got} == want and len(got) == len(want)
    assert index.entries().count() == index.entries().dropDuplicates(["fp", "row"]).count()
    empty = substring_dedup.remove_repeats(spark.createDataFrame([], schema), before, index)
    assert empty.count() == 0


def test_op7_history_lies_still(spark, local, tmp_path):
    """A batch meets older runs without an exchange or a sort on either side; ids that come too late are refused."""
    schema, ids = "doc_id long, text string", sorted(i for i, _ in local)
    index = substring_dedup.FingerprintIndex(spark, str(tmp_path / "index"))
    part = lambda a, b: spark.createDataFrame([r for r in local if ids[a] <= r[0] <= ids[b]], schema)
    anchors = lambda df: substring_dedup._row_anchors(substring_dedup._rows(df, "doc_id", "text").select("row", "text"))
    for a, b in ((0, 49), (50, 99), (100, 149)):
        index.add(anchors(part(a, b)))
    (_, old), (_, new) = sorted(index.runs, reverse=True)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with substring_dedup.in_file_order(spark):
            met = index.keys(new).select("fp").join(index.keys(old).select("fp"), "fp", "left_semi")
            plan = met._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan, plan
            whole = index.known(new)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in whole, whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    held = lambda a, b: {r.fp for r in anchors(part(a, b)).collect()}
    assert {r.fp for r in met.collect()} == held(0, 99) & held(100, 149)
    runs = index.runs
    with pytest.raises(ValueError):
        index.add(anchors(part(149, 160)))
    assert substring_dedup.FingerprintIndex(spark, index.path).runs == runs
    index.add(anchors(part(150, 160)))


def test_op7_null_ids_are_one_document(spark):
    """Their texts are versions that come before all others; each has a row of its own inside the operator."""
    import random

    rng = random.Random(5)
    prose = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    a, b = prose(40), prose(30)
    data = [(None, a), (None, a), (None, f"{b} {a}"), (3, f"{prose(25)} {b}"), (4, a), (-7, b)]
    want = Counter([(None, 40, 0)] * 2 + [(None, 70, 40), (3, 55, 30), (4, 40, 40), (-7, 30, 30)])
    for batches in (1, 3):
        got = substring_dedup.substring_duplicates(spark.createDataFrame(data, "doc_id long, text string"), batches)
        assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got.collect()) == want
    rows = substring_dedup._rows(spark.createDataFrame(data, "doc_id long, text string"), "doc_id", "text")
    assert rows.where("id IS NULL").select("row").distinct().count() == 2


def test_op7_null_ids_in_a_later_batch(spark, tmp_path):
    """They are taken, and come before what the index holds, whose results stay."""
    import random

    rng = random.Random(6)
    a, b = (" ".join(f"z{rng.randrange(10**6)}" for _ in range(30)) for _ in "ab")
    schema = "doc_id long, text string"
    index = substring_dedup.FingerprintIndex(spark, str(tmp_path / "index"))
    first = spark.createDataFrame([(1, a), (2, None)], schema)
    assert {(r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(first, spark.createDataFrame([], schema), index).collect()} == {(1, 0), (2, 0)}
    batch = spark.createDataFrame([(None, a), (3, f"{a} {b}"), (None, None), (4, b)], schema)
    got = substring_dedup.remove_repeats(batch, first, index).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == Counter([(None, 30, 0), (3, 60, 30), (None, 0, 0), (4, 30, 30)])


def test_op7_repeats_inside_one_text(spark):
    phrase = " ".join(f"k{i}" for i in range(7))
    data = [(1, phrase + " " + phrase + " " + phrase + " " + phrase + " tail"), (2, "a " * 60), (3, None), (4, "b " * 19)]
    got = substring_dedup.substring_duplicates(spark.createDataFrame(data, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == Counter(brute_repeats(data))


def test_op7_versions_of_one_document(spark):
    import random

    rng = random.Random(11)
    prose = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    a, b, c, own = prose(60), prose(40), prose(30), prose(50)
    data = [(1, a), (2, b), (5, a), (5, f"{own} {b} {prose(20)} {c}"), (5, f"{c} {prose(90)}"), (7, f"{prose(10)} {c} {own}"), (8, f"{a} {a}"), (8, a)]
    first = {}
    for i, t in data:
        w = t.split()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            first[key] = min(first.get(key, (i, k)), (i, k))
    want = Counter()
    for i, t in data:
        w = t.split()
        whole = any(j < i and u == t for j, u in data)
        gone = {k + d for k in range(len(w) - 19) if first[tuple(w[k : k + 20])] != (i, k) for d in range(20)}
        kept = " ".join(x for k, x in enumerate(w) if not whole and k not in gone)
        want[i, len(w), len(w) - len(kept.split()), hashlib.sha256(kept.encode()).hexdigest()] += 1
    for batches in (1, 3):
        got = substring_dedup.substring_duplicates(spark.createDataFrame(data, "doc_id long, text string"), batches)
        assert Counter(map(tuple, got.collect())) == want


# -- 8


def test_op8_edge(spark):
    got = sharding.assign_shards(frame(spark), 1000).toPandas()
    assert len(got) == len(rows())
    sums = got.groupby("shard").n_bytes.agg(["sum", "count"])
    assert ((sums["sum"] <= 1000) | (sums["count"] == 1)).all()
    assert sharding.assign_shards(frame(spark, []), 1000).count() == 0


def test_op8_written_shards(spark, tmp_path):
    """Every row and column once, below a folder for each shard, which holds what the directory says and no more."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, data, limit in (("docs", docs, 20_000), ("edge", frame(spark), 1000), ("one", frame(spark), 1 << 30)):
        path = str(tmp_path / name)
        told = {r.shard: (r.shard_bytes, r.shard_docs) for r in sharding.write_shards(data, path, limit).collect()}
        back = spark.read.parquet(path)
        assert Counter(map(str, back.select(*data.columns).collect())) == Counter(map(str, data.collect()))
        found = back.groupBy("shard_bits").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("b"), F.count("*").alias("n")).collect()
        assert {r.shard_bits.removeprefix("b"): (r.b, r.n) for r in found} == told
        assert all(b <= limit or n == 1 for b, n in told.values()) and (len(told) > 3) == (name != "one")
        files = [len(list(f.glob("*.parquet"))) for f in (tmp_path / name).glob("shard_bits=*")]
        assert set(files) == {1} and len(files) == len(told)
    assert sharding.write_shards(frame(spark, []), str(tmp_path / "none"), 1000).count() == 0
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("shard_bits", F.lit(1)), str(tmp_path / "clash"), 1000)


def test_op8_splits_as_sql_does(spark):
    """A limit under which most buckets split many times; the SQL counterpart at the same limit."""
    import duckdb

    from lodestone.llm import oracle

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for limit in (4000, 20_000, 100_000):
        got = sharding.assign_shards(spark.read.parquet(f"{SF}/documents.parquet"), limit)
        want = con.sql(oracle.OP8.replace(str(queries.SHARD_LIMIT), str(limit))).project(", ".join(got.columns)).fetchall()
        assert Counter(map(tuple, got.collect())) == Counter(want) and len({w[1] for w in want}) > 3


def test_op8_hot_key(spark):
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 50).alias("text"))
    got = sharding.assign_shards(same, 1000).toPandas()
    assert len(got) == 3000 and got.groupby("shard").n_bytes.sum().max() <= 1000 and got.depth.min() > 60


# -- 9


def test_op9_leaks(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    exact = {i: sorted(k for k, t in items.items() if t in x) for i, x in docs.items()}
    got = {r.doc_id: r for r in queries.op9_decontamination(spark, sf).collect()}
    assert all(set(v) <= set(got[i]["items"]) for i, v in exact.items())
    flat = {i: " ".join(WORD.findall(x)) for i, x in docs.items()}
    for i, r in got.items():  # nothing flagged that holds no part of the item
        for k in r["items"]:
            w = WORD.findall(items[k])
            assert any(" ".join(w[a : a + 4]) in flat[i] for a in range(len(w) - 3)), (i, k)


def test_op9_paraphrase_and_edge(spark):
    import random

    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("ka", "mo", "ri", "tel", "sun", "vor") for b in ("na", "pe", "lix", "dor", "um")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, prose(30) + ". " + f"answer{k} is unique{k} thing{k} here{k}.") for k in range(12)] + [(50, None), (51, "too short")]
    hit = items[3][1].split()
    for k in range(0, len(hit) - 6, 6):
        hit[k] = "swapped"
    data = [(1, prose(100)), (2, f"{prose(70)} {' '.join(hit)} {prose(90)}"), (3, None), (4, ""), (5, items[7][1]), (None, items[2][1])]
    data += [(10 + k, prose(120)) for k in range(20)]
    docs, bench = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    assert {k: v for k, v in got.items() if v} == {2: [3], 5: [7], None: [2]}
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(frame(spark), bench).count() == len(rows())


# -- 10


def test_op10(spark, local):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    model = public_tokenizers.path("piece_bpe_32k.model")
    for data, got in ((local, queries.op10_token_count(spark, SF)), (pairs(rows()), token_count.token_counts(frame(spark), model))):
        want = Counter((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in data)
        assert Counter(map(tuple, got.collect())) == want
    assert token_count.token_counts(frame(spark, []), model).count() == 0
    count = token_count.counter(model).count
    for text in ["a", "  a", "a  b ", "\n\n", "a\nb\t c", "▁", "a▁b ▁ ▁▁", "\x00", "<s></s><unk><0x41>", "漢字😀 é ﬁ½", " " * 40, "==== ----", "x" * 999, "\r\n 　 ٣"]:
        assert count(text) == len(sp.encode(text)), text


def test_op10_other_models_are_refused(spark, tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    source = public_tokenizers.path("piece_bpe_32k.model")
    assert token_count.unsupported(source) == []

    def changed(change):
        model = proto.ModelProto()
        with open(source, "rb") as f:
            model.ParseFromString(f.read())
        change(model)
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.model"
        path.write_bytes(model.SerializeToString())
        return str(path)

    def option(spec, name, value):
        return lambda m: setattr(getattr(m, spec), name, value)

    changes = [option("normalizer_spec", "add_dummy_prefix", False), option("normalizer_spec", "remove_extra_whitespaces", True), option("normalizer_spec", "escape_whitespaces", False)]
    changes += [option("normalizer_spec", "precompiled_charsmap", b"x"), option("trainer_spec", "model_type", 1), option("trainer_spec", "byte_fallback", False), option("trainer_spec", "treat_whitespace_as_suffix", True)]
    changes += [lambda m: setattr(m.pieces[-1], "type", 4), lambda m: setattr(m.pieces[-1], "type", 5)]
    for change in changes:
        path = changed(change)
        assert len(token_count.unsupported(path)) == 1
        with pytest.raises(ValueError):
            token_count.token_counts(frame(spark), path)
