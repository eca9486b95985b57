"""Recall of decontamination against brute-force subsequences, by item length and share of words replaced."""

import random
import re
import time

import pyarrow as pa
import pytest

from lodestone.llm import decontaminate

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def space(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    matrix = decontaminate.latent_space(docs, bench, "doc_id", "text", "text")
    items = [(r.item_id, r.text) for r in bench.orderBy("item_id").collect()]
    hosts = [r.text.split() for r in docs.orderBy("doc_id").collect() if len((r.text or "").split()) > 150]
    return decontaminate.Items(items, matrix), items, hosts


def hashes(text):
    return next(decontaminate.words_of(pa.array([text]))).tolist()


def trials(items, hosts, share, each):
    """Item id, words and a long text that holds the item at a random place with a share of its words replaced, if brute force accepts it."""
    rng = random.Random(5)
    for k, text in items:
        item = hashes(text)
        answer = set(hashes([s for s in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if s.strip()][-1]))
        for _ in range(each):
            copy, host, other = text.split(), rng.choice(hosts), rng.choice(hosts)
            for i in rng.sample(range(len(copy)), round(share * len(copy))):
                copy[i] = rng.choice(other)
            at = rng.randrange(len(host) + 1)
            words = hashes(" ".join(copy))
            n = decontaminate.common_subsequence(item, words)
            if n >= 0.75 * len(item) or n >= 0.5 * len(item) and len(answer & set(words)) >= 0.6 * len(answer):
                yield k, len(item), " ".join(host[:at] + copy + host[at:])


def recall(space, share, least=8, most=10**9):
    ready, items, hosts = space
    made = [t for t in trials(items, hosts, share, 12) if least <= t[1] < most]
    assert len(made) > 50
    found = ready.found_in(pa.array([t[2] for t in made]))
    return sum(t[0] in f for t, f in zip(made, found)) / len(made)


def test_op9_recall_of_long_items(space):
    assert recall(space, 0.25, 32) > 0.99
    assert recall(space, 0.4, 32) > 0.98
    assert recall(space, 0.5, 32) > 0.88


def test_op9_recall_of_short_items(space):
    """Items that no passage of WINDOW words must contain."""
    for share, least in ((0, 1), (0.2, 0.99), (0.25, 0.97), (0.4, 0.93)):
        assert recall(space, share, 8, 32) >= least, share
        assert recall(space, share, 32, 48) >= least, share


def test_op9_bounds_leave_out_no_match(space):
    """Every passage around which brute force over all items accepts one passes both exact bounds."""
    ready, items, hosts = space
    for share in (0.25, 0.5):
        for k, _, text in trials(items, hosts, share, 2):
            words = next(decontaminate.words_of(pa.array([text])))
            possible = dict(ready.possible(words))
            met = {i: [s for s in range(0, len(words) - 12, decontaminate.STRIDE) if ready.matches(words, s, i)] for i in range(len(ready.ids))}
            assert all(set(s) <= set((possible[i] * decontaminate.STRIDE).tolist()) for i, s in met.items() if s)
            assert k in [ready.ids[i] for i, s in met.items() if s]


def test_op9_blocks_of_items(spark, monkeypatch):
    """Several passes over the documents find what one finds."""
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", bench.selectExpr("sum(length(text))").first()[0] // 3)
    got = {r.doc_id: r["items"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == want and any(want.values())


def test_op9_texts_are_searched_together(space, monkeypatch):
    """Runs of texts give what each text alone gives, in less than half its time; so do runs of few words."""
    ready, items, hosts = space
    texts = pa.array([" ".join(h) for h in hosts] + [t for _, _, t in trials(items, hosts, 0.3, 1)] + [None, "", "too short"], pa.string())
    took = [time.process_time()]
    alone = [ready.found_in(texts.slice(i, 1))[0] for i in range(len(texts))]
    took.append(time.process_time())
    assert ready.found_in(texts) == alone and any(alone)
    took.append(time.process_time())
    assert 2 * (took[2] - took[1]) < took[1] - took[0]
    monkeypatch.setattr(decontaminate, "RUN_WORDS", 5000)
    monkeypatch.setattr(decontaminate, "RUN_FLAGS", 1)
    some = texts.slice(len(texts) - 60)
    assert ready.found_in(some) == alone[-60:]
