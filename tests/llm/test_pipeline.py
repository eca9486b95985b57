"""The pipeline against its stages one by one, and against what was planted."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from edge import frame

import corpus_pipeline
from lodestone.llm import mixing, quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen[name] = rows
    assert {r.doc_id for r in seen["quality rules"]} == {r.doc_id for r in quality_rules.quality_verdicts(spark.read.parquet(f"{SF}/documents.parquet")).where("kept").collect()}
    sets = [set(zip(*[WORD.findall(r.text.lower())[k:] for k in range(5)])) for r in seen["near dedup"]]
    for i, a in enumerate(sets):
        assert all(5 * len(a & b) < 4 * len(a | b) for b in sets[:i])
    assert not any(t in r.text for r in seen["decontamination"] for t in items)
    assert {r.doc_id for r in seen["mixing"]} == {r.doc_id for r in seen["decontamination"]}
    t, out = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for r in sorted(seen["mixing"], key=lambda r: r.doc_id):
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 2]
        out.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert got == sorted(out)
    assert got == sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())


def test_edge_rows_pass_every_stage(spark):
    """Each stage keeps what its rule keeps of the edge rows, in whole rows; empty tables pass all."""
    from test_operators import brute_near, brute_stats

    docs = frame(spark)
    rows = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, SF).collect()
    fit = [r for r in rows if not brute_stats(r.text)[-1]]
    assert not Counter(good) - Counter(fit) and len(good) >= len(fit) - 2  # of 20 rows one text is all of one word
    unlike = stages["near dedup"](spark, docs, SF).collect()
    kept = Counter(r[0] for r in brute_near([(r.doc_id, r.text) for r in rows], 80) if r[3])
    assert {r.doc_id for r in unlike} == set(kept) and not Counter(unlike) - Counter(rows)
    assert Counter(r.doc_id for r in unlike) == Counter({i: n if i is None else 1 for i, n in kept.items()})
    assert Counter(stages["decontamination"](spark, docs, SF).collect()) == Counter(rows)
    mix = Counter(stages["mixing"](spark, docs, SF).collect())
    assert set(mix) == set(rows) and all(n <= mix[r] <= 2 * n for r, n in Counter(rows).items())
    tokens = stages["token output"](spark, docs, SF).collect()
    assert Counter(r.doc_id for r in tokens) == Counter(r.doc_id for r in rows)
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_tokens_follow_the_mix(spark, tmp_path):
    """The token files hold the rows in the order that the mix gave them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix = mixing.mixed(docs, max_repeats=2.0)
    want = sorted((r["__mix"].position, r.doc_id) for r in mix.select("doc_id", "__mix").collect())
    corpus_pipeline.mix_sources(spark, docs, SF).write.parquet(path := str(tmp_path / "mix"))
    got = corpus_pipeline.write_tokens(spark, spark.read.parquet(path), SF).orderBy("start").collect()
    places = dict.fromkeys((i for _, i in want), None)
    assert len(got) == len(want) and [r.doc_id for r in got] != sorted(r.doc_id for r in got) and len(places) == len({r.doc_id for r in got})
    blocks = {}
    for p, i in want:
        blocks.setdefault(p, Counter())[i] += 1
    at = 0
    for p in sorted(blocks):  # rows of a block share a position
        n = sum(blocks[p].values())
        assert Counter(r.doc_id for r in got[at : at + n]) == blocks[p]
        at += n
