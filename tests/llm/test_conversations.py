"""Conversation repair against a brute-force version that compares whole strings of edits."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

from lodestone.llm import conversations, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, letter string, header string, n string"
BLANK = re.compile("[\x20\x09-\x0d]*")


def cheapest(rows):
    """cost, edits of (initial, cut, must go): every way from each row on, as whole strings."""

    @lru_cache(None)
    def after(i, state, inserted):
        ways = []
        if i == len(rows) and state in "ea":
            ways.append((0, ""))
        to = "a" if state == "u" else "u"
        if inserted < 3:
            c, e = after(i, to, inserted + 1)
            ways.append((c + 3, "I" + e))
        if i < len(rows):
            initial, cut, gone = rows[i]
            c, e = after(i + 1, state, 0)
            ways.append((c + 4, "D" + e))
            if not gone:
                if initial == to or (initial == "s" and state == "e"):
                    c, e = after(i + 1, initial, 0)
                    ways.append((c + 3 * cut, "K" + e))
                c, e = after(i + 1, to, 0)
                ways.append((c + 3 + 3 * cut, "R" + e))
        return min(ways, default=(10**9, ""))

    sys.setrecursionlimit(20_000)
    return after(0, "e", 0)


def brute(data):
    convs = defaultdict(list)
    show = lambda x: " " if x is None else str(x)
    for conv, turn, role, text, *_ in data:
        convs[conv]
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if kind == 0:
            continue
        row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        convs[conv] += [row] * (2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            plain = re.sub("[\x20\x09-\x0d]+$", "", text)
            fault = 0 if not plain else 1 if (role, text) in seen else 2 if plain[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marks.append((role[:1], fault == 2, fault in (0, 1)))
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = cheapest(tuple(marks))
        made, k = [], 0
        total = len(audit.replace("D", ""))
        for e in audit:
            role = "user" if (total - len(made)) % 2 == 0 else "assistant"
            if e == "I":
                made.append((role, ""))
                continue
            if e != "D":
                made.append((rows[k][1] if e == "K" else role, rows[k][2]))
            k += 1
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def result(frame):
    rows = [tuple(r[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_op11(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op11_conversation_repair(spark, SF)) == brute(data)


def test_op11_random_and_edge(spark):
    rng = random.Random(3)
    roles, texts = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "sue", "User"], ["Yes.", "No!", "Why?", "and then", "", " \t\n", "one. two", "x" * 50 + ".", None, "é。", "no"]
    row = lambda conv, turn: (conv, turn, rng.choice(roles), rng.choice(texts), "a", "b", "c")
    data = [row(conv, turn) for conv in range(120) for turn in range(rng.randrange(9))]
    data += [row(500, 7 * k) for k in range(400)]  # a long one
    data += [row(501, None), row(501, None), row(501, 3), row(501, 3), row(None, 1), row(None, None), row(None, 2)]
    data += [(502, t, None, None, None, None, None) for t in (None, -(2**63), 2**63 - 1)]
    data += [data[5]] * 3
    rng.shuffle(data)
    want = {k: (min(v[0], 2**63 - 1), *v[1:]) for k, v in brute(data).items()}
    assert result(conversations.repairs(spark.createDataFrame(data, SCHEMA))) == want
    assert conversations.repairs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_op11_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    out = result(conversations.repairs(spark.createDataFrame([(1, turn, "user", "Hi.", "", "", "")], SCHEMA)))
    assert out == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_op11_shared_prefixes_are_computed_once(monkeypatch):
    made, real = [], conversations.next_layer
    monkeypatch.setattr(conversations, "next_layer", lambda layer, letter: made.append(letter) or real(layer, letter))
    signatures = sorted({"uaua", "uauad", "uaUa", "suaua", "", "suau", "o"})
    found = list(conversations.walk(iter(signatures)))
    prefixes = {s[:k] for s in signatures for k in range(1, len(s) + 1)}
    assert len(made) == len(prefixes)
    for signature, cost, audit in found:
        assert (cost, audit) == cheapest(tuple((x.lower(), x.isupper(), x == "d") for x in signature))


def test_op11_random_signatures():
    rng = random.Random(9)
    signatures = sorted({"".join(rng.choice("suaoSUAOd") for _ in range(rng.randrange(12))) for _ in range(1500)})
    for signature, cost, audit in conversations.walk(iter(signatures)):
        assert (cost, audit) == cheapest(tuple((x.lower(), x.isupper(), x == "d") for x in signature)), signature
