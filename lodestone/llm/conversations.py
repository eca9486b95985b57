"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

A conversation's rows become a signature with a letter a row: its role and its fault. The signatures that occur, each
once, are sorted over all tasks, so that those with a common prefix follow each other. A task walks them as a prefix
trie: it keeps the layers of the dynamic programme of the signature before, goes back to the common prefix, and computes
layers from there on alone. Answers are read at the terminal nodes and joined back.

A layer has an entry for each state of the pattern (s?(ua)+)?: cost, rank among the layer's entries by their edits, and
where it came from. Two different ways to the same row never have edits of which one begins the other, so ranks decide
ties as whole strings would, and a layer takes the same room however long the conversation is.

Facts go without texts through a first shuffle by conversation, texts through a second one, in which each conversation
starts with its answer. Both are sorted runs that tasks stream through: a conversation of any length takes a letter a row
in memory. One task reads all of one conversation, as its hash is sequential.

Defined results: a null or empty table of conversations gives no rows; null roles and texts are one space, which in the
id of a damage stands for a null conv_id or turn too; a null conv_id is a conversation of its own; rows of one turn go by
role and the text's MD5; repeated rows are duplicates; gaps saturate at the largest long; roles whose first character is
none of s, u, a (an empty role too) must be changed or deleted; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, materialize

BLANKS = " \t\n\x0b\x0c\r"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

RELABEL, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: A row's letter: its role's initial, in capitals where the text is cut off; o stands for other roles, d for rows that must go.
LETTERS = "suaoSUAOd"
#: States: nothing yet, after a system turn, after the user, after the assistant. The last column: where a turn of s, u, a leads.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the turn that may be inserted or made by a new role


def _moves() -> dict[str, list[tuple[int, int, int, str]]]:
    """For each letter: (state before, state after, cost, edits) of up to two insertions and what becomes of the row."""
    moves: dict[str, list[tuple[int, int, int, str]]] = {}
    for letter in LETTERS:
        role, extra, out = letter.lower(), CUT_OFF * letter.isupper(), []
        for start in range(4):
            state = start
            for inserted in range(3):
                cost, edits = INSERT * inserted, "I" * inserted
                out.append((start, state, cost + DELETE, edits + "D"))
                if letter != "d":
                    if (state, role) in STEP:
                        out.append((start, STEP[state, role], cost + extra, edits + "K"))
                    out.append((start, STEP[state, NEXT[state]], cost + extra + RELABEL, edits + "R"))
                state = STEP[state, NEXT[state]]
        moves[letter] = out
    return moves


MOVES = _moves()
ENDS = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

#: Entries by state, None where none: (cost, rank, state before, edits).
Layer = list
ROOT: Layer = [(0, 0, 0, ""), None, None, None]


def next_layer(layer: Layer, letter: str) -> Layer:
    best: list = [None] * 4
    for start, state, cost, edits in MOVES[letter]:
        entry = layer[start]
        if entry is not None:
            found = (entry[0] + cost, entry[1], edits, start)
            if best[state] is None or found < best[state]:
                best[state] = found
    order = sorted((x[1], x[2], q) for q, x in enumerate(best) if x is not None)
    rank = {q: r for r, (_, _, q) in enumerate(order)}
    return [x and (x[0], rank[q], x[3], x[2]) for q, x in enumerate(best)]


def read_answer(layers: list[Layer]) -> tuple[int, str]:
    """Cost and edits of the cheapest way through all layers."""
    last = layers[-1]
    cost, _, edits, state = min((e[0] + INSERT * len(ENDS[q]), e[1], ENDS[q], q) for q, e in enumerate(last) if e is not None)
    parts = [edits]
    for layer in reversed(layers[1:]):
        _, _, before, made = layer[state]
        parts.append(made)
        state = before
    return cost, "".join(reversed(parts))


def walk(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """signature, cost, edits of sorted signatures: layers of a prefix shared with the one before are kept."""
    before, layers = "", [ROOT]
    for signature in signatures:
        n = min(len(before), len(signature))
        shared = n if before[:n] == signature[:n] else next(i for i in range(n) if before[i] != signature[i])
        del layers[shared + 1 :]
        for letter in signature[shared:]:
            layers.append(next_layer(layers[-1], letter))
        before = signature
        yield signature, *read_answer(layers)


def answers(signatures: DataFrame) -> DataFrame:
    """signature, cost, audit of every different value of signature; equal ones are put together before they are shuffled."""
    n = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = signatures.select("signature").distinct().repartitionByRange(n, "signature").sortWithinPartitions("signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for found in walk(s for batch in batches for s in batch.column(0).to_pylist()):
            rows.append(found)
            size += len(found[0]) + len(found[2])
            if len(rows) == 10_000 or size > 4 << 20:
                yield _batch(rows, ["signature", "cost", "audit"], [pa.string(), pa.int64(), pa.string()])
                rows, size = [], 0
        yield _batch(rows, ["signature", "cost", "audit"], [pa.string(), pa.int64(), pa.string()])

    return once.mapInArrow(run, "signature string, cost long, audit string")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after damage, with n: how often each is there, 0 where it is dropped."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(written("text"), ".!?", "")).otherwise(written("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(written("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"))


def _facts(rows: DataFrame) -> DataFrame:
    """conv_id, turn, initial, letter, blank, duplicate, cut of every row by conversation and turn; a dropped row has a null letter."""
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    small = rows.select("conv_id", "turn", "role", F.md5("text").alias("key"), (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"), "n")
    each = small.withColumn("n", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), "n")).otherwise(F.array(F.lit(0)))))
    # The window's keys contain that of the shuffle, so rows move once; only equal rows meet in a window.
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "key", F.col("n") == 0).orderBy("turn", "n"))
    dealt = each.repartition("conv_id").withColumn("seen", seen)
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    duplicate = ~F.col("blank") & (F.col("seen") > 1)
    letter = F.when(F.col("n") == 0, F.lit(None)).when(F.col("blank") | duplicate, "d").when(F.col("cut"), F.upper(initial)).otherwise(initial)
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "key", "n"]
    return dealt.sortWithinPartitions(*order).select("conv_id", "turn", initial.alias("initial"), letter.alias("letter"), "blank", duplicate.alias("duplicate"))


LEGAL = {b"su", b"ua", b"au"}
LARGEST = 2**63 - 1


def measured(rows: DataFrame) -> DataFrame:
    """A row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal and its signature, from damaged rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]
        conv_type, done, now = None, [], None
        types = lambda: [conv_type, *[pa.int64()] * 5, pa.string()]

        def result() -> tuple:
            conv, least, most, turns, _, blank, duplicate, truncated, illegal, _, letters = now
            gaps = min(most - least + 1 - turns, LARGEST) if turns else 0
            return conv, gaps, blank, duplicate, truncated, illegal, letters.decode()

        for batch in batches:
            conv_type = batch.column(0).type
            for conv, turn, initial, letter, blank, duplicate in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now[0]:
                    if now is not None:
                        done.append(result())
                    #     id, least turn, greatest, different ones, last one, blank, duplicate, truncated, illegal, last initial, letters
                    now = [conv, None, None, 0, None, 0, 0, 0, 0, None, bytearray()]
                if letter is None:
                    continue
                if turn is not None:
                    now[1] = turn if now[1] is None else now[1]
                    now[3] += turn != now[4]
                    now[2] = now[4] = turn
                now[5] += blank
                now[6] += duplicate
                now[7] += letter.isupper()
                initial = initial.encode()
                now[8] += now[9] is not None and now[9] + initial not in LEGAL
                now[9] = initial
                now[10] += letter.encode()
            yield _batch(done, names, types())
            done = []
        if now is not None:
            yield _batch([result()], names, types())

    return _facts(rows).mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, signature string")


class _Repair:
    """A conversation's repaired text, hashed row by row as its damaged rows come by."""

    def __init__(self, header: tuple):
        self.header, self.audit = header, header[-1]
        self.hash, self.at, self.made, self.system = hashlib.sha256(), 0, 0, (len(self.audit) - self.audit.count("D")) % 2

    def add(self, role: str | None, text: str | None) -> None:
        if self.made:
            self.hash.update(b"\n")
        if role is None:
            role = "user" if (self.made - self.system) % 2 == 0 else "assistant"
        self.hash.update(f"{role}:{text}".encode())
        self.made += 1

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.add(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.add(role if edit == "K" else None, text)

    def result(self) -> tuple:
        self.insertions()
        return *self.header, self.hash.hexdigest()


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id and RESULT of every conversation in rows (conv_id, turn, role, text), which are damaged first."""
    bound_batches(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    broken = damaged(rows)
    facts = materialize(measured(broken), "conversation-facts")
    solved = materialize(answers(facts), "conversation-answers")
    headers = facts.join(solved, "signature").select("conv_id", F.lit(None).cast(broken.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.struct("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").alias("header"))
    texts = broken.where("n > 0").withColumn("n", F.explode(F.sequence(F.lit(1), "n"))).drop("n").withColumn("header", F.lit(None).cast(headers.schema["header"].dataType))
    order: list[str | Column] = ["conv_id", F.isnull("header"), F.asc_nulls_first("turn"), "role", F.md5("text")]
    dealt = headers.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(x.split()[0] for x in RESULT.split(", "))]
        conv_type, done, now = None, [], None
        types = lambda: [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        for batch in batches:
            conv_type = batch.column(0).type
            for conv, role, text, header in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "header")), strict=True):
                if header is None:
                    now.row(role, text)
                    continue
                if now is not None:
                    done.append(now.result())
                now = _Repair((conv, *header.values()))
            yield _batch(done, names, types())
            done = []
        if now is not None:
            yield _batch([now.result()], names, types())

    return dealt.mapInArrow(run, f"conv_id {kind}, {RESULT}")
