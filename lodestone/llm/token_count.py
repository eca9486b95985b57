"""Token counts by heap-and-linked-list byte-pair merging, without emitting identifiers.

A text's count is its initial symbols minus the merges made: symbols sit in a linked list, and
the adjacent pair of lowest rank (leftmost among equals) is popped from a heap until no pair is a
piece of the vocabulary. A symbol that is no piece falls back to its UTF-8 bytes and weighs that many.

No piece of the vocabulary holds a word mark after another character or holds a line feed, so
merges never cross those places. Texts are therefore cut there and counts of short cuts are kept in
a bounded table per Python worker, where most words of a corpus are found again.

What this rests on is read from the model before anything is counted: byte-pair merges with byte fallback, texts
as they are but for a word mark in front and in place of spaces, and none but plain pieces. A model with other options
is refused.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null doc_id stays null;
repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re

from pyspark.sql import DataFrame

from lodestone.llm.common import map_rows

MARK = "▁"
KEEP = 400_000  # cuts whose counts a worker remembers
KEEP_CHARS = 48  # longer cuts are counted anew each time
_CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class PieceCounter:
    """Counts tokens as a piece vocabulary of scored merges with byte fallback gives them."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.scores = {
            sp.id_to_piece(i): sp.get_score(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        }
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.scores):
            raise ValueError("pieces cross word marks or lines; texts can't be cut there")
        self.known: dict[str, int] = {}

    def weight(self, symbol: str) -> int:
        return 1 if symbol in self.scores else len(symbol.encode())

    def merge_count(self, cut: str) -> int:
        scores, n = self.scores, len(cut)
        if cut in scores and n == 1:
            return 1
        symbols = list(cut)
        total = sum(map(self.weight, symbols))
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(-s, i, p) for i in range(n - 1) if (s := scores.get(p := symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left = symbols[i]
            j = after[i]
            if left is None or j < 0 or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
                continue  # one side has been merged since
            total += 1 - self.weight(left) - self.weight(symbols[j])
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (s := scores.get(p := pair + symbols[k])) is not None:
                    heapq.heappush(heap, (-s, i, p))
            if (k := before[i]) >= 0 and (s := scores.get(p := symbols[k] + pair)) is not None:
                heapq.heappush(heap, (-s, k, p))
        return total

    def cut_count(self, cut: str) -> int:
        n = self.known.get(cut)
        if n is None:
            n = self.merge_count(cut)
            if len(cut) <= KEEP_CHARS and len(self.known) < KEEP:
                self.known[cut] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        known, total, lines = self.known, 0, (MARK + text.replace(" ", MARK)).split("\n")
        for line in lines:
            for cut in _CUT.findall(line):
                total += known.get(cut) or self.cut_count(cut)
        return total + (len(lines) - 1) * self.weight("\n")


def unsupported(model_file: str) -> list[str]:
    """Options of a model under which the counts here would not be the library's."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    trainer, normal = model.trainer_spec, model.normalizer_spec
    kinds = {piece.type for piece in model.pieces}
    wrong = {
        "merges that aren't byte pairs": trainer.model_type != trainer.BPE,
        "no byte fallback": not trainer.byte_fallback,
        "word marks at the end of words": trainer.treat_whitespace_as_suffix,
        "no word mark in front": not normal.add_dummy_prefix,
        "spaces removed": normal.remove_extra_whitespaces,
        "spaces not marked": not normal.escape_whitespaces,
        "characters normalised": bool(normal.precompiled_charsmap),
        "pieces of the user's own": model.SentencePiece.USER_DEFINED in kinds,
        "unused pieces": model.SentencePiece.UNUSED in kinds,
    }
    return [name for name, found in wrong.items() if found]


_counters: dict[str, PieceCounter] = {}


def counter(model_file: str) -> PieceCounter:
    if model_file not in _counters:
        _counters[model_file] = PieceCounter(model_file)
    return _counters[model_file]


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text.

    ValueError for a model with options that aren't followed here.
    """
    if wrong := unsupported(model_file):
        raise ValueError(f"{model_file}: {', '.join(wrong)}")
    kind = docs.schema[id_col].dataType.simpleString()

    def row(doc_id, text: bytes | None) -> tuple:
        n = counter(model_file).count(text.decode()) if text else 0
        return doc_id, len(text or b""), n, n > limit

    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean", row, text_col)
