"""Secret scans over a text and all layers that can be decoded out of it.

A worklist starts with the text. Each layer is scanned by every rule; then its URL escapes, its
Unicode escapes and each base64 run (plain or compressed, over several lines, or glued to a word by
one of /, _ and -) are unwrapped into further layers until no new layer comes up. Compressed are gzip, zlib and
raw deflate streams, bzip2, xz and zstandard, of any number of members; text is UTF-8 or UTF-16. A layer already
seen over the same part of the text is not taken again, so payloads that unpack to themselves end. Each layer
knows how its positions map to its parent's, and a finding's span is mapped back to the code points of the
original text.

Nothing that unpacks is left out for its size: what comes out of a compressed payload is decoded as it is read, and
beyond MAX_LAYER characters it is scanned in pieces that overlap by OVERLAP, of which one is in memory at a time (such
payloads are counted in n_large). A piece does not end inside of a base64 run but where that is longer than MAX_RUN (64 Mi
characters): such a run alone is cut, and its parts are decoded by themselves.

Time grows in proportion to a text: a run is decoded once as it stands and once for each alignment that a separator in it
gives; what else starts in it is looked for in the bytes.

Defined results: null and empty texts have no spans (counts 0, sha256 of the empty string); a null
doc_id stays null; repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import xxhash
import zstandard
from pyspark.sql import DataFrame

from lodestone.llm.common import map_rows

MAX_LAYER = 1 << 24  # characters
OVERLAP, CHUNK = 1 << 16, 1 << 20
MAX_RUN = 1 << 26  # characters of one base64 run in a payload beyond MAX_LAYER

# The base rules, by kind in order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 or more; shorter ones fail whole
_HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINE_AFTER = re.compile(r"[\x20\t]*\r?\n[\x20\t]*([A-Za-z0-9+/_-]+={0,2})")
_LINE_BEFORE = re.compile(r"([A-Za-z0-9+/_-]+)[\x20\t]*\r?\n[\x20\t]*\Z")
_GLUE = re.compile(r"[/_-]+")


def scan(text: str) -> list[tuple[int, int, str]]:
    """start, end (code points, end exclusive) and kind of what the rules match in one layer."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


class Layer:
    """A decoded text and the way back to its parent's positions, piece by piece."""

    def __init__(self, text: str, parent: Layer | None = None, pieces: list[tuple[int, int, int, bool]] | None = None):
        # pieces: position here, start and end in the parent, whether it is verbatim; in order
        self.text, self.parent, self.pieces = text, parent, pieces or []
        self.at = [p[0] for p in self.pieces]

    def to_root(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent is not None:
            at, a, _, same = layer.pieces[bisect_right(layer.at, start) - 1]
            at2, c, d, same2 = layer.pieces[bisect_right(layer.at, max(start, end - 1)) - 1]
            start, end = (a + start - at if same else a), (c + end - at2 if same2 else d)
            layer = layer.parent
        return start, end


def _substituted(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match decoded in place; None if nothing decodes."""
    out, pieces, here, last = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        plain = decode(m.group())
        if plain is None:
            continue
        if m.start() > last:
            pieces.append((here, last, m.start(), True))
            out.append(layer.text[last : m.start()])
            here += m.start() - last
        if plain:
            pieces.append((here, m.start(), m.end(), False))
            out.append(plain)
            here += len(plain)
        last = m.end()
    if not out or last == 0:
        return None
    if last < len(layer.text):
        pieces.append((here, last, len(layer.text), True))
        out.append(layer.text[last:])
    return Layer("".join(out), layer, pieces)


def _url(escapes: str) -> str | None:
    """The text of the escapes, U+FFFD for bytes that aren't UTF-8; None if none are."""
    plain = bytes.fromhex(escapes.replace("%", "")).decode(errors="replace")
    return plain if plain.strip("\ufffd") else None


def _unicode(escape: str) -> str | None:
    if len(escape) == 12:  # a pair that stands for one character
        return chr(0x10000 + (int(escape[2:6], 16) - 0xD800 << 10) + int(escape[8:], 16) - 0xDC00)
    code = int(escape[2:].strip("{}"), 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _zstd(raw: memoryview) -> Iterator[bytes]:
    reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
    while plain := reader.read(CHUNK):
        yield plain


#: How compressed streams begin (fixed values), and what reads them.
_MAGIC: tuple[tuple[bytes, Callable], ...] = (
    (b"\x1f\x8b", lambda: zlib.decompressobj(zlib.MAX_WBITS | 16)),
    (b"\x78\x01", zlib.decompressobj),
    (b"\x78\x5e", zlib.decompressobj),
    (b"\x78\x9c", zlib.decompressobj),
    (b"\x78\xda", zlib.decompressobj),
    (b"BZh", bz2.BZ2Decompressor),
    (b"\xfd7zXZ\x00", lzma.LZMADecompressor),
    (b"\x28\xb5\x2f\xfd", None),
)
_MAKERS = dict(_MAGIC)
#: Where gzip and zlib streams may begin inside of a run.
_HEADS = re.compile(rb"\x1f\x8b(?=\x08)|\x78[\x01\x5e\x9c\xda]")
FEED = 1 << 16  # bytes that a decompressor gets at once, so that a false start costs no more


def _inflated(raw: bytes, make: Callable | None, start: int = 0) -> Iterator[bytes]:
    """What a compressed stream at a place holds, member after member, chunk by chunk; what comes before an error counts."""
    view, at = memoryview(raw), start
    try:
        if make is None:
            yield from _zstd(view[at:])
            return
        while at < len(view):
            d = make()
            while not d.eof:
                fed = view[at : at + FEED]
                if not len(fed):
                    return  # the stream has no end
                at += len(fed)
                plain = d.decompress(fed, CHUNK)
                while True:
                    if plain:
                        yield plain
                    rest = getattr(d, "unconsumed_tail", b"")
                    if d.eof or not (rest or (plain and not getattr(d, "needs_input", True))):
                        break
                    plain = d.decompress(rest, CHUNK)
            at -= len(d.unused_data)
            while at < len(view) and not view[at]:
                at += 1  # members may be padded
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return


def _encoding(head: bytes) -> str:
    """UTF-16 by its mark or by the zero bytes of Latin text, UTF-8 otherwise."""
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    zeros = head[0:512:2].count(0), head[1:512:2].count(0)
    if len(head) >= 8 and 4 * max(zeros) > len(head[:512]) and 8 * min(zeros) < max(zeros):
        return "utf-16-be" if zeros[0] > zeros[1] else "utf-16-le"
    return "utf-8"


def _open_run(text: str) -> int:
    """The length of the base64 run, over lines too, that a text ends with and that may go on."""
    return len(text) - len(text.rstrip(_RUN_LETTERS))


_RUN_LETTERS = string.ascii_letters + string.digits + "+/_-=\r\n"


def _texts(chunks: Iterator[bytes]) -> Iterator[str]:
    """The text of chunks, whole up to MAX_LAYER characters, else in pieces; ends at bytes that can't be decoded.

    A piece does not end inside of a base64 run, unless that run alone is longer than MAX_RUN.
    """
    decoder, held, size = None, [], 0
    try:
        for chunk in chunks:
            decoder = decoder or codecs.getincrementaldecoder(_encoding(chunk))("strict")
            held.append(decoder.decode(chunk))
            size += len(held[-1])
            if size > MAX_LAYER and (size > MAX_LAYER + MAX_RUN or _open_run(held[-1]) < len(held[-1])):
                text = "".join(held)
                tail = min(max(OVERLAP, _open_run(text)), MAX_RUN)
                yield text
                held, size = [text[-tail:]], tail
        if decoder:
            held.append(decoder.decode(b"", True))
    except UnicodeDecodeError:
        return
    if any(held):
        yield "".join(held)


def _raw(run: str, lenient: bool = False) -> bytes | None:
    """The bytes of a base64 run (either alphabet, padding optional); a lenient one may have a character too many."""
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        if not lenient:
            return None
        body = body[:-1]
    try:
        return base64.b64decode(body.translate({45: 43, 95: 47}) + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def _decoded(run: str) -> Iterator[str]:
    """The text in a base64 run, inflated if compressed; in pieces if it is large."""
    raw = _raw(run)
    if raw is None:
        return
    for magic, make in _MAGIC:
        if raw.startswith(magic):
            packed = False
            for text in _texts(_inflated(raw, make)):
                packed = True
                yield text
            if packed:
                return
            break
    plain = False
    for text in _texts(raw[k : k + CHUNK] for k in range(0, len(raw), CHUNK)):
        plain = True
        yield text
    if not plain:  # nothing tells a raw deflate stream but that it inflates to text
        yield from _texts(_inflated(raw, lambda: zlib.decompressobj(-zlib.MAX_WBITS)))


#: Text among other bytes: no finding, and nothing that unwraps to one, is shorter.
_SHOWN = rb"[\x09-\x0d\x20-\x7e]"
_TEXT = re.compile(rb"%s{12,}|(?:%s\x00){12,}|(?:\x00%s){12,}" % (_SHOWN, _SHOWN, _SHOWN))


def _blocks(lines: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last line of the wrapped payloads that lines (start, end) may be: equal lines, the first (after other words) and the last may be shorter."""
    width, out = [b - a for a, b in lines], []
    for i in range(len(lines) - 1):
        if i and width[i] == width[i - 1]:
            continue
        j = i + 1
        # A shorter line ends a payload, but the first one may be what is left of a line.
        while j + 1 < len(lines) and width[j] == width[i + 1] and width[j + 1] <= width[j]:
            j += 1
        out.append((i, j))
    return out


def _glued(run: str, first: int) -> Iterator[tuple[int, Iterator[str]]]:
    """Start and texts of the payloads that may follow a separator in the first characters of run.

    The run is decoded once for each alignment, from the first separator that gives it: that holds the bytes of all later
    starts. Text among them is taken as it is found, and compressed streams are read from where their heads are.
    """
    starts: dict[int, int] = {}
    for g in _GLUE.finditer(run, 0, first):
        for at in range(g.start() + 1, g.end() + 1):
            starts.setdefault(at % 4, at)
        if len(starts) == 4:
            break
    for at in sorted(starts.values()):
        raw = _raw(run[at:], lenient=True)
        if not raw:
            continue
        if shown := [x.replace(b"\0", b"").decode() for x in _TEXT.findall(raw)]:
            yield at, iter(["\ufffd".join(shown)])
        if magic := next((m for m in _MAKERS if raw.startswith(m)), None):
            yield at, _texts(_inflated(raw, _MAKERS[magic]))
        yield at, _texts(_inflated(raw, lambda: zlib.decompressobj(-zlib.MAX_WBITS)))
        for head in _HEADS.finditer(raw, 1):
            here = at + head.start() // 3 * 4
            if head.start() % 3 == 0 and here <= first and run[here - 1] in "/_-":
                yield here, _texts(_inflated(raw, _MAKERS[head.group()], head.start()))


def _payloads(text: str) -> Iterator[tuple[int, int, Iterator[str]]]:
    """Start, end and texts, in pieces if large, of all that may be a base64 payload."""
    grouped = 0
    for m in _BASE64.finditer(text):
        runs = [(m.start(), m.end(), m.group(), len(m.group()))]
        if m.start() >= grouped:
            lines = [m.span()]
            before = _LINE_BEFORE.search(text, max(0, m.start() - 200), m.start())
            if before:
                lines.insert(0, before.span(1))
            while after := _LINE_AFTER.match(text, lines[-1][1]):
                lines.append(after.span(1))
            grouped = lines[-1][1]
            runs += [(lines[i][0], lines[j][1], "".join(text[a:b] for a, b in lines[i : j + 1]), lines[i][1] - lines[i][0]) for i, j in _blocks(lines)]
        for start, end, run, first in runs:
            yield start, end, _decoded(run)
            for at, texts in _glued(run, first):
                yield start + at, end, texts


def _inner(layer: Layer, large: list[int]) -> Iterator[Layer]:
    """The layers right inside of one; large gets a number for each payload that comes in pieces."""
    if "%" in layer.text and (found := _substituted(layer, _URL, _url)):
        yield found
    if "\\" in layer.text and (found := _substituted(layer, _UNICODE, _unicode)):
        yield found
    for start, end, texts in _payloads(layer.text):
        for k, text in enumerate(texts):
            if k == 1:
                large.append(start)
            yield Layer(text, layer, [(0, start, end, False)])


def scan_layers(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], int]:
    """Base spans, all spans (base ones and those of every decoded layer, mapped), and payloads scanned in pieces."""
    base, large = scan(text), []
    spans, seen = set(base), {(xxhash.xxh3_128_digest(text.encode()), 0, len(text))}
    work = [_inner(Layer(text), large)]
    while work:
        found = next(work[-1], None)
        if found is None:
            work.pop()
            continue
        key = (xxhash.xxh3_128_digest(found.text.encode(errors="surrogatepass")), *found.to_root(0, len(found.text)))
        if not found.text or key in seen:
            continue
        seen.add(key)
        spans.update((*found.to_root(s, e), kind) for s, e, kind in scan(found.text))
        work.append(_inner(found, large))
    return base, list(spans), len(large)


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_large of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def row(doc_id, text: bytes | None) -> tuple:
        base, spans, large = scan_layers(text.decode()) if text else ([], [], 0)
        counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
        return doc_id, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), large

    return map_rows(docs, [id_col, text_col], f"{id_col} {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_large long", row, text_col)
