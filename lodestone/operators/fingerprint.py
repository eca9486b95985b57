"""Winnowing: k-gram hashes of the normalised text, the least of each window, one row each time it moves."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.functions.predicates import fingerprintable
from lodestone.functions.text import byte_view
from lodestone.sources.storage import kept

GRAM, WINDOW = 30, 64


_MD5_ADD = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_TURN = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_MD5_WORD = [i for i in range(16)] + [(5 * i + 1) % 16 for i in range(16)] + [(3 * i + 5) % 16 for i in range(16)] + [7 * i % 16 for i in range(16)]
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_GRAMS = 1 << 15  # hashed at once: so many that numpy's calls don't count, so few that a core's cache holds most of them


def _md5_heads(words: np.ndarray, n: int, gram: int) -> np.ndarray:
    """The first word of the MD5 of each of n grams; words has the four bytes from each place on."""
    a, b, c, d = (np.full(n, v, np.uint32) for v in _MD5_START)
    f, bits = np.empty(n, np.uint32), 8 * gram
    blocks = (gram + 8) // 64 + 1
    for block in range(blocks):
        before, parts = [x.copy() for x in (a, b, c, d)], []
        for at in range(64 * block, 64 * block + 64, 4):
            left = gram - at  # bytes of a gram from there on; then a bit, zeros, and the length in bits
            if left >= 4:
                parts.append((words[at : at + n], 0))
            elif left > 0:
                parts.append((words[at : at + n] & np.uint32((1 << 8 * left) - 1), 0x80 << 8 * left))
            else:
                parts.append((None, 0x80 if left == 0 else bits >> 32 * (at % 64 - 56 >> 2) & 0xFFFFFFFF if block == blocks - 1 and at % 64 >= 56 else 0))
        last = block == blocks - 1
        for i in range(61 if last else 64):  # the first word is set in the 61st step
            if i < 16:
                np.bitwise_xor(c, d, f)
                f &= b
                f ^= d
            elif i < 32:
                np.bitwise_xor(b, c, f)
                f &= d
                f ^= c
            elif i < 48:
                np.bitwise_xor(b, c, f)
                f ^= d
            else:
                np.invert(d, f)
                f |= b
                f ^= c
            array, constant = parts[_MD5_WORD[i]]
            a += f
            a += np.uint32(_MD5_ADD[i] + constant & 0xFFFFFFFF)
            if array is not None:
                a += array
            np.left_shift(a, np.uint32(_MD5_TURN[i]), f)
            a >>= np.uint32(32 - _MD5_TURN[i])
            a |= f
            a += b
            a, b, c, d = d, a, b, c
        if last:
            return before[0] + b
        for x, y in zip((a, b, c, d), before, strict=True):
            x += y
    raise AssertionError


def gram_md5(plain: bytes, gram: int) -> np.ndarray:
    """The first four bytes of the MD5 of every gram, thousands of grams at a time in each step of MD5."""
    n = len(plain) - gram + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.uint32)
    raw = np.frombuffer(plain + bytes(4), np.uint8).astype(np.uint32)
    words = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    for at in range(0, n, _GRAMS):
        out[at : at + _GRAMS] = _md5_heads(words[at:], min(_GRAMS, n - at), gram)
    return out.byteswap().astype(np.int64)


def _crc_table(polynomial: int) -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(polynomial), np.uint32(0))
    return table


class GramCrc:
    """A cyclic redundancy check of every gram of a text at once.

    The check is linear: that of two parts is that of the first, moved on by the second's length, and that of the second.
    So grams of 2, 4, 8, ... bytes come from those half as long, and a gram of any length from a few of these. Moving on by
    a length is looked up for each half of the 32 bits.
    """

    def __init__(self, polynomial: int):
        self.table = _crc_table(polynomial)
        self.moves: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def move(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if length not in self.moves:
            halves = [np.arange(1 << 16, dtype=np.uint32), np.arange(1 << 16, dtype=np.uint32) << np.uint32(16)]
            for _ in range(length):
                halves = [self.table[h & np.uint32(0xFF)] ^ (h >> np.uint32(8)) for h in halves]
            self.moves[length] = halves[0], halves[1]
        return self.moves[length]

    def joined(self, first: np.ndarray, second: np.ndarray, length: int) -> np.ndarray:
        low, high = self.move(length)
        return low[first & np.uint32(0xFFFF)] ^ high[first >> np.uint32(16)] ^ second

    def plain(self, length: int) -> int:
        """What a gram's check differs by, as it starts and ends with all bits turned."""
        low, high = self.move(length)
        return int(low[0xFFFF] ^ high[0xFFFF]) ^ 0xFFFFFFFF

    def __call__(self, text: bytes, gram: int) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        n = len(raw) - gram + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        power, length, whole, done = self.table[raw], 1, None, gram
        # Parts are taken from the gram's end, the shortest first.
        while True:
            if gram & length:
                done -= length
                part = power[done : done + n]
                whole = part if whole is None else self.joined(part, whole, gram - done - length)
            if done == 0:
                return (whole ^ np.uint32(self.plain(gram))).astype(np.int64)
            power = self.joined(power[:-length], power[length:], length)
            length *= 2


#: By name: of the text's letters and digits and the gram's size, a hash of each gram. Reflected polynomials.
HASHES: dict[str, Callable[[bytes, int], np.ndarray]] = {"md5": gram_md5, "crc32": GramCrc(0xEDB88320), "crc32c": GramCrc(0x82F63B78)}
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_OTHERS = bytes(b for b in range(256) if not chr(b).isascii() or not chr(b).isalnum())
_KEEP = np.isin(np.arange(256), list(_OTHERS), invert=True)
GROUP_BYTES = 1 << 18  # of texts that are hashed together


def winnow_all(texts: list[bytes], gram: int, window: int, hashes: Callable[[bytes, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each fingerprint's text (from 0), the fingerprint, and the line (from 1) where its gram starts. Texts are hashed as one; no window spans two."""
    joined = b"".join(texts)
    raw, plain = np.frombuffer(joined, np.uint8), joined.translate(_FOLD, _OTHERS)
    place, ends = np.flatnonzero(_KEEP[raw]), np.cumsum([len(t) for t in texts], dtype=np.int64)
    upto = np.searchsorted(place, ends)
    first = np.append(0, upto[:-1]).astype(np.int64)
    count = np.maximum(upto - first - gram - window + 2, 0)  # windows of each text
    if not count.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = hashes(plain, gram)
    # The rightmost of the least: places count down, so the greater place is the lesser key.
    key = (h << 31) | ((1 << 31) - 1 - np.arange(len(h)))
    least, width = key, 1
    while 2 * width <= window:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    least = least[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())]
    moved = np.append(True, least[1:] != least[:-1])  # keys hold places, so those of two texts differ
    at = (1 << 31) - 1 - (least[moved] & ((1 << 31) - 1))
    owner, ended = np.repeat(np.arange(len(texts)), count)[moved], np.flatnonzero(raw == 10)
    before = np.searchsorted(ended, np.append(0, ends[:-1]))
    return owner, h[at], 1 + np.searchsorted(ended, place[at]) - before[owner]


def winnow(text: bytes, gram: int, window: int, hashes: Callable[[bytes, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a text and the lines (from 1, saturating) where their grams start."""
    _, h, lines = winnow_all([text], gram, window, hashes)
    return h, np.minimum(lines, V.MAX_LINE_NUMBER)


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about GROUP_BYTES, each with its first one's place."""
    start, some, size = 0, [], 0
    for k, text in enumerate(texts.cast(pa.binary())):
        some.append(text.as_py() or b"")
        size += len(some[-1])
        if size >= GROUP_BYTES:
            yield start, some
            start, some, size = k + 1, [], 0
    if some:
        yield start, some


def fingerprints(files: DataFrame, gram: int = GRAM, window: int = WINDOW, hash_name: str = "crc32", id_col: str = "file_id", text_col: str = "text", blank_lines: int = 0) -> DataFrame:
    """file_id, wfp, line of every admissible text. Texts go to Python by batch; nothing is shuffled.

    With blank_lines, of each text after so many empty lines, which nobody has to write out: they hold no gram, and only count.
    """
    kind = files.schema[id_col].dataType.simpleString()
    fit = files.select(F.col(id_col).alias("file_id"), F.col(text_col).alias("text")).where(fingerprintable(byte_view(F.col("text")), blank_lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _groups(batch.column(1)):
                at, h, lines = winnow_all(texts, gram, window, HASHES[hash_name])
                lines = np.minimum(lines + blank_lines, V.MAX_LINE_NUMBER).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(start + at)), pa.array(h), pa.array(lines)], names=["file_id", "wfp", "line"])

    return fit.mapInArrow(run, f"file_id {kind}, wfp long, line int")


def fingerprint_finder(gram: int = GRAM, window: int = WINDOW, hash_name: str = "crc32"):
    """wfp, line as an array, of a text's bytes: each fingerprint with its least line. For plans that compute all facts at once."""
    kind = pa.list_(pa.struct([("wfp", pa.int64()), ("line", pa.int32())]))

    @F.arrow_udf("array<struct<wfp: bigint, line: int>>")
    def found(texts: pa.Array) -> pa.Array:
        counts, hs, ls = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for _, some in _groups(texts):
            at, h, line = winnow_all(some, gram, window, HASHES[hash_name])
            order = np.lexsort((h, at))  # stable, and lines grow along a text
            at, h, line = at[order], h[order], line[order]
            first = np.append(True, (at[1:] != at[:-1]) | (h[1:] != h[:-1]))[: len(h)]
            counts.append(np.bincount(at[first], minlength=len(some)))
            hs.append(h[first])
            ls.append(np.minimum(line[first], V.MAX_LINE_NUMBER).astype(np.int32))
        offsets = np.cumsum(np.concatenate(counts))
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(hs)), pa.array(np.concatenate(ls))], names=["wfp", "line"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(kind)

    return found


def first_lines(wfps: DataFrame) -> DataFrame:
    """One row for each fingerprint and file: the least line."""
    return wfps.groupBy("wfp", "file_id").agg(F.min("line").alias("line"))


MAX_DENIED = 1_000_000  # fingerprints that are broadcast as they are, some 20 MB
MAX_BITS = 27  # of places in the filter that stands for more of them: 16 MB
_SPREAD = 40503  # odd, so that places differ


def read_denied(spark: SparkSession, path: str) -> DataFrame:
    """wfp of a list of fingerprints in text: eight hexadecimal digits each, apart by anything else; # starts a comment."""
    digits = F.regexp_extract_all(F.regexp_replace("value", "#.*", ""), F.lit("(?i)(?:0x)?\\b([0-9a-f]{8})\\b|0x([0-9a-f]{8})"), F.lit(0))
    words = spark.read.text(path).select(F.explode(digits).alias("hex"))
    return words.select(F.conv(F.substring("hex", -8, 8), 16, 10).cast("long").alias("wfp")).distinct()


def _bits(denied: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """A bit for each place that a denied fingerprint has, about 16 places a fingerprint: bitmaps put together by aggregates."""
    width = min(max((16 * n - 1).bit_length(), 15), MAX_BITS)
    place = (F.col("wfp") * _SPREAD).bitwiseXOR(F.shiftright("wfp", 13)).bitwiseAND(F.lit((1 << width) - 1)) + 1
    rows = denied.select(place.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")).collect()
    out = np.zeros(1 << (width - 3), np.uint8)
    for r in rows:  # 4 KB each, 2^MAX_BITS bits at most
        out[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return width, out


def without_denied(wfps: DataFrame, denied: DataFrame, most: int = MAX_DENIED) -> DataFrame:
    """The rows of wfps whose fingerprint is not in denied; none of them is shuffled but what a longer list may hold.

    Up to most denied fingerprints are broadcast. For more, a filter of bits tells those rows that may be denied, and
    these alone are joined with the list; wfps is read twice then, and should be a stored table.
    """
    some = kept(denied.select("wfp").where("wfp IS NOT NULL").distinct(), "denied")
    n = some.count()
    if n <= most:
        return wfps.join(F.broadcast(some), "wfp", "left_anti").select(*wfps.columns)
    width, bits = _bits(some, n)
    shared = wfps.sparkSession.sparkContext.broadcast(bits)  # 2^MAX_BITS bits at most

    @F.arrow_udf("boolean")
    def maybe(column: pa.Array) -> pa.Array:
        v = column.fill_null(0).to_numpy()
        place = (v * _SPREAD ^ v >> 13) & ((1 << width) - 1)
        return pa.array((shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool))

    marked = wfps.withColumn("__maybe", maybe("wfp"))
    clear, rest = marked.where("NOT __maybe").drop("__maybe"), marked.where("__maybe").drop("__maybe")
    return clear.unionByName(rest.join(some, "wfp", "left_anti").select(*wfps.columns))


CLASS_BLOCK = 1024  # files of a class that are dealt together


def _classes(rows: DataFrame, name: str) -> DataFrame:
    """name, class, wfps: the set of fingerprints of each file, and what stands for it."""
    sets = rows.where("wfp IS NOT NULL").groupBy(name).agg(F.array_sort(F.collect_set("wfp")).alias("wfps"))
    return sets.withColumn("class", F.md5(F.array_join(F.col("wfps").cast("array<string>"), ",")))


def snippet_matches(queries: DataFrame, known: DataFrame) -> DataFrame:
    """Extension: query_id, file_id, hits: files that share fingerprints with a query.

    Most files share but a few frequent fingerprints with any query. So files with the same set of asked fingerprints are
    one class, as are queries; hits are counted between classes, and pairs of files come from a join without an aggregate.
    Files of large classes are dealt by blocks.
    """
    asked = kept(_classes(queries.select(F.col("file_id").alias("query_id"), "wfp"), "query_id"), "asked")
    each = asked.dropDuplicates(["class"]).select(F.col("class").alias("query_class"), F.explode("wfps").alias("wfp"))
    held = kept(_classes(known.select("file_id", "wfp").join(each.select("wfp").distinct(), "wfp", "left_semi"), "file_id"), "held")
    sizes = held.groupBy("class").agg(F.count("*").alias("n"), F.first("wfps").alias("wfps"))
    classes = kept(sizes.select(F.col("class").alias("file_class"), F.ceil(F.col("n") / CLASS_BLOCK).alias("blocks"), "wfps"), "classes")
    found = each.join(classes.select("file_class", F.explode("wfps").alias("wfp")), "wfp").groupBy("query_class", "file_class").agg(F.count("*").alias("hits"))
    blocks = classes.select("file_class", "blocks")
    dealt = found.join(blocks, "file_class").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = dealt.join(asked.select("query_id", F.col("class").alias("query_class")), "query_class")
    files = held.select("file_id", F.col("class").alias("file_class")).join(blocks, "file_class")
    files = files.select("file_id", "file_class", F.pmod(F.xxhash64("file_id"), F.col("blocks")).alias("block"))
    return left.join(files, ["file_class", "block"]).select("query_id", "file_id", "hits")
