"""Token ids as binary shards with a minimal perfect hash index from document keys to offsets.

File format: a folder of Parquet files that serve as a container which Spark commits as one whole
and any of its readers can open. A row is a shard:

    part, seq        place of the shard: range partition of doc_id, then number within it
    part_offset      ids written in this partition before the shard
    n_ids, n_docs    sizes
    first_id, last_id  least and greatest doc_id (first_id null: the shard holds null ids)
    payload          the raw ids, little-endian uint16 or uint32 by vocabulary size
    docs             doc_id as int64 and a null flag as uint8 per document, in payload order
    index            minimal perfect hash: words of bits by level, the number of bits before each word (uint32),
                     then by slot the fingerprint (uint32) and the first id and number of ids in the payload (uint32 each)

Beside them, _directory has a bucket of ids in each folder, with an index of the same kind to the shards that hold an id.

Keyed access: hash the key, read one word of bits a level to its slot, compare the stored fingerprint: first in one bucket
of the directory, then in the shard that it names; no search, no scan, whatever the order of documents. Repeated ids get
an occurrence number, so each row has a key.

Defined results: null texts are empty documents (they hold the end id alone); null ids sort first;
rows with equal ids keep separate entries; empty tables give no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bound_batches, split_words

SHARD_IDS = 2_000_000  # a shard is closed once it holds this many ids
BUCKET_DOCS = 1 << 18  # documents of a bucket of the directory, about
KEEP_PIECES = 300_000  # pieces that a Python worker remembers
SHARD_SCHEMA = "part int, seq int, part_offset long, n_ids long, n_docs long, first_id long, last_id long, payload binary, docs binary, index binary"

# ---------------------------------------------------------------- encoding

# Fixed value: the vocabulary's own split of lower-cased text.
_PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
_WHOLE = "\x01"  # begins what is encoded as a whole; no piece has this character


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the others as U+0100 onwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Texts -> their ids as little-endian bytes, exactly as the tokenizers library encodes them.

    The vocabulary drops white space and never joins across it, so words are encoded one by one, each different
    word of some hundred texts once. Words in printable Latin are lower-cased and split into pieces by
    Arrow, and each different piece goes to the library's model; any other word, and all that might
    hold a special token, goes through the library's whole encoder. A bounded number of pieces is remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.packed = [self.pack([i]) for i in range(self.tokenizer.get_vocab_size())]
        self.letters = _byte_letters()
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def piece(self, piece: str) -> bytes:
        if not piece:  # Arrow's split gives one after the last space
            return b""
        if piece[0] == _WHOLE:
            return self.pack(self.tokenizer.encode(piece[1:], add_special_tokens=False).ids)
        text = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return b"".join([self.packed[t.id] for t in self.model.tokenize(text)])

    def pieces(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of some different pieces."""
        at = pc.index_in(pieces, self.known)
        new = pieces.filter(pc.is_null(at))
        fresh = pa.array(map(self.piece, new.to_pylist()), pa.large_binary())
        place = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        place[pc.is_null(at).to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, fresh])
        if len(self.known) < KEEP_PIECES:
            short = pc.less_equal(pc.binary_length(new), 48)
            self.known, self.ids = pa.concat_arrays([self.known, new.filter(short)]), pa.concat_arrays([self.ids, fresh.filter(short)])
        return ids.take(pa.array(place))

    def words(self, words: pa.Array) -> pa.Array:
        """The ids of each word."""
        whole, lower = pa.array(_beyond_latin(words)), pc.utf8_lower(words)
        parted = pc.and_not(pc.invert(pc.utf8_is_alpha(lower)), whole)
        split = pc.replace_substring_regex(lower.filter(parted), _PIECES, r"\1 ")
        kept = pc.binary_join_element_wise(pa.scalar(_WHOLE, words.type), words.filter(whole), pa.scalar("", words.type))
        lists = pc.ascii_split_whitespace(pc.replace_with_mask(pc.replace_with_mask(lower, parted, split), whole, kept))
        coded = lists.flatten().dictionary_encode()
        return _joined(self.pieces(coded.dictionary).take(coded.indices), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text."""
        for words, coded, ends in split_words(texts, 1000):
            ids = _joined(self.words(words).take(pa.array(coded)), np.concatenate([[0], ends]))
            _, offsets, data = ids.buffers()
            at = np.frombuffer(offsets, np.int64, len(ids) + 1).tolist()
            for a, b in zip(at, at[1:]):
                yield data.slice(a, b - a).to_pybytes() if b > a else b""


def _beyond_latin(words: pa.Array) -> np.ndarray:
    """Words with anything but printable Latin up to U+023F, a capital that lower-cases to two characters, or what may begin a special token; and those of 200 bytes or more."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
    if at[-1] == at[0]:
        return np.zeros(len(words), bool)
    here = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    before = np.concatenate([[0], here[:-1]])
    odd = (here < 0x21) | (here == 0x7F) | (here >= 0xC9)
    odd |= (before == 0xC2) & ((here <= 0xA0) | (here == 0xAD)) | (before == 0xC4) & (here == 0xB0) | (before == 0x3C) & (here == 0x7C)
    upto = np.concatenate([[0], np.cumsum(odd)])[at - at[0]]
    return (np.diff(upto) > 0) | (np.diff(at) >= 200)


def _joined(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Each run of values, from one of bounds to the next, as one value."""
    if not len(values):
        return pa.array([b""] * (len(bounds) - 1), pa.large_binary())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64, len(values) + 1)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(at[bounds].tobytes()), data])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each Python worker, which Spark uses for many tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- minimal perfect hash

_GOLDEN = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixer (xor-shift and multiply) of keys under a seed."""
    x = x + np.uint64((seed + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_ids: np.ndarray, nulls: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return _mix(_mix(doc_ids.astype("<i8").view(np.uint64), 11) ^ (occurrence.astype(np.uint64) << np.uint64(1)) ^ nulls.astype(np.uint64), 12)


def occurrences(doc_ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """0, 1, 2... for the rows of equal keys, in order."""
    order = np.lexsort((doc_ids, nulls))
    ids, none = doc_ids[order], nulls[order]
    new = np.ones(len(order), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])
    starts = np.flatnonzero(new)
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
    return out


def build_index(hashes: np.ndarray, first: np.ndarray, size: np.ndarray) -> bytes:
    """Level by level, keys that fall alone on a bit take it; the others go on to the next level.

    Beside each word of bits stands how many bits are set before it, over all levels, so a key's slot comes from one word.
    """
    left, levels = hashes, []
    while len(left) and len(levels) < 60:
        bits = -(-max(64, 2 * len(left)) // 64) * 64
        at = (_mix(left, 100 + len(levels)) % np.uint64(bits)).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(alone)
        left = left[~alone[at]]
    if len(left):
        raise ValueError("two keys of a shard have the same 64-bit hash")
    words = np.packbits(np.concatenate(levels), bitorder="little").view("<u8") if levels else np.zeros(0, "<u8")
    count = np.bitwise_count(words).astype("<u4")
    before = (np.cumsum(count, dtype="<u4") - count).astype("<u4")
    head = struct.pack("<II", len(hashes), len(levels)) + b"".join(struct.pack("<I", len(b)) for b in levels)
    values = np.zeros((len(hashes), 3), "<u4")
    index = head + words.tobytes() + before.tobytes()
    values[_slots(index, hashes)[0]] = np.stack([_mix(hashes, 7).astype(np.uint32), first, size], 1)
    return index + values.tobytes()


def _slots(index: bytes, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """The slot of each key, -1 if it has none, and where the values begin. Of the index only single words are read."""
    _, k = struct.unpack_from("<II", index)
    sizes, at = struct.unpack_from(f"<{k}I", index, 8), 8 + 4 * k
    n = sum(sizes) // 64
    words, before = np.frombuffer(index, "<u8", n, at), np.frombuffer(index, "<u4", n, at + 8 * n)
    slot, todo, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    for level, bits in enumerate(sizes):
        place = _mix(hashes[todo], 100 + level) % np.uint64(bits)
        word, bit = (place >> np.uint64(6)).astype(np.int64) + base, place & np.uint64(63)
        seen = words[word]
        hit = seen >> bit & np.uint64(1) == 1
        rank = before[word] + np.bitwise_count(seen & ((np.uint64(1) << bit) - np.uint64(1)))
        slot[todo[hit]] = rank[hit]
        todo, base = todo[~hit], base + bits // 64
        if not len(todo):
            break
    return slot, at + 12 * n


def lookup(index: bytes, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """found, first id and number of ids of each key; a key whose fingerprint differs is not there."""
    slot, at = _slots(index, hashes)
    (n,) = struct.unpack_from("<I", index)
    if not n:
        return slot >= 0, slot, slot
    values = np.frombuffer(index, "<u4", 3 * n, at).reshape(n, 3)[slot]
    return (slot >= 0) & (values[:, 0] == _mix(hashes, 7).astype(np.uint32)), values[:, 1].astype(np.int64), values[:, 2].astype(np.int64)


# ---------------------------------------------------------------- write and read


def _shard(part: int, seq: int, offset: int, ids: list, payload: list[bytes], width: int) -> tuple:
    nulls = np.array([i is None for i in ids], np.uint8)
    keys = np.array([i or 0 for i in ids], "<i8")
    size = np.array([len(p) // width for p in payload], np.int64)
    first = np.cumsum(size) - size
    index = build_index(key_hash(keys, nulls, occurrences(keys, nulls)), first, size)
    return part, seq, offset, int(size.sum()), len(ids), None if nulls.any() else int(keys.min()), int(keys[nulls == 0].max()) if not nulls.all() else None, b"".join(payload), keys.tobytes() + nulls.tobytes(), index


def write_token_shards(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text", as_stored: bool = False) -> None:
    """Encode every whole text, append end_id, and write the shards to path in ascending doc_id order.

    The one shuffle is by ranges of doc_id. Rows of one repeated id may be any share of the table:
    the row's place in the scan breaks ties, so that such rows spread over several ranges too.
    With as_stored the order is that of the rows in the files that docs are read from (by file name, then
    row), such as a mix was written in; rows that come from no files are in order of doc_id again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(tokenizer_file), TaskContext.get().partitionId()
        end, width = enc.pack([end_id]), enc.dtype.itemsize
        ids: list = []
        payload: list[bytes] = []
        held = offset = seq = 0
        names = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]

        def out(row: tuple) -> pa.RecordBatch:
            types = [pa.int32()] * 2 + [pa.int64()] * 5 + [pa.binary()] * 3
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in batches:
            for doc_id, encoded in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1)), strict=True):
                ids.append(doc_id)
                payload.append(encoded + end)
                held += len(payload[-1]) // width
                if held >= SHARD_IDS:
                    yield out(_shard(part, seq, offset, ids, payload, width))
                    offset, seq, held, ids, payload = offset + held, seq + 1, 0, [], []
        if ids:
            yield out(_shard(part, seq, offset, ids, payload, width))

    spark = docs.sparkSession
    bound_batches(spark)
    row = [F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, order = docs.select(*row, F.monotonically_increasing_id().alias("tie")), [F.asc_nulls_first("k"), F.col("tie")]
    if as_stored:
        try:
            rows = docs.select(*row, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("tie"))
            order = [F.col("file"), F.col("tie")]
        except AnalysisException:  # docs aren't read from files
            pass
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.select("k", "t").mapInArrow(run, SHARD_SCHEMA).write.mode("overwrite").parquet(path)
    write_directory(spark, path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, found through the index of the files."""
    shards = read_token_shards(spark, path)
    # One row per range partition: their number, not the data's size, bounds this table.
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = totals.select("part", F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, ids = row["n_docs"], row["payload"]
                keys = np.frombuffer(row["docs"], "<i8", n)
                nulls = np.frombuffer(row["docs"], np.uint8, n, 8 * n)
                found, first, size = lookup(row["index"], key_hash(keys, nulls, occurrences(keys, nulls)))
                if not found.all():
                    raise ValueError("the index misses a document of its own shard")
                raw = np.frombuffer(ids, np.dtype("<u2" if len(ids) == 2 * row["n_ids"] else "<u4")).astype("<u4")
                crc = [zlib.crc32(raw[a : a + s].tobytes()) for a, s in zip(first, size, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=nulls.astype(bool)), pa.array(first + (row["base"] or 0) + row["part_offset"]), pa.array(size), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.join(F.broadcast(bases), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


DIRECTORY_SCHEMA = "buckets int, shards binary, index binary, bucket int"


def _bucket_of(doc_ids: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(doc_ids.astype("<i8").view(np.uint64), 13) % np.uint64(buckets)).astype(np.int32)


def write_directory(spark: SparkSession, path: str) -> None:
    """Beside the shards, which of them hold a doc_id: buckets of ids, each with a minimal perfect hash to its ids' shards.

    A repeated id counts once for each shard, so what a bucket holds is bounded by shards and by its own different ids.
    """
    shards = read_token_shards(spark, path)
    total = shards.agg(F.sum("n_docs").alias("n")).first().n or 0
    buckets = max(1, -(-total // BUCKET_DOCS))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, n, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(docs, "<i8", n)
                ids = np.unique(ids[np.frombuffer(docs, np.uint8, n, 8 * n) == 0])
                columns = [_bucket_of(ids, buckets), ids, np.full(len(ids), part, np.int32), np.full(len(ids), seq, np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "id", "part", "seq"])

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            ids, place = (np.concatenate(x) for x in zip(*held, strict=True))
            starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            keys, none = ids[starts], np.zeros(len(starts), np.int64)
            index = build_index(key_hash(keys, none, none), starts, np.diff(np.append(starts, len(ids))))
            return pa.RecordBatch.from_arrays([pa.array([buckets], pa.int32()), pa.array([place.astype("<i4").tobytes()], pa.binary()), pa.array([index], pa.binary()), pa.array([now], pa.int32())], names=["buckets", "shards", "index", "bucket"])

        for batch in batches:
            bucket, ids, part, seq = (c.to_numpy() for c in batch.columns)
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            for a, b in zip(starts, [*starts[1:], len(bucket)]):
                if held and bucket[a] != now:
                    yield out()
                    held = []
                now = int(bucket[a])
                held.append((ids[a:b], np.stack([part[a:b], seq[a:b]], 1)))
        if held:
            yield out()

    rows = shards.select("part", "seq", "n_docs", "docs").mapInArrow(places, "bucket int, id long, part int, seq int")
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "id", "part", "seq")
    dealt.mapInArrow(indexed, DIRECTORY_SCHEMA).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/_directory")


def shards_of(spark: SparkSession, path: str, doc_id: int) -> list[tuple[int, int]]:
    """part and seq of the shards that hold a doc_id, from one bucket of the directory."""
    directory = spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{path}/_directory")
    any_row = directory.select("buckets").first()
    if any_row is None:
        return []
    key = np.array([doc_id], "<i8")
    row = directory.where(F.col("bucket") == int(_bucket_of(key, any_row.buckets)[0])).first()
    if row is None:
        return []
    found, first, size = lookup(row["index"], key_hash(key, np.zeros(1, np.int64), np.zeros(1, np.int64)))
    if not found[0]:
        return []
    place = np.frombuffer(row.shards, "<i4").reshape(-1, 2)[first[0] : first[0] + size[0]]
    return [(int(a), int(b)) for a, b in place]


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of each row that was written under doc_id: the directory names the shards, their indexes find the ids."""
    out = []
    for part, seq in shards_of(spark, path, doc_id):
        row = read_token_shards(spark, path).where((F.col("part") == part) & (F.col("seq") == seq)).first()
        raw = np.frombuffer(row.payload, np.dtype("<u2" if len(row.payload) == 2 * row.n_ids else "<u4"))
        for k in range(row.n_docs):
            found, first, size = lookup(row["index"], key_hash(np.array([doc_id]), np.zeros(1, np.uint8), np.array([k])))
            if not found[0]:
                break
            out.append(raw[first[0] : first[0] + size[0]].tolist())
    return out
