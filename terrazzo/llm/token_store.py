"""Token ids in binary shards with Elias-Fano document boundaries.

Shard image (all integers little-endian):

    8 bytes   magic b"TZIDS\\x01\\0\\0"
    4 x u64   documents, ids, bytes of the boundary part, bytes per id (2 or 4)
    boundary  Elias-Fano code of the end offset of each document
    ids       one array, documents after one another in ascending key order

Boundary part: u64 low bits per value, u64 high words, packed low bits (padded to
8 bytes), the high bit vector as 64-bit words, and for select one u32 a word, the
ones before it. An offset costs 2 + log2(ids / documents) bits plus half a bit of
directory, not 64.

The keys of a shard ascend, so they are a second Elias-Fano run beside the image, of
the differences to the first; no 64-bit table is kept of keys or offsets.

`write_store` range-partitions the documents by key (one shuffle of the texts),
encodes them where they lie, and writes shard images of bounded size as rows of a
Parquet table, since executors share no other file system than Spark's.
`read_store` opens those images again, asks select for each document's end and
yields documents with global offsets:
only one row per partition (its id count) goes through a window; ids are never
shuffled.

Defined results: a null text is an empty document (the end id only); a null key
comes first; repeated keys keep one entry each, in an order fixed by the text;
an empty table gives no shards. Other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .byte_bpe import PRETOKEN, byte_letters, chunks

MAGIC = b"TZIDS\x01\0\0"
SHARD_IDS = 2_000_000
#: White space beside a space, or a space at an end, in Arrow's patterns: such texts are cut one by one.
_SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN = f" [{_SPACES}]|[{_SPACES}] |^ | $"
#: Bytes of text whose parts are told apart at once.
PORTION = 16 << 20


class EliasFano:
    """A nondecreasing sequence in about 2 + log2(last / count) bits a value."""

    def __init__(self, low_bits: int, low: np.ndarray, high: np.ndarray, before: np.ndarray, count: int):
        self.low_bits, self.low, self.high, self.before, self.count = low_bits, low, high, before, count

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        return cls(low_bits, low, high, cls.directory(high), n)

    @staticmethod
    def directory(high: np.ndarray) -> np.ndarray:
        """Ones before each word."""
        sums = np.cumsum(np.bitwise_count(high), dtype=np.uint32)
        return np.concatenate([np.zeros(min(1, len(high)), np.uint32), sums[:-1]])

    def to_bytes(self) -> bytes:
        pad = b"\0" * (-len(self.low) % 8)
        return struct.pack("<QQ", self.low_bits, len(self.high)) + self.low.tobytes() + pad + self.high.astype("<u8").tobytes() + self.before.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, count: int) -> EliasFano:
        low_bits, words = struct.unpack_from("<QQ", data)
        low_size = (low_bits * count + 7) // 8
        at = 16 + low_size + -low_size % 8
        low = np.frombuffer(data, np.uint8, low_size, 16)
        high = np.frombuffer(data, "<u8", words, at)
        return cls(low_bits, low, high, np.frombuffer(data, "<u4", words, at + 8 * words), count)

    def select(self, i: int) -> int:
        """The i-th value: the directory finds the word of the i-th one, its bits the place."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        word = int(self.before.searchsorted(i, side="right")) - 1
        rest, left = int(self.high[word]), i - int(self.before[word])
        for _ in range(left):
            rest &= rest - 1
        place = word * 64 + (rest & -rest).bit_length() - 1
        start = i * self.low_bits
        held = int.from_bytes(self.low[start >> 3 : (start + self.low_bits + 7) >> 3].tobytes(), "little") >> (start & 7)
        return place - i << self.low_bits | held & (1 << self.low_bits) - 1

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.count:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        out = (ones - np.arange(self.count)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits].reshape(self.count, self.low_bits)
            out = out + bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out


def pack_shard(runs: list[bytes], width: int) -> bytes:
    """The image of documents given as their ids' bytes."""
    ends = np.cumsum([len(r) // width for r in runs]) if runs else np.zeros(0, np.int64)
    bounds = EliasFano.encode(ends).to_bytes()
    return MAGIC + struct.pack("<QQQQ", len(runs), int(ends[-1]) if runs else 0, len(bounds), width) + bounds + b"".join(runs)


class Shard:
    """A shard image, opened."""

    def __init__(self, image: bytes):
        if image[:8] != MAGIC:
            raise ValueError("not a shard image")
        self.documents, self.total, size, width = struct.unpack_from("<QQQQ", image, 8)
        self.bounds = EliasFano.from_bytes(image[40 : 40 + size], self.documents)
        self.ids = np.frombuffer(image, f"<u{width}", self.total, 40 + size)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i - 1) if i else 0 : self.bounds.select(i)]


class Encoder:
    """The tokenizers library behind bounded caches.

    A text without special strings is cut at its even gaps, which no pretoken
    crosses. The library's model encodes each distinct pretoken once, for as long as
    the caches hold it; texts with special strings go to the library whole. Of many
    texts at once, distinct parts are found in Arrow and looked up once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.packed = [i.to_bytes(self.width, "little") for i in range(self.library.get_vocab_size())]
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_letters()))
        self.find = regex.compile(PRETOKEN).findall
        self.words = common.Memo(self.encode_pretoken, 100_000)
        self.after_gap = common.Memo(self.encode_after_gap, 400_000)

    def encode_pretoken(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self.letters)
        return self.encode_spelt(spelt)

    def encode_spelt(self, spelt: str) -> bytes:
        packed, found = self.packed, self.tokenize(spelt)
        return packed[found[0].id] if len(found) == 1 else b"".join([packed[t.id] for t in found])

    def encode_after_gap(self, part: str) -> bytes:
        """Ids of a space and `part`; letters alone, or before one mark, need no pattern."""
        if part.isalpha():
            return self.encode_spelt(self.letters[32] + part) if part.isascii() else self.encode_pretoken(" " + part)
        if part[-1:] in ".,;:!?" and part[:-1].isalpha():
            return self.after_gap[part[:-1]] + self.words[part[-1]]
        return b"".join(map(self.words.__getitem__, self.find(" " + part)))

    def __call__(self, text: str) -> bytes:
        """The text's ids as bytes, without the end id."""
        if any(s in text for s in self.specials):
            return b"".join([self.packed[i] for i in self.library.encode(text, add_special_tokens=False).ids])
        first, rest = chunks(text)
        return self.start(first) + b"".join(map(self.after_gap.__getitem__, rest))

    def start(self, first: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(first)))

    def many(self, texts: pa.StringArray) -> Iterator[bytes]:
        """The same for each text in order, some megabytes of them at a time; null: none."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(sizes.searchsorted((sizes[at - 1] if at else 0) + PORTION, side="right")))
            yield from self.portion(pc.fill_null(texts[at:end], ""))
            at = end

    def portion(self, texts: pa.StringArray) -> list[bytes]:
        odd = pc.match_substring_regex(texts, UNEVEN)
        for s in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        cuts, coded = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().dictionary_encode()
        parts, places = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().copy()
        # The first part of a text has no space before it.
        firsts = [parts[i] for i in places[cuts[:-1]].tolist()]
        places[cuts[:-1]] = np.arange(len(parts), len(parts) + len(firsts))
        codes = pa.array([*self.after_gap.all(parts), *map(self.start, firsts)], pa.binary())
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(codes).to_numpy(zero_copy_only=False)[places], dtype=np.int64)])
        taken = codes.take(pa.array(places)).buffers()[2]
        bounds, data = offsets[cuts].tolist(), memoryview(taken) if taken else b""
        even = iter([bytes(data[a:b]) for a, b in zip(bounds, bounds[1:])])
        return [self(x.as_py()) if o else next(even) for x, o in zip(texts, odd.to_pylist(), strict=True)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack_keys(keys: list[int | None]) -> tuple[int, int, bytes]:
    """(how many are null, the first other one, an Elias-Fano run of the differences to it) of ascending keys, nulls first."""
    known = [k for k in keys if k is not None]
    if not known:
        return len(keys), 0, b""
    return len(keys) - len(known), known[0], EliasFano.encode(np.array([k - known[0] for k in known], np.uint64)).to_bytes()


def unpack_keys(nulls: int, first: int, run: bytes, count: int) -> list[int | None]:
    known = (EliasFano.from_bytes(run, count - nulls).values().astype(np.int64) + first).tolist() if count > nulls else []
    return [None] * nulls + known


def write_store(docs: DataFrame, vocabulary: str, end_id: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, write and return the shard table: (part, seq, part_start, ids, nulls, first, keys, image); the key is an integer."""
    shard_ids = SHARD_IDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        tail = end_id.to_bytes(encode.width, "little")
        keys, runs, held, done, seq = [], [], 0, 0, 0

        def shard():
            nulls, first, packed = pack_keys(keys)
            values = ((part, pa.int32()), (seq, pa.int32()), (done, pa.int64()), (held, pa.int64()), (nulls, pa.int32()), (first, pa.int64()), (packed, pa.binary()), (pack_shard(runs, encode.width), pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=["part", "seq", "part_start", "ids", "nulls", "first", "keys", "image"])

        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), encode.many(batch.column(1)), strict=True):
                keys.append(k)
                runs.append(ids + tail)
                held += len(ids) // encode.width + 1
                if held >= shard_ids:
                    yield shard()
                    keys, runs, held, done, seq = [], [], 0, done + held, seq + 1
        if keys:
            yield shard()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # By a hash of the text too: many rows of one key, or of none, are no single task's.
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text").select("key", "text")
    shards = dealt.mapInArrow(run, "part int, seq int, part_start long, ids long, nulls int, first long, keys binary, image binary")
    return common.stored(shards, "shards")


def read_store(shards: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document in the shard table."""
    # One row per partition: ids before it. The last shard of a part holds its total.
    parts = shards.groupBy("part").agg(F.max(F.col("part_start") + F.col("ids")).alias("total"))
    offsets = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, nulls, first, packed, image in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                shard = Shard(image.as_py())
                wide, begin, starts, sizes, sums = shard.ids.astype("<u4"), 0, [], [], []
                for i in range(shard.documents):
                    end = shard.bounds.select(i)
                    starts.append(start + begin)
                    sizes.append(end - begin)
                    sums.append(zlib.crc32(wide[begin:end]))
                    begin = end
                keys = unpack_keys(nulls, first, packed, shard.documents)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, sizes, sums)], names=["key", "start", "n_tokens", "ids_crc32"])

    # As many offsets as write tasks, two integers each: a broadcast of bounded size.
    own = shards.join(F.broadcast(offsets), "part").select((F.col("part_start") + F.col("before")).alias("start"), "nulls", "first", "keys", "image")
    return own.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)
