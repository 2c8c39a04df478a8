"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if it lies in a string of `length` bytes that also starts earlier, in
the order of documents and places. Suffix arrays of the whole corpus don't
distribute, so places that can match are brought together first, without loss:

* in every window of `length` bytes the least hash of its k-grams is its anchor.
  Equal windows have equal anchors, so only anchors that occur twice matter;
* a text falls into runs of windows with one anchor. The bytes under such a run, a
  segment, go to the group of their anchor's hash. Equal segments are one: all but
  the first are repeats as they stand;
* each batch of whole groups becomes one string, segments in document order. Its
  windows are put in suffix order to the depth of `length` by prefix doubling. The
  previous and the next smaller place in that order share most with a window of all
  that start before it: their common bytes are its longest previous factor, cut at
  `length`, and a window is a repeat if the factor reaches `length`.

A group of more than LARGEST segments (an anchor at the edge of a passage that very
many documents share) is not given to one task: its windows are dealt out by
digest, and the least place of each is found with partial aggregation.

Exact copies of a text count once; later ones go whole. Texts are dealt out twice,
to meet their anchors and to meet their removed spans; only anchors' hashes are
counted over the corpus. Defined results: a null text is empty; a null id comes
first; rows alike in id and text are one document and get the same result; rows
that share only an id are ordered by a hash of their text; texts are told apart by
two 64-bit hashes, segments by one of 128 bits; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .ngram_join import mixed

GRAM = 24
BATCH_BYTES = 4 << 20
LARGEST = 20_000
CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0] = 1
    if count > 1:
        out[1:] = np.uint64(base)
        out = np.multiply.accumulate(out)
    return out


_UP = powers(_BASE, CHUNK + 1)
_DOWN = powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of windows with one anchor: the anchor's hash, the text's index, first << 16 | anchor - first << 8 | last - first."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, data in enumerate(texts):
        for begin in range(0, len(data) - length + 1, CHUNK - length + 1):
            part = data[begin : begin + CHUNK]
            if held and size + len(part) > CHUNK:
                found.append(anchors_of(held, length))
                held, size = [], 0
            held.append((i, begin, part))
            size += len(part)
    if held:
        found.append(anchors_of(held, length))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def anchors_of(parts: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`anchors` of parts that fit one chunk, laid end to end; windows across a seam are left out."""
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8).astype(np.uint64)
    sizes = np.array([len(p) for _, _, p in parts])
    span = length - GRAM + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * _UP[: len(data)], dtype=np.uint64)])
    hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: len(data) - GRAM + 1])
    # top bits of the hash, then the place: the least is the leftmost of the least
    least = (hashes & np.uint64(_MASK ^ 0xFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(hashes) - span + 1], least[span - width :])
    at = (least & np.uint64(0xFFFFF)).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(parts)), sizes)
    starts = np.flatnonzero(owner[: len(at)] == owner[length - 1 :])
    own = at[starts]
    first = np.concatenate([np.zeros(1, np.int64), np.flatnonzero((np.diff(own) != 0) | (np.diff(starts) != 1)) + 1])
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    part = owner[starts[first]]
    begin = starts[first] - (ends - sizes)[part] + np.array([b for _, b, _ in parts])[part]
    place = begin << 16 | (own[first] - starts[first]) << 8 | (starts[last] - starts[first])
    return hashes[own[first]].view(np.int64), np.array([i for i, _, _ in parts])[part], place


def repeated_windows(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, in order, which of its windows occur earlier in it or in one before it."""
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes)
    starts = np.concatenate([np.arange(e - s, e - length + 1) for s, e in zip(sizes, ends, strict=True)])
    flags = np.zeros(int(ends[-1]), bool)
    flags[starts] = longest_previous(np.frombuffer(b"".join(segments), np.uint8), starts, length) >= length
    return [flags[e - s : e - length + 1] for s, e in zip(sizes, ends, strict=True)]


def first_words(data: np.ndarray) -> np.ndarray:
    """The first 8 bytes of every suffix as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(data), np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k : k + len(data)]
    return word


def suffix_ranks(word: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(depth, ranks of all suffixes by their first `depth` bytes) for 8, 16, ... bytes up to `length`."""
    out = [(8, np.unique(word, return_inverse=True)[1].astype(np.int32))]
    while out[-1][0] < length:
        depth, rank = out[-1]
        step = min(depth, length - depth)
        ahead = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.int32)])
        out.append((depth + step, np.unique(rank.astype(np.int64) * (len(word) + 1) + ahead, return_inverse=True)[1].astype(np.int32)))
    return out


def longest_previous(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The longest previous factor of each window, cut at `length`: bytes it shares with one that starts before it.

    The windows, each within one segment, stand in suffix order, equal ones by place.
    Of all that start before a window, the nearest in that order on either side, the
    previous and the next smaller place, share most with it.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    word = first_words(data)
    ranks = suffix_ranks(word, length)
    last = ranks[-1][1]
    sorted_by = np.lexsort((starts, last[starts]))
    place = starts[sorted_by]
    factor = np.zeros(len(starts), np.int64)
    for order in (place, place[::-1]):
        near = previous_smaller(order)
        found = shared_bytes(word, ranks, order, np.where(near >= 0, order[near], -1), length)
        factor = np.maximum(factor, found if order is place else found[::-1])
    out = np.empty(len(starts), np.int64)
    out[sorted_by] = factor
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each index the nearest before it with a smaller value, or -1.

    All between an index and its pointer are larger; a pointer at a larger value moves
    on to where that one points, so the distance doubles with each round.
    """
    bounded = np.concatenate([values, [-1]])
    near = np.arange(-1, len(values) - 1)
    open_ones = np.flatnonzero(bounded[near] > values)
    while len(open_ones):
        near[open_ones] = near[near[open_ones]]
        open_ones = open_ones[bounded[near[open_ones]] > values[open_ones]]
    return near


def equal_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit numbers."""
    x, out = x.copy(), np.full(len(x), 8, np.int64)
    for bits in (32, 16, 8):
        high = x >> np.uint64(bits) != 0
        out -= high * (bits // 8)
        x = np.where(high, x >> np.uint64(bits), x)
    return out - (x != 0)


def shared_bytes(word: np.ndarray, ranks: list[tuple[int, np.ndarray]], one: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
    """Common first bytes of the suffixes at two places, cut at `length`; none where `other` is -1."""
    out = np.zeros(len(one), np.int64)
    there = np.flatnonzero(other >= 0)
    out[there] = equal_bytes(word[one[there]] ^ word[other[there]])
    long = there[out[there] == 8]
    same = ranks[-1][1][one[long]] == ranks[-1][1][other[long]]
    out[long[same]] = length
    long = long[~same]
    a, b, at = one[long], other[long], np.zeros(len(long), np.int64)
    for depth, rank in reversed(ranks[:-1]):
        x, y = np.minimum(a + at, len(word) - 1), np.minimum(b + at, len(word) - 1)
        at += depth * (rank[x] == rank[y])
    x, y = np.minimum(a + at, len(word) - 1), np.minimum(b + at, len(word) - 1)
    out[long] = at + equal_bytes(word[x] ^ word[y])
    return np.minimum(out, length)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 100, texts: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]) of every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("tie"), F.xxhash64(F.lit("also"), body).alias("also"), F.octet_length(body).alias("bytes"), body.alias("body"))
    rows = common.spread(rows)
    texts_of = rows.filter(F.col("bytes") >= length)  # told apart by two hashes, 128 bits

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ties, others = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            h, own, place = anchors([x.as_py() for x in batch.column(2).cast(pa.binary())], length)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ties[own]), pa.array(others[own]), pa.array(place)], names=["h", "tie", "also", "place"])

    entries = common.stored(texts_of.select("tie", "also", "body").mapInArrow(list_anchors, "h long, tie long, also long, place long"), "entries")
    # A stored table on the side of the counts leaves a plain join, whose large keys Spark splits.
    twice = common.stored(entries.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "twice")
    met = common.stored(entries.join(twice, "h").distinct(), "anchors")  # copies of a text say the same
    common.drop(entries, twice)
    again = common.stored(met.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "again")
    # The first row of each text stands for it.
    firsts = common.stored(texts_of.groupBy("tie", "also").agg(F.min(F.coalesce("id", F.lit(-(1 << 63)))).alias("first"), F.count("*").alias("n")), "firsts")
    asked = met.join(again, "h").groupBy("tie", "also").agg(F.collect_list(F.struct("h", "place")).alias("places")).join(firsts, ["tie", "also"])
    asked = common.stored(asked.select("tie", "also", "first", "places"), "asked")
    common.drop(met, again)
    first_rows = texts_of.withColumn("first", F.coalesce("id", F.lit(-(1 << 63))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for tie, also, first, places, data in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4).cast(pa.binary()), strict=True):
                data = data.as_py()
                for e in places:
                    start, more = e["place"] >> 16, e["place"] & 0xFF
                    segment = data[start : start + more + length]
                    for column, v in zip(out, (e["h"], xxhash.xxh3_128_digest(segment), segment, first, tie, also, start, start + len(segment)), strict=True):
                        column.append(v)
                if len(out[0]) > 20_000:
                    yield segment_batch(out)
                    out = [[] for _ in range(8)]
            yield segment_batch(out)

    def segment_batch(out):
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["h", "digest", "segment", "first", "tie", "also", "start", "stop"])

    own = first_rows.join(asked.select("tie", "also", "first", "places"), ["tie", "also", "first"]).dropDuplicates(["tie", "also", "first"]).select("tie", "also", "first", "places", "body")
    segments = common.stored(own.mapInArrow(cut, "h long, digest binary, segment binary, first long, tie long, also long, start long, stop long"), "segments")
    common.drop(asked)
    place = F.struct("first", "tie", "start")
    leaders = common.stored(segments.groupBy("h", "digest").agg(F.min(place).alias("lead")), "leaders")
    later = segments.drop("segment").join(leaders, ["h", "digest"]).filter("not (first = lead.first and tie = lead.tie and start = lead.start)")
    whole = common.stored(later.select("tie", "also", F.col("start").alias("a"), F.col("stop").alias("b")), "whole")
    groups = common.stored(leaders.groupBy("h").agg(F.count("*").alias("members")).filter("members > 1"), "groups")
    several = common.stored(leaders.join(groups, "h"), "several")
    leading = segments.join(several, ["h", "digest"]).filter("first = lead.first and tie = lead.tie and start = lead.start").select("h", "segment", "first", "tie", "also", "start", "members")

    batch_bytes = BATCH_BYTES

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_bytes, last = 0, None

        def solve():
            held.sort(key=lambda r: (r[1], r[2], r[4]))
            ties, others, a, b = [], [], [], []
            for row, flags in zip(held, repeated_windows([r[0] for r in held], length), strict=True):
                hit = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                for x, y in zip(hit[::2].tolist(), hit[1::2].tolist(), strict=True):
                    ties.append(row[2])
                    others.append(row[3])
                    a.append(row[4] + x)
                    b.append(row[4] + y - 1 + length)
            return pa.RecordBatch.from_arrays([pa.array(ties, pa.int64()), pa.array(others, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["tie", "also", "a", "b"])

        for batch in batches:
            for h, *row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if h != last and held_bytes >= batch_bytes:
                    yield solve()
                    held, held_bytes = [], 0
                last = h
                held.append(tuple(row))
                held_bytes += len(row[0])
        if held:
            yield solve()

    usual = leading.filter(F.col("members") <= LARGEST).drop("members").repartition("h").sortWithinPartitions("h")
    partly = usual.select("h", "segment", "first", "tie", "also", "start").mapInArrow(factors, "tie long, also long, a long, b long")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, first, tie, also, start in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                n = len(segment) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(segment[i : i + length]).digest() for i in range(n)], pa.binary()), pa.array(np.full(n, first)), pa.array(np.full(n, tie)), pa.array(np.full(n, also)), pa.array(np.arange(start, start + n))],
                    names=["window", "first", "tie", "also", "start"],
                )

    crowded = leading.filter(F.col("members") > LARGEST).select("segment", "first", "tie", "also", "start").mapInArrow(windows, "window binary, first long, tie long, also long, start long")
    earliest = crowded.groupBy("window").agg(F.min(place).alias("lead"))
    single = crowded.join(earliest, "window").filter("not (first = lead.first and tie = lead.tie and start = lead.start)").select("tie", "also", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    spans = common.stored(whole.union(partly).union(single).groupBy("tie", "also").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    common.drop(segments, leaders, groups, several)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, count, sums, lists, left = [], [], [], [], []
            for spans, data in zip(batch.column(3).to_pylist(), batch.column(4).cast(pa.binary()), strict=True):
                data, runs = data.as_py(), merged([(s["a"], s["b"]) for s in spans])
                rest = b"".join(data[x:y] for x, y in zip([0, *(b for _, b in runs)], [*(a for a, _ in runs), len(data)], strict=True))
                gone.append(len(data) - len(rest))
                count.append(len(runs))
                sums.append(hashlib.sha256(rest).hexdigest())
                lists.append([{"a": a, "b": b} for a, b in runs])
                left.append(rest)
            arrays = [*batch.columns[:3], pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sums, pa.string())]
            names = ["tie", "also", "first", "gone", "runs", "rest"]
            if texts:
                arrays += [pa.array(lists, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(left, pa.binary())]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    more = ", spans array<struct<a:long,b:long>>, kept binary" if texts else ""
    cut_rows = first_rows.join(spans.join(firsts, ["tie", "also"]).select("tie", "also", "first", "spans"), ["tie", "also", "first"])
    changed = cut_rows.dropDuplicates(["tie", "also", "first"]).select("tie", "also", "first", "spans", "body").mapInArrow(keep, f"tie long, also long, first long, gone long, runs long, rest string{more}")
    base = rows.select("id", "tie", "also", "bytes", F.sha2("body", 256).alias("sha"), *([F.col("body").cast("binary").alias("body")] if texts else []))
    copied = firsts.filter("n > 1").select("tie", "also", F.col("first").alias("lead"))
    joined = base.join(copied, ["tie", "also"], "left").withColumn("first", F.coalesce("id", F.lit(-(1 << 63)))).join(changed, ["tie", "also", "first"], "left")
    later_copy = F.col("lead").isNotNull() & (F.col("lead") != F.col("first"))
    empty = hashlib.sha256(b"").hexdigest()
    size = F.col("bytes").cast("long")
    out = [
        F.col("id").alias(key),
        size.alias("n_bytes"),
        F.when(later_copy, size).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(later_copy, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(later_copy, F.lit(empty)).otherwise(F.coalesce("rest", "sha")).alias("kept_sha256"),
    ]
    if texts:
        none = F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")
        out += [F.when(later_copy, F.array(F.struct(F.lit(0).cast("long").alias("a"), size.alias("b")))).otherwise(F.coalesce("spans", none)).alias("spans"), F.when(later_copy, F.lit(b"")).otherwise(F.coalesce("kept", "body")).alias("kept")]
    return joined.select(*out)
