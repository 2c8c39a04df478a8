"""Size-aware heavy-light join of documents on the Jaccard similarity of word shingles.

Texts become sets of 64-bit shingle hashes. Equal sets are one node first. Then,
by a boundary on set size:

* light sets: a pair of sizes (s, t) links exactly if the sets share o(s, t)
  elements, so each set lists its subsets of that fixed size, per pair of sizes,
  and equal subsets meet; keys have 128 bits;
* heavy sets: inverted lists of the shingles that come first in one global order
  (rare ones first); two sets that link share one of their first
  n - ceil(0.9 n) + 1.

Light sets reach a band above the boundary, so a pair across it meets as subsets.
The order is by document counts over the whole corpus, hashed into COUNTERS
counters. The boundary is the size from which listing subsets costs more than
scanning lists; sizes come from all documents, the length of lists from a sample.
Neither changes the result: any order and any boundary give the same links.

A list is not multiplied out. Lists are split by size bands, so that members can
link by size. Each list compares its members with one leader; links merge
components; lists whose members are in one component are done. The leader is the
member with the fewest prefix elements of its own: among copies that were each
altered by themselves, nearly all that link with any member link with that one. A
second round takes the leader outside the list's main component. They are followed
by an exact one: members outside a list's main component meet all others that are
still in another component, long lists dealt out to several tasks.

What meets is checked in three steps. Parity sketches bound the symmetric
difference from below: 1024 bits within the join, then one bit a shingle, so that
large sets are told apart too. What is left is checked on the full sets: first the
nearest partner of each member, then those pairs that are still in two components.
So a group of near copies costs rows in proportion to its members, and no link
that matters for a component is lost.

Defined results: null ids link with nothing and get a null component; rows that
share an id are one document, which links by any of its texts; null or wordless
texts have an empty set and their own id; an empty table gives an empty table;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: Documents in the sample from which the boundary's costs are estimated, at most about.
SAMPLE = 8192
#: Counters of shingles over all documents, and how many of them one row carries.
COUNTERS, CHUNK = 1 << 19, 1 << 14
#: Parts, by hash, in which the lists' entries are counted: shuffle files of one part go before the next.
PARTS = 4
#: Costs in rows that are moved: of meeting a member of a list, and of an element in its full check.
MEETING, ELEMENT = 8.0, 0.5
#: Members outside the main component of a list that one task compares.
DEAL = 1024
SKETCH_WORDS = 16
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; fewer words are one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    many = max(1, len(ids) - width + 1)
    out = np.full(many, min(len(ids), width), np.uint64)
    for k in range(min(width, len(ids))):
        out = mixed(out * _MIX[0] + ids[k : k + many])
    return np.unique(out)


def overlap(s: int, t: int, percent: int) -> int:
    """Common elements that sets of s and t need to link."""
    return -(-percent * (s + t) // (100 + percent))


def partners(s: int, percent: int) -> range:
    """Sizes that a set of s can link with."""
    return range(max(1, -(-percent * s // 100)), 100 * s // percent + 1)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


@functools.lru_cache(maxsize=256)
def left_out(size: int, count: int) -> np.ndarray:
    """The places of every choice of `count` out of `size`."""
    found = itertools.chain.from_iterable(itertools.combinations(range(size), count))
    return np.fromiter(found, np.int64).reshape(-1, count) if count else np.zeros((1, 0), np.int64)


def subset_keys(sets: np.ndarray, boundary: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys, as rows of two numbers, and sizes of the smaller set for every fixed-size subset: sums of mixed hashes."""
    s = len(sets)
    own = np.stack([mixed(sets + _MIX[0]), mixed(sets ^ _MIX[2])], 1)
    whole = own.sum(0, dtype=np.uint64)
    keys, smaller = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int32)]
    for t in partners(s, percent):
        small, large = min(s, t), max(s, t)
        need = overlap(s, t, percent)
        if small >= boundary or need > s:
            continue
        label = mixed(np.array([small << 32 | large], np.uint64))
        found = mixed((whole - own[left_out(s, s - need)].sum(1, dtype=np.uint64)) ^ label)
        keys.append(found)
        smaller.append(np.full(len(found), small, np.int32))
    return np.concatenate(keys), np.concatenate(smaller)


@dataclass
class Plan:
    """What the corpus says: counts by hashed shingle, and the boundary."""

    counts: np.ndarray
    boundary: int

    def prefix(self, sets: np.ndarray, percent: int) -> np.ndarray:
        """The first elements in the global order: by counter, then by hash."""
        rank = self.counts[(sets & np.uint64(COUNTERS - 1)).astype(np.int64)]
        return sets[np.lexsort((sets, rank))[: prefix_size(len(sets), percent)]]


def corpus_counts(docs: DataFrame, text: str, width: int) -> tuple[np.ndarray, dict[int, int]]:
    """Documents by hashed shingle, and by set size, over all documents.

    A task sends its counters as COUNTERS / CHUNK rows; they are added up in two
    steps, so no task reads what more than some hundreds have sent for one chunk.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sizes = np.zeros(COUNTERS, np.uint32), {}
        held, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                sets = shingles(x.as_py(), width)
                sizes[len(sets)] = sizes.get(len(sets), 0) + 1
                held.append(sets & np.uint64(COUNTERS - 1))
                size += len(sets)
                if size >= COUNTERS:
                    own += np.bincount(np.concatenate(held).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
                    held, size = [], 0
        if held:
            own += np.bincount(np.concatenate(held).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        if sizes:
            yield told({k: own[k * CHUNK : (k + 1) * CHUNK].astype(np.int64) for k in range(COUNTERS // CHUNK)}, sizes)

    def told(chunks: dict[int, np.ndarray], sizes: dict[int, int]) -> pa.RecordBatch:
        blobs = [c.astype("<i8").tobytes() for c in chunks.values()] + [np.array(list(sizes.items()), "<u8").tobytes()]
        from pyspark import TaskContext

        salt = np.full(len(blobs), TaskContext.get().partitionId())
        return pa.RecordBatch.from_arrays([pa.array([*chunks, -1], pa.int32()), pa.array(salt, pa.int64()), pa.array(blobs, pa.binary())], names=["chunk", "salt", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                values = np.frombuffer(blob.as_py(), "<u8").astype(np.int64)
                if k >= 0:
                    chunks[k] = chunks[k] + values if k in chunks else values
                else:
                    for s, n in values.reshape(-1, 2).tolist():
                        sizes[s] = sizes.get(s, 0) + n
        if chunks or sizes:
            yield told(chunks, sizes)

    kind = "chunk int, salt long, blob binary"
    partial = docs.select(F.col(text).alias("text")).mapInArrow(count, kind)
    partial = partial.repartition("chunk", F.pmod("salt", F.lit(16))).mapInArrow(add, kind)
    # At most COUNTERS counters in chunks, and as many pairs as there are sizes.
    total = partial.repartition("chunk").mapInArrow(add, kind)
    with common.freed(docs.sparkSession):
        rows = total.toArrow()
    counts, sizes = np.zeros(COUNTERS, np.uint32), {}
    for k, blob in zip(rows["chunk"].to_pylist(), rows["blob"], strict=True):
        values = np.frombuffer(blob.as_buffer(), "<i8")
        if k >= 0:
            counts[k * CHUNK : (k + 1) * CHUNK] = np.minimum(values, 0xFFFFFFFF)
        else:
            for s, n in values.reshape(-1, 2).tolist():
                sizes[s] = sizes.get(s, 0) + n
    return counts, sizes


def plan(docs: DataFrame, key: str, text: str, width: int, percent: int) -> Plan:
    """Order and sizes from all documents; the boundary's costs from about SAMPLE of them, chosen by hash of the id."""
    counts, sizes = corpus_counts(docs, text, width)
    part = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    held = docs.sparkSession.sparkContext.broadcast(Plan(counts, 1))
    chosen = docs.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int(part * (1 << 30))).select(F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (texts,) in common.portions(batch, "text", limit=1 << 23):
                found = np.concatenate([np.zeros(0, np.uint64), *(held.value.prefix(s, percent) for t in texts if len(s := shingles(t, width)))])
                found, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["h", "n"])

    lists = chosen.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    stats = lists.agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")).first()
    met = (stats["q"] / stats["s"] - 1) / max(part, 1e-9) if stats["s"] else 0.0
    return Plan(counts, cheapest_boundary(sizes, met, percent))


def cheapest_boundary(sizes: dict[int, int], met: float, percent: int) -> int:
    """The size below which sets list subsets, from counts of sizes and the others that a list's entry meets.

    A listed subset and a list's entry are one moved row each. A subset that meets
    links as it is; a member of a list that meets its leader costs MEETING rows and
    ELEMENT for each element of the full check.
    """

    def listed(s: int, boundary: int) -> int:
        return sum(math.comb(s, o) for t in partners(s, percent) if min(s, t) < boundary and (o := overlap(s, t, percent)) <= s)

    def scanned(s: int) -> float:
        entries = prefix_size(s, percent)
        return entries + min(1.0, entries * met) * (MEETING + ELEMENT * s)

    known = sorted((s, n) for s, n in sizes.items() if s)
    over, best, least = sum(n * scanned(s) for s, n in known), 1, math.inf
    for boundary in range(1, (known[-1][0] if known else 0) + 2):
        top = 100 * boundary // percent + 1
        lists = sum(n * listed(s, boundary) for s, n in itertools.takewhile(lambda x: x[0] <= top, known))
        if lists >= least:
            break  # subsets alone cost more than the best, and larger boundaries list more
        cost = lists + over
        if cost < least:
            best, least = boundary, cost
        over -= sum(n * scanned(s) for s, n in known if s == boundary)
    return best


def sketch_of(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Parity of the set's hashes in 64 * SKETCH_WORDS bits, and in a power of two of at least one bit an element where that is more."""
    bits = 64 * SKETCH_WORDS
    width = max(bits, 1 << max(0, len(sets) - 1).bit_length())
    parity = np.bincount(((sets >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    coarse = np.bitwise_xor.reduce(parity.reshape(-1, bits), 0)
    words = lambda p: np.packbits(p.astype(np.uint8)).view(np.int64)
    return words(coarse), words(parity) if width > bits else None


def describe(docs: DataFrame, key: str, text: str, width: int, percent: int, how: Plan) -> DataFrame:
    """(key, n, sig, prefix, subsets, sketch, fine) of every row, in one pass over the texts."""
    held = docs.sparkSession.sparkContext.broadcast(how)
    kind = docs.schema[key].dataType.simpleString()
    subset = pa.struct([("h", pa.int64()), ("g", pa.int64()), ("small", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed = held.value
        top = 100 * fixed.boundary // percent + 1
        for batch in (piece for b in batches for piece in common.slices(b)):
            n, sig, prefix, subsets, sketch, fine = [], [], [], [], [], []
            for x in batch.column(1):
                sets = shingles(x.as_py(), width)
                size = len(sets)
                n.append(size)
                sig.append(hashlib.blake2b(sets.tobytes(), digest_size=16).digest())
                prefix.append(fixed.prefix(sets, percent).view(np.int64) if size >= fixed.boundary and size else [])
                if 0 < size <= top:
                    keys, small = subset_keys(sets, fixed.boundary, percent)
                    subsets.append([{"h": h, "g": g, "small": m} for (h, g), m in zip(keys.view(np.int64).tolist(), small.tolist(), strict=True)])
                else:
                    subsets.append([])
                coarse, whole = sketch_of(sets)
                sketch.append(coarse)
                fine.append(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(sig, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(subsets, pa.list_(subset)), pa.array(sketch, pa.list_(pa.int64())), pa.array(fine, pa.list_(pa.int64()))],
                names=["key", "n", "sig", "prefix", "subsets", "sketch", "fine"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n int, sig binary, prefix array<long>, subsets array<struct<h:long,g:long,small:int>>, sketch array<long>, fine array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(node, elements) for the wanted nodes."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for b in batches for piece in common.slices(b)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x.as_py(), width).view(np.int64) for x in batch.column(1)], pa.list_(pa.int64()))], names=["node", "elements"])

    rows = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(wanted, "node", "left_semi")
    return rows.mapInArrow(run, f"node {kind}, elements array<long>")


def allowed(a: str, b: str, percent: int) -> str:
    """SQL: the largest symmetric difference of two members that link."""
    total = f"(cast({a}.n as bigint) + {b}.n)"
    return f"{total} - 2 * (({percent} * {total} + {99 + percent}) div {100 + percent})"


def same_size(a: str, b: str, percent: int) -> str:
    return f"100L * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"


def bits_apart(x: str, y: str) -> str:
    """SQL: bits in which two arrays of words differ; null where one is null."""
    return f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)"


def coarse(a: str, b: str) -> str:
    """SQL: a lower bound of the symmetric difference, by the sketches of fixed size, written out for the inside of a join."""
    return " + ".join(f"bit_count({a}.sketch[{k}] ^ {b}.sketch[{k}])" for k in range(SKETCH_WORDS))


def finer(a: str, b: str) -> str:
    """SQL: the same by the larger sketches, the longer one folded to the length of the other; null where one has none."""
    halves = lambda x: f"zip_with(slice({x}, 1, size({x}) div 2), slice({x}, size({x}) div 2 + 1, size({x}) div 2), (p, q) -> p ^ q)"
    fit = lambda x, y: f"case when size({x}) = 2 * size({y}) then {halves(x)} else {x} end"
    x, y = f"{a}.fine", f"{b}.fine"
    return bits_apart(fit(x, y), fit(y, x))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("y")), "b")
    common_size = F.size(F.array_intersect("x", "y"))
    return two.select("a", "b", F.size("x").cast("long").alias("s"), F.size("y").alias("t"), common_size.alias("i")).filter(f"100 * i >= {percent} * (s + t - i)").select("a", "b").distinct()


def mains(lists: DataFrame) -> DataFrame:
    """(h, band, main, apart): each list's component of most members, and the members outside it."""
    sizes = lists.groupBy("h", "band", "component").agg(F.count("*").alias("c"))
    main = sizes.groupBy("h", "band").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("all"))
    return main.select("h", "band", F.col("top.component").alias("main"), (F.col("all") - F.col("top.c")).alias("apart"))


def led(lists: DataFrame, percent: int, *, outside: bool) -> DataFrame:
    """Each list's members against one member, its leader: the least alone of all, or of those outside the main component."""
    choice = lists.join(mains(lists), ["h", "band"]).filter("component <> main") if outside else lists
    heads = choice.groupBy("h", "band").agg(F.min(F.struct("alone", F.xxhash64("node").alias("at"), "node", "n", "component")).alias("head"))
    pairs = lists.alias("m").join(heads.alias("l"), ["h", "band"]).filter("m.component <> l.head.component").filter(same_size("m", "l.head", percent))
    return pairs.select(F.col("m.node").alias("a"), F.col("l.head.node").alias("b")).distinct()


def sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b, d) for the pairs that the sketches of both allow to link; d bounds their difference from below."""
    one = pairs.join(sketches.select(F.col("node").alias("a"), F.struct("n", "sketch", "fine").alias("x")), "a")
    two = one.join(sketches.select(F.col("node").alias("b"), F.struct("n", "sketch", "fine").alias("y")), "b")
    near = two.filter(same_size("x", "y", percent)).select("a", "b", F.expr(f"coalesce({finer('x', 'y')}, {bits_apart('x.sketch', 'y.sketch')})").alias("d"), F.expr(allowed("x", "y", percent)).alias("most"))
    return near.filter("d <= most").groupBy("a", "b").agg(F.min("d").alias("d"))


def rest(lists: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Members outside a list's main component against all members of other components; long lists are dealt out."""
    lists = common.stored(lists.join(sketches.select("node", "sketch"), "node"), "rest")
    main = mains(lists).withColumn("deals", F.ceil(F.col("apart") / DEAL).cast("int"))
    told = lists.join(main, ["h", "band"])
    few = told.filter("component <> main").withColumn("deal", F.pmod(F.xxhash64("node"), F.col("deals")).cast("int"))
    every = told.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    pairs = few.alias("m").join(
        every.alias("l"), F.expr(f"m.h = l.h and m.band = l.band and m.deal = l.deal and m.component <> l.component and (l.component = m.main or m.node < l.node) and {same_size('m', 'l', percent)} and {coarse('m', 'l')} <= {allowed('m', 'l', percent)}")
    )
    return pairs.select(F.col("m.node").alias("a"), F.col("l.node").alias("b")).distinct()


def of_two(lists: DataFrame) -> DataFrame:
    """Lists whose members are in two components or more."""
    several = lists.groupBy("h", "band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("h", "band")
    return lists.join(several, ["h", "band"])


def unlike(lists: DataFrame) -> DataFrame:
    """Lists of two or more, one of those with the same members: a near copy shares most of its lists.

    Members are told by their count and four sums of 31 bits each from two hashes: 124
    bits, so that lists that differ don't agree by chance.
    """
    low, high = (lambda code: code.bitwiseAND(F.lit(0x7FFFFFFF))), (lambda code: F.shiftrightunsigned(code, 33))
    codes = [F.xxhash64("node"), F.xxhash64(F.lit("second"), "node")]
    sums = [F.sum(half(code)).alias(f"s{i}{j}") for i, code in enumerate(codes) for j, half in enumerate((low, high))]
    told = lists.groupBy("h", "band").agg(F.count("*").alias("c"), *sums).filter("c > 1")
    one = told.groupBy("c", "s00", "s01", "s10", "s11").agg(F.min(F.struct("h", "band")).alias("one")).select("one.h", "one.band")
    return lists.join(one, ["h", "band"])


def loneliness(lists: DataFrame, percent: int) -> DataFrame:
    """(node, alone): elements of a node's prefix that no other node lists; each shared one is in the lists of two bands."""
    prefix = F.expr(f"first(n) - ({percent}L * first(n) + 99) div 100 + 1")
    return lists.groupBy("node").agg((prefix - F.count("*") / 2).alias("alone"))


class Groups:
    """Components so far, and the full sets by which pairs are checked; each is read from the texts once."""

    def __init__(self, docs: DataFrame, key: str, text: str, width: int, percent: int):
        self.docs, self.key, self.text, self.width, self.percent = docs, key, text, width, percent
        self.tables: list[DataFrame] = []
        self.checked: list[DataFrame] = []
        self.found = docs.sparkSession.createDataFrame([], f"node {docs.schema[key].dataType.simpleString()}, component {docs.schema[key].dataType.simpleString()}")

    def links(self, pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        for known in self.tables:
            wanted = wanted.join(known.select("node"), "node", "left_anti")
        wanted = common.stored(wanted, "wanted")
        if not wanted.isEmpty():
            self.tables.append(common.stored(full_sets(self.docs, wanted, self.key, self.text, self.width), "elements"))
        common.drop(wanted)
        return linked(pairs, functools.reduce(DataFrame.union, self.tables), self.percent)

    def of(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        """`rows` with the component of `node` as `name`: the node itself if none is known."""
        own = self.found.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        return rows.join(own, rows[node] == F.col("_node"), "left").withColumn(name, F.coalesce("_component", F.col(node))).drop("_node", "_component")

    def merge(self, links: DataFrame) -> None:
        """Join the components that links (a, b) connect: a graph of components only."""
        joined = self.of(self.of(links, "a", "x"), "b", "y").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        joined = common.stored(joined.distinct(), "joined")
        many = joined.count()
        if not many:
            return
        moved = components(joined, many).select(F.col("node").alias("old"), F.col("component").alias("new"))
        # A component's own name is a node too; it may come twice, with one component.
        known = self.found.select("node", "component").union(moved.select("old", "old"))
        now = known.join(moved, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
        before, self.found = self.found, common.stored(now.groupBy("node").agg(F.min("component").alias("component")), "found")
        common.drop(joined, moved, before)

    def unchecked(self, pairs: DataFrame) -> DataFrame:
        """Pairs that no earlier round has checked."""
        if not self.checked:
            return pairs
        known = functools.reduce(DataFrame.union, self.checked)
        return pairs.join(known.union(known.select("b", "a")), ["a", "b"], "left_anti")

    def check(self, pairs: DataFrame) -> None:
        """Merge by pairs (a, b, d) whose sets link: the nearest partner of each first, then what is still apart."""
        if pairs.isEmpty():
            return
        first = common.stored(pairs.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select("a", F.col("m.b").alias("b")), "first")
        self.merge(self.links(first))
        self.checked.append(first)
        apart = self.of(self.of(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), "a", "x"), "b", "y").filter("x <> y")
        apart = common.stored(apart.select("a", "b"), "apart")
        if not apart.isEmpty():
            self.merge(self.links(apart))
            self.checked.append(apart)


def join_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """(key, n_shingles, component_id) of every row: links are Jaccard >= percent / 100 on word shingles."""
    docs = common.spread(docs.select(key, text))
    how = plan(docs, key, text, width, percent)
    table = common.stored(describe(docs, key, text, width, percent, how), "sets")
    first = lambda c: F.first(c).alias(c)
    nodes = common.stored(table.filter("n > 0 and key is not null").groupBy("sig").agg(F.min("key").alias("node"), *map(first, ("n", "prefix", "subsets", "sketch", "fine"))), "nodes")
    sketches = nodes.select("node", "n", "sketch", "fine")
    groups = Groups(docs, key, text, width, percent)
    # Rows that share an id are one document: each of its nodes links with the least.
    copies = common.stored(table.select("key", "n", "sig").join(nodes.select("sig", "node"), "sig", "left").select("key", "n", "node"), "copies")
    several = copies.filter("key is not null").groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("key", "a")
    same_id = copies.join(several, "key").filter("node <> a").select("a", F.col("node").alias("b"))
    groups.merge(same_id.union(light_links(nodes)))
    # Lists of two or more.
    entries = nodes.select("node", "n", F.explode("prefix").alias("h"))
    base = 1.000001 * math.log(100 / percent)
    band = F.floor(F.log(F.col("n")) / base)
    parts = []
    for k in range(PARTS):
        part = entries.filter(F.pmod("h", F.lit(PARTS)) == k)
        repeated = part.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
        parts.append(part.join(repeated, "h").select("h", "node", "n", F.explode(F.array(band, band + 1)).alias("band")))
    short = common.stored(parts[0], "short", *parts[1:])
    lists = common.stored(unlike(short).join(loneliness(short, percent), "node"), "lists")
    common.drop(short)
    for outside in (False, True, None):
        # A list that is in one component stays so: each round goes on with the open ones.
        before, lists = lists, common.stored(of_two(groups.of(lists.select("h", "band", "node", "n", "alone"), "node", "component")), "open")
        common.drop(before)
        if lists.isEmpty():
            break
        pairs = common.stored(sketched(groups.unchecked(rest(lists, sketches, percent) if outside is None else led(lists, percent, outside=outside)), sketches, percent), "pairs")
        groups.check(pairs)
        common.drop(pairs)
    own = groups.of(copies, "node", "component")
    common.drop(*groups.tables)
    return own.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("key").isNotNull(), F.coalesce("component", "node", "key")).alias("component_id"))


def light_links(nodes: DataFrame) -> DataFrame:
    """(a, b) of light sets with equal subsets: all of a key meet a member of the smaller size, with which each links."""
    keyed = nodes.select("node", "n", F.explode("subsets").alias("e")).select("node", "n", "e.*")
    heads = keyed.groupBy("h", "g", "small").agg(F.min(F.when(F.col("n") == F.col("small"), F.col("node"))).alias("head"), F.count("*").alias("c")).filter("c > 1 and head is not null")
    return keyed.join(heads, ["h", "g", "small"]).filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
