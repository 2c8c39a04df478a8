"""Byte-level BPE: pretokens, and token counts by heap and linked list.

`count_tokens` is the operator. A text is cut into pretokens by the pattern of
the vocabulary; within a pretoken a heap holds every adjacent pair that has a
rank, a doubly linked list holds the symbols that are left. The lowest rank
(leftmost if equal) is popped until no ranked pair is left, and the count is the
number of bytes less the number of merges. No identifier list is made.

Cost: words repeat, so counts are kept per word in a bounded cache of the Python
worker, and a text mostly costs one split and one lookup a word. The plan has no
shuffle and no state between rows, so a lost executor repeats its own splits only.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows
give repeated results; an empty table gives an empty table; columns other than
the two named ones are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The pretoken pattern of the published byte-level vocabularies,
# with white space as Unicode's White_Space property has it.
GAP = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRETOKEN = rf" ?\p{{L}}+|'(?:s|t|re|ve|m|ll|d)| ?\p{{N}}+| ?[^{GAP}\p{{L}}\p{{N}}]+|[{GAP}]+(?![^{GAP}])|[{GAP}]+"

_UNEVEN = re.compile(r" \s|\s ")
_EVEN_GAP = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def chunks(text: str) -> tuple[str, list[str]]:
    """The text up to the first even gap, and what follows each even gap.

    An even gap is one space between characters that aren't white space. No
    pretoken crosses it, and the space belongs to what follows.
    """
    parts = text.split(" ") if not _UNEVEN.search(text) and text[:1] != " " and text[-1:] != " " else _EVEN_GAP.split(text)
    return parts[0], parts[1:]


class HeapCounter:
    """Counts the tokens of pretokens under one vocabulary.

    A symbol is a byte's value, or 256 + rank once it was made by a merge.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        symbol = {c: b for b, c in enumerate(byte_letters())}
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(symbol[left] << 16 | symbol[right], rank)
            symbol.setdefault(left + right, 256 + rank)
        self.first = [self.merges.get((x >> 8) << 16 | x & 255, -1) for x in range(1 << 16)]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.find = regex.compile(PRETOKEN).findall
        self.words = common.Memo(self.count_pretoken, 100_000)
        self.after_gap = common.Memo(self.count_after_gap, 400_000)

    def count_pretoken(self, word: str) -> int:
        """Symbols less merges."""
        data, first, known = word.encode(), self.first, self.merges.get
        n = len(data)
        heap = [rank << 32 | i for i in range(n - 1) if (rank := first[data[i] << 8 | data[i + 1]]) >= 0]
        if not heap:
            return n
        heapify(heap)
        symbols, after, before, left = list(data), list(range(1, n + 1)), list(range(-1, n - 1)), n
        while heap:
            top = heappop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if j >= n or known(symbols[i] << 16 | symbols[j]) != rank:
                continue  # one of the two has merged meanwhile
            symbols[i], symbols[j] = merged, _ = 256 + rank, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := known(merged << 16 | symbols[k])) is not None:
                    heappush(heap, rank << 32 | i)
            k = before[i]
            if k >= 0 and (rank := known(symbols[k] << 16 | merged)) is not None:
                heappush(heap, rank << 32 | k)
        return left

    def count_after_gap(self, part: str) -> int:
        """Tokens of a space and `part`; letters alone, or before one mark, need no pattern."""
        if part.isalpha():
            return self.count_pretoken(" " + part)
        if part[-1:] in ".,;:!?" and part[:-1].isalpha():
            return self.after_gap[part[:-1]] + 1
        return sum(map(self.words.__getitem__, self.find(" " + part)))

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        runs = self.special.split(text) if self.special else [text]
        total = len(runs) - 1
        for run in runs:
            if run:
                first, rest = chunks(run)
                total += sum(map(self.words.__getitem__, self.find(first))) + sum(map(self.after_gap.__getitem__, rest))
        return total


@functools.lru_cache(maxsize=2)
def counter(path: str) -> HeapCounter:
    """One counter a worker and vocabulary."""
    return HeapCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row of `docs`."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            size = [len(t.encode()) if (t := x.as_py()) else 0 for x in texts]
            tokens = [count(x.as_py() or "") for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64())], names=["key", "n_bytes", "n_tokens"])

    out = common.spread(docs.select(F.col(key).alias("key"), F.col(text).alias("text"))).mapInArrow(run, f"key {kind.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
