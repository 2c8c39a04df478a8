"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding.

Encoding a string by merges has a property that makes it incremental: the tokens
of a prefix are those of a shorter prefix and one more, the prefix's last token,
which is unique. So one pass over the string fills a table: an automaton over
the vocabulary gives the tokens that end at each place; the one that is chosen is
the one that is compatible with the last token of what stands before it, i.e. the
two, merged as a string of their own, come out as those two. Ids are recovered
from the end of the table backwards. Characters outside the vocabulary become
byte tokens and touch no merge.

Strings are cut first where no merge can cross: at any two neighbours that no
vocabulary entry holds side by side. What lies between cuts repeats a lot, so it
is kept in bounded caches. Each row is independent: no shuffle, no state.

Defined results: a null text counts as empty (no ids, empty decoded text);
repeated rows give repeated results; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceCodec:
    """One SentencePiece BPE vocabulary with a dummy prefix and byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(count)]
        self.byte_of = {i: int(self.piece[i][3:5], 16) for i in range(count) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.unknown = model.unk_id()
        self.silent = {i for i in range(count) if model.is_control(i)}
        self.score = {self.piece[i]: model.get_score(i) for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.id = {self.piece[i]: i for i in range(count) if self.piece[i] in self.score and i not in self.byte_of}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.id.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.size = [len(p) for p in self.piece]
        self.inner = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.compatible = common.Memo(self.test_pair, 400_000, letters=0)
        self.cuts = common.Memo(self.encode_cut, 100_000)
        self.segments = common.Memo(self.code_segment, 250_000)

    def merge(self, text: str) -> list[str]:
        """Merges by definition: the best-scored adjacent pair first, the leftmost of equals."""
        parts, score, none = list(text), self.score.get, -math.inf
        worth = [score(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while worth and (best := max(worth)) > none:
            i = worth.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del worth[i]
            if i:
                worth[i - 1] = score(parts[i - 1] + parts[i], none)
            if i < len(worth):
                worth[i] = score(parts[i] + parts[i + 1], none)
        return parts

    def test_pair(self, pair: int) -> bool:
        """Whether two ids, as left << 16 | right, stay as they are; left -1: whether right does on its own."""
        left, right = pair >> 16, self.piece[pair & 0xFFFF]
        return self.merge(right) == [right] if left < 0 else self.merge(self.piece[left] + right) == [self.piece[left], right]

    def encode_cut(self, text: str) -> tuple[int, ...]:
        """Ids of any string, by the table of each prefix's last token (-1: not in the vocabulary)."""
        last, size, compatible = [-1] * len(text), self.size, self.compatible
        for end, i in self.automaton.iter(text):  # by end, longest first
            if last[end] < 0:
                start = end - size[i]
                if compatible[(last[start] if start >= 0 else -1) << 16 | i]:
                    last[end] = i
        out, at = [], len(text) - 1
        while at >= 0:
            i = last[at]
            if i >= 0:
                out.append(i)
                at -= size[i]
            else:
                out += [self.byte_id.get(b, self.unknown) for b in reversed(text[at].encode())]
                at -= 1
        return tuple(reversed(out))

    def encode_segment(self, text: str) -> list[int]:
        inner, begin, out = self.inner, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in inner:
                out += self.cuts[text[begin:i]]
                begin = i
        out += self.cuts[text[begin:]]
        return out

    def spell(self, ids) -> str:
        """What ids stand for, spaces included, without the rule for the first one."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(spell_bytes(held))
                held = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.piece[i].replace(SPACE, " "))
        if held:
            out.append(spell_bytes(held))
        return "".join(out)

    def code_segment(self, rest: str) -> tuple[str, str]:
        """Comma-joined ids of a space sign and `rest`, and what they decode to."""
        if rest.isalpha():
            ids = self.encode_cut(SPACE + rest)
        elif rest[-1:] in ".,;:!?" and rest[:-1].isalpha() and rest[-2:] not in self.inner:
            word, mark = self.segments[rest[:-1]], self.cuts[rest[-1]]
            return f"{word[0]},{','.join(map(str, mark))}", word[1] + rest[-1]
        else:
            ids = self.encode_segment(SPACE + rest)
        return ",".join(map(str, ids)), self.spell(ids)

    @staticmethod
    def split(text: str) -> list[str]:
        """Segments without the space sign that each begins with."""
        parts = text.split(" ")
        if "" in parts or SPACE in text:
            parts = [s[1:] for s in _SEGMENT.findall(SPACE + text.replace(" ", SPACE))]
        return parts

    def encode(self, text: str) -> list[int]:
        return [i for rest in self.split(text) for i in self.encode_segment(SPACE + rest)] if text else []

    def decode(self, ids) -> str:
        """The text of `ids`; the dummy prefix's space goes."""
        ids = [i for i in ids if i not in self.silent]
        return self.spell(ids).removeprefix("" if ids and ids[0] in self.byte_of else " ")

    def code(self, text: str) -> tuple[int, str, str]:
        """(number of ids, comma-joined ids, decoded text)."""
        if not text:
            return 0, "", ""
        found = list(map(self.segments.__getitem__, self.split(text)))
        ids = ",".join([f[0] for f in found])
        return ids.count(",") + 1, ids, "".join([f[1] for f in found]).removeprefix(" ")


def spell_bytes(data: bytes) -> str:
    """UTF-8, with one replacement character for each byte that is part of no character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(bytes(data[at : at + size]).decode())
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec a worker and vocabulary."""
    return PieceCodec(path)


def encode_decode(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row; with `digest`, SHA-256 of both instead."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocabulary)
        for batch in (piece for b in batches for piece in common.slices(b)):
            n, ids, texts = [], [], []
            for x in batch.column(1):
                size, joined, decoded = tool.code(x.as_py() or "")
                n.append(size)
                ids.append(hashlib.sha256(joined.encode()).hexdigest() if digest else [int(i) for i in joined.split(",")] if joined else [])
                texts.append(hashlib.sha256(decoded.encode()).hexdigest() if digest else decoded)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string() if digest else pa.list_(pa.int32())), pa.array(texts, pa.string())], names=["key", "n_tokens", "ids", "decoded"])

    rows = common.spread(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    out = rows.mapInArrow(run, f"key {kind}, n_tokens long, ids {'string' if digest else 'array<int>'}, decoded string").withColumnRenamed("key", key)
    return out.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"}) if digest else out
