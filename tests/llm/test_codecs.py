"""Token counts, the token store and the piece codec against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from terrazzo.llm import byte_bpe, common, pieces, token_store

TEXTS = ["", "a", " a  b\n\n c", "The quick brown fox's 12 jumps, don't!", "<|endoftext|>x<|endoftext|>", "▁▁ x▁y", "naïve — 你好 😀 \x85 　é", "aaaa" * 500, "x" * 3000, "  lead and trail  ", "\x1c\x1d odd​spaces here", "<s> </s> <0x0A>"]


def fuzz(n, seed):
    rng = random.Random(seed)
    parts = list("ab  \n\t.'sré1²½一 ▁\x1c\x85　️😀٣_,!") + ["<|endoftext|>", "'s", " the", "   ", "<s>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS + fuzz(60, 3))]
    rows += [(3, TEXTS[3], "repeated", 2), (None, "no id", "x", 3), (900, None, "null text", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n_tokens int")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.vocabulary("byte_bpe_50k.json"))


def test_heap_counts_equal_the_library():
    count, lib = byte_bpe.counter(common.vocabulary("byte_bpe_50k.json")), library()
    for t in TEXTS + fuzz(3000, 1):
        assert count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_count_query_defines_every_row(spark, docs):
    out = byte_bpe.count_tokens(docs, common.vocabulary("byte_bpe_50k.json"))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows, lib = out.collect(), library()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in docs.collect():
        t = r.text or ""
        assert (by_id[r.doc_id].n_bytes, by_id[r.doc_id].n_tokens) == (len(t.encode()), len(lib.encode(t).ids))
    assert byte_bpe.count_tokens(docs.limit(0), common.vocabulary("byte_bpe_50k.json")).count() == 0


def test_elias_fano_round_trip_and_select():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 10**9), (500, 3), (3000, 10**7), (200, 200)):
        v = np.sort(rng.integers(0, top + 1, n))
        code = token_store.EliasFano.from_bytes(token_store.EliasFano.encode(v).to_bytes(), n)
        assert code.values().tolist() == v.tolist()
        assert [code.select(i) for i in range(0, n, max(1, n // 50))] == v[:: max(1, n // 50)].tolist()
    wide = np.sort(rng.integers(0, 10**8, 20_000))
    assert len(token_store.EliasFano.encode(wide).to_bytes()) < 20_000 * 8 / 3


def test_store_reads_back_what_the_library_gives(spark, docs):
    shards = token_store.write_store(docs, common.vocabulary("byte_bpe_50k.json"), 2)
    out = token_store.read_store(shards).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    lib, at, want = library(), 0, []
    for r in rows:
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == want
    image = shards.first()["image"]
    shard = token_store.Shard(bytes(image))
    assert shard.document(0).tolist()[-1] == 2
    assert token_store.read_store(token_store.write_store(docs.limit(0), common.vocabulary("byte_bpe_50k.json"), 2)).count() == 0


def test_starts_follow_totals_of_any_bytes(spark):
    """Four parts of 195 ids (0xC3, the first byte of a two-byte character) each."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.createDataFrame([(i, " a" * 194) for i in range(4)], "doc_id long, text string")
        shards = token_store.write_store(rows, common.vocabulary("byte_bpe_50k.json"), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    images = shards.select("part", "image").collect()
    assert len({r.part for r in images}) > 2
    assert any(token_store.Shard(bytes(r.image)).total & 0xFF >= 0xC2 for r in images if r.part < max(x.part for x in images))
    got = sorted((r.doc_id, r.start, r.n_tokens) for r in token_store.read_store(shards).collect())
    assert got == [(i, 195 * i, 195) for i in range(4)]


def test_several_shards_null_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 40)
    rows = [(None, "first of all"), (None, "another one"), *((7, f"same key {i}") for i in range(9)), *((i * 1000003, "word " * (i % 13)) for i in range(30)), (-5, None), (2**62, "far")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shards = token_store.write_store(docs, common.vocabulary("byte_bpe_50k.json"), 2)
    assert shards.agg({"seq": "max"}).first()[0] > 1
    out = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in token_store.read_store(shards).collect())
    lib = library()
    want = {}
    for k, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault(k, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for start, n, key, crc in out:
        assert start == at and (n, crc) in want[key]
        want[key].remove((n, crc))
        at += n
    assert not any(want.values())
    keys = [key for _, _, key, _ in out]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])


def test_caches_stay_small_on_unspaced_text():
    count, codec = byte_bpe.counter(common.vocabulary("byte_bpe_50k.json")), pieces.codec(common.vocabulary("piece_bpe_32k.model"))
    rng = random.Random(2)
    for _ in range(30):
        blob = "".join(rng.choices("ABCDEFabcdef0123456789+/", k=20_000))
        count(blob)
        codec.code(blob)
    for memo in (count.words, count.after_gap, codec.segments, codec.cuts):
        assert sum(map(len, memo)) + sum(map(len, memo.old)) <= 2 * memo.letters


def test_prefix_table_equals_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=common.vocabulary("piece_bpe_32k.model"))
    own = pieces.codec(common.vocabulary("piece_bpe_32k.model"))
    for t in TEXTS + fuzz(2000, 2):
        ids = lib.encode(t)
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids), repr(t)
        assert own.code(t) == (len(ids), ",".join(map(str, ids)), lib.decode(ids))
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 6))]
        assert own.decode(ids) == lib.decode(ids), ids


def test_piece_query_defines_every_row(spark, docs):
    out = pieces.encode_decode(docs, common.vocabulary("piece_bpe_32k.model"), digest=True)
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[900].n_tokens == 0 and by_id[900].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert out.count() == docs.count() and None in by_id
    full = pieces.encode_decode(docs, common.vocabulary("piece_bpe_32k.model")).filter("doc_id = 1").first()
    assert full.decoded == "a" and full.n_tokens == len(full.ids)


def test_many_texts_at_once_match_the_library_and_look_parts_up_once(monkeypatch):
    """Even and uneven gaps, Unicode's white space, special strings, nulls and slices; a part that comes back costs no lookup of its own."""
    import pyarrow as pa

    from terrazzo.llm import common, token_store

    encode = token_store.Encoder(common.vocabulary("byte_bpe_50k.json"))
    rng = random.Random(8)
    pieces = [" ", "  ", "\n", " \t", "　", "\xa0", "\x85", "\x1c", "\x0b", "​", "é", "日本", "don't", "x", "1,", "a.b", "<|endoftext|>", "\U0001f642", "foo", "Bar;", " word", " word"]
    texts = [None, "", " ", "  ", *("".join(rng.choices(pieces, k=rng.randrange(14))) for _ in range(3000))]
    want = [b"".join([encode.packed[i] for i in encode.library.encode(t or "", add_special_tokens=False).ids]) for t in texts]
    for portion in (64, 1 << 24):
        monkeypatch.setattr(token_store, "PORTION", portion)
        assert list(encode.many(pa.array(texts, pa.string()))) == want
        assert list(encode.many(pa.array(texts, pa.string())[7:300])) == want[7:300]
    assert list(encode.many(pa.array([], pa.string()))) == []
    asked = []
    monkeypatch.setattr(encode, "after_gap", type("Told", (common.Memo,), {"all": lambda self, keys: asked.extend(keys) or common.Memo.all(self, keys)})(encode.encode_after_gap, 100))
    list(encode.many(pa.array(["every word here " * 500 + "ends"] * 20)))
    assert sorted(asked) == ["ends", "every", "here", "word"]
    assert len(encode.after_gap) <= 100
