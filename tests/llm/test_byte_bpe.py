import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from postlens.llm import byte_bpe, queries

SCHEMA = "doc_id long, text string, lang string, n_tokens string"


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(queries.RANKS_PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=bpe.pattern, mergeable_ranks=bpe.ranks, special_tokens={})


def pack(ids):
    return b"".join(struct.pack("<I", i) for i in ids)


def test_matches_tiktoken_on_odd_texts(bpe, reference):
    rng = random.Random(3)
    pool = [chr(c) for c in range(0x250)] + list(" \n\t\r' 　​") * 12 + ["\U0001f600", "一", "١", "\0"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", " ", "  ", "a  b", " a", "a ", "it's  we'll\n\n x", "x" * 5000, " " * 3000 + "a", "<|endoftext|>"]
    got = bpe.encode_all(texts)
    assert got == [pack(reference.encode_ordinary(t)) for t in texts]
    assert [bpe.decode(x) for x in got] == [t.encode() for t in texts]


def test_results_do_not_depend_on_the_cache(bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 450)
    small = byte_bpe.ByteBpe(bpe.ranks, bpe.pattern)
    for _ in range(2):
        assert small.encode_all(["one two three", "four five one"]) == bpe.encode_all(["one two three", "four five one"])
    assert len(small.known) <= 2


def test_entry_that_merges_cannot_reach():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256}
    coder = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    assert coder.encode_all(["abc abcd"]) == [pack([256, 32, 97, 98, 99, 100])]


def test_frames(spark, bpe, reference):
    rows = [(1, "Hello, world", "en", "x"), (1, "Hello, world", "en", "x"), (2, None, None, None), (3, "", "fr", ""), (None, "é\n", "fr", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = byte_bpe.encode_documents(docs, bpe, with_ids=True)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()}
    want = set()
    for i, text, _, _ in rows:
        ids = reference.encode_ordinary(text or "")
        want.add((i, len(ids), hashlib.sha256(pack(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want and out.count() == len(rows)
    back = {(r.doc_id, r.text) for r in byte_bpe.decode_documents(out, bpe).collect()}
    assert back == {(i, t or "") for i, t, _, _ in rows}
    assert byte_bpe.encode_documents(docs.limit(0), bpe).count() == 0


def test_query(spark, reference):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_byte_bpe(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        r = got[d.doc_id]
        ids = reference.encode_ordinary(d.text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(pack(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_cache_is_bounded_in_bytes(monkeypatch):
    """Long texts with runs of white space are never kept, short units up to a bound."""
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 40_000)
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(queries.RANKS_PATH), public_tokenizers.PATTERN)
    again = byte_bpe.ByteBpe(byte_bpe.read_ranks(queries.RANKS_PATH), public_tokenizers.PATTERN)
    for i in range(60):
        texts = [f"line {i}  with\n\n runs " * 400, " ".join(f"word{i}x{j}" for j in range(300))]
        got = bpe.encode_all(texts)
        assert [bpe.decode(g).decode() for g in got] == texts
        size = sum(len(k) + len(v) + byte_bpe.CACHE_OVERHEAD for k, v in bpe.known.items())
        assert size <= 40_000 and size == bpe.held and max(map(len, bpe.known), default=0) <= byte_bpe.CACHE_LENGTH
        assert got == again.encode_all(texts)
