import hashlib
import random
import re
import struct

import pytest
import xxhash

from postlens.llm import minhash as M
from postlens.llm import queries


def chained(values, fmt):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(struct.pack(fmt, v), seed=seed).intdigest()
    return seed


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    if len(words) < M.SHINGLE:
        joined = xxhash.xxh64((" ".join(words) if words else text).encode(), seed=42).intdigest()
        return {xxhash.xxh64(struct.pack("<i", len(words)), seed=joined).intdigest()}
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words]
    return {chained(h[i:i + M.SHINGLE], "<Q") for i in range(len(h) - M.SHINGLE + 1)}


def brute(text):
    bins = {}
    for h in shingles(text):
        b, signed = h >> 57, h - (1 << 64) if h >> 63 else h
        bins[b] = min(bins.get(b, signed), signed)
    own = [bins.get(b, None) for b in range(M.BINS)]
    full = [v if v is not None else next(own[b] for b in M.probe_order(j) if own[b] is not None) for j, v in enumerate(own)]
    return "".join(f"{v & 255:02x}" for v in full)


def near(a, b):
    same = sum(a[i:i + 2] == b[i:i + 2] for i in range(0, len(a), 2)) / M.BINS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def check(rows, got):
    """rows in the order of the contract: descending doc_id, ties by text."""
    want = []
    for i, (doc, text) in enumerate(rows):
        following, n = rows[(i + 1) % len(rows)][1], len(text)
        edited = text[:n - n // 3] + following[:n // 3]
        a, b, c = brute(text), brute(edited), brute(following)
        want.append((doc, n, hashlib.sha256(edited.encode()).hexdigest(), a, b, round(near(a, b), 9), round(near(a, c), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
            for r in got.collect()]
    assert sorted(have, key=str) == sorted(want, key=str)


def ordered(rows):
    return sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))


@pytest.mark.parametrize("bucket_bytes", [M.BUCKET_BYTES, 300])
def test_cases(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(M, "BUCKET_BYTES", bucket_bytes)
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(["Ab", "c", "dé", "😀", "e f", "gh\n"]) for _ in range(n))
    rows = [(rng.choice((1, 10, 1000)) * i - 50, text(rng.choice((0, 1, 3, 5, 30, 200)))) for i in range(40)]
    rows += [(10**12, None), (5, " \t"), (5, "!!!"), (5, "!!!"), (None, "a b c d e f"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, fingerprint string, bucket int")
    check(ordered(rows), M.compare(docs))


def test_empty_single_and_query(spark):
    docs = spark.createDataFrame([(3, "one two three four five six")], "doc_id long, text string")
    check([(3, "one two three four five six")], M.compare(docs))
    assert M.compare(docs.limit(0)).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(ordered(rows), queries.op7_minhash(spark, sf))


def test_likeness_follows_jaccard():
    rng = random.Random(1)
    errors = []
    for _ in range(40):
        words = [str(rng.random()) for _ in range(400)]
        other = words[:rng.randrange(400)] + [str(rng.random()) for _ in range(200)]
        a, b = " ".join(words), " ".join(other)
        sa, sb = shingles(a), shingles(b)
        errors.append(near(brute(a), brute(b)) - len(sa & sb) / len(sa | sb))
    assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < 0.2
