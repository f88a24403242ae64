"""The pipeline's near-copy rule, five words and 80 %, against brute force."""

import random

import numpy as np

import corpus_pipeline
from postlens.llm import jaccard_join as J
from tests.llm.test_jaccard_join import WORD, roots

RULE = corpus_pipeline.NEAR_COPIES


def shingles(text, k):
    w = WORD.findall((text or "").lower())
    return {(*w[i:i + k],) for i in range(len(w) - k + 1)} if len(w) >= k else ({(*w,)} if w else set())


def links(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    return [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and 100 * len(a & b) >= percent * len(a | b)]


def test_rule():
    assert (RULE.shingle, RULE.percent) == (5, 80) and (J.RULE.shingle, J.RULE.percent) == (3, 90)


def test_similar_sets_share_a_signature():
    rng = random.Random(9)
    starts = J.band_starts(2500, 80)
    plans = [{b: J.allocate(n, last - 1, 80) for b, last in enumerate(starts[1:])} for n in (1, 10**4, 10**9)]
    linked = 0
    for _ in range(300):
        s = rng.choice((rng.randrange(1, 30), rng.randrange(1, 400), rng.randrange(1, 2000)))
        base = [rng.getrandbits(64) for _ in range(s)]
        cut, add = rng.randrange(s // 5 + 2), rng.randrange(s // 5 + 2)
        a, b = (np.unique(np.array(x, np.uint64)) for x in (base, base[cut:] + [rng.getrandbits(64) for _ in range(add)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            linked += 1
            for plan in plans:
                signer = J.Signer(starts, plan, RULE)
                assert len(np.intersect1d(signer(a), signer(b)))
    assert linked > 50


def test_shingles_are_those_of_the_words():
    words = [b"a", b"b"]
    rng = random.Random(2)
    for k in (1, 3, 5, 7):
        cut = J.Shingler(k)
        for n in (*range(10), 200):
            text = " ".join(rng.choice(words).decode() for _ in range(n))
            assert len(cut(text)) == len(shingles(text, k))


def test_stage_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = ["", None, "one two", "one two", "one two three", "a b c d", "a b c d", "a b c e"]
    for _ in range(30):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((6, 20, 60, 120, 300)))]
        for _ in range(6):
            copy = list(words)
            at = rng.randrange(len(copy))
            size = rng.randrange(1 + len(copy) // 6)
            copy[at:at + size] = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(copy))
    found = links(texts, 5, 80)
    assert set(found) - set(links(texts, 3, 90))  # such copies used to stay
    group = roots(len(texts), found)
    first = {}
    for i, g in enumerate(group):
        first.setdefault(g, i)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == {i for i, t in enumerate(texts) if not t or first[group[i]] == i}
