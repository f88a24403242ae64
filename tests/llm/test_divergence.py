import random
import re
from collections import Counter

import numpy as np
import pytest

from postlens.llm import divergence as D

SCHEMA = "text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, top=10):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    docs = [(TERM.findall(lower(t)), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        df = Counter(t for w, _, _ in own for t in set(w))
        kept = sorted(t for t, n in df.items() if n >= least)
        v = len(kept)
        counts = {s: Counter(t for w, _, x in own if x == s for t in w if df[t] >= least) for s in {d[2] for d in own}}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def got(spark, rows, schema=SCHEMA, **kw):
    return sorted(tuple(r) for r in D.audit(spark.createDataFrame(rows, schema), **kw).collect())


def corpus(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice(('a', 'É', 'ß', 'Zz', '日'))}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(words)]
    return [(rng.choice(("", "1 ", ", ")).join(w + " " for w in rng.choices(vocabulary, [1 / (k + 1) for k in range(words)], k=rng.randrange(60))),
             rng.choice(("en", "en", "en", "de", None, "")), rng.choice(("hot", "hot", "s1", "s2", "ü", None))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, monkeypatch, small):
    if small:  # several shards, rounds and blocks
        for name, value in (("SHARD_TERMS", 20), ("ROUND_BYTES", 900), ("HELD_TERMS", 50), ("HELD_BYTES", 100), ("CELLS", 60)):
            monkeypatch.setattr(D, name, value)
    rows = corpus(4, 400, 300)
    assert got(spark, rows) == brute(rows)


def test_cases(spark):
    rows = [("One two", "en", "a")] * 10 + [("two three THREE", "en", "b")] * 10 + [(None, "en", None), ("", "en", "c"), ("only here", "xx", "z"), ("x", "yy", "a"),
            ("y", "yy", "b"), (None, None, None), ("word " * 70_000 + "q" * 300_000, "en", "a")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert got(spark, rows, least=1, top=2) == brute(rows, 1, 2)


def test_clashing_columns(spark):
    rows = corpus(1, 60, 20)
    wide = [(*r, 1, "k", 2) for r in rows]
    assert got(spark, wide, SCHEMA + ", n int, term string, i int") == brute(rows)


def test_perfect_hash():
    keys = [f"k{i}".encode() for i in range(5000)]
    made = D.PerfectHash.build(keys)
    assert sorted(made.slots(keys, D._hashes(keys)).tolist()) == list(range(5000))
    names = ["sizes", "bits", "ends", "keys"]
    made = D.PerfectHash.of_row(dict(zip(names, made.row())))
    assert sorted(made.slots(keys, D._hashes(keys)).tolist()) == list(range(5000))
    strange = [f"x{i}".encode() for i in range(5000)]
    assert (made.slots(strange, D._hashes(strange)) == -1).all()
    assert len(D.PerfectHash.build([b"one"])) == 1


def test_shares_are_exact():
    rng = random.Random(2)
    n = [0, 1, 5, 10**14, 3 * 10**15] + [rng.randrange(10**12) for _ in range(200)]
    total = [max(x + 2, rng.randrange(1, 4 * 10**15)) for x in n]
    assert D.shares(np.array(n), np.array(total)).tolist() == [1 + 10**9 * (x + 2) // t for x, t in zip(n, total)]
