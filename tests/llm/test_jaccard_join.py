import random
import re

import pytest

from postlens.llm import jaccard_join as J
from postlens.llm import queries
from postlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {(*w[i:i + 3],) for i in range(len(w) - 2)} if len(w) >= 3 else ({(*w,)} if w else set())


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        up[find(a)] = find(b)
    return [find(i) for i in range(n)]


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    near = {(a, b) for i, s in enumerate(sets) for a, b in ((i, j) for j in {j for x in s for j in by[x] if j > i})
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    group = roots(len(rows), near)
    least = {}
    for g, (doc, _) in zip(group, rows, strict=True):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    return sorted(((doc, len(s), least.get(g) if s else doc) for (doc, _), s, g in zip(rows, sets, group, strict=True)), key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def test_similar_sets_always_share_a_signature():
    rng = random.Random(3)
    starts = J.band_starts(3000)
    plans = [{b: J.allocate(n, last - 1) for b, last in enumerate(starts[1:])} for n in (1, 10**4, 10**9)]
    need = lambda last: (last - 1) // 9 + 1
    for n, t in J.SHAPES:  # every shape in every band, with as few groups as it may have
        plans.append({b: J.Plan(-(-need(last) // ((n - t if t else 1) + 1)), n, t, need(last)) for b, last in enumerate(starts[1:])})
    import numpy as np
    for _ in range(400):
        s = rng.choice((rng.randrange(1, 30), rng.randrange(1, 400), rng.randrange(1, 2500)))
        base = [rng.getrandbits(64) for _ in range(s)]
        cut, add = rng.randrange(s // 9 + 2), rng.randrange(s // 9 + 2)
        other = base[cut:] + [rng.getrandbits(64) for _ in range(add)]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (base, other))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 90 * (len(a) + len(b) - both):
            for plan in plans:
                signer = J.Signer(starts, plan)
                assert len(np.intersect1d(signer(a), signer(b)))


def test_unrelated_sets_share_no_empty_signature():
    """Sets that may leave their empty signatures out share none by chance."""
    import numpy as np
    rng = np.random.default_rng(5)
    starts = J.band_starts(3000, 80)
    rule = J.Rule(5, 80)
    for n in (10**4, 10**7):
        signer = J.Signer(starts, {b: J.allocate(n, last - 1, 80, first) for b, (first, last) in enumerate(zip(starts, starts[1:]))}, rule)
        seen, shared = set(), 0
        for size in rng.integers(60, 900, 120):
            own = set(signer(rng.integers(0, 2**63, size, dtype=np.uint64)).tolist())
            shared += bool(seen & own)
            seen |= own
        assert shared <= 12


def test_stream_keeps_signatures_of_two_nodes(spark):
    rng = random.Random(8)
    rows = [(rng.choice((1, 2, 3, 50, 51, rng.randrange(10**6))), rng.randrange(9)) for _ in range(3000)] + [(7, 5)] * 40 + [(8, x) for x in range(25_000)]
    want = {}
    for s, n in rows:
        want.setdefault(s, set()).add(n)
    got = J._shared(spark.createDataFrame(rows, "sig long, node long")).collect()
    assert sorted(map(tuple, got)) == sorted((s, n) for s, ns in want.items() if len(ns) > 1 for n in ns)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    frame = components(spark.createDataFrame(links, "a long, b long"))
    want = {}
    group = roots(2100, links)
    for a, b in links:
        if a != b:
            for x in (a, b):
                want[x] = min(y for y in range(2100) if group[y] == group[x])
    assert {r.node: r.root for r in frame.collect()} == want


@pytest.mark.parametrize("small", [J.SMALL_BUCKET, 2])
def test_random_near_copies(spark, monkeypatch, small):
    monkeypatch.setattr(J, "SMALL_BUCKET", small)
    rng = random.Random(6)
    vocabulary = [f"W{i}é" for i in range(400)]
    rows = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 8, 14, 25, 60, 200)))]
        for _ in range(12):
            copy = list(words)
            for _ in range(rng.randrange(1 + len(words) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 997, " ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy)))
        if base % 5 == 0:  # a chain: each link changes a little more
            for k in range(8):
                words = words + [rng.choice(vocabulary) for _ in range(max(1, len(words) // 40))]
                rows.append((2000 + 10 * base + k, " ".join(words)))
    rows += [(5, None), (5, ""), (5, " \n"), (None, rows[3][1]), (None, "only here"), (None, "only here"), (1, rows[40][1]), (1, rows[60][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node long")
    assert got(J.join_documents(docs)) == brute(rows)
    assert J.join_documents(docs.limit(0)).count() == 0
    assert got(J.join_documents(docs.where("text is null"))) == [(5, 0, 5)]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert got(queries.op3_jaccard_join(spark, path)) == brute(rows)
