import hashlib
import re
import zlib

import pytest

from postlens.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, text, lang, source, n):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)))


def climb(nodes, spot, change):
    """Root of a list of hashes; siblings of one place, and what a changed
    hash at that place folds to."""
    proof, node, at = [], change, spot
    while len(nodes) > 1:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        slot = at % 16
        proof += run[:slot] + run[slot + 1:]
        node = sha(*run[:slot], node, *run[slot + 1:])
        nodes = [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], proof, node


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: x[:3])
    sub = [climb([x[2] for x in trees[s]], 0, "")[0] for s in names]
    out = []
    for i, s in enumerate(names):
        own = [x[2] for x in trees[s]]
        for at, (_, _, h, (d, text, lang, source, n)) in enumerate(trees[s]):
            node = h
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None:
                node = leaf(d, re.sub("[A-Z]", lambda m: m[0].lower(), text), lang, source, n)
            _, low, node = climb(own, at, node)
            root, high, node = climb(sub, i, node)
            out.append((d, h, sub[i], root, sha(*low, *high), node, node == root))
    return sorted(out, key=str)


def got(spark, rows, schema=SCHEMA):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    out = M.manifest(spark.createDataFrame(rows, schema))
    assert out.columns == cols
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [16, 1], [17, 257, 15, 1], [33] * 18])
def test_sizes(spark, sizes):
    rows, d = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            d += 7
            rows.append((d % 4001, f"Text {d} ÄB", "en", f"s{s}", d))
    assert got(spark, rows) == brute(rows)


def test_runs_reach_over_blocks_and_partitions(spark):
    """A source over several window blocks beside a small one."""
    rows = [(i * 3 % 5003, f"T{i}", None, "big" if i % 9 else "Ä", None) for i in range(5003)]
    assert got(spark, rows) == brute(rows)


def test_cases(spark):
    rows = [(1, "A", "en", "x", 1), (1, "A", "en", "x", 1), (1, "B", "en", "x", 1), (None, "Q", "en", "x", 1), (None, None, None, None, None),
            (5, None, "en", None, 0), (6, "", "", "", 0), (7, "ß" * 70_000 + "Z", "de", "ü", 70_001), (8, "-", "1:", ":", -3), (15, "no capital", "en", "x", 10)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_tampering_shows(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "s", 5) for i in range(60)]
    bad = {r[0] for r in got(spark, rows) if not r[6]}
    assert bad == {i for i in range(60) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0} and bad


def test_clashing_columns(spark):
    rows = [(i, "T", "en", "s", 1, "p", 3, "h") for i in range(20)]
    assert got(spark, rows, SCHEMA + ", path string, pos int, hash string") == brute([r[:5] for r in rows])
