import random

import pytest

from postlens.llm import substring_dedup as S

SCHEMA = "doc_id long, text string"


def run(spark, rows, window=50, share=S.HOT_SHARE, schema=SCHEMA):
    got = S.digest(S.remove_repeats(spark.createDataFrame(rows, schema), window, share))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str)


def want(rows, window=50):
    return sorted(S.brute_force(rows, window), key=str)


def corpus(rng, n, words, window):
    """Texts with shared passages, copies, near copies and inner repeats."""
    word = lambda: rng.choice("abcdefgh") * rng.choice((1, 2)) + rng.choice(("", "É", "."))
    passages = [[word() for _ in range(rng.randrange(window // 2, 3 * window))] for _ in range(4)]
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(words))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, at = rng.randrange(len(p)), rng.randrange(len(w) + 1)
            w[at:at] = p[a:a + rng.randrange(2 * window)]
        if out and rng.random() < 0.2:
            w = out[rng.randrange(len(out))][1].split()
            if w and rng.random() < 0.5:
                w[rng.randrange(len(w))] = "changed"
        out.append((i, rng.choice((" ", "\n", "\t ")).join(w)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("window", "share"), [(50, S.HOT_SHARE), (5, S.HOT_SHARE), (12, 0.002), (20, 0.5)])
def test_random_texts(spark, monkeypatch, window, share):
    monkeypatch.setattr(S, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(S, "CHUNK", 40)
    monkeypatch.setattr(S, "LOCAL_HOT", 2)
    rows = corpus(random.Random(window), 150, 4 * window, window)
    assert run(spark, rows, window, share) == want(rows, window)


def test_cases(spark):
    p = " ".join(f"w{i}" for i in range(70))
    rows = [(5, p), (5, p), (3, p.replace("w60", "x")), (None, p), (None, p), (9, None), (8, ""), (7, " \t"), (6, "w1 w2"),
            (2, " ".join([p, p])), (4, p.upper()), (10, "a " + p + " b"), (11, p), (1, "w0 " * 49), (0, None)]
    got = run(spark, rows)
    assert got == want(rows)
    removed = {r[0]: r[2] for r in got}
    assert removed[5] == 70 and removed[None] == 0 and removed[2] == 0 and removed[10] == 70 and removed[4] == 0


def test_rows_of_one_id_with_other_texts(spark):
    p, q = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    rows = [(1, p), (2, p), (2, q), (2, f"{q} {p}"), (3, q)]
    assert run(spark, rows) == want(rows)


def test_empty_and_clashing_columns(spark):
    assert run(spark, []) == []
    p = " ".join(f"w{i}" for i in range(55))
    d = spark.createDataFrame([(1, p, 1, "x", "y"), (2, p, 2, "x", "y")], "doc_id long, text string, key long, mark string, starts string")
    assert {r.doc_id: r.n_removed for r in S.remove_repeats(d).collect()} == {1: 0, 2: 55}


def test_long_text_and_hot_passage(spark):
    """A word of 200,000 letters, a text of 60,000 words, one passage in all texts."""
    rng = random.Random(1)
    p = " ".join(f"h{i}" for i in range(80))
    rows = [(i, " ".join([f"{rng.random()}" for _ in range(30)] + [p] + [f"{rng.random()}" for _ in range(30)])) for i in range(300)]
    rows += [(1000, " ".join(f"{i % 997}x{i}" for i in range(60_000))), (1001, "z" * 200_000), (1002, "z" * 200_000 + " " + p)]
    got = run(spark, rows)
    assert got == want(rows) and sum(r[2] for r in got) == 300 * 80


def test_frequent_anchors_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(S, "LOCAL_HOT", 2)
    rng = random.Random(3)
    p = [f"h{i}" for i in range(8)]
    rows = [(i, " ".join([f"{rng.random()}" for _ in range(60)] + p + [f"{rng.random()}" for _ in range(60)])) for i in range(100)]
    hot = S.frequent_anchors(spark.createDataFrame(rows, SCHEMA), 9, 0.005)
    assert 1 <= len(hot) <= 200
    assert run(spark, rows, 9, 0.005) == want(rows, 9)
