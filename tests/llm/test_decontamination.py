import hashlib
import random
import re

import pytest

from postlens.llm import decontamination as D
from postlens.llm import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault((*w[i:i + n],), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (*w[i:i + n],) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[(*w[i:i + n],)]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def rows(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()), key=str)


@pytest.mark.parametrize("window", [13, 4])
def test_random_texts(spark, window):
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("abcdeÉ") * rng.choice((1, 1, 2)) for _ in range(n))
    items = [(i, text(rng.choice((1, 2, 5, 7, 12, 13, 14, 30)))) for i in range(30)] + [(3, "a b"), (99, None), (98, "!")]
    docs = [(i, text(rng.randrange(40))) for i in range(120)]
    for i in range(60):
        item = rng.choice(items[:30])[1].split()
        a = rng.randrange(len(item))
        docs.append((500 + i, f"{text(rng.randrange(30))} {' '.join(item[a:a + rng.randrange(40)]).upper()}, {text(rng.randrange(30))}"))
    docs += [(7, "x"), (7, items[7][1]), (None, items[8][1]), (-1, None), (-2, ""), (-3, items[9][1] * 1), (-4, (items[9][1] + " ") * 400)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, items string, n_hit int")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, digest string")
    assert rows(D.scan(frame, bench, window)) == sorted(brute(docs, items, window), key=str)
    keep = {d[0] for d in brute(docs, items, window) if not d[5]} - {7}
    left = D.clean(frame, bench, window)
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} - {7} == keep


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert rows(D.scan(docs, bench.limit(0))) == brute([(1, "a b c")], [])
    assert D.scan(docs.limit(0), bench).count() == 0
    assert rows(D.scan(docs, bench)) == brute([(1, "a b c")], [(1, "a b c")])


def test_shuffled_path_gives_the_same(spark):
    sf = "/root/testdata/sf0.001"
    want = rows(queries.op6_decontamination(spark, sf))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(queries.op6_decontamination(spark, sf)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert want == sorted(brute(docs, items), key=str) and any(r[5] for r in want)


def test_preamble_shared_by_all_items(spark):
    """Hundreds of items that begin alike are one set of holders."""
    preamble = " ".join(f"p{i}" for i in range(40))
    items = [(i, f"{preamble} own{i} " + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(300)]
    docs = [(1, preamble), (2, f"a {preamble} b"), (3, items[7][1]), (4, "nothing here"), (5, " ".join(preamble.split()[:12])), (6, preamble + " " + items[9][1].split(maxsplit=41)[-1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = D.item_windows(bench)
    assert windows.where("holders like '300:%'").select("holders").distinct().count() == 1
    assert D.item_sets(bench, windows).count() == 600
    got = D.scan(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert rows(got) == sorted(brute(docs, items), key=str)


def test_clean_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "d", 7), (2, " ".join("abcdefghijklmnop"), 6, "e", 8)], "doc_id long, text string, n_hit int, digest string, __n_hit int")
    bench = spark.createDataFrame([(1, " ".join("abcdefghijklmnop"))], "item_id long, text string")
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c", 5, "d", 7)]
