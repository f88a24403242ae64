import random

import numpy as np

from postlens.llm import language_id as L
from postlens.llm import queries

DOCS = "doc_id long, text string, lang string, lang_pred string"


def test_filters_return_every_member():
    rng = np.random.default_rng(4)
    members = [rng.integers(0, 2**32, 5000, dtype=np.uint64).astype(np.int64) for _ in range(11)]
    filters = L.Filters.build([f"l{k:02}" for k in range(11)], "l00", members)
    for k, ids in enumerate(members):
        found = filters.counts(ids)
        own = (len(ids) - len(ids) * filters.false_rate[k]) / (1 - filters.false_rate[k])
        assert np.isclose(found[k], own) and found.argmax() == k
        assert found[(k + 1) % 11] < 60  # expected false positives are taken off


def test_counts_match_brute_force(spark):
    texts = [(1, "Abc abcd", "en"), (2, "abc, ABC", "en"), (3, "ñandú", "es"), (4, None, "es"), (6, "123", "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    want = {}
    for _, text, lang in texts:
        if L.has_letter(text):
            raw = b" " + b" ".join("".join(c if c.isalpha() else " " for c in text.lower()).encode().split()) + b" "
            for i in range(len(raw) - 3):
                key = lang, int.from_bytes(raw[i:i + 4], "little")
                want[key] = want.get(key, 0) + 1
    assert {(r.lang, r.gram): r.n for r in L.count_grams(docs).collect()} == want


def test_held_out_and_cases(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang == held.lang_pred).mean() > 0.97
    rows = [(1, "der hund und die katze", "de", ""), (2, "the dog and the cat", "en", ""), (3, None, "en", ""), (4, "12 !", "fr", ""),
            (None, "the cat", None, None), (2, "the dog and the cat", "en", ""), (7, "", None, ""), (9, "жук", None, "")]
    docs = spark.createDataFrame(rows, DOCS)
    out = L.identify(docs, L.learn(docs)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert (by[1].lang_pred, by[2].lang_pred, by[None].lang_pred) == ("de", "en", "en")
    assert [by[i].lang_pred for i in (3, 4, 7)] == ["und"] * 3 and by[9].score == 0.0
    none = L.learn(docs.limit(0))
    assert L.identify(docs, none).where("lang_pred != 'und'").count() == 0
    assert L.identify(docs.limit(0), none).count() == 0


def test_more_than_eight_languages(spark):
    rng = random.Random(7)
    rows = []
    for k in range(10):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(12)]
        rows += [(100 * k + i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30)), f"x{k}", "") for i in range(12)]
    docs = spark.createDataFrame(rows, DOCS)
    got = L.identify(docs, L.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_sixty_languages_of_flat_grams(spark):
    """Far more n-grams than the 131,072 that an earlier version kept in all."""
    rng = random.Random(9)
    rows = []
    for k in range(60):
        letters = [chr(0x4E00 + 90 * k + j) for j in range(90)]
        rows += [(100 * k + i, " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(150)), f"x{k:02}", "") for i in range(10)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    filters = L.learn(docs)
    assert L.count_grams(docs).select("gram").distinct().count() > 200_000 and filters.bits > 20
    got = L.identify(docs, filters).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred and r.score > 0 for r in got)
    assert L.keep(docs).count() == len(rows)


def test_kept_grams_cover_each_language(spark):
    """A rare language keeps its n-grams beside a frequent one with a long tail."""
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(6))
    rows = [(i, " ".join(word("abcdefghijklmnopqrstuvwxyz") for _ in range(200)), "big", "") for i in range(60)]
    rows += [(1000 + i, " ".join(word("αβγδε") for _ in range(5)), "small", "") for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang_pred for r in L.identify(docs, L.learn(docs)).collect()}
    assert all(got[1000 + i] == "small" for i in range(3)) and got[0] == "big"
