import public_tokenizers

import corpus_pipeline
from postlens.llm import byte_bpe, decontamination, language_id, quality_trees, queries
from postlens.llm.jaccard_join import keep_one
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import roots
from tests.llm.test_near_copies_rule import links, shingles

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_trees.classify(docs, labels).where("predicted = 1").collect()}
    one = corpus_pipeline.quality(spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == good
    filters = language_id.learn(one)
    two = corpus_pipeline.language(spark, one, SF)
    kept = two.collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in one.collect() if filters.decide(r.text)[1] > 0}
    rule = corpus_pipeline.NEAR_COPIES
    group = roots(len(kept), links([r.text for r in kept], rule.shingle, rule.percent))
    least = {}
    for r, g in zip(kept, group):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    three = corpus_pipeline.near_copies(spark, two, SF)
    left = three.collect()
    assert sorted(r.doc_id for r in left) == sorted(r.doc_id for r, g in zip(kept, group) if least[g] == r.doc_id or not shingles(r.text, rule.shingle))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated([(r.doc_id, r.text) for r in left], items) if r[5]}
    four = corpus_pipeline.decontaminate(spark, three, SF)
    assert {r.doc_id for r in four.collect()} == {r.doc_id for r in left} - bad
    got = corpus_pipeline.run(spark, SF).collect()
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(queries.RANKS_PATH), public_tokenizers.PATTERN)
    text = {r.doc_id: r.text for r in left}
    assert {r.doc_id for r in got} == {r.doc_id for r in left} - bad
    for r in got:
        assert bpe.decode(b"".join(i.to_bytes(4, "little") for i in r.ids)).decode() == text[r.doc_id] and r.n_tokens == len(r.ids)


def test_cases(spark):
    rows = [(1, "The cat and the dog ran away home", "en"), (1, "The cat and the dog ran away home", "en"),
            (0, "the cat and the dog ran away HOME", None), (None, "the cat and the dog ran away home", "en"),
            (None, "alone here by the sea", "en"), (7, None, None), (8, "", "en"), (8, "", "en"), (9, "x " * 3000, "en")]
    docs = spark.createDataFrame([(a, b, c, "s", 1, 0.5, "x") for a, b, c in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double, node string")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[2][:2], rows[4][:2], rows[5][:2], rows[6][:2], rows[7][:2], rows[8][:2]], key=str)
    assert {r.doc_id for r in language_id.keep(docs).collect()} >= {0, 1, 9} and language_id.keep(docs).where("text is null").count() == 0
    labels = spark.createDataFrame([(1, 1), (None, 0), (9, 0)], "doc_id long, quality int")
    assert quality_trees.keep(docs, labels).columns == docs.columns
    bench = spark.createDataFrame([(1, "alone here by the sea")], "item_id long, text string")
    assert decontamination.clean(docs, bench).count() == len(rows) - 1
    empty = docs.limit(0)
    for stage in (keep_one, language_id.keep, lambda d: quality_trees.keep(d, labels), lambda d: decontamination.clean(d, bench)):
        assert stage(empty).count() == 0
