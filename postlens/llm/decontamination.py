"""Benchmark decontamination by winnowing (Spark SQL functions only).

Items are cut into windows of ``window`` words (a shorter item is one
window). Of the k-gram hashes inside a window the least, rightmost on ties,
is its fingerprint, so two equal windows have equal fingerprints and every
shared span of ``window`` words or more shares one. A text's fingerprints
are the distinct minima of its windows, about one in five positions.

1. Fingerprints of the texts are semi-joined with those of the items; what
   is left are places of texts that may hold an item's window.
2. Around each such place the windows are written out and joined with the
   items' windows by their words, so a hit is exact.
3. Overlapping windows of a text are merged and counted. A window names the
   set of items that hold it; a text's distinct sets are joined with their
   items at the end, so a preamble that all items share is one set, not a list
   that rides on every hit.

Texts are keyed by their digest, so copies are extended once and get the same
result; the join back from digests to documents may have a hot digest, which
the adaptive skew join splits. The items' fingerprints are broadcast only if
their counted size is within ``spark.sql.autoBroadcastJoinThreshold``; beyond
it both sides are shuffled by fingerprint.

Cases: a null or empty text or item has no words, hits nothing and is not
contaminated; repeated documents and repeated items count as they stand (an
item once); documents and benchmark may be empty; other columns are ignored.
A text of any length is one row; its windows are never paired with each
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.columns import alnum_words, gram_hashes, indices, let
from postlens.llm.common import stored
from postlens.sources.tables import broadcast_threshold

WINDOW, GRAM = 13, 5


def _minima(words: Column, window: int, body) -> Column:
    """``body(gram hashes, packed minima)``: each minimum holds 31 bits of its
    hash above the 32-bit position, of which the larger wins a tie."""
    k = min(GRAM, window)

    def of(grams):
        packed = F.transform(grams, lambda g, i: F.shiftleft(F.shiftrightunsigned(g, 33), 32).bitwiseOR(F.lit(0xFFFFFFFF) - i.cast("long")))
        return let(packed, lambda p: body(grams, F.array_distinct(F.transform(
            indices(F.size(p) - (window - k)), lambda i: F.array_min(F.slice(p, i + 1, F.lit(window - k + 1)))))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(gram_hashes(h, k), of))


def fingerprints(words: Column, window: int) -> Column:
    """array<struct<at, mark>>: position and hash of the distinct minima."""
    def found(grams, minima):
        place = F.transform(minima, lambda m: (F.lit(0xFFFFFFFF) - m.bitwiseAND(F.lit(0xFFFFFFFF))).cast("int"))
        return F.transform(place, lambda q: F.struct(q.alias("at"), F.get(grams, q).alias("mark")))
    return _minima(words, window, found)


def _text_of(words: Column, at: Column, window: int) -> Column:
    return F.array_join(F.slice(words, at + 1, F.lit(window)), " ")


def _item_rows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, length, words): the distinct windows of every item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), alnum_words(F.col("text").cast("string")).alias("w"))
    sized = items.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    each = F.explode(let(F.col("w"), lambda w: F.transform(
        indices(F.size(w) - F.col("length") + 1), lambda i: F.array_join(F.slice(w, i + 1, F.col("length")), " "))))
    return sized.select("item", "length", each.alias("words")).distinct()


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(length, words, holders): every distinct window, and a name of the set
    of items that hold it: their number and two 64-bit digests of them. A
    window that all items share has one row as well."""
    digest = lambda salt: F.bit_xor(F.xxhash64("item", F.lit(salt)))
    return (_item_rows(benchmark, window).groupBy("length", "words")
            .agg(F.count("*").alias("n"), digest(1).alias("x"), digest(2).alias("y"))
            .select("length", "words", F.concat_ws(":", "n", "x", "y").alias("holders")))


def item_sets(benchmark: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(holders, item): the members of each named set once, however many
    windows it holds in common."""
    first = windows.groupBy("holders").agg(F.min(F.struct("length", "words")).alias("f")).select("holders", "f.*")
    return _item_rows(benchmark, window).join(first, ["length", "words"]).select("holders", "item")


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if 0 <= rows * row_bytes <= broadcast_threshold(df.sparkSession) else df


def text_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(digest, n_hit, items) of the distinct texts that hold a window."""
    windows = stored(item_windows(benchmark, window), "item-windows")
    sets = stored(item_sets(benchmark, windows, window), "item-sets")
    sizes = {r.length: r.n for r in windows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    texts = docs.select(F.md5("text").alias("digest"), F.col("text").cast("string").alias("text")).where("text is not null")
    found = None
    for length, n in sorted(sizes.items()):
        own = windows.where(F.col("length") == length)
        k = min(GRAM, length)
        marks = own.select(F.explode(fingerprints(F.split("words", " "), length)).alias("f")).select("f.mark").distinct()
        places = texts.select("digest", F.explode(fingerprints(alnum_words(F.col("text")), length)).alias("f")).select("digest", "f.*")
        near = (places.join(_small(marks, n, 32), "mark", "left_semi")
                .groupBy("digest").agg(F.array_sort(F.collect_set("at")).alias("places")))  # bounded by a text's length
        near = stored(near, "near-windows")
        count = near.count()
        some = (texts.join(_small(near.select("digest"), count, 64), "digest", "left_semi").dropDuplicates(["digest"])
                .join(near, "digest"))

        def around(w, at, length=length, k=k):
            starts = F.flatten(F.transform(at, lambda q: F.sequence(F.greatest(F.lit(0), q - (length - k)), F.least(q, F.size(w) - length))))
            return F.transform(F.array_distinct(starts), lambda i: F.struct(i.alias("at"), _text_of(w, i, length).alias("words")))

        cut = some.select("digest", F.explode(let(alnum_words(F.col("text")), lambda w: around(w, F.col("places")))).alias("c"))
        hit = (cut.select("digest", "c.*").join(_small(own.select("words", "holders"), n, 96 + 12 * length), "words")
               .select("digest", F.struct("at", (F.col("at") + length).alias("end")).alias("span"), "holders"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return docs.sparkSession.createDataFrame([], "digest string, n_hit long, items array<string>")
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(F.array_sort("spans"), zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["end"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["at"]))).alias("n")))
    found = stored(found, "window-hits")
    spans = found.groupBy("digest").agg(F.collect_set("span").alias("spans")).select("digest", covered["n"].alias("n_hit"))  # bounded by a text's length
    items = (found.select("digest", "holders").distinct().join(_small(sets, sets.count(), 96), "holders")
             .groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items")))  # the items that the result names
    per_text = spans.join(items, "digest")
    # stored, so that a join to it has a plain exchange on both sides and the copies of one text can be split
    return stored(per_text, "text-hits")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: its words, those inside an item's window, the items."""
    hits = text_hits(docs, benchmark, window)
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"),
                        F.size(alnum_words(F.col("text").cast("string"))).cast("long").alias("n_words"))
    n_hit, items = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return every.join(hits, "digest", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    hits = text_hits(docs, benchmark, window).select("digest", "n_hit")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.md5("text").alias("digest"), F.size(alnum_words(F.col("text").cast("string"))).alias("n_words"))
    return whole.join(hits, "digest", "left").where(F.col("n_hit").isNull() | (20 * F.col("n_hit") < F.col("n_words"))).select("row.*")
