"""Document fingerprints: one-permutation MinHash with optimal densification
and b-bit packing (Spark SQL functions only).

Every five-word shingle is hashed once; the upper bits name one of ``BINS``
bins and the least hash of a bin is its value. An empty bin takes the value
of the first filled bin in its own fixed pseudo-random order of the others
(the bin's universal hash sequence, each bin once), so any two sets fill
equal bins alike. The lowest ``BITS`` bits of every bin are packed as two
hexadecimal digits; agreement of two packed fingerprints is corrected for
chance equality of the kept bits: (share - c) / (1 - c), c = 2^-BITS, cut to
0..1.

Words are white-space separated, A-Z lower-cased. A text of one to four words
has one shingle of all of them, a text without words one of the text itself;
so equal texts have equal fingerprints and every text has one.

Cases: null is the empty text; rows of one doc_id are ordered by text; empty
tables give an empty result; other columns are ignored; null ids come last.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.columns import gram_hashes, let, space_words

SHINGLE, BINS, BITS = 5, 128, 8
#: Bins an empty bin tries one by one before it searches all (speed only).
EAGER = 3
#: Text bytes an ordering bucket should hold.
BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 20_000


def probe_order(bin_: int, bins: int = BINS) -> list[int]:
    """The other bins in the order in which an empty bin tries them: sorted
    by a multiplicative hash of (bin, other)."""
    mix = lambda x: (x * 0x9E3779B97F4A7C15 ^ (x * 0xC2B2AE3D27D4EB4F) >> 29) % (1 << 64)
    return sorted((b for b in range(bins) if b != bin_), key=lambda b: mix(mix(bin_ * bins + b + 1)))


def shingle_hashes(text: Column) -> Column:
    def of(words):
        n = F.size(words)
        few = F.array(F.xxhash64(F.when(n > 0, F.array_join(words, " ")).otherwise(F.coalesce(text, F.lit(""))), n))
        return F.when(n >= SHINGLE, let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: gram_hashes(h, SHINGLE))).otherwise(few)
    return let(space_words(text), of)


def least_hashes(text: Column) -> Column:
    """array<long>: for each bin its least hash, null for an empty bin."""
    width = BINS.bit_length() - 1
    bin_ = lambda h: F.shiftrightunsigned(h, 64 - width).cast("int")
    # sorted, the hashes of a bin stand together, its least one first
    first = let(F.sort_array(shingle_hashes(text)), lambda s: F.filter(
        s, lambda h, i: (i == 0) | (bin_(h) != bin_(F.get(s, F.greatest(i - 1, F.lit(0)))))))
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    return let(first, lambda found: let(F.transform(found, bin_), lambda n: F.transform(
        every, lambda j: F.get(found, F.array_position(n, j).cast("int") - 1))))


def densified(own: Column, bin_: int) -> Column:
    """A bin's value: its own, else that of the first filled bin in its order."""
    order = probe_order(bin_)
    late = F.get(own, F.element_at(F.filter(F.array(*map(F.lit, order)), lambda b: F.get(own, b).isNotNull()), 1))
    return F.coalesce(F.get(own, F.lit(bin_)), *(F.get(own, F.lit(b)) for b in order[:EAGER]), late)


def packed(text: Column) -> Column:
    """array<long>: the lowest ``BITS`` bits of the bins, 64 bits a number."""
    each = 64 // BITS

    def word(own, first):
        parts = [F.shiftleft(densified(own, first + j).bitwiseAND(F.lit((1 << BITS) - 1)), 64 - BITS * (j + 1)) for j in range(each)]
        return functools.reduce(lambda a, b: a.bitwiseOR(b), parts)

    return let(least_hashes(text), lambda own: F.array(*[word(own, k) for k in range(0, BINS, each)]))


def as_text(numbers: Column) -> Column:
    """A packed fingerprint as hexadecimal digits."""
    return F.array_join(F.transform(numbers, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected share of equal bins of two packed fingerprints."""
    ones = int.from_bytes(sum(1 << BITS * i for i in range(64 // BITS)).to_bytes(8, "big"), "big", signed=True)

    def unequal(x, y):  # folds every bin's difference into its lowest bit
        d, step = x.bitwiseXOR(y), BITS // 2
        while step:
            d, step = d.bitwiseOR(F.shiftrightunsigned(d, step)), step // 2
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda n, x: n + x)
    chance = 2.0 ** -BITS
    return F.greatest(F.lit(0.0), (1 - differing / F.lit(float(BINS)) - chance) / F.lit(1 - chance))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, print, next_text, next_print): every text with its packed
    fingerprint, and those of the next document by descending doc_id, ties by
    text, the first after the last.

    Ids are cut into buckets of about ``BUCKET_BYTES`` of text by approximate
    quantiles; the window runs inside each bucket, which also holds a copy of
    the first document of the bucket that follows (one row a bucket)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text").cast("double"))).first()
    if not n:
        return rows.select("doc_id", "text", packed(F.col("text")).alias("print"), F.col("text").alias("next_text"),
                           F.array().cast("array<long>").alias("next_print"))
    buckets = int(min(MOST_BUCKETS, max(1, (size or 0) // BUCKET_BYTES), n))
    cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 10 * buckets + 100)).first()[0] or [])) \
        if buckets > 1 else []
    # buckets count upwards as ids go down; null ids are last
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(bounds, lambda c: c >= F.col("doc_id"))))
    placed = rows.withColumn("bucket", bucket)
    order = [F.desc_nulls_last("doc_id"), F.col("text")]
    heads = (placed.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).collect())  # one row a bucket
    present = sorted(h.bucket for h in heads)
    before = {b: present[i - 1] for i, b in enumerate(present)}  # the first follows the last
    head = spark.createDataFrame([(h.doc_id, h.bucket, before[h.bucket]) for h in heads], "doc_id long, bucket int, halo int")
    first = (placed.join(F.broadcast(head.withColumnRenamed("doc_id", "head")), "bucket")  # at most MOST_BUCKETS small rows
             .where(F.col("doc_id").eqNullSafe(F.col("head")))
             .groupBy("halo").agg(F.min("text").alias("text")))
    halo = first.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("halo").alias("bucket"), F.lit(1).alias("copied"))
    both = placed.withColumn("copied", F.lit(0)).unionByName(halo).withColumn("print", packed(F.col("text")))
    near = Window.partitionBy("bucket").orderBy("copied", *order)
    return (both.withColumns({"next_text": F.lead("text").over(near), "next_print": F.lead("print").over(near)})
            .where("copied = 0").select("doc_id", "text", "print", "next_text", "next_print"))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    made = with_next(docs).select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        "print", packed(edited).alias("edited_print"), "next_print")
    return made.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
                       as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))
