"""Language identification with language-bitmask n-gram filters.

Byte 4-grams of the lower-cased text (digits, ASCII punctuation and white
space count as one blank) are counted per language over all training rows. An
n-gram belongs to every language whose relative frequency of it is at least a
fifth of the largest. Of each language the n-grams from its most frequent down
to those that complete ``COVER`` of its mass (ties included) go into bit-sliced
Bloom filters: each slot holds one bit per language, and the AND of an n-gram's
slots gives all languages that contain it. The number of slots follows the
number of n-grams, up to a bound; the bits of a slot are joined by Spark. Per
document, bits are counted per language, the count expected from false
positives is taken off, and the largest corrected count decides (ties: first
value in sorted order). The score is its share of all corrected counts.

Cases: null text or text without a letter gives ``und`` and score 0, as does
a table without training rows; letters without any known n-gram give the most
frequent training language and score 0; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored. Counting emits
one row per (language, n-gram) of a block of texts before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import fold, pieces, stored

#: Share of a language's n-gram occurrences that its kept n-grams hold at least.
COVER = 0.9999
#: Slots of the filters: eight an n-gram, between these powers of two; hash functions.
LEAST_BITS, MOST_BITS, HASHES = 16, 24, 2
#: A language contains an n-gram from this share of the largest relative frequency on.
SHARE = 0.2
UNKNOWN = "und"

_BLANK = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams(text: str | None) -> np.ndarray:
    """4-grams of bytes as unsigned 32-bit integers."""
    raw = b" " + b" ".join((text or "").lower().encode().translate(_BLANK).split()) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.zeros(0, np.uint32)
    return b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) per language; partial counts of blocks are summed."""

    def rows(batches):
        held: dict[str, list[np.ndarray]] = {}

        def block():
            for lang, found in held.items():
                ids, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(ids), pa.string()), pa.array(ids.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])

        size = 0
        for whole in batches:
            for part in pieces(whole):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if has_letter(text):
                        held.setdefault(lang, []).append(grams(text))
                        size += len(held[lang][-1])
                if size > 1 << 24:
                    yield from block()
                    held, size = {}, 0
        yield from block()

    return docs.select(docs["text"].cast("string"), docs["lang"].cast("string")).mapInArrow(rows, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slot_bits(grams: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (8 * grams).bit_length()))


def slots(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slot of each n-gram for each hash function."""
    x = ids.astype(np.uint64)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(0xD6E8FEB86659FD93)
    return [((x * np.uint64(m)) >> np.uint64(64 - bits)).astype(np.int64) for m in _MULTIPLIERS[:HASHES]]


@dataclass
class Filters:
    langs: list[str]          # sorted
    default: str
    planes: list[np.ndarray]  # one byte a slot for each eight languages
    false_rate: np.ndarray    # per language
    bits: int                 # slots are 2 ** bits

    def slots(self, ids: np.ndarray) -> list[np.ndarray]:
        return slots(ids, self.bits)

    @classmethod
    def build(cls, langs: list[str], default: str, members: list[np.ndarray]) -> Filters:
        """members: n-grams of each language."""
        bits = slot_bits(len(np.unique(np.concatenate(members))) if members else 0)
        planes = [np.zeros(1 << bits, np.uint8) for _ in range((len(langs) + 7) // 8)]
        for k, ids in enumerate(members):
            for at in slots(ids, bits):
                planes[k // 8][at] |= np.uint8(1 << k % 8)
        return cls.of_planes(langs, default, planes, bits)

    @classmethod
    def of_planes(cls, langs: list[str], default: str, planes: list[np.ndarray], bits: int) -> Filters:
        rate = np.array([np.count_nonzero(planes[k // 8] & np.uint8(1 << k % 8)) / (1 << bits) for k in range(len(langs))])
        return cls(langs, default, planes, rate ** HASHES, bits)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Per language, the n-grams it contains, less the false positives expected."""
        at, found = self.slots(ids), np.zeros(len(self.langs))
        for k, plane in enumerate(self.planes):
            bits = plane[at[0]]
            for a in at[1:]:
                bits = bits & plane[a]
            kinds = np.bincount(bits, minlength=256)
            for j in range(8 * k, min(8 * k + 8, len(self.langs))):
                found[j] = kinds[(np.arange(256) >> j % 8 & 1).astype(bool)].sum()
        return np.maximum(0, (found - len(ids) * self.false_rate) / (1 - np.minimum(self.false_rate, 0.99)))

    def decide(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        found = self.counts(grams(text))
        total = float(found.sum())
        return (self.langs[int(found.argmax())], float(found.max()) / total) if total > 0 else (self.default, 0.0)


def learn(docs: DataFrame) -> Filters:
    """Filters from the rows outside fold 0 whose lang is known. The driver
    gets one row per language and the set slots of the filters."""
    counts = stored(count_grams(docs.where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull())), "language-grams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Filters([], UNKNOWN, [], np.zeros(0), LEAST_BITS)
    of_lang = lambda values: F.element_at(F.create_map(*[F.lit(x) for lang in langs for x in (lang, values[lang])]), F.col("lang"))
    # the count down to which a language's n-grams are kept, from its (few) distinct counts
    kinds = counts.groupBy("lang", "n").agg(F.sum("n").alias("mass"))
    down = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    reached = kinds.withColumn("upto", F.sum("mass").over(down)).where(F.col("upto") >= COVER * of_lang(totals))
    least = {r.lang: r.n for r in reached.groupBy("lang").agg(F.max("n").alias("n")).collect()}
    rated = counts.select("gram", F.struct((F.col("n") / of_lang(totals)).alias("share"), "lang").alias("of"), (F.col("n") >= of_lang(least)).alias("kept"))
    best = rated.groupBy("gram").agg(F.collect_list("of").alias("of"), F.max("of.share").alias("top"), F.max("kept").alias("kept")).where("kept")  # a list of the languages at most
    owned = stored(best.select("gram", F.transform(F.filter("of", lambda x: x["share"] >= SHARE * F.col("top")), lambda x: x["lang"]).alias("langs")), "language-filters")
    bits, index = slot_bits(owned.count()), {lang: k for k, lang in enumerate(langs)}

    def rows(batches):
        for b in batches:
            at = slots(b.column(0).to_numpy(), bits)
            masks: dict[int, list[int]] = {}
            for row, own in enumerate(b.column(1).to_pylist()):
                for lang in own:
                    masks.setdefault(index[lang] // 8, [0] * b.num_rows)[row] |= 1 << index[lang] % 8
            for plane, mask in masks.items():
                mask = np.array(mask)
                hit = mask > 0
                for a in at:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(hit.sum(), plane, np.int32)), pa.array(a[hit]), pa.array(mask[hit])], names=["plane", "slot", "mask"])

    joined = owned.mapInArrow(rows, "plane int, slot long, mask long").groupBy("plane", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()  # 2 ** bits rows a plane at most
    planes = [np.zeros(1 << bits, np.uint8) for _ in range((len(langs) + 7) // 8)]
    plane, slot, mask = (joined.column(c).to_numpy() for c in ("plane", "slot", "mask"))
    for k, own in enumerate(planes):
        own[slot[plane == k]] = mask[plane == k]
    return Filters.of_planes(langs, min(langs, key=lambda x: (-totals[x], x)), planes, bits)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # a byte a slot for each eight languages

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                got = [shared.value.decide(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    out = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(rows, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def keep(docs: DataFrame) -> DataFrame:
    """The documents in a recognised language, as they are: those without a
    letter or without any n-gram of a learned language go."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs.select("doc_id", "text", "lang")))
    at = docs.columns.index("text")

    def rows(batches):
        for whole in batches:
            for part in pieces(whole):
                yield part.filter(pa.array([shared.value.decide(t)[1] > 0 for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
