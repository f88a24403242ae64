"""Divergence of the sources of a language by a perfect-hash recount.

1. ``kept_terms``: a first pass counts, per language, the documents of every
   term exactly and keeps the terms of ``MIN_DOCS`` documents or more.
2. ``perfect_hashes``: the kept terms of a language are dealt to shards of
   about ``SHARD_TERMS`` terms. A shard's minimal perfect hash is built in one
   task: keys that meet no other key on a level's bit array take that bit, the
   rest go to the next level, and a key's slot is the rank of its bit. The keys
   are stored by slot.
3. ``recount``: shards are broadcast in rounds of at most ``ROUND_BYTES``, so
   the broadcast is bounded however large the vocabulary is (each round
   reads the texts once more). A task looks up the terms of a block of texts,
   compares the stored key, and increments the dense slots of the
   document's group; slots above zero leave as (group, slot, count) rows.
4. ``audit``: from the summed counts, all terms of a group over-represented
   against their language are ranked, and the divergences of all pairs of
   sources are summed over blocks of slots, each a dense matrix of sources by
   slots of bounded size (terms that a group lacks count there with zero).

All arithmetic is on integers. A group's count of terms is taken to stay below
4 * 10^15.

Cases: null text, lang and source count as empty; a language without kept
terms has pairs of value 0 and no term rows; a language of one source has no
pair rows; repeated rows are documents of their own; bytes that are no valid
UTF-8 count as letters; an empty table gives an empty result; other columns
are ignored. A hot group sends one count a slot and task.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import pieces, stored
from postlens.sources.tables import broadcast_if_rows_at_most

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Terms of a shard (its build is one task's work) and bytes of a round's shards.
SHARD_TERMS, ROUND_BYTES = 1 << 12, 32 << 20
#: Terms counted before a task looks them up or hands them on; bytes of dense slots a task holds.
HELD_TERMS, HELD_BYTES = 1 << 18, 64 << 20
#: Cells (source by slot) of a matrix when pairs are compared.
CELLS = 1 << 17

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SHARD = "lang binary, shard int, shards int, n int, sizes binary, bits binary, ends binary, keys binary"


def terms(text: bytes | None) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z lower-cased."""
    return (text or b"").translate(_LETTERS).split()


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("text", "lang", "source")])


def _columns(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(n).to_pylist() for n in names))


def kept_terms(docs: DataFrame, least: int = MIN_DOCS) -> DataFrame:
    """(lang, term) with ``least`` documents of the language or more."""

    def rows(batches):
        held: dict[bytes, Counter] = defaultdict(Counter)

        def out():
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.binary()), pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                                 names=["lang", "term", "n"])
            held.clear()

        for b in batches:
            for piece in pieces(b):
                for text, lang in _columns(piece, "text", "lang"):
                    held[lang].update(set(terms(text)))
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield from out()
        yield from out()

    counts = _read(docs).select("text", "lang").mapInArrow(rows, "lang binary, term binary, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers a key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.uint64).reshape(-1, 2)


def _places(h: np.ndarray, level: int, size: int) -> np.ndarray:
    x = h[:, 0] + h[:, 1] * np.uint64(2 * level + 1)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of a set of keys, which it stores by slot."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ends: np.ndarray, keys: bytes):
        self.sizes, self.ends, self.keys = sizes, ends, keys
        self.bits = np.unpackbits(bits)[:int(sizes.sum())].astype(bool)
        self.rank = np.cumsum(self.bits, dtype=np.int32) - 1

    def __len__(self) -> int:
        return len(self.ends) - 1

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        h, left, sizes, bits = _hashes(keys), np.arange(len(keys)), [], []
        while len(left):
            size = len(left) * 3 // 2 + 1
            at = _places(h[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        made = cls(np.array(sizes, np.int64), np.packbits(np.concatenate([np.zeros(0, bool), *bits])), np.zeros(len(keys) + 1, np.int64), b"")
        order = np.argsort(made._slots(h))
        ordered = [keys[i] for i in order.tolist()]
        made.keys, made.ends = b"".join(ordered), np.concatenate([[0], np.cumsum([len(k) for k in ordered], dtype=np.int64)]).astype(np.int64)
        return made

    def _slots(self, h: np.ndarray) -> np.ndarray:
        """The slot of each key if it is in the set, else -1 or any slot."""
        out, left, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + _places(h[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
            if not len(left):
                break
        return out

    def slots(self, keys: list[bytes], h: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if it isn't the key stored there."""
        out, ends, stored_keys = self._slots(h), self.ends, self.keys
        for i, s in enumerate(out.tolist()):
            if s >= 0 and stored_keys[ends[s]:ends[s + 1]] != keys[i]:
                out[i] = -1
        return out

    def row(self) -> list[bytes]:
        return [self.sizes.tobytes(), np.packbits(self.bits).tobytes(), self.ends.tobytes(), self.keys]

    @classmethod
    def of_row(cls, r) -> PerfectHash:
        return cls(np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["bits"], np.uint8), np.frombuffer(r["ends"], np.int64), bytes(r["keys"]))


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h[:, 0] >> np.uint64(17)) % np.uint64(shards)).astype(np.int64)


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """A row of ``_SHARD`` for each shard of a language's kept terms."""
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_TERMS).cast("int").alias("shards"))
    sized = kept.join(broadcast_if_rows_at_most(sizes, 10_000), "lang")

    def deal(batches):
        for b in batches:
            if b.num_rows:
                shards = b.column("shards").to_numpy()
                shard = (_hashes(b.column("term").to_pylist())[:, 0] >> np.uint64(17)) % shards.astype(np.uint64)
                yield b.append_column("shard", pa.array(shard.astype(np.int32)))

    def build(table: pa.Table) -> pa.Table:
        made = PerfectHash.build(table.column("term").to_pylist())
        values = [table.column("lang")[0].as_py(), table.column("shard")[0].as_py(), table.column("shards")[0].as_py(), len(made), *made.row()]
        names = [x.split()[0] for x in _SHARD.split(", ")]
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32()] + [pa.binary()] * 4
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, values, kinds)})

    dealt = sized.mapInArrow(deal, "lang binary, term binary, shards int, shard int")
    return dealt.groupBy("lang", "shard").applyInArrow(build, _SHARD)


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, shard, slot, n): occurrences above zero."""
    spark = docs.sparkSession
    size = sum(F.octet_length(c) for c in ("sizes", "bits", "ends", "keys"))
    sized = shards.select("lang", "shard", size.alias("size")).orderBy("lang", "shard").collect()  # a row for each SHARD_TERMS terms
    rounds, room = [], 0
    for r in sized:
        if not rounds or r["size"] > room:
            rounds.append([])
            room = ROUND_BYTES
        rounds[-1].append((bytes(r["lang"]), r["shard"]))
        room -= r["size"]
    schema = "lang binary, source binary, shard int, slot int, n long"
    out = [spark.createDataFrame([], schema)]
    for names in rounds:
        some = spark.createDataFrame(names, "lang binary, shard int")
        own = spark.sparkContext.broadcast([r.asDict() for r in shards.join(F.broadcast(some), ["lang", "shard"]).collect()])  # at most ROUND_BYTES or one shard
        out.append(_read(docs).mapInArrow(_counter(own), schema))
    return reduce(DataFrame.unionByName, out).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def _counter(shards):
    def rows(batches):
        hashes: dict[bytes, list[tuple[int, PerfectHash]]] = defaultdict(list)
        number: dict[bytes, int] = {}
        for r in sorted(shards.value, key=lambda r: r["shard"]):
            lang = bytes(r["lang"])
            hashes[lang].append((r["shard"], PerfectHash.of_row(r)))
            number[lang] = r["shards"]
        # a language's slots of this round stand one shard after the other
        first = {lang: np.cumsum([0] + [len(h) for _, h in own]) for lang, own in hashes.items()}
        held: dict[bytes, dict[bytes, Counter]] = defaultdict(lambda: defaultdict(Counter))
        dense: dict[tuple[bytes, bytes], np.ndarray] = {}

        def places(lang: bytes) -> dict[bytes, int]:
            """Slot of every held term of a language, each looked up once; -1 if it isn't kept."""
            keys = list(set().union(*held[lang].values()))
            h, at = _hashes(keys), np.full(len(keys), -1, np.int64)
            shard = _shard_of(h, number[lang])
            for start, (k, made) in zip(first[lang], hashes[lang]):
                mine = np.flatnonzero(shard == k)
                slots = made.slots([keys[i] for i in mine.tolist()], h[mine])
                at[mine] = np.where(slots >= 0, start + slots, -1)
            return dict(zip(keys, at.tolist()))

        def look_up():
            for lang, sources in held.items():
                place = places(lang)
                for source, c in sources.items():
                    at = np.fromiter(map(place.__getitem__, c), np.int64, len(c))
                    n = np.fromiter(c.values(), np.int64, len(c))
                    if (lang, source) not in dense:
                        dense[lang, source] = np.zeros(int(first[lang][-1]), np.int64)
                    dense[lang, source][at[at >= 0]] += n[at >= 0]  # a term stands once in a counter
                    if sum(x.nbytes for x in dense.values()) > HELD_BYTES:
                        yield from out()
            held.clear()

        def out():
            for (lang, source), slots in dense.items():
                at = np.flatnonzero(slots)
                within = np.searchsorted(first[lang], at, "right") - 1
                shard = np.array([k for k, _ in hashes[lang]], np.int32)[within]
                slot = (at - first[lang][within]).astype(np.int32)
                for a in range(0, len(at), 1 << 16):
                    b = min(len(at), a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a), pa.binary()), pa.array([source] * (b - a), pa.binary()), pa.array(shard[a:b]),
                                                      pa.array(slot[a:b]), pa.array(slots[at[a:b]])], names=["lang", "source", "shard", "slot", "n"])
            dense.clear()

        for b in batches:
            for piece in pieces(b):
                for text, lang, source in _columns(piece, "text", "lang", "source"):
                    if lang in hashes:
                        held[lang][source].update(terms(text))
                if sum(len(c) for sources in held.values() for c in sources.values()) > HELD_TERMS:
                    yield from look_up()
        yield from look_up()
        yield from out()

    return rows


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / total), three digits at a time so that no
    product leaves 64 bits; n + 2 is at most ``total``."""
    digit, rest = np.divmod(n + 2, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        digit = digit * 1000 + more
    return 1 + digit


def _pairs(batches):
    """Per matrix, the divergence of every pair of its sources (i below j)."""
    for b in batches:
        for r in range(b.num_rows):
            one = b.slice(r, 1)
            total = np.array(one.column("totals")[0].as_py(), np.int64)
            cells = one.column("cells")[0].values
            i, slot, count = (pc.struct_field(cells, k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 2))
            n = np.zeros((len(total), one.column("width")[0].as_py()), np.int64)
            n[i, slot] = count
            p = shares(n, total[:, None])
            for a in range(len(total) - 1):
                other = p[a + 1:]
                f = ((other - p[a]) * (other - p[a]) // (other + p[a])).sum(axis=1)
                m = len(f)
                yield pa.RecordBatch.from_arrays([pa.array([one.column("lang")[0].as_py()] * m, pa.binary()), pa.array(np.full(m, a, np.int32)),
                                                  pa.array(np.arange(a + 1, a + 1 + m, dtype=np.int32)), pa.array(f)], names=["lang", "i", "j", "value"])


def audit(docs: DataFrame, least: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module's text."""
    kept = stored(kept_terms(docs, least), "kept-terms")
    shards = stored(perfect_hashes(kept), "perfect-hashes")
    cells = stored(recount(docs, shards), "term-counts")

    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    size = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = _read(docs).select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(size, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("long")
    groups = stored(groups.select("lang", "source", F.coalesce("n", zero).alias("total"), F.coalesce("v", zero).alias("v"), place.alias("i")), "term-groups")

    # terms: a group's count against its language's
    def share(n: str, total: str):
        return F.expr(f"1 + (cast({SCALE} AS decimal(10,0)) * ({n} + 2)) div ({total} + 2 * v)")

    keyed = shards.mapInArrow(_stored_keys, "lang binary, shard int, slot int, term binary")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    of_lang = F.sum("n").over(Window.partitionBy("lang", "shard", "slot"))
    stats = broadcast_if_rows_at_most(groups.join(langs, "lang"), 100_000)
    compared = (cells.withColumn("lang_n", of_lang).join(keyed, ["lang", "shard", "slot"]).join(stats, ["lang", "source"])
                .select("lang", "source", "term", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")).where("p > q")
                .withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    # the best of a hot group's terms: first among those of one salt, then among what is left
    salted = Window.partitionBy("lang", "source", F.crc32("item") % 32).orderBy(F.desc("value"), "item")
    over = (compared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))

    # pairs: dense matrices of a language's sources by a block of slots
    most = groups.agg(F.max("i")).first()[0]
    width = max(1, CELLS // ((most or 0) + 1))
    totals = groups.where("v > 0").groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", (F.col("total") + 2 * F.col("v")).alias("t")))), lambda x: x["t"]).alias("totals"))
    block = F.floor(F.col("slot") / width).cast("int")
    place = groups.select("lang", "source", "i")
    matrices = (cells.join(broadcast_if_rows_at_most(place, 100_000), ["lang", "source"]).groupBy("lang", "shard", block.alias("block"))
                .agg(F.collect_list(F.struct("i", (F.col("slot") - block * width).alias("slot"), "n")).alias("cells")))  # at most CELLS of them
    wide = (matrices.join(broadcast_if_rows_at_most(shards.select("lang", "shard", F.col("n").alias("terms")), 100_000), ["lang", "shard"])
            .join(broadcast_if_rows_at_most(totals, 1_000), "lang")
            .select("lang", "totals", F.least(F.lit(width), F.col("terms") - F.col("block") * width).alias("width"), "cells"))
    value = wide.mapInArrow(_pairs, "lang binary, i int, j int, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    both = value.unionByName(value.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("i").alias("j"))
    pairs = (groups.join(other, "lang").where("i != j").join(both, ["lang", "i", "j"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)))
    text = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    return pairs.unionByName(over).select(*text, "part", F.col("item").cast("string").alias("item"), F.col("value").cast("long").alias("value"), "rank")


def _stored_keys(batches):
    for b in batches:
        for r in b.to_pylist():
            made = PerfectHash.of_row(r)
            e = made.ends.tolist()
            keys = [made.keys[e[s]:e[s + 1]] for s in range(len(made))]
            yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(keys), pa.binary()), pa.array(np.full(len(keys), r["shard"], np.int32)),
                                              pa.array(np.arange(len(keys), dtype=np.int32)), pa.array(keys, pa.binary())], names=["lang", "shard", "slot", "term"])
