"""N-gram Jaccard join by partitioning the universe of tokens.

A document's set holds the 64-bit hashes of its distinct shingles of a
``Rule``'s number of words. Two sets link if their Jaccard similarity is at
least the rule's per cent. The query's rule is three words and 90 %, the
pipeline's five words and 80 %.

Size bands. Sizes are cut into bands; a pair is found in the band of its
smaller set, whose size s bounds the symmetric difference by
H = floor(u x (100 - percent) / percent), u the band's largest size. A set
signs its own band and, if it may be the larger of a pair, the band below.

Segments and subsets. A band's universe is cut by hash into groups, a group
into n segments. A group has an error budget b: with at most b differing tokens
in it, two sets agree on some t = n - b of its segments, and each set writes
one signature for every choice of t segments (``Plan``); or n is 1, the budget
is 1, and a set writes the group's whole content and, for each of its tokens,
the content without it (one-deletion neighbourhood). If groups x (b + 1) is
at least H + 1, two sets with a difference of at most H agree in some group.

Empty signatures, of choices in which a set has no token, say nothing and would
join unrelated sets. A set has no use for them if enough of its groups have
none: of G groups those with an empty choice are left out, and if the rest x
(b + 1) still is at least H + 1, a similar set agrees with it on a choice with
tokens. The number of groups has a margin for that; the few sets which it
does not serve write their empty signatures, too.

The shape (n, t or deletion) is chosen per band by cost: signatures written plus
candidate pairs, of sets that share a passage and nothing else, which agree on
choices that hold tokens of the passage only; from the number of sets per band.

Verification. Signatures are shuffled once; the sorted stream drops those of a
single set. Sets with a common signature form a bucket. Round by round, the
first members of each bucket are compared with the bucket's members of other
components: first sizes and parity sketches, which no linking pair fails (large
sets have a second sketch that grows with them, as the short one tells them
apart no more), then exactly; a member linked to them joins their component and needs no
comparison inside it, so a group of n near copies costs about n comparisons, not
n squared; compared members leave the bucket, and the rounds end when every
bucket holds one component only. Buckets come in two phases, a thirty-second of the
signatures first, so that most find their members linked already. No link between different components is
left out, so the components are those of all links.

Equal sets are one node from the start (named by a 64-bit digest of the set),
so copies are signed once a task and compared once. Cases: null, empty or blank text has the empty set and links with nothing;
a text with fewer words than a shingle is one shingle; of repeated doc_ids each row is a document;
null ids form components under the least non-null id, or null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import IdFilter, pieces, space_words, stored
from postlens.llm.components import components
from postlens.sources.tables import broadcast_threshold



@dataclass(frozen=True)
class Rule:
    """Words of a shingle; least Jaccard similarity of a link in per cent."""

    shingle: int = 3
    percent: int = 90


RULE = Rule()
#: Ratio of a band's largest to its smallest size, at least.
BAND_RATIO = 1.5
#: Cost of one candidate pair, in signatures written: nearly all end at the
#: sketch inside a join, while a signature is made, moved and sorted.
PAIR_COST = 0.2
#: Share of the sets, and tokens, of the passage that the cost of candidates assumes.
SHARED_BY, PASSAGE = 1 / 3, 40
#: (segments of a group, segments of a choice) that may be chosen; (1, 0) is one-deletion.
SHAPES = ((1, 1), (3, 2), (4, 3), (4, 2), (5, 3), (6, 3), (1, 0))
#: Longs of a set's parity sketch; sets beyond ``wide_from`` have a second one
#: of one bit a token at least.
SKETCH = 8
#: Buckets are compared in phases, by signature modulo the last number: similar
#: sets share many signatures, so a few buckets link nearly all of them, and most
#: of the others then hold one component and need no comparison.
PHASES = (0, 2, 64)
#: First members of a bucket that are compared: in the first round, the factor
#: from round to round, and at most.
FIRST, MORE, MOST = 1, 64, 4096
#: Members of a bucket up to which they don't carry their sketches: it is one pair.
SMALL_BUCKET = 2
CACHE_ENTRIES = 150_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SALTS, _FACTORS = (_A, _B, _C), (_B, _C, _A)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, words: int = RULE.shingle):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = space_words(text)
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        if len(h) < self.words:
            h = np.concatenate((h, np.full(self.words - len(h), len(h), np.uint64)))
        n, total = len(h) - self.words + 1, np.uint64(0)
        for i in range(self.words):
            part = mix(h[i:i + n] + _SALTS[i % 3]) * _FACTORS[i % 3]
            # from the fourth word on, what came before is mixed, so that the order counts
            total = (mix(total) if i and i % 3 == 0 else total) + part
        return np.unique(mix(total))


def node_of(tokens: np.ndarray) -> int | None:
    """64-bit digest of a set; the empty set is no node."""
    return int.from_bytes(xxhash.xxh3_64_digest(tokens.tobytes()), "big", signed=True) if len(tokens) else None


def partner(size: int, percent: int = RULE.percent) -> int:
    """Largest size of a set that can link with one of this size."""
    return size * 100 // percent


def band_starts(largest: int, percent: int = RULE.percent) -> list[int]:
    """First sizes of the bands; each band reaches at least every possible
    partner of its first size, so a pair spans two neighbouring bands at most."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(partner(out[-1], percent), int(out[-1] * BAND_RATIO)) + 1)
    return out


@dataclass(frozen=True)
class Plan:
    """Groups of a band, segments of a group, segments of a choice (0: the
    group's content and its one-deletion neighbourhood), and H + 1."""

    groups: int
    segments: int
    take: int
    need: int

    @property
    def budget(self) -> int:
        return self.segments - self.take if self.take else 1

    def signatures(self, size: float) -> float:
        return self.groups * math.comb(self.segments, self.take) if self.take else self.groups + size

    def useless(self, size: float) -> float:
        """Chance that a group of a random set of this size has an empty choice."""
        rate = size / (self.groups * self.segments)
        empty = math.exp(-rate)
        if not self.take:
            return empty * (1 + rate)
        return sum(math.comb(self.segments, k) * empty ** k * (1 - empty) ** (self.segments - k) for k in range(self.take, self.segments + 1))

    def enough(self, size: float) -> bool:
        """Nearly all sets of this size may leave their empty signatures out."""
        bad = self.useless(size)
        return (self.groups * (1 - bad) - 2 * math.sqrt(self.groups * bad * (1 - bad))) * (self.budget + 1) >= self.need


def allocate(sets: int, last: int, percent: int = RULE.percent, first: int | None = None) -> Plan:
    """The cheapest plan for a band of so many sets of ``first`` to ``last`` tokens."""
    need = last * (100 - percent) // percent + 1
    first = min(last, max(1, last / BAND_RATIO if first is None else first))
    best = None
    for segments, take in SHAPES:
        least = -(-need // ((segments - take if take else 1) + 1))
        groups = next((g for g in range(least, 2 * least + 3) if Plan(g, segments, take, need).enough(first)), least)
        plan = Plan(groups, segments, take, need)
        written = plan.signatures(first)
        held = (take or 1) * last / (groups * segments)  # tokens of a choice
        shared = min(1.0, PASSAGE / last)
        only = math.exp(-held * (1 - shared)) * (1 - math.exp(-held * shared)) if held * (1 - shared) < 700 else 0.0
        pairs = (sets * SHARED_BY) ** 2 / 2 * groups * max(1, math.comb(segments, take)) * only * only * (1 if take else (1 + held) ** 2)
        if not plan.enough(first):
            pairs += sets * sets / 2 * written * math.exp(-2 * held)
        cost = sets * written + PAIR_COST * pairs
        if best is None or cost < best[0]:
            best = cost, plan
    return best[1]


def parity(tokens: np.ndarray, longs: int = SKETCH) -> np.ndarray:
    """``longs`` x 64 parity bits of a set. Two sets' sketches differ in at
    most as many bits as the sets do in tokens."""
    bits = np.bincount((mix(tokens ^ _C) % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_from(percent: int) -> int:
    """Half the size from which any two sketches of ``SKETCH`` longs pass: they
    differ in half of their bits at most, on average."""
    return 64 * SKETCH * (100 + percent) // (8 * (100 - percent)) if percent < 100 else 0


def wide_parity(tokens: np.ndarray, percent: int) -> np.ndarray | None:
    """The second sketch of a large set: the least power of two of bits that is
    no less than its size; that of twice the length folds to it by exclusive or."""
    return parity(tokens, 1 << (-(-len(tokens) // 64) - 1).bit_length()) if len(tokens) > wide_from(percent) else None


class Signer:
    """Signatures of a set under the bands' plans."""

    def __init__(self, starts: list[int], plan: dict[int, Plan], rule: Rule = RULE):
        self.starts, self.plan, self.rule = np.array(starts), plan, rule
        self.choices = {(n, t): np.array(list(combinations(range(n), t))) for n, t in {(p.segments, p.take) for p in plan.values()} if t}

    def bands(self, size: int) -> list[int]:
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        below = own > 0 and partner(int(self.starts[own]) - 1, self.rule.percent) >= size
        return [b for b in ([own, own - 1] if below else [own]) if b in self.plan]

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        out = [self._band(tokens, band, self.plan[band]) for band in self.bands(len(tokens))]
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)

    def _band(self, tokens: np.ndarray, band: int, plan: Plan) -> np.ndarray:
        m = plan.groups * plan.segments
        own_salt = mix(np.array([band + 1], np.uint64))
        at = (mix(tokens + own_salt) % np.uint64(m)).astype(np.int64)
        value = mix(tokens ^ _B)
        order = np.argsort(at, kind="stable")
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[order])])  # wraps modulo 2^64
        count = np.bincount(at, minlength=m)
        end = np.cumsum(count)
        total = sums[end] - sums[end - count]
        salt = mix(np.arange(m, dtype=np.uint64) * _C + own_salt)
        held = count.astype(np.uint64)
        whole = mix(total * _A + salt + held)
        if not plan.take:
            loose = mix((total[at] - value) * _A + salt[at] + held[at] - np.uint64(1))
            found, full = np.concatenate([whole, loose]), np.concatenate([count > 0, count[at] > 1])
            useful = plan.groups - int((count <= 1).sum())
        elif plan.segments == 1:
            found, full, useful = whole, count > 0, int((count > 0).sum())
        else:
            chosen = self.choices[plan.segments, plan.take]
            segments, empty = whole.reshape(plan.groups, -1), (count == 0).reshape(plan.groups, -1)
            found = np.zeros((plan.groups, len(chosen)), np.uint64)
            for column in chosen.T:
                found = mix(found + segments[:, column])
            found = found.ravel()
            full = ~np.all(empty[:, chosen], axis=2).ravel()
            useful = plan.groups - int((empty.sum(axis=1) >= plan.take).sum())
        return found[full] if useful * (plan.budget + 1) >= plan.need else found


_SKETCH = [f"s{i}" for i in range(SKETCH)]


def _may_link(percent: int) -> Column:
    """No pair that links fails this: sizes fit, and the sketches differ in no
    more bits than the sets may in tokens."""
    differ = functools.reduce(lambda a, b: a + b, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_a"))) for c in _SKETCH))
    return ((100 * F.least("size", "size_a") >= percent * F.greatest("size", "size_a"))
            & ((100 + percent) * differ <= (100 - percent) * (F.col("size") + F.col("size_a"))))


def _wide_differ(x: Column, y: Column) -> Column:
    """Differing bits of two wide sketches, the longer one folded."""
    n = F.least(F.size(x), F.size(y))
    folded = lambda c, i: F.aggregate(F.sequence(i, F.size(c) - 1, n), F.lit(0).cast("long"), lambda acc, j: acc.bitwiseXOR(F.get(c, j)))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + F.bit_count(folded(x, i).bitwiseXOR(folded(y, i))))


def _memberships(docs: DataFrame, rule: Rule) -> DataFrame:
    def rows(batches):
        shingle = Shingler(rule.shingle)
        for whole in batches:
            for part in pieces(whole):
                sets = [shingle(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()),
                     *(pa.array(x) for x in np.array([parity(s) for s in sets], np.int64).reshape(-1, SKETCH).T),
                     pa.array([wide_parity(s, rule.percent) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "mark", "n_shingles", "node", *_SKETCH, "wide"])
            pa.default_memory_pool().release_unused()

    return docs.withColumn("mark", F.md5("text")).mapInArrow(rows, "doc_id long, mark string, n_shingles long, node long, " + ", ".join(f"{c} long" for c in _SKETCH) + ", wide array<long>")


def _signatures(docs: DataFrame, signer: Signer) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(signer)  # two numbers a band

    def rows(batches):
        shingle, seen = Shingler(shared.value.rule.shingle), set()
        for whole in batches:
            for part in pieces(whole):
                sig, node = [], []
                for text in part.column(1).to_pylist():
                    tokens = shingle(text)
                    own = node_of(tokens)
                    if own is None or own in seen:  # copies in this task
                        continue
                    if len(seen) > CACHE_ENTRIES:
                        seen.clear()
                    seen.add(own)
                    sig.append(shared.value(tokens).view(np.int64))
                    node.append(np.full(len(sig[-1]), own, np.int64))
                if sig:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sig, node)], names=["sig", "node"])
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(rows, "sig long, node long")


def _shared(signed: DataFrame) -> DataFrame:
    """The distinct rows (sig, node) of signatures that several nodes have.
    One exchange by signature; the sorted rows are streamed, so a signature
    that very many nodes have is never held."""
    def rows(batches):
        # the last row seen, which waits for its successor, and whether it has gone already
        sig, node, gone = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            s, n = (np.concatenate([h, batch.column(c).to_numpy()]) for c, h in (("sig", sig), ("node", node)))
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (n[1:] != n[:-1])
            s, n = s[new], n[new]
            follows = s[1:] == s[:-1]
            keep = np.append(False, follows) | np.append(follows, False)
            if len(sig) and gone:
                keep[0] = False
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(n[keep])], names=["sig", "node"])
            gone = bool(keep[-1]) if len(s) > 1 else gone
            sig, node = s[-1:], n[-1:]

    return signed.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(rows, "sig long, node long")


def _texts_of(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(node, text): one text of each node. ``nodes`` names a document of the
    node (of repeated ids the one with the node's set is taken); nodes that
    only documents without an id have are found among those."""
    def rows(batches):
        shingle = Shingler(rule.shingle)
        for whole in batches:
            for part in pieces(whole):
                own = [node_of(shingle(t)) for t in part.column(1).to_pylist()]
                wanted = part.column(0).to_pylist()
                keep = pa.array([o is not None and w in (None, o) for o, w in zip(own, wanted, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), part.column(1)], names=["node", "text"]).filter(keep)

    own, known = nodes.where("doc_id is not null"), docs.where("doc_id is not null")
    if own.count() * 64 <= broadcast_threshold(docs.sparkSession):
        named = known.join(F.broadcast(own), "doc_id").select("node", "text")
    else:  # only texts that may be wanted are shuffled
        named = IdFilter(own, "doc_id").rows(known, "doc_id").join(own.hint("merge"), "doc_id").select("node", "text")
    others = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("node"), "text")
    found = named.mapInArrow(rows, "node long, text string")
    rest = others.mapInArrow(rows, "node long, text string").join(nodes.where("doc_id is null").select("node"), "node")
    return found.unionByName(rest).dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The (a, b) whose sets link, by exact counts of their shingles. Each row
    that is moved holds one text: a's comes first, then that of each b; the
    partners of an a that has very many are dealt over salts."""
    def rows(batches):
        shingle, own, x = Shingler(rule.shingle), None, None
        for whole in batches:
            for part in pieces(whole):
                left, right, keep = [], [], []
                for a, salt, b, text in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    tokens = shingle(text)
                    if b is None:
                        own, x = (a, salt), tokens
                        continue
                    assert own == (a, salt), "a's text comes first"
                    both = len(np.intersect1d(x, tokens, assume_unique=True))
                    left.append(a)
                    right.append(b)
                    keep.append(100 * both >= rule.percent * (len(x) + len(tokens) - both))
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
            pa.default_memory_pool().release_unused()

    dealt = pairs.select("a", F.pmod("b", F.lit(16)).alias("salt"), "b")
    first = dealt.select("a", "salt").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    second = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "text")
    ordered = first.unionByName(second).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return ordered.mapInArrow(rows, "a long, b long")


def set_components(docs: DataFrame, rule: Rule = RULE) -> tuple[DataFrame, DataFrame]:
    """(documents with n_shingles and node, (node, root) of linked nodes)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = stored(_memberships(plain, rule), "shingle-sets")
    # stored, as every round joins it
    nodes = stored(members.where("node is not null").groupBy("node").agg(
        F.max("n_shingles").alias("size"), F.min("doc_id").alias("doc_id"), *(F.max(c).alias(c) for c in _SKETCH), F.max("wide").alias("wide")), "set-nodes")
    largest = nodes.agg(F.max("size")).first()[0] or 0
    starts = band_starts(largest, rule.percent)
    bounds = F.array(*[F.lit(s) for s in starts])
    counts = {r.band: r.n for r in nodes.groupBy((F.size(F.filter(bounds, lambda s: s <= F.col("size"))) - 1).alias("band"))
              .agg(F.count("*").alias("n")).collect()}  # one row a band
    plan = {b: allocate(counts.get(b, 0) + counts.get(b + 1, 0), stop - 1, rule.percent, start)
            for b, (start, stop) in enumerate(pairwise(starts)) if b in counts}
    empty = docs.sparkSession.createDataFrame([], "node long, root long")
    if not plan:
        return members.drop(*_SKETCH, "wide"), empty
    bucket = stored(_shared(_signatures(plain, Signer(starts, plan, rule))), "shared-signatures")
    sets = nodes.drop("doc_id")
    shared_signatures, roots, links = bucket, empty, None
    for low, high in pairwise(PHASES):
        bucket, leaders = shared_signatures.where(F.pmod("sig", F.lit(PHASES[-1])).between(low, high - 1)), FIRST
        while not bucket.isEmpty():
            at = bucket.join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
            mixed = at.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n")).where("r0 != r1").select("sig", "n")
            left = stored(at.join(mixed, "sig"), "open-buckets")
            # the first members of every open bucket (Spark limits the ranks before the shuffle as well),
            # of a hot bucket first those of a salt
            heads = left
            for key in (["sig", F.pmod("node", F.lit(16))], ["sig"]):
                rank = F.row_number().over(Window.partitionBy(*key).orderBy("node"))
                heads = heads.withColumn("rank", rank).where(F.col("rank") <= leaders).drop("rank")
            heads = stored(heads, "bucket-heads")
            pairs = stored(_possible(_pairs(left, heads, sets, rule).distinct(), sets, rule), "candidate-pairs")
            if not pairs.isEmpty():  # only the texts that are compared now are fetched
                wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                texts = stored(_texts_of(plain, nodes.join(wanted, "node").select("node", "doc_id"), rule), "candidate-texts")
                found = stored(_verified(pairs, texts, rule), "links")
                links = found if links is None else links.unionByName(found)
                if not found.isEmpty():
                    roots = stored(components(links), "components")
            bucket = stored(left.select("sig", "node").join(heads.select("sig", "node"), ["sig", "node"], "left_anti"), "open-buckets")
            leaders = min(MORE * leaders, MOST)
    return members.drop(*_SKETCH, "wide"), roots


def _pairs(left: DataFrame, heads: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): head and member of a bucket, of different components. The heads
    are a bucket's least nodes, so of two heads the lesser is a. Members of
    buckets of three or more carry their size and sketch, so that pairs which
    can't link end before they are moved; others are one pair."""
    a = lambda df, *more: df.select("sig", *(F.col(c).alias("a" if c == "node" else f"{c}_a") for c in ["node", "root", *more]))
    apart = (F.col("root") != F.col("root_a")) & (F.col("node") > F.col("a"))
    few = left.where(F.col("n") <= SMALL_BUCKET).join(a(heads.where(F.col("n") <= SMALL_BUCKET)), "sig").where(apart)
    wide = lambda df: df.where(F.col("n") > SMALL_BUCKET).join(sets.drop("wide"), "node")
    many = wide(left).join(a(wide(heads), "size", *_SKETCH), "sig").where(apart & _may_link(rule.percent))
    return few.select("a", F.col("node").alias("b")).unionByName(many.select("a", F.col("node").alias("b")))


def _possible(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sizes and sketches allow a link."""
    first = sets.select(F.col("node").alias("a"), *(F.col(c).alias(f"{c}_a") for c in ["size", *_SKETCH, "wide"]))
    near = pairs.join(first, "a").join(sets.withColumnRenamed("node", "b"), "b").where(_may_link(rule.percent))
    close = (100 + rule.percent) * _wide_differ(F.col("wide"), F.col("wide_a")) <= (100 - rule.percent) * (F.col("size") + F.col("size_a"))
    return near.where(F.col("wide").isNull() | F.col("wide_a").isNull() | close).select("a", "b")


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    members, roots = set_components(docs)
    at = members.join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("root", "node").alias("group"))
    # stored, so that the join below has a plain exchange on both sides and a hot component can be split
    least = stored(at.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return at.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One document of each component under the rule, as it is: the one with the least id
    (null last), then the least digest of its text; documents without words
    all stay. Rows that repeat id and text of the one that stays fall away.

    The choice is made on ids and digests. Texts of documents that surely stay
    are not moved; only those whose id may be in the list of rows to drop (a
    bitmap tells) meet that list."""
    members, roots = set_components(docs, rule)
    rows = members.where("node is not null").groupBy("doc_id", "mark", "node").agg(F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "mark", "node")
    grouped = stored(rows.join(roots, "node", "left").select("doc_id", "mark", "node", "rows", F.coalesce("root", "node").alias("group")), "near-groups")
    first = stored(grouped.groupBy("group").agg(F.min(order).alias("o")).select("group", F.col("o.doc_id").alias("d"), F.col("o.mark").alias("m"), F.col("o.node").alias("k")), "near-firsts")
    stays = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("node") == F.col("k"))
    listed = stored(grouped.join(first, "group").select("doc_id", "mark", "rows", stays.alias("stays")).where("not stays or rows > 1").select("doc_id", "mark", "stays"), "near-dropped")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.md5(F.col("text").cast("string")).alias("digest"))
    known = IdFilter(listed, "doc_id")
    met = known.rows(whole, "id").join(listed, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("digest") == F.col("mark")), "left")
    unlisted = met.where("stays is null").select("row")
    chosen = met.where("stays").groupBy("id", "digest").agg(F.first("row").alias("row")).select("row")
    return known.rows(whole, "id", among=False).select("row").unionByName(unlisted).unionByName(chosen).select("row.*")
