"""Removal of repeated passages by Rabin-Karp hashes of every token window.

A window is ``window`` consecutive white-space separated words of one
document. Its Rabin-Karp hash is a difference of two prefix sums of word
hashes times powers of an odd base, modulo 2^64, so all windows of a block of
texts are hashed in a few numpy passes. A window is removed where its words
also start in a document with a smaller ``doc_id``.

1. ``frequent_anchors``: the anchor of a window is the least hash of its
   ``GRAM``-word grams, which equal windows share and neighbouring windows
   mostly do. The anchors that hold more than ``HOT_SHARE`` of all runs are
   listed (at most 1 / ``HOT_SHARE`` numbers, so the list may go to every
   task).
2. Every window's hash is sent to the task of its key: its anchor, or, where
   the anchor is in that list, the anchor salted with the window's hash.
   Consecutive windows with one key travel as one row. Inside a block of texts
   a window goes only from its smallest ``doc_id``; the block's other holders
   are decided on the spot, so a passage that a third of all documents share
   is sent once a block.
3. A task reads its keys in order and, per key, documents in ascending order;
   the first holder of a hash has the smallest id, all later ones are repeats.
   It holds the distinct hashes of one key at most (plus a buffer).
4. Repeats of consecutive windows leave as intervals of words. Per document
   they are merged into maximal intervals, which meet the text and cut it.

Two windows are taken as equal if a 64-bit gram hash and 56 bits of the window
hash agree. Documents are told apart by ``doc_id`` and a hash of their text.

Cases: a null text has no words; a null ``doc_id`` is smaller than nothing and
has nothing smaller, so its document stays whole and removes nothing; repeats
inside one document, or in rows of one id, are not removed; repeated rows
each give a row; a text below ``window`` words stays; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import pieces

WINDOW = 50
GRAM, HASH_BYTES = 8, 7
#: An anchor with more than this share of all runs is split by window hash.
HOT_SHARE = 1e-4
#: Holders an anchor needs inside a block to be counted as possibly hot.
LOCAL_HOT = 8
#: Text of a block, and windows a task compares at a time.
BLOCK_BYTES, CHUNK = 4 << 20, 1 << 19
#: Words whose hash a worker keeps, and the longest of them.
CACHE_WORDS, CACHE_LENGTH = 1 << 18, 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SALTS = np.uint64(256)
_PAIR = "key long, doc_id long, mark long, start int, end int, hashes binary"
_SPAN = "doc_id long, mark long, start int, end int"


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    """64-bit hash of a word; frequent short ones are kept, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


class Block:
    """All windows of some texts: place, anchor and hash of each."""

    def __init__(self, texts: list[bytes], window: int, hashes: WordHashes):
        own = [np.fromiter(map(hashes.__getitem__, t.split()), np.uint64) for t in texts]
        self.n_words = np.array([len(w) for w in own], np.int64)
        ends = np.cumsum(self.n_words)
        self.first = ends - self.n_words  # place of each text's first word
        total = int(ends[-1]) if len(ends) else 0
        self.text = np.zeros(0, np.int64)
        if total < window:
            return
        h = np.concatenate(own)
        # sums of h[j] / base^j up to each place; a span's sum times base^(its start) is free of the place
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(_INVERSE, total))])
        power = _powers(_BASE, total)

        def spans(n: int) -> np.ndarray:
            at = total - n + 1
            return _mix((sums[n:] - sums[:at]) * power[:at])

        gram = min(GRAM, window)
        least, width, want = spans(gram), 1, window - gram + 1
        while width < want:  # sliding minimum over the grams of a window
            step = min(width, want - width)
            least, width = np.minimum(least[:len(least) - step], least[step:]), width + step
        fits = np.zeros(total + 1, np.int64)  # places where a window of one text starts
        long = self.n_words >= window
        np.add.at(fits, self.first[long], 1)
        np.add.at(fits, ends[long] - window + 1, -1)
        self.at = np.flatnonzero(np.cumsum(fits)[:total - window + 1])
        self.anchor, self.hash = least[self.at], spans(window)[self.at] >> np.uint64(64 - 8 * HASH_BYTES)
        self.text = np.repeat(np.flatnonzero(long), self.n_words[long] - window + 1)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in pc.cast(batch.column("text"), pa.binary()).to_pylist()]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def frequent_anchors(docs: DataFrame, window: int = WINDOW, share: float = HOT_SHARE) -> np.ndarray:
    """Anchors of more than ``share`` of all runs, sorted: at most 1 / share.
    A block counts anchors that begin ``LOCAL_HOT`` runs in it or more."""

    def rows(batches):
        cache = WordHashes()
        for b in batches:
            for piece in pieces(b, most_bytes=BLOCK_BYTES):
                block = Block(_texts(piece), window, cache)
                if not len(block.text):
                    continue
                anchors, n = np.unique(block.anchor[_runs(block.text, block.at, block.anchor)[0]], return_counts=True)
                total = int(n.sum())
                anchors, n = anchors[n >= LOCAL_HOT], n[n >= LOCAL_HOT]
                yield pa.RecordBatch.from_arrays([pa.array([None, *anchors.view(np.int64).tolist()], pa.int64()), pa.array([total, *n.tolist()], pa.int64())], names=["anchor", "n"])

    # at most 1 / LOCAL_HOT of a block's runs as rows
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    limit = int(1 / share)
    top = counts.orderBy(F.col("anchor").isNotNull(), F.desc("n"), "anchor").limit(limit + 1).collect()
    total = next((r.n for r in top if r.anchor is None), 0)
    return np.sort(np.array([r.anchor for r in top if r.anchor is not None and r.n > share * total], np.int64).view(np.uint64))


def dealt_windows(docs: DataFrame, hot: np.ndarray, window: int = WINDOW) -> DataFrame:
    """Rows of ``_PAIR``: runs of windows with their hashes, each from the
    smallest id of its block, and, with an ``end`` in place of hashes, spans
    that the block already knows as repeats (keyed by id)."""

    def rows(batches):
        cache = WordHashes()
        for b in batches:
            for piece in pieces(b, most_bytes=BLOCK_BYTES):
                block = Block(_texts(piece), window, cache)
                known = ~np.asarray(pc.is_null(piece.column("doc_id")))
                keep = known[block.text] if len(block.text) else np.zeros(0, bool)
                if not keep.any():
                    continue
                ids = pc.fill_null(piece.column("doc_id"), 0).to_numpy(zero_copy_only=False)
                marks = piece.column("mark").to_numpy(zero_copy_only=False)
                text, at, anchor, h = block.text[keep], block.at[keep], block.anchor[keep], block.hash[keep]
                repeat = _known_repeats(ids[text], anchor, h)
                start = at - block.first[text]
                found = np.flatnonzero(repeat)
                if len(found):
                    head, size = _runs(text[found], start[found])
                    t, s = text[found[head]], start[found[head]]
                    yield _dealt(_mix(ids[t].view(np.uint64)), ids[t], marks[t], s, s + size - 1 + window, pa.nulls(len(head), pa.binary()))
                sent = np.flatnonzero(~repeat)
                key = anchor[sent]
                if len(hot):
                    salted = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                    key[salted] = _mix(key[salted] + h[sent[salted]] % _SALTS)
                head, _ = _runs(text[sent], start[sent], key)
                t = text[sent[head]]
                raw = np.ascontiguousarray(h[sent].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
                offsets = np.append(head, len(sent)).astype(np.int32) * HASH_BYTES
                body = pa.BinaryArray.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                yield _dealt(key[head], ids[t], marks[t], start[sent[head]], None, body)

    return _rows(docs).mapInArrow(rows, _PAIR)


def _known_repeats(doc: np.ndarray, anchor: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for windows whose equal has a smaller id in the block."""
    order = np.argsort(_mix(anchor) ^ h, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (anchor[order[1:]] != anchor[order[:-1]])
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    repeat = np.zeros(len(order), bool)
    repeat[order] = doc[order] > least
    return repeat


def _runs(row: np.ndarray, start: np.ndarray, key: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of runs of consecutive windows of one row (and key)."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    if key is not None:
        new[1:] |= key[1:] != key[:-1]
    head = np.flatnonzero(new)
    return head, np.diff(np.append(head, len(row)))


def _dealt(key, doc, mark, start, end, body) -> pa.RecordBatch:
    end = pa.nulls(len(doc), pa.int32()) if end is None else pa.array(end.astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(mark), pa.array(start.astype(np.int32)), end, body],
                                      names=["key", "doc_id", "mark", "start", "end", "hashes"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, share: float = HOT_SHARE) -> DataFrame:
    """(doc_id, mark, start, end): spans of words to remove, start included
    and end not; they may overlap."""
    hot = frequent_anchors(docs, window, share)
    dealt = dealt_windows(docs, hot, window).repartition("key").sortWithinPartitions("key", "doc_id")
    names = ["doc_id", "mark", "start", "end"]

    def rows(batches):
        held_key, held_hash, held_doc = None, None, None  # of the key that goes on: least id of each hash
        for batch in batches:
            bare = pc.is_null(batch.column("hashes"))
            yield batch.filter(bare).select(names)
            batch = batch.filter(pc.invert(bare))
            for low, high in _chunks(batch):
                part = batch.slice(low, high - low)
                key, doc, mark = (part.column(c).to_numpy() for c in ("key", "doc_id", "mark"))
                size = pc.binary_length(part.column("hashes")).to_numpy() // HASH_BYTES
                wide = np.zeros((int(size.sum()), 8), np.uint8)
                wide[:, :HASH_BYTES] = np.frombuffer(b"".join(part.column("hashes").to_pylist()), np.uint8).reshape(-1, HASH_BYTES)
                h, row = wide.view("<u8").ravel(), np.repeat(np.arange(len(size)), size)
                start = part.column("start").to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                all_key, all_hash, all_doc = key[row], h, doc[row]
                more = len(held_hash) if held_key is not None and held_key == key[0] else 0
                if more:
                    all_key = np.concatenate([np.full(more, held_key), all_key])
                    all_hash, all_doc = np.concatenate([held_hash, all_hash]), np.concatenate([held_doc, all_doc])
                order = np.lexsort((all_doc, all_hash, all_key))
                new = np.ones(len(order), bool)
                new[1:] = (all_key[order[1:]] != all_key[order[:-1]]) | (all_hash[order[1:]] != all_hash[order[:-1]])
                begin = np.flatnonzero(new)
                least = np.empty(len(order), np.int64)
                least[order] = all_doc[order[begin]][np.cumsum(new) - 1]
                of_last = order[begin][all_key[order[begin]] == key[-1]]
                held_key, held_hash, held_doc = key[-1], all_hash[of_last], all_doc[of_last]
                found = np.flatnonzero(all_doc[more:] > least[more:])
                head, count = _runs(row[found], start[found])
                r, s = row[found[head]], start[found[head]]
                yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(mark[r]), pa.array(s.astype(np.int32)), pa.array((s + count - 1 + window).astype(np.int32))], names=names)

    return dealt.mapInArrow(rows, _SPAN)


def _chunks(batch: pa.RecordBatch):
    """Slices of at most about ``CHUNK`` windows (one row at least)."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(batch.column("hashes")).to_numpy() // HASH_BYTES)
    low = 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
        yield low, high
        low = high


def remove_repeats(docs: DataFrame, window: int = WINDOW, share: float = HOT_SHARE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): words before, removed words, and
    the words that are left, joined by one space."""

    def rows(batches):
        for b in batches:
            for piece in pieces(b):
                n_words, removed, kept = [], [], []
                for text, starts, ends in zip(_texts(piece), piece.column("starts").to_pylist(), piece.column("ends").to_pylist()):
                    w = text.split()
                    left, at = [], 0
                    for s, e in sorted(zip(starts or (), ends or ())):  # maximal intervals, in order
                        if s > at:
                            left += w[at:s]
                        at = max(at, e)
                    left += w[at:]
                    n_words.append(len(w))
                    removed.append(len(w) - len(left))
                    kept.append(b" ".join(left))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                                                  pc.cast(pa.array(kept, pa.binary()), pa.string(), safe=False)], names=["doc_id", "n_words", "n_removed", "kept"])

    spans = (repeated_spans(docs, window, share).groupBy("doc_id", "mark")  # bounded by a document's words
             .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
             .select("doc_id", "mark", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")))
    return (_rows(docs).join(spans, ["doc_id", "mark"], "left").select("doc_id", "text", "starts", "ends")
            .mapInArrow(rows, "doc_id long, n_words long, n_removed long, kept string"))


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], window: int = WINDOW) -> list[tuple]:
    """The contract word by word, for tests: (doc_id, n_words, n_removed, kept_sha256)."""
    first: dict[tuple, int] = {}
    cut = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in cut:
        for i in range(len(w) - window + 1):
            if d is not None:
                first[(*w[i:i + window],)] = min(d, first.get((*w[i:i + window],), d))
    out = []
    for d, w in cut:
        gone = {j for i in range(len(w) - window + 1) if d is not None and first[(*w[i:i + window],)] < d for j in range(i, i + window)}
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out
