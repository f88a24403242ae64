"""Byte-level BPE through a sentencepiece model built from a rank file.

A rank file (``base64(bytes) rank`` lines) becomes a sentencepiece BPE model
without any training: every vocabulary entry is one piece whose bytes are
written as 256 consecutive code points, its score is the negative rank and
the normaliser is the identity. sentencepiece then merges the adjacent pair
with the lowest rank first, leftmost on ties, as byte-level BPE does. Text is
cut into pre-tokens by the pattern (one whose tokens hold a space only as
their first character or in white space); a pre-token that is itself an entry
takes that entry's id, any other is merged by the model. Decoding joins the bytes
of the ids.

Cases: null or empty text gives no ids (0 tokens, digest of nothing); a
pre-token of any length is encoded whole; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
Map-only: no shuffle, each task streams its Arrow batches.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from postlens.llm.common import pieces

#: First of the 256 code points that stand for the byte values.
BYTE_BASE = 0x2800
_TO_CHARS = {b: chr(BYTE_BASE + b) for b in range(256)}
#: Units kept per Python worker (memory bound; the results don't depend on it).
#: Bytes that a worker's cached units take at most, characters of the longest
#: of them, and what a unit takes besides its characters and ids.
CACHE_BYTES, CACHE_LENGTH, CACHE_OVERHEAD = 48 << 20, 64, 200
#: A space beside other white space; elsewhere no pre-token crosses into a space.
_SPACE_RUN = re.compile(r" \s|\s ").search

ENCODE_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def as_chars(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARS)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece model of a rank table. Piece index i holds
    the i-th entry by rank; the unknown piece comes last."""
    out = bytearray()
    for raw, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = _field(1, as_chars(raw).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1)
        out += _field(1, piece)
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(ranks) + 1) + _number(40, len(ranks))
    normaliser = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(out) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder over one rank table. Plain data travels to the
    tasks (the table is a vocabulary, its size doesn't follow the corpus);
    the sentencepiece model is built once per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"rank table lacks {len(missing)} single bytes")
        self.ranks, self.pattern = ranks, pattern
        self.proto = model_proto(ranks)
        self._ready = False

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "proto": self.proto, "_ready": False}

    def _prepare(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=self.proto)
        in_order = sorted(self.ranks.items(), key=lambda x: x[1])
        self.to_rank = np.array([r for _, r in in_order], dtype="<u4")
        top = in_order[-1][1] + 1
        self.lengths, self.starts = np.zeros(top, np.int64), np.zeros(top, np.int64)
        self.lengths[self.to_rank] = [len(raw) for raw, _ in in_order]
        self.bytes = np.frombuffer(b"".join(raw for raw, _ in in_order), np.uint8)
        self.starts[self.to_rank] = np.cumsum(self.lengths[self.to_rank]) - self.lengths[self.to_rank]
        self.known: dict[str, bytes] = {}
        self.held = 0
        self._ready = True

    def _merge(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens, each on its own."""
        raw = [t.encode() for t in tokens]
        ranks = [self.ranks.get(r) for r in raw]
        merged = self.model.encode([as_chars(r) for r, k in zip(raw, ranks, strict=True) if k is None], out_type=int, num_threads=1)
        flat = self.to_rank[np.fromiter(chain.from_iterable(merged), np.int64)].tobytes()
        ends = accumulate((4 * len(m) for m in merged), initial=0)
        rest = (flat[a:b] for a, b in pairwise(ends))
        return [next(rest) if k is None else struct.pack("<I", k) for k in ranks]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A space between two characters that are not white space starts a
        pre-token, so text is cut there into units first and each distinct
        unit is split and merged once; texts with other white space beside
        a space are one unit."""
        if not self._ready:
            self._prepare()
        known = self.known
        units = [[t] if _SPACE_RUN(t) else t.replace(" ", "\0 ").split("\0") if "\0" not in t else [t] for t in texts]
        new = list(set(chain.from_iterable(units)).difference(known))
        cut = [self.split(u) for u in new]
        tokens = list(set(chain.from_iterable(cut)))
        ids = dict(zip(tokens, self._merge(tokens), strict=True)).__getitem__
        known.update((u, b"".join(map(ids, c))) for u, c in zip(new, cut, strict=True))
        out = [b"".join(map(known.__getitem__, u)) for u in units]
        for u in new:  # long units, such as whole texts with runs of white space, aren't kept
            if len(u) > CACHE_LENGTH:
                del known[u]
            else:
                self.held += len(u) + len(known[u]) + CACHE_OVERHEAD
        if self.held > CACHE_BYTES:
            known.clear()
            self.held = 0
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of little-endian 32-bit ids (inverse mapping)."""
        if not self._ready:
            self._prepare()
        ranks = np.frombuffer(ids, dtype="<u4")
        lengths = self.lengths[ranks]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ranks] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.bytes[at].tobytes()


def encode_documents(docs: DataFrame, bpe: ByteBpe, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: token count, digest of the ids,
    digest and length of the decoded bytes, and with ``with_ids`` the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def rows(batches):
        coder = shared.value
        for whole in batches:
            for part in pieces(whole):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = coder.encode_all(texts)
                raw = [coder.decode(x) for x in ids]
                columns = [
                    part.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                    pa.array([len(x) for x in raw], pa.int64()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, dtype="<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ENCODE_SCHEMA + (", ids array<long>" if with_ids else "")
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(rows, schema)


def decode_documents(encoded: DataFrame, bpe: ByteBpe) -> DataFrame:
    """``(doc_id, ids)`` back to ``(doc_id, text)``; bytes that are not UTF-8
    (ids of a cut text) are replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)

    def rows(batches):
        coder = shared.value
        for b in batches:
            texts = [coder.decode(np.asarray(x or [], dtype="<u4").tobytes()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(encoded["doc_id"].cast("long"), "ids").mapInArrow(rows, "doc_id long, text string")
