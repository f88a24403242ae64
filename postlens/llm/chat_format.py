"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<turn>role<text>text</turn>`` per row, in
order of turn. Inside roles and texts a backslash becomes ``\\\\\\\\`` and ``<``
becomes ``\\\\l``, so no mark can occur there, and reading back is exact. The
marks are single tokens that never merge with what stands beside them. The
rendering is encoded once with offsets; the sorted spans of assistant texts
are intersected with the token spans by binary search, which gives the loss
mask. Everything returned is read back from the rendering and the mask.

Rows of a conversation are brought together and sorted by Spark; a task holds
one piece of a conversation at a time (whole turns, about ``PIECE_CHARS``
characters; encoding a piece equals encoding it inside the whole, because a
piece starts and ends at marks), so a conversation of any length streams.

Cases: a null text or role is empty; a null turn comes first; equal turns are
ordered by role, then text; repeated rows are repeated turns; a null conv_id
is a conversation of its own; an empty table gives an empty result; other
columns are ignored. Only the role ``assistant`` is learned.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

TURN, TEXT, END = "<turn>", "<text>", "</turn>"
LEARNED = "assistant"
PIECE_CHARS = 1 << 20
SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "n_tokens long, loss_tokens long")

_PARSE = re.compile(f"{TURN}([^<]*){TEXT}([^<]*){END}", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, list[str]]:
    """The formatted text, (start, end) of every turn's escaped text, roles."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{END}")
        at += len(out[-1])
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2), [r for r, _ in turns]


def token_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens whose span meets one of the sorted, disjoint, non-empty spans."""
    if not len(spans):
        return np.zeros(len(offsets), bool)
    after = np.searchsorted(spans[:, 0], offsets[:, 1], "left") - 1   # last span that starts before the token's end
    return (after >= 0) & (spans[np.maximum(after, 0), 1] > offsets[:, 0])


@dataclass
class Formatter:
    """A tokenizer of the ``tokenizers`` library (as its JSON text) and the marks."""

    tokenizer_json: str

    def __post_init__(self):
        self._tokenizer = None

    def __getstate__(self):
        return {"tokenizer_json": self.tokenizer_json}

    def __setstate__(self, state):
        self.tokenizer_json, self._tokenizer = state["tokenizer_json"], None

    def encode(self, formatted: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and (start, end) offsets in code points."""
        if self._tokenizer is None:
            t = Tokenizer.from_str(self.tokenizer_json)
            t.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, TEXT, END)])
            self._tokenizer = t
        got = self._tokenizer.encode(formatted, add_special_tokens=False)
        return np.array(got.ids, np.int64), np.array(got.offsets, np.int64).reshape(-1, 2)

    def format(self, turns: list[tuple[str, str]]):
        """(formatted text, ids, offsets, loss mask) of whole turns."""
        formatted, spans, roles = render(turns)
        ids, offsets = self.encode(formatted)
        learned = spans[[r == LEARNED for r in roles]].reshape(-1, 2)
        return formatted, ids, offsets, token_mask(offsets, learned[learned[:, 1] > learned[:, 0]])


def masked_texts(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """Unescaped runs of text under the mask."""
    picked = offsets[mask]
    if not len(picked):
        return []
    reach = np.maximum.accumulate(picked[:, 1])
    new = np.flatnonzero(np.concatenate(([True], picked[1:, 0] > reach[:-1])))
    ends = reach[np.append(new[1:] - 1, len(reach) - 1)]
    return [unescape(formatted[a:b]) for a, b in zip(picked[new, 0].tolist(), ends.tolist(), strict=True)]


def conversations_digest(conversations: DataFrame, formatter: Formatter) -> DataFrame:
    """One row per conversation, read back from its formatted pieces."""
    shared = conversations.sparkSession.sparkContext.broadcast(formatter)  # a tokenizer's vocabulary

    def rows(batches):
        state, turns, size, out = None, [], 0, []

        def piece():
            nonlocal turns, size
            formatted, ids, offsets, mask = shared.value.format(turns)
            for role, text in _PARSE.findall(formatted):
                state["n_turns"] += 1
                state["turns"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            for text in masked_texts(formatted, offsets, mask):
                state["loss_chars"] += len(text)
                state["loss"].update(text.encode())
            state["formatted_chars"] += len(formatted)
            state["n_tokens"] += len(ids)
            state["loss_tokens"] += int(mask.sum())
            turns, size = [], 0

        def finish():
            piece()
            out.append((state["id"], state["n_turns"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(),
                        state["formatted_chars"], state["n_tokens"], state["loss_tokens"]))

        def block():
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)

        for b in batches:
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if state is None or conv != state["id"]:
                    if state is not None:
                        finish()
                    state = {"id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(),
                             "formatted_chars": 0, "n_tokens": 0, "loss_tokens": 0}
                turns.append((role or "", text or ""))
                size += len(role or "") + len(text or "")
                if size >= PIECE_CHARS:
                    piece()
            if out:
                yield block()
                out = []
        if state is not None:
            finish()
            yield block()

    c = conversations.select(F.col("conv_id").cast("long"), F.col("turn"), F.col("role").cast("string"), F.col("text").cast("string"))
    return (c.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
            .select("conv_id", "role", "text").mapInArrow(rows, SCHEMA))
