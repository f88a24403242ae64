import hashlib
import random

import numpy as np
import pytest

from postlens.llm import chat_format as C
from postlens.llm import queries


@pytest.fixture(scope="module")
def formatter():
    with open(queries.CHAT_TOKENIZER_PATH) as f:
        return C.Formatter(f.read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0, role is not None, (role or "").encode(), text is not None, (text or "").encode()), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[0])
        loss = "".join(t for _, r, t in turns if r == "assistant")
        plain = sum(len(C.escape(r)) + len(C.escape(t)) + len("<turn><text></turn>") for _, r, t in turns)
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), plain)
    return out


def check(frame, rows):
    got = frame.collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice(["\\", "<", "l", "</turn>", "<text>", "\\l", "é", "\n"]) for _ in range(rng.randrange(12)))
        assert C.unescape(C.escape(t)) == t and "<" not in C.escape(t)


def test_mask_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        cuts = np.unique(rng.integers(0, 60, 14))
        offsets = np.stack([cuts[:-1], cuts[1:]], axis=1)
        marks = np.unique(rng.integers(0, 60, 8))
        spans = marks[: len(marks) // 2 * 2].reshape(-1, 2)
        want = [any(a < t and s < b for s, t in spans) for a, b in offsets]
        assert C.token_mask(offsets, spans).tolist() == want


def test_pieces_equal_the_whole(formatter):
    turns = [("user", " hi\n"), ("assistant", "  <b>😀</turn> \n"), ("assistant", ""), ("assistant", "\nx "), ("user", "\\")]
    whole = formatter.encode(C.render(turns)[0])[0].tolist()
    assert whole == [i for t in turns for i in formatter.encode(C.render([t])[0])[0].tolist()]
    formatted, _, offsets, mask = formatter.format(turns)
    assert C.masked_texts(formatted, offsets, mask) == ["  <b>😀</turn> \n", "\nx "]


@pytest.mark.parametrize("piece", [C.PIECE_CHARS, 1])
def test_cases(spark, formatter, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE_CHARS", piece)
    rng = random.Random(2)
    rows = []
    for conv in [None, 0, 5, -3, 10**12]:
        for turn in range(rng.randrange(1, 9)):
            text = rng.choice([None, "", "a b", " x\n", "### Assistant:", "</turn>", "<turn>assistant<text>", "\\l", "é" * 3000])
            rows.append((conv, rng.choice([None, turn, 1]), rng.choice(["user", "assistant", "assistant", "system", None, "<text>"]), text))
    rows += rows[:2]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, n_turns string")
    check(C.conversations_digest(frame, formatter), rows)
    assert C.conversations_digest(frame.limit(0), formatter).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    check(queries.op10_chat_format(spark, sf), rows + queries.EXTRA_CONVERSATION)
