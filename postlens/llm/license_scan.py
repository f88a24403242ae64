"""Licence scan by a generalised suffix automaton.

One automaton over the words of all templates and phrases. A text is
streamed through it: after each word the automaton knows the longest suffix
read so far that occurs in any template (the matching statistic) and where.
A base phrase stands wherever the statistic reaches its length and its state
is a suffix-link ancestor. Matches that cannot grow to the right and have at
least ``min_match`` words are chained per template while text and template
positions both advance, with at most ``max_gap`` words skipped on either
side. A chain's cover is its matched words over the template's words plus the
text's words skipped inside it, so missing and inserted words both count
against it; from ``min_cover`` on it is a span. Relatives (two notices that
differ in a word) all span such a place: of spans that overlap by more than
half of the shorter one, the one with the most words matched less words
missing and inserted stays and gives its template's label.

The words ``SPDX License Identifier``, found by the same automaton, are followed
by identifiers joined by or, and, with: each known one is a span with cover 1.

Cases: a null or empty text has no words, no label, score 0; repeated rows
give repeated results; an empty table gives an empty result; other columns
are ignored; equal spans go to the first label. Only words known to a
template leave the automaton's root, so cost follows the text's length; a
text that repeats a notice many times gives one chain after another. The
score is the largest covered share of a template, 1 with a base phrase.
Map-only: no shuffle; the automaton is a fixed table of the templates' size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import alnum_words, pieces

SCHEMA = ("doc_id long, n_words long, bases array<struct<label:string,start:long>>, "
          "spans array<struct<label:string,start:long,end:long,cover:double>>, best double")


class Automaton:
    """Generalised suffix automaton over word ids."""

    def __init__(self, templates: list[list[bytes]], phrases: list[tuple[list[bytes], str]]):
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link, self.ends = [0], [-1], [[]]
        self.template_words = [len(t) for t in templates]
        for k, words in enumerate([*templates, *(p for p, _ in phrases)]):
            at = 0
            for j, w in enumerate(words):
                at = self._extend(at, self.ids.setdefault(w, len(self.ids)))
                if k < len(templates):
                    self.ends[at].append((k, j))
        order = sorted(range(1, len(self.length)), key=lambda s: self.length[s])
        for s in reversed(order):  # a state's places include those of the longer strings that end in it
            self.ends[self.link[s]].extend(self.ends[s])
        self.ends = [tuple(sorted(set(e))) for e in self.ends]
        self.ends[0] = ()
        own: dict[int, list[tuple[int, str]]] = {}
        for words, label in phrases:
            at = 0
            for w in words:
                at = self.next[at][self.ids[w]]
            own.setdefault(at, []).append((len(words), label))
        self.phrases: list[tuple[tuple[int, str], ...]] = [()] * len(self.length)
        for s in order:
            self.phrases[s] = tuple(own.get(s, ())) + self.phrases[self.link[s]]

    def _clone(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.length.append(length)
        self.link.append(self.link[state])
        self.ends.append([])
        return len(self.length) - 1

    def _extend(self, at: int, word: int) -> int:
        found = self.next[at].get(word)
        if found is not None and self.length[found] == self.length[at] + 1:
            return found
        if found is not None:
            new = self._clone(found, self.length[at] + 1)
            self.link[found] = new
            self._redirect(at, word, found, new)
            return new
        self.next.append({})
        self.length.append(self.length[at] + 1)
        self.link.append(0)
        self.ends.append([])
        new = len(self.length) - 1
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            below = self.next[at][word]
            if self.length[below] == self.length[at] + 1:
                self.link[new] = below
            else:
                clone = self._clone(below, self.length[at] + 1)
                self.link[below] = self.link[new] = clone
                self._redirect(at, word, below, clone)
        return new

    def _redirect(self, at: int, word: int, old: int, new: int) -> None:
        while at != -1 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]

    def statistics(self, word_ids: list[int]):
        """(state, length) after each word."""
        state = length = 0
        for w in word_ids:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                length += 1
            yield state, length


#: Label of the phrase that announces identifiers; it is no base phrase.
_ANNOUNCED = "\0spdx"
_JOINED = (b"or", b"and", b"with")


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: tuple[tuple[str, str], ...], min_match: int = 4, max_gap: int = 6,
                 min_cover: float = 0.6, identifiers: dict[str, str] | None = None):
        self.labels = [label for label, _ in templates]
        split = [(alnum_words(p), label) for p, label in phrases.items()]
        self.identifiers = {tuple(alnum_words(i)): label for i, label in (identifiers or {}).items()}
        self.longest = max(map(len, self.identifiers), default=0)
        if self.identifiers:
            split.append(([b"spdx", b"license", b"identifier"], _ANNOUNCED))
        self.automaton = Automaton([alnum_words(t) for _, t in templates], split)
        self.shortest = min([len(p) for p, _ in split] + [min_match])
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover

    def scan(self, text: str | None):
        """(number of words, [(label, start)] of phrases, [(label, start,
        end, cover)] of chained spans, largest cover of any chain)."""
        words = alnum_words(text)
        get = self.automaton.ids.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        bases: list[tuple[str, int]] = []
        announced: list[int] = []
        matches: list[tuple[int, int, int]] = []  # (first word, words, state)
        for a, b in known.reshape(-1, 2).tolist():
            if b - a < self.shortest:
                continue
            before = (0, 0)
            for i, now in enumerate(self.automaton.statistics(ids[a:b].tolist()), a):
                if now[1] <= before[1] and before[1] >= self.min_match:
                    matches.append((i - before[1], before[1], before[0]))
                for n, label in self.automaton.phrases[now[0]]:
                    if now[1] >= n and label == _ANNOUNCED:
                        announced.append(i + 1)
                    elif now[1] >= n:
                        bases.append((label, i - n + 1))
                before = now
            if before[1] >= self.min_match:
                matches.append((b - before[1], before[1], before[0]))
        spans, best = self._chains(matches)
        named = [found for at in announced for found in self._identified(words, at)]
        return len(words), bases, sorted([*spans, *named], key=lambda s: s[1:3]), 1.0 if named else best

    def _identified(self, words: list[bytes], at: int):
        """Spans of the identifiers that begin at a word; the longest known one each."""
        while True:
            n = next((n for n in range(min(self.longest, len(words) - at), 0, -1) if (*words[at:at + n],) in self.identifiers), 0)
            if not n:
                return
            yield self.identifiers[(*words[at:at + n],)], at, at + n, 1.0
            at += n
            if at >= len(words) or words[at] not in _JOINED:
                return
            at += 1

    def _chains(self, matches: list[tuple[int, int, int]]):
        open_: dict[int, list[int]] = {}  # template: [text start, text end, template end, covered, inserted]
        found: list[tuple[int, str, int, int, float]] = []  # with words matched less words missing and inserted
        best = 0.0

        def close(k: int) -> None:
            nonlocal best
            start, end, _, covered, inserted = open_.pop(k)
            whole = self.automaton.template_words[k]
            cover = covered / (whole + inserted)
            best = max(best, cover)
            if cover >= self.min_cover:
                found.append((2 * covered - whole - inserted, self.labels[k], start, end, cover))

        for start, n, state in matches:
            places: dict[int, list[int]] = {}
            for k, end in self.automaton.ends[state]:
                places.setdefault(k, []).append(end + 1)
            for k, ends in places.items():
                if k in open_:
                    chain = open_[k]
                    # the nearest place that goes on with the chain; what overlaps it counts once
                    gap = start - chain[1]
                    fits = [e for e in ends if e > chain[2] and e - n - chain[2] <= self.max_gap and abs(e - n - chain[2] - gap) <= self.max_gap]
                    if fits and start + n > chain[1] and gap <= self.max_gap:
                        end = min(fits)
                        chain[3] += min(n, end - chain[2], start + n - chain[1])
                        chain[4] += max(0, gap)
                        chain[1], chain[2] = start + n, end
                        continue
                    if gap < 0 and n <= chain[3]:  # a shorter match elsewhere inside the chain
                        continue
                    close(k)
                open_[k] = [start, start + n, min(ends), n, 0]
        for k in list(open_):
            close(k)
        return _told_apart(found), best


def _told_apart(found: list[tuple[int, str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Of spans that overlap by more than half of the shorter one the best,
    in order of the text."""
    groups: list[list[tuple[str, int, int, float]]] = []
    # spans that can overlap lie near each other, so each run of touching spans is settled on its own
    reach = -1
    for x in sorted(found, key=lambda f: f[2:4]):
        if x[2] >= reach:
            groups.append([])
        groups[-1].append(x)
        reach = max(reach, x[3])
    spans = []
    for run in groups:
        kept: list[tuple[int, str, int, int, float]] = []
        for x in sorted(run, key=lambda f: (-f[0], -f[4], f[1], f[2])):
            if all(2 * (min(x[3], y[3]) - max(x[2], y[2])) <= min(x[3] - x[2], y[3] - y[2]) for y in kept):
                kept.append(x)
        spans += [x[1:] for x in kept]
    return sorted(spans, key=lambda s: s[1:3])


def scan_documents(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """Per document: its words, places of base phrases, covered spans."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)  # size of the templates

    def rows(batches):
        scan = shared.value.scan
        for whole in batches:
            for part in pieces(whole):
                got = [scan(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([g[0] for g in got], pa.int64()),
                    pa.array([[{"label": a, "start": b} for a, b in g[1]] for g in got],
                             pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
                    pa.array([[{"label": a, "start": b, "end": c, "cover": d} for a, b, c, d in g[2]] for g in got],
                             pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))),
                    pa.array([g[3] for g in got], pa.float64()),
                ], names=["doc_id", "n_words", "bases", "spans", "best"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(rows, SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document with counts and comma-joined labels."""
    base, more = F.col("bases.label"), F.col("spans.label")
    found = F.size("bases") > 0
    return scanned.select(
        "doc_id", "n_words", F.size("bases").cast("long").alias("n_base"),
        F.array_min("bases.start").alias("first_word"), F.array_max("bases.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(found, F.lit(1.0)).otherwise(F.col("best")).alias("score"),
        F.size("spans").cast("long").alias("n_spans"))
