import random
import re

import pytest

from postlens.llm import license_scan, queries
from postlens.llm import licence_texts as T
from postlens.llm.common import alnum_words
from postlens.llm.license_scan import Automaton, Scanner
from postlens.llm.licence_texts import MIT, PHRASES, TEMPLATES

SCANNER = Scanner(PHRASES, TEMPLATES)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base_places(text):
    words = WORD.findall(lower(text))
    out = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), sorted(out)


def test_matching_statistics_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 5))]
        auto = Automaton(texts, [([b"a", b"b"], "ab")])
        doc = [rng.choice([b"a", b"b", b"c"]) for _ in range(40)]
        grams = {(*t[i:j],): k for k, t in enumerate([*texts, [b"a", b"b"]]) for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for i, (state, n) in enumerate(auto.statistics([auto.ids.get(w, -1) for w in doc])):
            longest = max((m for m in range(i + 2) if m == 0 or (*doc[i + 1 - m:i + 1],) in grams))
            assert n == longest
            if n:
                want = {(k, e) for k, t in enumerate(texts) for e in range(n - 1, len(t)) if t[e - n + 1:e + 1] == doc[i + 1 - n:i + 1]}
                assert set(auto.ends[state]) == want
            assert any(m <= n for m, _ in auto.phrases[state]) == (doc[max(0, i - 1):i + 1] == [b"a", b"b"])


def test_words_are_the_contract_words():
    text = "Ünder THE\tMIT-license_x 12é\x7f b\x00c"
    assert [w.decode() for w in alnum_words(text)] == WORD.findall(lower(text))


def test_spans():
    n, bases, spans, best = SCANNER.scan("x " * 20 + MIT.replace("merge, publish,", "merge, print, publish,") + " y" * 9)
    assert not bases and [s[0] for s in spans] == ["mit"] and 0.9 < best <= 1
    assert spans[0][1] == 20 and spans[0][2] == n - 9
    assert [s[0] for s in SCANNER.scan(f"{MIT} and then {MIT}")[2]] == ["mit", "mit"]
    assert SCANNER.scan("this work is licensed under the GNU General Public License, version 3.")[2][0][0] == "gpl"
    assert SCANNER.scan("the software is in the house of the person")[2] == []


def test_frames(spark):
    texts = ["Released under the MIT License.", None, "", "cc by nc cc by nc", "Licensed under the Apache License, Version 2.0.",
             "mit license", "under the mit license " * 3000, "UNDER THE MİT LICENSE"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, texts[3], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = license_scan.digest(license_scan.scan_documents(docs, SCANNER)).collect()
    assert len(out) == len(rows)
    for r in out:
        n, places = base_places(texts[3 if r.doc_id is None else r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan.digest(license_scan.scan_documents(docs.limit(0), SCANNER)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op2_license_scan(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n, places = base_places(d.text)
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(places), ",".join(sorted({p[1] for p in places})))
        if "GNU General Public License" in d.text:
            assert "gpl" in r.labels


def labels_of(text):
    from postlens.llm.licence_texts import SPDX
    scanner = license_scan.Scanner(T.PHRASES, T.TEMPLATES, identifiers=SPDX)
    return {s[0] for s in scanner.scan(text)[2]}


@pytest.mark.parametrize(("label", "text"), [
    ("cc-by-nd", T.CC_BY_ND_NOTICE), ("cc-by-nc-sa", T.CC_BY_NC_SA_NOTICE), ("cc-by-nc-nd", T.CC_BY_NC_ND_NOTICE), ("cc-by", T.CC_BY_NOTICE),
    ("cc-by-sa", T.CC_BY_SA_NOTICE), ("cc-by-nc", T.CC_BY_NC_NOTICE), ("lgpl", T.LGPL_NOTICE), ("lgpl", T.LGPL_PROGRAM_NOTICE), ("agpl", T.AGPL_NOTICE),
    ("gpl", T.GPL_NOTICE), ("gpl", T.GPL_TEXT), ("agpl", T.AGPL_TEXT), ("lgpl", T.LGPL_TEXT), ("apache-2", T.APACHE_TEXT), ("mit", T.MIT),
    ("cc-by-nc-sa", "text under CC BY-NC-SA 4.0, see there"), ("cc-by-sa", "text under CC BY-SA 4.0, see there")])
def test_relatives_are_told_apart(label, text):
    assert labels_of(text) == {label}
    assert labels_of(f"Some words before. {text} And some more after that.") == {label}
    changed = text.split()
    if len(changed) > 30:  # a word lost, a word put in
        del changed[9]
        changed.insert(20, "really")
        assert labels_of(" ".join(changed)) == {label}


def test_neighbouring_notices_all_count():
    assert labels_of(f"{T.GPL_NOTICE} {T.LGPL_NOTICE} {T.AGPL_NOTICE} {T.CC_BY_ND_NOTICE}") == {"gpl", "lgpl", "agpl", "cc-by-nd"}


@pytest.mark.parametrize(("line", "labels"), [
    ("// SPDX-License-Identifier: MIT", {"mit"}), ("# SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause", {"mit", "apache-2", "bsd-3-clause"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl"}), ("SPDX-License-Identifier: LGPL-2.1-only WITH Some-exception", {"lgpl"}),
    ("SPDX-License-Identifier: AGPL-3.0", {"agpl"}), ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", {"cc-by-nc-sa"}), ("SPDX-License-Identifier: Unknown-1.0", set()),
    ("SPDX-License-Identifier:", set()), ("the MIT or Apache 2.0 people", set())])
def test_spdx_lines(line, labels):
    assert labels_of(line) == labels
    assert labels_of(f"code before\n{line}\nimport os, sys and more code") == labels


def test_identifiers_are_no_base_phrases(spark):
    from postlens.llm.licence_texts import SPDX
    docs = spark.createDataFrame([(1, "SPDX-License-Identifier: MIT"), (2, "under the MIT license"), (3, T.LGPL_NOTICE)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.digest(license_scan.scan_documents(docs, license_scan.Scanner(T.PHRASES, T.TEMPLATES, identifiers=SPDX))).collect()}
    assert (got[1].n_base, got[1].base_labels, got[1].labels, got[1].score) == (0, "", "mit", 1.0)
    assert (got[2].n_base, got[2].base_labels, got[2].labels) == (1, "mit", "mit")
    assert (got[3].n_base, got[3].labels) == (0, "lgpl")
