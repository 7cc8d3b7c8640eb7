"""License scans: alignment against brute force, notices in noise."""

from __future__ import annotations

import random

from tests.llm.conftest import SF_DIR, prose
from tidemark.llm.license_scan import TEMPLATES, _rising, align, scan


def test_longest_rising_chain():
    draw = random.Random(0)
    for _ in range(200):
        values = draw.sample(range(30), draw.randint(0, 9))
        pairs = list(enumerate(values))
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max([best[j] for j in range(i) if values[j] < values[i]], default=0)
        chain = _rising(pairs)
        assert len(chain) == max(best, default=0)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chain, chain[1:]))


def test_alignment_is_a_rising_match():
    draw = random.Random(1)
    for _ in range(300):
        a, b = ([draw.choice("abcdefghij") for _ in range(draw.randint(0, 14))] for _ in range(2))
        found = align(a, b)
        assert all(a[x] == b[y] for x, y in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
    same = list("abcabcxyz")
    assert len(align(same, ["q", *same, "r"])) == len(same)


def test_notices_in_noise(spark, hard, nothing):
    texts = []
    for k, (name, text) in enumerate(TEMPLATES.items()):
        texts += [(3 * k, f"{prose(k, 300)}\n{text}\n{prose(k + 50, 300)}"), (3 * k + 1, text.upper().replace(" ", "\n  * "))]
        texts.append((3 * k + 2, text + " " + prose(k, 50) + " the under license version " + text))
    rows = scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license): r for r in rows}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        assert all((3 * k + j, name) in got for j in range(3)), name
        row = got[3 * k, name]
        assert texts[3 * k][1][row.first_char : row.last_char].lower().strip('."') in text.lower() and row.coverage == 1
    assert scan(hard).count() == scan(nothing).count() == 0
    assert scan(hard, templates={}).count() == 0


def test_missing_words_lower_the_coverage(spark):
    words = TEMPLATES["BSD"].split()
    most, few = " ".join(w for k, w in enumerate(words) if k % 8), " ".join(w for k, w in enumerate(words) if k % 3)
    rows = scan(spark.createDataFrame([(1, most), (2, few)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(1, "BSD")] and 0.8 <= rows[0].coverage < 1


def test_adjacent_copies_are_found(spark):
    texts = [(2 * k + j - 2, " ".join([text] * j)) for k, text in enumerate(TEMPLATES.values()) for j in (2, 3)]
    rows = scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.license): r for r in rows}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        assert all(got[2 * k + j - 2, name].coverage == 1 for j in (2, 3)), name


def test_relatives_are_told_apart(spark):
    gnu = "This work is licensed under the GNU {} Public License, version {}."
    texts = {
        "Released under the BSD License.": "BSD-notice", "Released under the XYZ License.": None,
        "Licensed under the MIT License.": "MIT-notice", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0-notice",
        "Licensed under CC BY 4.0.": "CC-BY-4.0-notice", "Licensed under CC BY-NC 3.0.": None,
        gnu.format("General", 2): "GPL-2.0-notice", gnu.format("Lesser General", "3.0"): "LGPL-3.0-notice",
        gnu.format("Library General", 2): None, "Licensed under the Apache License, Version 1.1.": None,
        "Licensed under the Apache License v2.0.": "Apache-2.0-notice",
        TEMPLATES["GPL-3.0"] + " " + TEMPLATES["LGPL-3.0"]: "GPL-3.0,LGPL-3.0", TEMPLATES["AGPL-3.0"]: "AGPL-3.0",
    }
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for k, (text, want) in enumerate(texts.items()):
        assert ",".join(sorted(r.license for r in rows if r.doc_id == k)) == (want or ""), text
    own = scan(spark.createDataFrame([(1, "made by the new people"), (2, "made by the old people")], "doc_id long, text string"), {"own": "Made by the old people"})
    assert [r.doc_id for r in own.collect()] == [2]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    found = {(r.doc_id, r.license) for r in scan(docs).collect()}
    want = {(r.doc_id, n) for r in docs.collect() for n, t in TEMPLATES.items() if t.lower() in (r.text or "").lower()}
    assert want <= found and len(found) <= len(want) + 2
