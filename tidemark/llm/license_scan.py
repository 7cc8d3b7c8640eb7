"""License scans: patience alignment of whole texts with license templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

# Notices and opening sentences of well-known licenses.
TEMPLATES = {
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "BSD-notice": "Released under the BSD License.",
    "ISC-notice": "Released under the ISC License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}

# Words next to each other that tell a license from its relatives; without them its text counts as another's.
NAMING = {
    "GPL-3.0-notice": ["gnu general", "3"], "GPL-3.0": ["gnu general", "3"],
    "GPL-2.0-notice": ["gnu general", "2"], "GPL-2.0": ["gnu general", "2"],
    "LGPL-3.0-notice": ["gnu lesser general", "3"], "LGPL-3.0": ["gnu lesser general", "3"],
    "LGPL-2.1-notice": ["gnu lesser general", "2.1"], "LGPL-2.1": ["gnu lesser general", "2.1"],
    "AGPL-3.0-notice": ["gnu affero general", "3"], "AGPL-3.0": ["gnu affero general", "3"],
    "MPL-2.0-notice": ["mozilla public", "2"], "MPL-2.0": ["mozilla public", "2"],
    "Apache-2.0-notice": ["apache license", "2"], "Apache-2.0": ["apache license", "2"],
    "CC-BY-NC-4.0-notice": ["by-nc 4"], "CC-BY-4.0-notice": ["by 4"],
    "CC-BY-SA-4.0-notice": ["by-sa 4"], "CC-BY-NC-SA-4.0-notice": ["by-nc-sa 4"],
    "MIT-notice": ["mit"], "BSD-notice": ["bsd"], "ISC-notice": ["isc"],
}
#: Other templates of so few words must be there as a whole.
SHORT = 12

_WORD = re.compile(r"\w+(?:[.-]\w+)*")
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)?")
FOUND = "doc_id long, license string, coverage double, first_char long, last_char long, matched long, template_words long"


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words in lower case and their places. Case, punctuation and the form of a version do not tell licenses apart."""
    found = [(m.group().lower(), m.span()) for m in _WORD.finditer(text)]
    return [_plain(w) for w, _ in found], [s for _, s in found]


def _plain(word: str) -> str:
    """v2.0 and 2.0 are 2."""
    version = _VERSION.fullmatch(word) if word[-1].isdigit() else None
    return version.group(1) if version else word


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that rises on both sides; ``pairs`` come sorted by the first."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b), ends.append(k)
        else:
            tops[pile], ends[pile] = b, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of template words ``a`` in text words ``b``.

    Anchors are the words that occur once in ``a`` and once in ``b``; the
    longest rising chain of them stays, and each gap between anchors is aligned
    in the same way. Equal words next to an anchor are matched first. Gaps are
    kept on a stack, so long texts do not nest calls.
    """
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0] and (a0, b0) != (0, 0):
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1] and (a1, b1) != (len(a), len(b)):
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        mine = {w: k for k, w in enumerate(a[a0:a1], a0)}
        once = {w for w, n in Counter(a[a0:a1]).items() if n == 1}
        theirs: dict[str, int] = {}
        for k in range(b0, b1):
            if b[k] in once:
                theirs[b[k]] = -1 if b[k] in theirs else k
        chain = _rising(sorted((mine[w], k) for w, k in theirs.items() if k >= 0))
        for (x, y), (x1, y1) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)]):
            if chain and x1 > x + 1 and y1 > y + 1:
                todo.append((x + 1, x1, y + 1, y1))
        matched += chain
    return sorted(matched)


def _tightest(matched: list[tuple[int, int]], words: int, slack: float) -> tuple[int, int, int]:
    """(first, last, n): text words of the run of matches with most of them in a window of ``slack`` times the template."""
    best, start, width = (0, -1, 0), 0, max(4, int(words * slack))
    for end in range(len(matched)):
        while matched[end][1] - matched[start][1] >= width:
            start += 1
        if end - start + 1 > best[2]:
            best = (matched[start][1], matched[end][1], end - start + 1)
    return best


def _holds(matched: list[tuple[int, int]], template: list[str], phrases: list[list[str]]) -> bool:
    """Whether each phrase is matched, its words next to each other."""
    at = dict(matched)
    return all(
        any(
            template[k : k + len(p)] == p and all(k + t in at and at[k + t] == at[k] + t for t in range(len(p)))
            for k in range(len(template) - len(p) + 1) if k in at
        )
        for p in phrases
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = 0.8,
    slack: float = 1.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of ``docs`` and license it holds: coverage and place in the text.

    Coverage is the share of the template's words that are aligned within
    ``slack`` times its length; ``threshold`` of it counts as found, if the words
    that name the license are among them (``NAMING``; of other short templates,
    all words). An anchor
    repeated elsewhere would not be unique, so each stretch around a rare
    template word is aligned by itself where words repeat; stretches that hold
    several copies are cut to one. Null, empty and other texts without a license give no
    rows; repeated rows are scanned one by one; other columns are ignored.
    """
    known = {name: words_of(text)[0] for name, text in (TEMPLATES if templates is None else templates).items()}
    known = {name: words for name, words in known.items() if words}
    naming = {name: [p.split() for p in NAMING.get(name, [])] for name in known} if templates is None else {
        name: [[w] for w in words] if len(words) <= SHORT else [] for name, words in known.items()
    }
    # A template can only be covered by a text that holds most of its different words.
    needs = {name: (set(words), threshold * len(words)) for name, words in known.items()}
    every = set().union(*(words for words, _ in needs.values())) if needs else set()

    def found_in(words: list[str], name: str, slack: float) -> tuple[int, int, int]:
        template = known[name]
        size = len(template)
        best = (0, -1, 0)

        def tried(low: int, high: int) -> None:
            nonlocal best
            low = max(0, low)
            matched = align(template, words[low:high])
            first, last, n = _tightest(matched, size, slack)
            if n > best[2] and _holds([m for m in matched if first <= m[1] <= last], template, naming[name]):
                best = (low + first, low + last, n)

        tried(0, len(words))
        rare = min(template, key=lambda w: (words.count(w) or len(words) + 1))
        places = [at for at, word in enumerate(words) if word == rare]
        reach = int(size * (slack + 1))
        if len(places) > 1:
            for at in places:
                tried(at - reach, at + reach)
        # Copies close together leave no word unique in such a stretch: cut between neighbours, and to one copy's length.
        if best[2] < size:
            for before, at, after in zip([-1, *places], places, [*places[1:], len(words)]):
                tried(max(before + 1, at - reach), min(after, at + reach))
                for own in (k for k, word in enumerate(template) if word == rare):
                    tried(at - own, at - own + size)
        return best

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                if not text:
                    continue
                lower = text.lower()
                there = {w for w in every if w in lower}
                likely = [
                    name for name, (own, least) in needs.items()
                    if sum(w in there for w in known[name]) >= least and len(own & there) > 0
                ]
                if not likely:
                    continue
                words, spans = words_of(text)
                for name in likely:
                    first, last, n = found_in(words, name, slack)
                    if n and n / len(known[name]) >= threshold:
                        size = len(known[name])
                        out.append((doc, name, n / size, spans[first][0], spans[last][1], n, size))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")]).astype({"doc_id": "Int64"})

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.where(F.length("text") > 0).mapInPandas(look, FOUND)
