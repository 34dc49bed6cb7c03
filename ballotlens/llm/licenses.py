"""License notices found by conditional compression.

Templates are short notices, identifiers, titles and the sentences of full
texts, in all their versions; a full text is found sentence by sentence.
Candidate blocks are the surroundings of the words that every template has one
of. A block is compressed alone and with each template as a raw zstandard
dictionary (but for templates of which it lacks a key word: those could not be
confirmed); the bytes saved, by the template's own compressed size, rank the
templates. Those that explain ``LEAST_SAVED`` or more are confirmed by their
exact wording: the template is aligned with the words of the block (edits
anywhere, free ends), at most a fifth of its words may differ, and its key
words (numbers and capitalised names) must all be there. Of confirmed
templates that overlap, the one with fewer differences by length stays, then
the one that saves more, then the longer.

Offsets are code points, ends are exclusive. Of an identifier expression (A OR
B) the first one is found. Defined cases: a null or empty
text has no notices; repeated rows each return theirs, a null doc_id is kept;
an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ballotlens.llm import common as C

# fixed values: licence identifiers and notices
NOTICES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation, either version "
                         "3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# fixed values: titles and sentences of full texts (the terms that two licences share carry both names)
PASSAGES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the license is "
                   "distributed on an \"as is\" basis, without warranties or conditions of any kind, either express or implied."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause OR BSD-3-Clause", "Redistributions of source code must retain the above copyright notice, this list of "
                                     "conditions and the following disclaimer."),
    ("BSD-2-Clause OR BSD-3-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of "
                                     "conditions and the following disclaimer in the documentation and/or other materials "
                                     "provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "The software is provided \"as is\" and the author disclaims all warranties with regard to this software "
            "including all implied warranties of merchantability and fitness."),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software."),
    ("MIT", "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
            "to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty."),
)
# fixed values: identifiers written after "SPDX-License-Identifier:"
_IDENTIFIERS = ("AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0",
                "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
                "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT",
                "MPL-2.0", "Unlicense", "Zlib")
# fixed values: conditions and versions of the Creative Commons licences, versions of the GNU licences
_CC_TERMS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
             "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
             "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
_GNU = (("AGPL-3.0", "Affero General", "3"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"),
        ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"))


def _versions() -> list[tuple[str, str]]:
    """Notices of all versions and conditions, built by rule."""
    found = [(i, f"SPDX-License-Identifier: {i}") for i in _IDENTIFIERS]
    for version, reach in _CC_VERSIONS.items():
        for short, terms in _CC_TERMS.items():
            name = f"CC-{short}-{version}"
            found += [(name, f"Licensed under CC {short} {version}."),
                      (name, f"This work is licensed under a Creative Commons {terms} {version} {reach} License.")]
    for name, kind, version in _GNU:
        terms = f"under the terms of the GNU {kind} Public License as published by the Free Software Foundation"
        found += [(name, f"This work is licensed under the GNU {kind} Public License, version {version}."),
                  (f"{name}-or-later", f"This program is free software: you can redistribute it and/or modify it {terms}, either "
                                       f"version {version} of the License, or (at your option) any later version.")]
    return found


TEMPLATES = NOTICES + PASSAGES                                              # as written above
VERSIONS = tuple(t for t in _versions() if t not in TEMPLATES)
ALL = TEMPLATES + VERSIONS                                                  # a template's number is its place here
# fixed values: each template has one of these
ANCHORS = ("licens", "licenc", "permission", "permitted", "redistribut", "copyright", "public domain", "warrant")

LEAST_SAVED = 0.2
MOST_DIFFERENT = 0.2
LEVEL = 3
_WORD = re.compile(r"[^\W_]+")
_ANCHOR = re.compile("|".join(a.replace(" ", r"[\W_]+") for a in ANCHORS))     # words apart as in _WORD
_REACH = max(len(t) for _, t in ALL) + 60
_BLOCK = 8 * _REACH


def _plain(word: str) -> str:
    return word.lower().replace("licence", "license")


def _words(text: str) -> list[tuple[str, int, int]]:
    return [(_plain(m.group()), m.start(), m.end()) for m in _WORD.finditer(text)]


def key_words(template: str) -> list[bool]:
    """Which words of a template must be there: numbers, and capitalised words but the first."""
    found = [m.group() for m in _WORD.finditer(template)]
    return [any(c.isdigit() for c in w) or (i > 0 and w[0].isupper()) for i, w in enumerate(found)]


WORDS = [[_plain(w) for w in _WORD.findall(t)] for _, t in ALL]
KEYS = [key_words(t) for _, t in ALL]
MUST = [frozenset(w for w, k in zip(words, keys) if k) for words, keys in zip(WORDS, KEYS)]


def blocks(text: str) -> list[tuple[int, int]]:
    """Merged surroundings of the anchor words. Long ones are cut into pieces
    that overlap by more than the longest notice."""
    lowered = text.lower()
    if len(lowered) != len(text):           # a few letters grow in lower case: keep offsets
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    spans: list[list[int]] = []
    for m in _ANCHOR.finditer(lowered):
        a, b = max(0, m.start() - _REACH), min(len(text), m.end() + _REACH)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    out = []
    for a, b in spans:
        while b - a > _BLOCK:
            out.append((a, a + _BLOCK))
            a += _BLOCK - 2 * _REACH
        out.append((a, b))
    return out


class Compressor:
    """Sizes of texts compressed alone and with templates as raw dictionaries."""

    def __init__(self):
        import zstandard as z
        dictionaries = [z.ZstdCompressionDict(t.lower().encode(), dict_type=z.DICT_TYPE_RAWCONTENT) for _, t in ALL]
        make = lambda **k: z.ZstdCompressor(level=LEVEL, write_content_size=False, **k)
        self.alone, self.given = make(), [make(dict_data=d) for d in dictionaries]
        empty = len(self.alone.compress(b""))
        self.own = [len(self.alone.compress(t.lower().encode())) - empty for _, t in ALL]

    def saved(self, block: str, among: list[int]) -> dict[int, float]:
        """For each template of ``among`` the share of its own size by which it shortens the block."""
        data = block.lower().encode()
        plain = len(self.alone.compress(data))
        return {i: (plain - len(self.given[i].compress(data))) / self.own[i] for i in among}


def align(template: list[str], key: list[bool], block: list[str], used: list[bool]) -> tuple[int, int, int] | None:
    """(differences, first, last + 1) of the best place among the block's words
    (edits of single words, free ends) that has all key words of the template;
    None if there is no such place. Used words match nothing."""
    m, never = len(block), len(template) + len(block) + 1
    cost, back = [[0] * (m + 1)], []
    for i, w in enumerate(template):
        miss = never if key[i] else 1
        row, from_ = [cost[-1][0] + miss], [2]
        for j in range(m):
            same = cost[-1][j] + (0 if block[j] == w and not used[j] else miss)
            drop, extra = cost[-1][j + 1] + miss, row[j] + 1
            best = min(same, drop, extra)
            row.append(best)
            from_.append(1 if best == same else 2 if best == drop else 3)
        cost.append(row)
        back.append(from_)
    j = min(range(m + 1), key=lambda k: cost[-1][k])
    end, i = j, len(template)
    while i > 0:
        step = back[i - 1][j]
        if step == 1:
            i, j = i - 1, j - 1
        elif step == 2:
            i -= 1
        else:
            j -= 1
    return (cost[-1][end], j, end) if cost[-1][end] < never and end > j else None


def find_notices(text: str, compressor: Compressor) -> list[dict]:
    out: dict[tuple[int, int], dict] = {}
    for a, b in blocks(text):
        words = _words(text[a:b])
        plain, used = [w for w, _, _ in words], [False] * len(words)
        there = set(plain)
        possible = [i for i, must in enumerate(MUST) if must <= there]
        if not possible:
            continue
        saved = compressor.saved(text[a:b], possible)
        ranked = sorted((i for i in possible if saved[i] >= LEAST_SAVED), key=lambda i: (-saved[i], i))
        while ranked:
            best = None
            for i in list(ranked):
                template = WORDS[i]
                found = align(template, KEYS[i], plain, used)
                if found is None or found[0] > MOST_DIFFERENT * len(template):
                    ranked.remove(i)        # no further place either
                    continue
                rank = (found[0] / len(template), -saved[i], -len(template), i)
                if best is None or rank < best[0]:
                    best = (rank, i, found, len(template))
            if best is None:
                break
            _, i, (differences, first, last), size = best
            used[first:last] = [True] * (last - first)
            span = (a + words[first][1], a + words[last - 1][2])
            out.setdefault(span, {"license_id": ALL[i][0], "template": i, "start": span[0], "end": span[1],
                                  "n_words": size, "n_differences": differences, "saved": saved[i]})
    found = sorted(out.values(), key=lambda r: (r["n_differences"] / r["n_words"], -r["n_words"], r["start"]))
    kept: list[dict] = []
    for r in found:                         # pieces of one block overlap: no text counts twice
        if all(r["end"] <= k["start"] or r["start"] >= k["end"] for k in kept):
            kept.append(r)
    return sorted(kept, key=lambda r: r["start"])


_FIELDS = (("doc_id", pa.int64(), "long"), ("license_id", pa.string(), "string"), ("template", pa.int32(), "int"),
           ("start", pa.int64(), "long"), ("end", pa.int64(), "long"), ("n_words", pa.int64(), "long"),
           ("n_differences", pa.int64(), "long"), ("saved", pa.float64(), "double"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor, schema = Compressor(), pa.schema([(n, k) for n, k, _ in _FIELDS])
    for part in C.text_slices(batches, "text"):
        rows = []
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            if text and _has_anchor(text):
                rows += [{"doc_id": doc_id, **r} for r in find_notices(text, compressor)]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _has_anchor(text: str) -> bool:
    return _ANCHOR.search(text.lower()) is not None


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per notice: doc_id, license_id, template number, start, end,
    words of the template, words that differ, share saved."""
    return C.id_text(docs, id_col, text_col).mapInArrow(_scan, ", ".join(f"`{n}` {k}" for n, _, k in _FIELDS))
