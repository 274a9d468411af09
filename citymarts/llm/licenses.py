"""License scan by conditional compression.

Blocks that hold a license word (lines; the surroundings of the word in a long
line; runs of neighbouring lines; then, for words outside of the notices found
there, the surroundings over as many lines as the longest template can be
wrapped to, without a least size reduction) are compressed with zstandard, once alone
and once with each template as raw dictionary. Templates are ranked by how
much the dictionary shrinks the block. A winner is confirmed by its wording:
the template's words are aligned with the block's, and it counts only if
nearly all of them are there in order and no number, negation or name of a
license differs; the differences are reported. Confirmed words are taken out
and the rest of the block is tried again, so a block can hold several notices.
Blocks longer than ``_SPAN`` words are taken in parts that overlap by more than the
longest notice, so the work grows with the text. A notice that the words before
it in its sentence negate ("not licensed under ...") does not count. Of an SPDX
expression with several licenses the first is found.

Defined results: NULL and empty texts have no findings; a NULL id is kept;
repeated rows give repeated findings; an empty table gives an empty result.
Positions are code points of the whole text, end exclusive. Other columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

#: Notices by license, as commonly worded.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation, either "
                         "version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("BSD", "Licensed under the BSD License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation; either "
                         "version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of "
                          "the GNU Lesser General Public License as published by the Free Software Foundation; either "
                          "version 2.1 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                        "International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]
#: Identifiers that stand behind "SPDX-License-Identifier:".
SPDX = ["MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0",
        "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC-BY-4.0",
        "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CC0-1.0", "Unlicense"]
TEMPLATES += [(name.removesuffix("-only"), f"SPDX-License-Identifier: {name}") for name in SPDX]
#: How a license binds its user.
CATEGORY = {"MIT": "permissive", "Apache-2.0": "permissive", "BSD": "permissive", "BSD-2-Clause": "permissive",
            "BSD-3-Clause": "permissive", "ISC": "permissive",
            "CC-BY-4.0": "permissive", "CC0-1.0": "public domain", "Unlicense": "public domain",
            "CC-BY-NC-4.0": "restricted", "CC-BY-ND-4.0": "restricted",
            "CC-BY-NC-SA-4.0": "restricted", "CC-BY-NC-ND-4.0": "restricted", "Proprietary": "restricted"}
CUE = r"(?i)licen[sc]|rights\W+reserved|redistribut|public\W+domain|hereby\W+granted|CC[ -]?BY|CC0|unencumbered"
#: Words that may not differ: they tell one license from another.
TELLING = {"not", "no", "never", "nor", "cannot", "isn", "wasn", "aren", "weren", "mit", "apache", "gnu", "general", "lesser", "affero", "mozilla", "bsd", "cc", "by", "sa",
           "nc", "nd", "cc0", "attribution", "creative", "commons", "public", "reserved", "without", "later",
           "sharealike", "noncommercial", "noderivatives", "noderivs", "eclipse", "clause", "only", "spdx", "identifier", "unlicense",
           "gpl", "lgpl", "agpl", "mpl", "epl", "isc"}
#: Spellings that count as one.
SPELLING = {"licence": "license", "licences": "licenses", "licenced": "licensed"}
NEGATION = re.compile(r"(?i)(?:\b(?:not|never|nor|cannot|no\s+longer)\b|n['\u2019]t\b)\W*(?:\w+\W+){0,2}$")
SENTENCE = re.compile(r"[.!?;]\s|\n\s*\n")
AROUND = 40          # words kept on either side of a license word in a line longer than twice that
LEAST_REDUCTION = 0.25
LEAST_WORDING = 0.85
SCHEMA = ("id {}, start int, end int, license string, category string, reduction double, wording double, "
          "missing string, extra string")

_WORD = re.compile(r"\w+(?:\.\d+)*")
_CUE = re.compile(CUE)


def _words(text: str) -> list[tuple[str, int, int]]:
    found = ((m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text))
    return [(SPELLING.get(w, w), a, b) for w, a, b in found]


_TEMPLATE_WORDS = [[w for w, _, _ in _words(t)] for _, t in TEMPLATES]
_REACH = max(AROUND, max(map(len, _TEMPLATE_WORDS)) * 6 // 5)  # with the extra words that confirm() allows
_SPAN = 4 * _REACH   # words scanned at a time


@lru_cache(1)
def _compressors() -> tuple[zstandard.ZstdCompressor, list[zstandard.ZstdCompressor]]:
    bare = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    with_template = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(
        " ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **bare) for w in _TEMPLATE_WORDS]
    return zstandard.ZstdCompressor(**bare), with_template


def reductions(words: list[str]) -> list[tuple[float, int]]:
    """(share of the compressed size saved, template), best first."""
    data = " ".join(words).encode()
    alone, given = _compressors()
    size = len(alone.compress(data))
    return sorted(((1 - len(c.compress(data)) / size, i) for i, c in enumerate(given)), key=lambda r: (-r[0], r[1]))


def confirm(words: list[str], template: int) -> tuple[float, int, int, list[str], list[str]] | None:
    """(share of the template's words found, first word, last word, missing, extra) or None."""
    want = _TEMPLATE_WORDS[template]
    tells = lambda w: w in TELLING or w[0].isdigit()
    known = set(words)
    absent = [w for w in want if w not in known]
    if 1 - len(absent) / len(want) < LEAST_WORDING or any(map(tells, absent)):
        return None
    # words farther from the longest common run than the template reaches are another text's
    run = SequenceMatcher(None, want, words, autojunk=False).find_longest_match()
    slack = max(1, len(want) // 5)
    skip = max(0, run.b - run.a - slack)
    near = words[skip:run.b + len(want) - run.a + slack]
    parts = SequenceMatcher(None, want, near, autojunk=False).get_matching_blocks()[:-1]
    parts = [p._replace(b=p.b + skip) for p in parts]
    first, last = parts[0].b, parts[-1].b + parts[-1].size
    found = {i for p in parts for i in range(p.a, p.a + p.size)}
    used = {i for p in parts for i in range(p.b, p.b + p.size)}
    missing = [w for i, w in enumerate(want) if i not in found]
    extra = [words[i] for i in range(first, last) if i not in used]
    share = len(found) / len(want)
    if share < LEAST_WORDING or len(extra) > max(1, len(want) // 5) or any(map(tells, [*missing, *extra])):
        return None
    return share, first, last, missing, extra


@lru_cache(20_000)
def _scan_part(words: tuple[str, ...], gated: bool = True) -> list[tuple]:
    """Findings in at most ``_SPAN`` words: (first word, last word, template, reduction, share, missing, extra)."""
    out, todo = [], [(0, [*words])]
    while todo:
        at, left = todo.pop()
        for gain, template in reductions(left) if left else []:
            if gated and gain < LEAST_REDUCTION and len(left) <= 3 * len(_TEMPLATE_WORDS[template]):
                break
            if hit := confirm(left, template):
                share, first, last, missing, extra = hit
                out.append((at + first, at + last, template, gain, share, missing, extra))
                todo += [(at, left[:first]), (at + last, left[last:])]
                break
    return sorted(out)


def _scan_words(words: list[str], gated: bool = True) -> Iterator[tuple]:
    """Findings in a block, which is taken in parts: a finding in a part's last words is left to the next one."""
    at = 0
    while at < len(words):
        found = _scan_part(tuple(words[at:at + _SPAN]), gated)
        open_at = _SPAN if at + _SPAN >= len(words) else _SPAN - _REACH
        whole = [f for f in found if f[1] <= open_at]
        for first, last, *rest in whole:
            yield (at + first, at + last, *rest)
        cut = min([open_at, *(f[0] for f in found if f[1] > open_at)])
        at += max([cut, *(f[1] for f in whole[-1:])])


def blocks(text: str) -> list[tuple[int, int]]:
    """Disjoint candidate blocks: (start, end)."""
    out: list[list[int]] = []
    start = 0
    for line in text.split("\n"):
        end = start + len(line)
        cues = [m.start() for m in _CUE.finditer(line)]
        if cues:
            words = [(m.start(), m.end()) for m in re.finditer(r"\S+", line)]
            if len(words) <= 2 * AROUND:
                spans = [(start, end)]
            else:
                spans, k = [], 0
                for c in cues:
                    while words[k][1] <= c:
                        k += 1
                    spans.append((start + words[max(0, k - AROUND)][0],
                                  start + words[min(len(words) - 1, k + AROUND)][1]))
            for a, b in spans:
                if out and a <= out[-1][1] + 1:  # overlapping, or on the next line
                    out[-1][1] = max(out[-1][1], b)
                else:
                    out.append([a, b])
        start = end + 1
    return [(a, b) for a, b in out]


def wrapped(text: str, found: list[tuple[int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """The words around license words outside of ``found``, over as many lines as a notice can be wrapped to."""
    cues, place = [], 0
    found = sorted(found)
    for c in _CUE.finditer(text):
        while place < len(found) and found[place][1] <= c.start():
            place += 1
        if place == len(found) or found[place][0] >= c.end():
            cues.append(c.start())
    if not cues:
        return
    words = _words(text)
    starts = [a for _, a, _ in words]
    done, k = 0, 0
    for a, b in [*found, (len(text), len(text))]:
        # between two findings
        first, last, to = done, bisect_left(starts, a), -1
        block: list[tuple[str, int, int]] = []
        while k < len(cues) and cues[k] < a:
            at = bisect_right(starts, cues[k]) - 1
            k += 1
            if not first <= at < last:
                continue
            start, end = max(first, at - _REACH), min(last, at + _REACH + 1)
            if start > to and block:
                yield block
                block = []
            block += words[max(start, to):end]
            to = end
        if block:
            yield block
        done = bisect_left(starts, b)


def negated(text: str, start: int) -> bool:
    """Whether the words right before ``start``, in the same sentence, negate what begins there."""
    return bool(NEGATION.search(SENTENCE.split(text[max(0, start - 60):start])[-1]))


def find(text: str) -> list[tuple]:
    """(start, end, license, category, reduction, wording, missing, extra) of every notice."""
    out = []

    def add(words: list[tuple[str, int, int]], at: int, gated: bool) -> None:
        for first, last, t, gain, share, missing, extra in _scan_words([w for w, _, _ in words], gated):
            name = TEMPLATES[t][0]
            out.append((at + words[first][1], at + words[last - 1][2], name, CATEGORY.get(name, "copyleft"),
                        round(gain, 6), round(share, 6), " ".join(missing), " ".join(extra)))

    for a, b in blocks(text):
        add(_words(text[a:b]), a, True)
    # the missing words may stand on the next line
    partial = [f for f in out if f[6]]
    out = [f for f in out if not f[6]]
    for words in wrapped(text, [f[:2] for f in out]):
        add(words, 0, False)
    out.sort()
    ends, also = [f[1] for f in out], []  # findings do not overlap
    for f in partial:
        k = bisect_right(ends, f[0])
        if k == len(out) or out[k][0] >= f[1]:
            also.append(f)
    return sorted(f for f in out + also if not negated(text, f[0]))


def _scanning(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["id", "start", "end", "license", "category", "reduction", "wording", "missing", "extra"]
    for pdf in batches:
        rows = [(i, *f) for i, t in zip(pdf["id"], pdf["text"]) for f in find(t)]
        yield pd.DataFrame(rows, columns=columns)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each confirmed notice."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.where(F.col("text").rlike(CUE)).mapInPandas(_scanning, SCHEMA.format(kind))
            .withColumnRenamed("id", id_col))
