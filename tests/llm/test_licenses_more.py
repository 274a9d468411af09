import time

import pytest

from citymarts.llm import licenses
from test_licenses import names


@pytest.mark.parametrize("text", [
    "Not licensed under the MIT License.", "It was never released under the MIT License, they said.",
    "This work isn't licensed under the GNU General Public License, version 3.", "The text is no longer\nreleased under the MIT License.",
])
def test_negated_notices_do_not_count(text):
    assert names(text) == [] and names(f"Some words before.\n{text}\nAnd some after it.") == []


def test_negation_of_another_sentence():
    assert names("We could not find it. Released under the MIT License.") == ["MIT"]
    assert names("It is not old.\n\nReleased under the MIT License.") == ["MIT"]


@pytest.mark.parametrize("name, text", [
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International Licence."),
    ("MIT", "Released under the MIT licence."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Licensed under the BSD License."), ("MIT", "# SPDX-License-Identifier: MIT"),
    ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"), ("GPL-2.0-or-later", "// SPDX-License-Identifier: GPL-2.0-or-later"),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser "
     "General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) "
     "any later version."),
])
def test_names(name, text):
    assert names(text) == [name]


def test_unknown_identifiers_are_not_taken_for_known_ones():
    assert names("SPDX-License-Identifier: XYZ-2.0") == [] and names("SPDX-License-Identifier: CC-BY-SA-3.0") == []


def test_time_grows_with_the_notices():
    lines = [f"page {k}: " + licenses.TEMPLATES[k % 2][1] for k in range(4000)]
    expected = ["MIT"] * 4000
    took = []
    for n in (1000, 4000):
        licenses._scan_part.cache_clear()
        start = time.process_time()
        found = licenses.find("\n".join(lines[:n]))
        took.append(time.process_time() - start)
        assert [f[2] for f in found] == expected[:n]
    assert took[1] < 10 * took[0]


def test_parts_find_what_one_block_finds():
    words = [w for k in range(60) for w, _, _ in licenses._words(f"word {k} " * (k % 7) + licenses.TEMPLATES[k % len(licenses.TEMPLATES)][1])]
    apart = [(f[0], f[1], f[2]) for f in licenses._scan_words(words, False)]
    whole = [(f[0], f[1], f[2]) for f in licenses._scan_part(tuple(words), False)]
    assert len(words) > 3 * licenses._SPAN and {f[:2] for f in whole} <= {f[:2] for f in apart}
