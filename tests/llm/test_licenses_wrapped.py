import textwrap

import pytest

from citymarts.llm import licenses

AROUND = "The mill stood by the river and nobody had ever seen the old garden by night or day. "


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_hard_wrapped_notices_are_found(name, text, mark):
    for width in (30, 60):
        body = "\n".join(mark + line for line in textwrap.wrap(text, width))
        for fill in (AROUND * 8, "Short.", ""):
            found = licenses.find(f"{fill}\n{body}\n{fill}")
            assert [f[2] for f in found] == [name] and found[0][5] == 1.0
