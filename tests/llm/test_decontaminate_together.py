"""Texts are searched together, with the windows that each has alone."""

import numpy as np
import pandas as pd

from citymarts.llm import decontaminate as d

ITEM = "A train leaves the station with 120 passengers and after 3 hours Maria counts 120 of them and 45 km to go"


class Among:
    value = np.sort(np.array([r[0] for r in d._rows(ITEM, [3, 8], None, True)], np.int64).astype(np.uint64))


def test_texts_are_searched_together(monkeypatch):
    words = ITEM.split()
    texts = [" ".join(words[i:]) for i in range(len(words))] + [" ".join(words[:i]) for i in range(len(words))]
    texts += ["", "Peter", "45 km", ".", "x " * 200_000 + ITEM] + ["nobody had ever seen the garden by night"] * 150
    df = pd.DataFrame({"id": [str(i) for i in range(len(texts))], "same": range(len(texts)), "text": texts})
    alone = [(str(i), i, *r) for i, t in enumerate(texts) for r in d._rows(t, [3, 8], Among.value, True)]
    found = pd.concat(d._windowing(Among, [3, 8], True)(iter([df])))
    assert [tuple(r) for r in found.itertuples(index=False)] == alone

    calls, real = [], d.windows
    monkeypatch.setattr(d, "windows", lambda *a: calls.append(a) or real(*a))
    none = df.where(df.text.str.startswith("nobody")).dropna()
    assert sum(map(len, d._windowing(Among, [3, 8], True)(iter([none])))) == 0
    assert len(calls) == 4      # each length, by template and by value
