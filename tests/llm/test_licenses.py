import re

import duckdb
import pytest

from citymarts.llm import licenses
from citymarts.llm.queries import QUERIES
from conftest import SF_CHECK


def names(text):
    return [f[2] for f in licenses.find(text)]


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
def test_every_template_is_found(name, text):
    found = licenses.find(f"Some words before.\n{text}\nAnd some after it.")
    assert [f[2] for f in found] == [name] and found[0][5] == 1.0
    assert licenses.find(text.upper())[0][2] == name


def test_wording_differences():
    assert names("This work is licenced under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Licensed under CC BY-NC-SA 4.0.") != ["CC-BY-NC-4.0"]
    assert names("Not all of the licenses in this town were given to drivers.") == []


def test_several_notices_and_long_line():
    text = "wo rd " * 500 + "Released under the MIT License. All rights reserved. " + "more words " * 500
    found = licenses.find(text)
    assert [f[2] for f in found] == ["MIT", "Proprietary"]
    assert text[found[0][0]:found[0][1]] == "Released under the MIT License"


def test_query_finds_every_notice_line(spark):
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{SF_CHECK}/documents.parquet')").fetchall()
    want = set()
    for name, t in licenses.TEMPLATES:
        body = re.compile(r"\W+".join(re.findall(r"[\w]+", t)), re.I)
        want |= {(i, name) for i, x in docs if body.search(x)}
    got = {(r.doc_id, r.license) for r in QUERIES["op8_licenses"](spark, SF_CHECK).collect()}
    assert want and want == got


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "All rights reserved.", 0), (3, "All rights reserved.", 0),
                                (3, "All rights reserved.", 0)], "doc_id long, text string, start int")
    assert sorted(str(r.doc_id) for r in licenses.scan(df).collect()) == ["3", "3", "None"]
    assert licenses.scan(df.limit(0)).count() == 0
