import math
import re
from collections import defaultdict

import duckdb

from citymarts.llm import pii
from citymarts.llm.queries import QUERIES
from conftest import SF_CHECK
from test_pii import base

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def expected(docs):
    """Flagged term spans by plain loops over whole documents: {(id, start, end, action)}."""
    words, holding, n = {}, defaultdict(set), len(docs)
    for i, t in docs:
        plain = re.sub(EMAIL, lambda m: "\1" * len(m[0]), t)
        words[i] = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", plain)]
        for kind, a, b in (s.split(":") for s in base(t)):
            v = t[int(a):int(b)]
            holding[kind, v.lower() if kind == "email" else re.sub("[^0-9.]" if kind == "ip" else "[^0-9]", "", v)].add(i)
    having = defaultdict(set)
    for i, ws in words.items():
        for w, _, _ in ws:
            having[w].add(i)
    best = {}
    for at in holding.values():
        n_e = len(at)
        for w in {w for i in at for w, _, _ in words[i]} if n > n_e else ():
            k, n_t, z = len(having[w] & at), len(having[w]), pii.Z
            p = k / n_t
            low = (p + z * z / 2 / n_t - z * math.sqrt(p * (1 - p) / n_t + z * z / 4 / n_t / n_t)) / (1 + z * z / n_t)
            if math.log(low * n / n_e) / math.log(n / n_e) >= pii.GENERALISE:
                best[w] = max(best.get(w, 0), math.log(k * n / (n_t * n_e)) / math.log(n / n_e))
    return {(i, a, b, "remove" if best[w] >= pii.REMOVE else "generalise")
            for i, ws in words.items() for w, a, b in ws if best.get(w, 0) >= pii.GENERALISE}


def flagged(scanned):
    return {(r.doc_id, s.start, s.end, s.action) for r in scanned.collect() for s in r.spans if s.kind == pii.TERM}


def test_judged_terms_go_wherever_they_stand(spark):
    far = "the harvest in the town was about as good as ever " * 4
    docs = [(i, f"the castellan wrote {far} bob@example.com") for i in range(8)]  # more than CONTEXT characters away
    docs += [(50, f"zanzibar {far} +49 30 1234567"), (51, f"quixotic {far} ann@example.org"), (52, f"quixotic {far} ann@example.org")]
    docs += [(100 + i, far) for i in range(600)] + [(900, "Castellan once, castellan twice"), (901, None)]
    df = spark.createDataFrame(docs + docs[:1], "doc_id long, text string")
    scanned = pii.scan(df, with_text=True, everywhere=True)
    assert flagged(scanned) == expected([(i, t or "") for i, t in docs])
    got = {r.doc_id: r for r in pii.sanitise(scanned).collect()}
    assert "castellan" not in got[0].text and "harvest" in got[0].text and "bob@" not in got[0].text
    assert got[900].text.lower().count("castellan") == 0 and len(got[900].spans) == 2
    assert "zanzibar" not in got[50].text and "quixotic" not in got[51].text  # entities of one and two documents
    assert not got[100].spans and not got[901].spans and got[901].text is None
    assert pii.scan(df.limit(0), everywhere=True).count() == 0


def test_query_judges_whole_documents(spark):
    docs = duckdb.sql(f"select doc_id, text from read_parquet('{SF_CHECK}/documents.parquet')").fetchall()
    want = defaultdict(set)
    for i, a, b, _ in expected([(i, t or "") for i, t in docs]):
        want[i].add(f"term:{a}:{b}")
    got = {r.doc_id: {s for s in r.spans.split(",") if s.startswith("term:")} for r in QUERIES["op5_pii"](spark, SF_CHECK).collect()}
    assert sum(map(len, want.values())) and got == {i: want[i] for i, _ in docs}
