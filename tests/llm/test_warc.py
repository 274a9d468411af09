import gzip
import hashlib
import io

from citymarts.llm import warc
from conftest import SF_SMOKE
from sqlcheck import assert_equals_sql


def test_query_equals_sql(spark):
    assert_equals_sql(spark, "op2_warc", SF_SMOKE)


def test_revisits_nulls_long_repeats(spark):
    long, short = "é" * 700, "x" * 999
    rows = [(1, "u", long, 9), (5, None, long, 9), (3, "u", short, 9), (4, "u", short, 9), (6, "u", None, 9),
            (7, "u", "", 9), (8, "a\r\nb", "y" * 3_000_000, 9), (9, "u", "z" * 1000, 9), (9, "u", "z" * 1000, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    got = sorted(map(tuple, warc.page_records(warc.round_trip(pages)).collect()))
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert [(r[0], r[1], r[3], r[4], r[5]) for r in got] == [
        (1, 1400, "revisit", 5, True), (3, 999, "response", None, True), (4, 999, "response", None, True),
        (5, 1400, "response", None, True), (6, 0, "response", None, True), (7, 0, "response", None, True),
        (8, 3_000_000, "response", None, True), (9, 1000, "response", None, True), (9, 1000, "response", None, True)]
    assert got[0][2] == got[3][2] == sha(long) and got[4][2] == sha("")
    assert warc.page_records(warc.round_trip(pages.limit(0))).count() == 0


def test_payloads_come_back_and_files_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}é</p>" * i) for i in range(40)],
                                  "page_id long, url string, html string")
    path = warc.write_archives(warc.with_revisits(pages), f"file://{tmp_path}/a", max_file_bytes=2000)
    got = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, path).collect()}
    assert got == {f"urn:page:{i}": (f"<p>{i}é</p>" * i).encode() for i in range(40)}
    files = list((tmp_path / "a").glob("*.warc.gz"))
    assert len(files) > 2 and all(gzip.open(f).read().startswith(b"WARC/1.1\r\n") for f in files)


def _archive(n=4):
    rows = []
    for i in range(n):
        body = f"body {i} ".encode() * 50
        row = {"record_id": f"urn:page:{i}", "record_type": "response", "target_uri": "u", "date": "d",
               "payload": body, "payload_bytes": len(body), "payload_digest": hashlib.sha1(body).hexdigest()}
        rows.append(warc.record_bytes(row))
    return rows


def test_damage_is_reported_and_skipped():
    plain = _archive()
    members = [warc._member(r, 6) for r in plain]
    members[1] = members[1][:30] + b"\xff" * 20 + members[1][50:]
    got = list(warc.read_archive(io.BytesIO(b"".join(members))))
    assert [r.get("record_id") for r in got] == ["urn:page:0", None, "urn:page:2", "urn:page:3"]
    assert got[1]["error"] and not got[2]["error"]
    assert [r["offset"] for r in got if r.get("record_id")][0] == 0
    cut = list(warc.read_archive(io.BytesIO(b"".join(members[2:])[:-9])))
    assert cut[0]["record_id"] == "urn:page:2" and cut[1]["error"]


def test_wrong_length_and_digest():
    r = _archive(1)[0]
    for bad, why in ((r.replace(b"body 0", b"BODY 0"), "block digest"), (r[:-10] + r[-4:], "content length"),
                     (r.replace(b"Content-Length: 4", b"Content-Length: 3", 1), "content length")):
        got = list(warc.read_archive(io.BytesIO(warc._member(bad, 6))))
        assert why in got[0]["error"], got
