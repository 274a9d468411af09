from citymarts.llm import decontaminate as d
from test_decontaminate import FILL, ITEM, found


def test_windows_full_of_numbers_and_names_match_by_their_values(spark):
    items = [(1, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, "What is 12 times 7?"), (3, "Then Anna Berta Clara Dora Emma Frieda Greta and Hanna"),
             (4, "7 plus 5"), (5, ITEM), (6, "Paris and Rome have met by night again")]
    docs = [(i, FILL + t + ". " + FILL) for i, t in items]
    docs += [(11, FILL + "1 2 3 4 9 6 7 8 5 10 11 13. "), (12, "What is 13 times 7?"), (14, "7 plus 6"), (20, FILL * 3), (21, None)]
    docs += [(15, FILL + ITEM.replace("120", "77").replace("Maria", "Peter"))]
    for limit in (d.BROADCAST_WINDOWS, 0):
        got = found(spark, docs, items, valued=True, broadcast_windows=limit)
        assert got.pop((15, 5))[0] == "reparameterised"
        assert got == {(i, i): ("exact", 0) for i, _ in items}
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    kept = {r.doc_id for r in d.without_leaks(a, b, valued=True).collect()}
    assert kept == {11, 12, 14, 20, 21}


LONG = " ".join(f"{a} {b}" for a, b in zip(
    "the miller found an old brass key under a wet stone near his barn and gave it to a passing clerk who kept every".split(),
    "grey while above before silent upon broken beneath heavy until beside sold between and copper toward inside lost over without during still once".split()))


def test_conflicts_void_windows_only_and_diagonals_are_merged(spark):
    item = ("A train leaves the old station by the river with 120 tired passengers and after a while the guard who sits in "
            "the last car counts 120 of them while the driver says there were 120 when they left home")
    words = item.split()
    docs = [(1, FILL + item.replace("120", "119", 1) + ". " + FILL),                        # one of three equal numbers altered
            (2, FILL + " ".join(words[:18] + ["very"] + words[18:]) + ". " + FILL),         # one word put in
            (3, FILL + " ".join(words[:16] + words[18:]) + ". " + FILL),                    # two left out
            (4, FILL + " ".join(words[:8]) + " " + FILL + " ".join(words[20:28]) + FILL),   # pieces
            (5, FILL + item.replace("120", "77") + ". " + FILL), (6, FILL * 5), (7, item), (7, item)]
    for limit in (d.BROADCAST_WINDOWS, 0):
        got = found(spark, docs, [(9, item), (9, item)], valued=True, broadcast_windows=limit)
        assert got == {(1, 9): ("reparameterised", 1), (2, 9): ("exact", 0), (3, 9): ("exact", 0),
                       (5, 9): ("reparameterised", 1), (7, 9): ("exact", 0)}
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    cover = {r.doc_id: r.coverage for r in d.leaks(a, b, valued=True).collect()}
    assert min(cover[2], cover[3]) > 0.9 and cover[7] == 1.0


def test_long_verbatim_run_is_a_leak_whatever_the_length(spark):
    words = (LONG + " " + " ".join(reversed(LONG.split())) + " " + " ".join(sorted(LONG.split()))).split()
    piece = lambda n: FILL + " ".join(words[5:5 + n]) + ". " + FILL
    docs = [(1, piece(d.RUN)), (2, piece(d.RUN - 1)), (2 ** 62 + 1, piece(60)), (None, piece(60))]
    assert 60 < d.COVERAGE * len(words)
    got = found(spark, docs, [(1, " ".join(words))], valued=True)
    assert set(got) == {(1, 1), (2 ** 62 + 1, 1), (None, 1)}
