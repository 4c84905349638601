"""Column functions, against plain Python."""

import difflib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenfold.functions import geometry as G
from lumenfold.functions import python as P
from lumenfold.functions import text as T


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_geometry(spark):
    rows = [(0, 0, 10, 10, 5, 5, 15, 15), (0, 0, 0, 0, 0, 0, 0, 0), (10, 20, 110, 70, 10, 20, 110, 70), (5, 5, 3, 9, 0, 0, 9, 9), (0, 0, 4, 4, 10, 10, 12, 12)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f int, g int, h int").select(G.box("a", "b", "c", "d").alias("p"), G.box("e", "f", "g", "h").alias("q"))
    got = df.select(G.box_iou(F.col("p"), F.col("q")), G.center_distance(F.col("p"), F.col("q"), F.lit(640), F.lit(480)), G.box_area(F.col("p")), G.box_height(F.col("p"))).collect()
    assert [tuple(r)[0] for r in got] == [25 / 175, 0.0, 1.0, 0.0, 0.0]
    assert got[0][1] == pytest.approx(math.hypot(5, 5) / 800) and [r[2] for r in got] == [100, 0, 5000, 0, 16] and got[3][3] == 4
    padded = df.select(G.expand_box(F.col("p"), F.lit(100), F.lit(60)).alias("b")).select("b.*").collect()
    assert tuple(padded[2]) == (0, 8, 99, 59) and tuple(padded[0]) == (0, 0, 30, 22)


def test_reference_height_is_the_upper_median(spark):
    got = one(spark, "h array<int>", [([],), ([3],), ([4, 1],), ([5, 1, 9],), ([1, 2, 3, 4],)], G.reference_height(F.col("h")))
    assert [r[0] for r in got] == [0, 3, 4, 5, 3]
    assert one(spark, "h array<int>", [([1, 2, 3, 4, 5],), ([],)], G.push_height(F.col("h"), F.lit(6))) == [([2, 3, 4, 5, 6],), ([6],)]


def test_scores(spark):
    b, p, w, h = G.box("a", "b", "c", "d"), F.col("p"), F.lit(100), F.lit(100)
    df = spark.createDataFrame([(5, 50, 25, 60, 1000.0), (50, 50, 60, 60, 100.0), (0, 50, 10, 60, 0.0)], "a int, b int, c int, d int, v double").withColumn("b", b).withColumn("p", G.expand_box(F.col("b"), w, h))
    got = df.select(G.candidate_score(F.lit(0.5), F.col("b"), p, F.col("v"), w, h)).collect()
    assert [round(r[0], 9) for r in got] == [round(0.5 + 0.2 + 0.4 - 0.15, 9), round(0.5 + 0.1 + 0.2, 9), round(0.5 + 0.1, 9)]


def test_shares(spark):
    rows = [(10, 10, 20, 30, 100, 200), (10, 10, 10, 30, 100, 200), (1, 1, 2, 2, 0, 5)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, w int, h int").withColumn("x", G.box("a", "b", "c", "d"))
    assert [r[0] for r in df.select(G.cxcywh(F.col("x"), F.col("w"), F.col("h"))).collect()] == ["0.150000 0.100000 0.100000 0.100000", "", ""]


def test_texts(spark):
    rows = [("  USER  Name ", "[ Ссылка  УДАЛЕНА )", " rub "), (None, None, "NO_CURRENCY"), ("Аноним", "Hi\n you", None)]
    got = one(spark, "d string, m string, c string", rows, T.normalize_donor(F.col("d")), T.normalize_message(F.col("m")), T.normalize_currency(F.col("c")))
    assert got == [("user name", "(ссылка удалена)", "RUB"), ("", "", ""), ("аноним", "hi you", "")]
    who = one(spark, "d string, m string", [("аноним", ""), ("anon", "hello"), ("bob", ""), ("", "link removed")], T.is_identifying(F.col("d"), F.col("m")))
    assert [r[0] for r in who] == [False, True, True, False]
    assert one(spark, "d string", [("Straße ΣΑΣ",), (None,)], T.casefold(F.col("d"))) == [("strasse σασ",), (None,)]


def test_amounts(spark):
    texts = ["5", " 5.5 ", "1e3", "5d", "", None, "abc", "-.5", "1_000", "inf"]
    got = [r[0] for r in one(spark, "a string", [(t,) for t in texts], T.normalize_amount(F.col("a")))]
    assert got == [5.0, 5.5, 1000.0, None, None, None, None, -0.5, None, math.inf]
    lines = ["donor - 1 500,50 RUB", "x 20 USD", "nothing", "7€"]
    assert [r[0] for r in one(spark, "a string", [(t,) for t in lines], T.amount_of_line(F.col("a")))] == [1500.5, 20.0, None, 7.0]


def test_times_and_names(spark):
    got = one(spark, "t double", [(0.0,), (-3.0,), (3661.25,), (59.9996,), (360000.5,)], T.seconds_to_timestamp(F.col("t")))
    assert [r[0] for r in got] == ["00:00:00.000", "00:00:00.000", "01:01:01.250", "00:00:60.000", "100:00:00.500"]
    names = one(spark, "n string", [("a b/c",), ("___",), (None,), ("имя-файла.mp4",), ("x" * 200,)], T.safe_filename(F.col("n")))
    assert [r[0] for r in names] == ["a_b_c", "run", "run", "имя-файла.mp4", "x" * 90]
    assert [r[0] for r in one(spark, "n string", [("event_0042_best.png",), ("x.png",)], T.crop_event_id(F.col("n")))] == [42, None]
    kinds = one(spark, "m int", [(5,), (0,), (9,)], T.image_kinds(F.col("m")))
    assert [tuple(k) if k else None for k, in kinds] == [(True, False, True), (False, False, False), None]
    assert one(spark, "s string", [(" a\r\n b   c ",)], T.one_line(F.col("s"))) == [("a b c",)]
    url = one(spark, "b binary", [(b"\x01" * 97,), (b"",)], T.data_url(F.col("b")))
    assert url[0][0].startswith("data:image/png;base64,AQEB") and "\n" not in url[0][0] and url[1][0] is None


def test_image_sizes():
    assert T.parse_image_size("640") == 640 and T.parse_image_size("384x640") == (384, 640) and T.parse_image_size(" 384, 640 ") == (384, 640)
    for bad in ("", "a", "1,2,3", "0"):
        with pytest.raises(ValueError):
            T.parse_image_size(bad)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 1000))
def test_laplacian_by_pixels(h, w, seed):
    g = np.random.default_rng(seed).integers(0, 256, (h, w))
    mirror = lambda i, n: 0 if n == 1 else -i if i < 0 else 2 * n - 2 - i if i >= n else i
    if min(h, w) == 1:
        mirror = lambda i, n: max(0, min(n - 1, i))
    v = [sum(int(g[mirror(y + a, h), mirror(x + b, w)]) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))) - 4 * int(g[y, x]) for y in range(h) for x in range(w)]
    assert P.laplacian(g) == pytest.approx(np.var(v))


def test_json_answers(spark):
    texts = ['{"donor":"a","amount":"12","needs_review":false}', 'so: {"donor":null} ok', "null", "[]", "0", "[1]", '"x"', "no", "", None, '{"a":1} junk {x}', '{"a":1} junk']
    got = [P.parse_response(t) for t in texts]
    assert got[0] == (True, "a", 12.0, None, None, False, False, None) and got[1][0] and got[1][6] is True
    assert got[2][0] is False and got[2][-1] is None and got[3][0] and got[4][0]
    assert all(got[i][-1].startswith("worker_exception") for i in (5, 6)) and all(got[i][-1].startswith("json_parse_failed") for i in (7, 8, 9, 10)) and got[11][0]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(P.extract_json(F.col("t")).alias("p")).select("p.*")
    assert [tuple(r)[0] for r in df.collect()] == [g[0] for g in got]


def test_flags_are_true_only_where_the_answer_says_true():
    flags = lambda x: P.parse_response('{"needs_review": %s, "fee_covered": %s}' % (x, x))[5:7]
    assert flags("true") == (True, True)
    assert all(flags(x) == (False, False) for x in ("false", "null", '"true"', '"false"', "1", "0", "[true]"))
    assert P.parse_response("{}")[5:7] == (False, True)


def test_similarity(spark):
    rows = [("hello world", "hallo world"), (None, None), (None, "x"), ("", "")]
    got = [r[0] for r in one(spark, "a string, b string", rows, P.text_similarity(F.col("a"), F.col("b")))]
    assert got == [difflib.SequenceMatcher(None, *rows[0], autojunk=False).ratio(), 1.0, 0.0, 1.0]
