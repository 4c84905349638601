import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold import schemas as S
from lumenfold.functions import python as P
from lumenfold.operators import ocr, rows, training


def square(x, y, w=20, h=10):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]


def test_blocks_and_lines(spark):
    old = [[square(50, 10), ["world", 0.9]], [square(10, 12), ["hello", 0.8]], [square(10, 60), ["500 RUB", 0.7]], [square(10, 60), ["500 RUB", 0.95]]]
    new = {"res": {"rec_texts": ["a", "", "b"], "rec_scores": [0.5, 0.1, 0.6], "rec_polys": [square(0, 0), square(0, 0), square(40, 2)]}}
    df = spark.createDataFrame([(1, json.dumps(old), 100), (2, json.dumps(new), 100), (3, "not json", 100), (4, None, 100), (5, json.dumps([["plain", 0.4]]), 100)], "id int, r string, h int")
    got = {r["id"]: r for r in ocr.read_results(df, "r", "h").withColumn("score", ocr.variant_score(F.col("blocks"), F.col("lines"))).collect()}
    assert got[1]["lines"] == ["hello world", "500 RUB"] and [b["confidence"] for b in got[1]["blocks"]] == [0.9, 0.8, 0.95]
    assert got[2]["lines"] == ["a b"] and got[3]["lines"] == got[4]["lines"] == [] and got[5]["lines"] == ["plain"]
    chars = len("helloworld|500RUB")
    assert got[1]["score"] == pytest.approx((0.9 + 0.8 + 0.95) / 3 * 1.2 + chars / 120 + 0.5)


def test_frequent_errors_are_mended(spark):
    texts = ["M\u0435H\u044f | T\u044b , там", "M\u0435\u043d\u044f", "Бечерний  звон", "это оха !", "как есть"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(ocr.tidy(F.col("t"))).collect()]
    assert got == ["меня\nТы, там", "меня", "Вечерний звон", "это Тоха!", "как есть"]


def test_plaques_without_lines(spark):
    got = ocr.parsed_plaques(spark.createDataFrame([(1, None), (2, []), (3, ["Ivan - 500 RUB", None, "hi"])], "id int, l array<string>"), "l").collect()
    assert [tuple(r)[2:] for r in sorted(got)] == [("", "", "", ""), ("", "", "", ""), ("Ivan", "500", "RUB", "hi")]


def test_rule_parser():
    assert ocr.parse_lines(["Ivan - 500 RUB", "hello", "there"]) == ("Ivan", "500", "RUB", "hello\nthere")
    assert ocr.parse_lines(["Ivan - 1", "500 руб", "hi"])[1:] in (("1", "", "500 руб\nhi"), ("1500", "RUB", "hi"))
    assert ocr.parse_lines(["Olga", "2 000 ₽", "hi"]) == ("Olga", "2000", "₽", "hi")
    assert ocr.parse_lines(["only text"]) == ("only text", "", "", "") and ocr.parse_lines([]) == ("", "", "", "")


def test_texts_and_variants(spark):
    df = spark.createDataFrame([("Ёлка  №1 | да !",)], "t string")
    assert tuple(df.select(ocr.normalize_ocr(F.col("t")), ocr.tidy(F.col("t")), ocr.clean_number(F.col("t"))).first()) == ("елка 1  да !", "Ёлка №1\nда!", "1")
    v = spark.createDataFrame([(1, "a", 0.5, ["x"]), (1, "b", 0.9, ["y"]), (1, "c", 0.9, ["z"])], "event_id int, variant string, score double, lines array<string>")
    assert tuple(ocr.best_variant(v, "event_id").first()) == (1, "b", 0.9, ["y"])


def test_letterbox():
    image = np.zeros((10, 20, 3), np.uint8)
    image[..., 2] = 255
    out, scale, left, top = P.letterbox(image, 40, 40)
    assert out.shape == (3, 40, 40) and (scale, left, top) == (2.0, 0, 10)
    assert np.allclose(out[0, 10:30], 1) and np.allclose(out[1:, 10:30], 0) and np.allclose(out[:, :10], 114 / 255)


def test_sweeps_residuals_and_counters(spark):
    runs = spark.createDataFrame([(1, 5.0), (2, 13.0), (4, 13.0)], "n int, rate double")
    assert tuple(rows.best_setting(runs, "n", "rate", 6.0).first()) == (2, 13.0, "headroom")
    pairs = spark.createDataFrame([("f", 1.0, 0.5), ("g", 0.9, 0.99)], "file_name string, sim_a double, sim_b double")
    assert [tuple(r) for r in rows.residual_errors(pairs, ["a", "b"]).collect()] == [("f", "b", 0.5), ("g", "a", 0.9)]
    events = spark.createDataFrame([("", True), ("x", False), (None, None)], "model_error string, is_duplicate boolean")
    assert tuple(rows.run_counters(events).first()) == (3, 1, 1)


def test_manifest(spark):
    sample = "strategy string, stream_id long, frame_idx int, confidence double, score double, event_id long, timestamp_sec double, x1 int, y1 int, x2 int, y2 int, frame_w int, frame_h int"
    samples = spark.createDataFrame([("negatives", 0, 5, None, None, None, 0.5, None, None, None, None, 100, 50), ("best", 0, 7, 0.91234, 1.0, 3, 0.7, 10, 10, 30, 20, 100, 50)], sample)
    labels = spark.createDataFrame([(0, 7, 1, "0 ...")], "stream_id long, frame_idx int, num_boxes int, label_text string")
    got = training.manifest(samples, labels, "v").collect()
    assert [r["strategy"] for r in got] == ["best", "negatives"] and got[0]["image"] == "images/best_0_0000007.jpg" and got[0]["box_xyxy"] == "[10,10,30,20]"
    assert got[1]["preview"] is None and got[1]["num_boxes"] == 0 and list(got[0].asDict()) == [f.split()[0] for f in S.MANIFEST.split(", ")]
