"""Awkward tables through every operator and stage, and the pipeline against its stages by hand."""

import random
import shutil

import pytest

import corpus_pipeline
from lumenfold.llm import bpe, gru, license_scan, lines, packing, quality, simhash, substring

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tid int, fp long, n_removed int, score double, keep boolean, start int, n long, bucket int, group_id long, good boolean, _p int, _new int"
EMPTY = (None,) * 12


def awkward():
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(60_000))
    rows = [(None, None), (None, "no id here\nat all\nreally\nnot"), (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, long), (6, long), (7, "same text\nwith lines\nof three\nmore"), (7, "same text\nwith lines\nof three\nmore"), (7, "another text with that id"), (8, "é" * 9000), (9, "!!! ???"), (10, "same text\nwith lines\nof three\nmore")]
    return [(i, t, None, None, None, *EMPTY) for i, t in rows]


def operators(labels):
    return {
        "bpe": lambda d: bpe.encode_documents(d, VOCABULARY), "ratio": lambda d: quality.importance_scores(d, labels), "fingerprints": simhash.document_fingerprints,
        "packing": packing.pack_documents, "license": license_scan.scan_licenses, "lm": lambda d: gru.language_model_scores(d, words=32, classes=2, rounds=1), "substring": substring.repeated_substrings,
        "remove": substring.remove_substrings, "classifier": lambda d: quality.classify(d, quality.fit_classifier(d, labels)), "lines": lines.dedup_lines, "near": simhash.near_duplicates,
    }


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (9, 0, 0), (9, 1, None), (None, 1, 0), (8, 0, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", operators(None))
def test_awkward_rows(spark, labels, name):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    got = operators(labels)[name](docs).collect()
    n = len(awkward())
    if name in ("bpe", "ratio", "fingerprints", "lm", "classifier", "lines", "remove"):
        assert len(got) == n
    if name == "near":
        by = {r["doc_id"]: (r["group_id"], r["keep"]) for r in got}
        assert by == {1: (1, True), 2: (2, True), 3: (2, False), 4: (4, True), 5: (5, True), 6: (5, False), 7: (7, True), 8: (8, True), 9: (2, False), 10: by[10]}
    if name == "substring":
        assert {(r["doc_id"], r["start_word"], r["end_word"], r["removed"]) for r in got} == {(5, 0, 60_000, False), (6, 0, 60_000, True)}
    if name == "lines":
        assert [r["n_removed"] for r in got if r["doc_id"] == 10] == [4] and all(r["n_removed"] == 0 for r in got if r["doc_id"] != 10)
    if name == "ratio":
        assert all(r["keep"] is False and r["score"] is None for r in got if r["doc_id"] in (1, 2, 3))
    if name == "packing":
        assert sum(r["used"] for r in got) == sum(len((r[1] or "").split()) for r in awkward())
    if name == "fingerprints":
        assert all(r["fingerprint"] is None and r["class_id"] is None and r["n_near"] == 0 and r["n_same"] == 0 for r in got if r["doc_id"] in (1, 2, 3, 9))


@pytest.mark.parametrize("name", operators(None))
def test_empty_tables(spark, labels, name):
    docs = spark.createDataFrame([], SCHEMA)
    assert operators(labels)[name](docs).collect() == []
    assert operators(labels.limit(0))[name](docs).collect() == []


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("rows", [awkward, list])
def test_awkward_stages(spark, labels, tmp_path, stage, rows):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    if stage != "packing":
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
    got = got.collect()
    if rows is list:
        assert got == []
    if stage == "near dedup" and rows is awkward:
        assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None)[:6] == [1, 2, 4, 5, 7, 8] and sum(r["doc_id"] is None for r in got) == 2


def test_near_dedup_judges_every_text(spark, tmp_path):
    rng = random.Random(4)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(5))
    rows = [(1, a), (1, b), (2, a), (3, c), (3, c), (4, d), (4, c), (5, d), (5, e), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.dedup_near(spark, docs, str(tmp_path)).collect()]
    assert sorted(t for _, t in got if t) == sorted([a, b, c, d, e]) and (6, None) in got
    assert set(got) == {(1, b), (2, a), (3, c), (4, d), (5, e), (6, None)}


def test_run_is_its_stages(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioustrnlm") for _ in range(rng.randrange(2, 8)))
    rows, marks = [], []
    for i in range(120):
        w = [word() for _ in range(rng.randrange(20, 120))]
        bad = i % 5 == 0
        if bad:
            w[3] = w[9] = "worthless"
        rows.append((i, " ".join(w), "en", "s", 0))
        marks.append((i, 1, int(bad)))
    rows += [(200 + k, rows[7 * k + 1][1] + " " + word(), "en", "s", 0) for k in range(10)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"step{k}")
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
    shape = lambda df: sorted(map(tuple, df.select("doc_ids", "starts", "lengths", "used").collect()))
    assert shape(corpus_pipeline.run(spark, str(tmp_path))) == shape(docs)
    packed = {d for r in docs.collect() for d in r["doc_ids"]}
    kept = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "step0")).collect()}
    assert not {i for i, _, t in marks if t} & kept and len({i for i, _, t in marks if not t} - kept) <= 2
    near = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "step2")).collect()}
    assert sum(200 + k in near for k in range(10)) <= 1 and packed <= near
    shutil.rmtree(tmp_path)
