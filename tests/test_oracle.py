"""Every query with SQL, outside of the training-data operators, against DuckDB on the smallest tables."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from lumenfold.operators import rows
from lumenfold.plans import queries as Q

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="the generated tables are not here")


def plain(x):
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    return x.isoformat() if isinstance(x, (date, datetime)) else x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in TABLES.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", Q.SQL)
def test_query_and_sql_agree(spark, duck, name):
    df = Q.QUERIES[name](spark, str(TABLES))
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    want = duck.sql(Q.SQL[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert len(got) == len(want) and got == want


def test_every_query_but_one_has_sql():
    assert set(Q.QUERIES) - set(Q.SQL) == {"eval_text_similarity"}


def test_other_import_failures_are_told(tmp_path):
    """Only a missing subpackage is passed over."""
    import __spark_entry__ as e

    assert e._optional("lumenfold.llm.absent") is None
    (tmp_path / "needs_absent_thing.py").write_text("import absent_thing\n")
    import sys

    sys.path.insert(0, str(tmp_path))
    with pytest.raises(ModuleNotFoundError, match="absent_thing"):
        e._optional("needs_absent_thing")
    sys.path.remove(str(tmp_path))


def test_tiles_are_floats_as_in_sql(spark, tmp_path):
    """Thousandths: many are whole numbers when multiplied as floats, and lie below them as doubles."""
    tiles = [(i, [s * (64 * i + k) / 1000 for k in range(64)]) for i, s in enumerate((1, -1, 1, -1))]
    spark.createDataFrame(tiles, "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = c.sql(Q.SQL["laplacian_variance"]).fetchall()
    assert sorted(map(tuple, Q.laplacian_variance(spark, str(tmp_path)).collect())) == sorted(want)


@pytest.mark.parametrize("name", ["truth_lookup", "truth_missing"])
def test_names_are_joined_in_partitions_that_follow_the_input(spark, duck, monkeypatch, name):
    """No side is broadcast by a guess of its size, and nothing is sorted before it is spread."""
    monkeypatch.setattr(rows, "ROWS", 100, raising=False)
    df = Q.QUERIES[name](spark, str(TABLES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    n = 2 * duck.sql("SELECT count(*) FROM events").fetchall()[0][0] // 100
    assert n > 4 and plan.count(f", {n}), REPARTITION_BY_NUM") == plan.count("Exchange ") == 2 and "Broadcast" not in plan
    assert "Sort" not in plan.rpartition("REPARTITION_BY_NUM")[2]
    names = sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(duck.sql(f"SELECT {', '.join(names)} FROM ({Q.SQL[name]})").fetchall())


def test_residuals_are_sorted_in_ranges_that_follow_the_input(spark, duck, monkeypatch):
    monkeypatch.setattr(rows, "ROWS", 100, raising=False)
    df = Q.residual_errors(spark, str(TABLES))
    n = 2 * duck.sql("SELECT count(*) FROM events").fetchall()[0][0] // 100
    assert n > 4 and f", {n}), REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString().partition("rangepartitioning")[2].split("\n")[0]
    got = [(r["similarity"], r["file_name"], r["field"]) for r in df.collect()]
    assert got == sorted(duck.sql(f"SELECT similarity, file_name, field FROM ({Q.SQL['residual_errors']})").fetchall())
