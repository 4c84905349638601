"""Joins and rows of the extraction stage, evaluation and benchmark aggregates."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfold.functions import python as P
from lumenfold.functions import text as T
from lumenfold.operators.dedup import counted

FALLBACK_ID = 10**9

#: Rows that a task of a join or a sort over names is to hold, some 100 bytes each.
ROWS = 1 << 19


def parts_of(spark: SparkSession, count: int) -> int:
    """Partitions for ``count`` rows, :data:`ROWS` in each; the shuffle partitions of the session at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // ROWS))


def global_rank(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their place, from 1, in the order of all of them; no task sees more than its range.

    The number of ranges is given, so that they are the same wherever the plan uses them."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_id", 33))
    sizes = local.groupBy("_p").agg(F.count("*").alias("_n"))  # a row per range
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_b"))
    return local.join(F.broadcast(before), "_p").withColumn(name, F.col("_b") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_id", "_p", "_b")


def crop_jobs(crops: DataFrame, meta: DataFrame) -> DataFrame:
    """Full outer join of crop files and metadata on ``crop``: ``crop, event_id, state``.

    A crop without metadata takes the number in its name, else 10**9 plus its place in the
    sorted list of crops; metadata without a crop (or with an empty name) is ``crop_missing``."""
    known = meta.select("id", F.when(F.col("crop") != "", F.col("crop")).alias("crop"))  # a NULL crop matches nothing
    joined = global_rank(crops.select("crop").distinct(), [F.col("crop")], "_place").join(known, "crop", "full")
    state = F.when(F.col("_place").isNull(), "crop_missing").when(F.col("id").isNull(), "no_metadata").otherwise("ok")
    number = F.coalesce("id", T.crop_event_id(F.col("crop")), F.lit(FALLBACK_ID - 1) + F.col("_place")).cast("long")
    return joined.select("crop", number.alias("event_id"), state.alias("state"))


def extract(jobs: DataFrame, extractor: Callable[[dict], str], schema_cols: list[str], retries: int = 2, pause: float = 1.0) -> DataFrame:
    """``jobs`` with the answer of ``extractor`` in ``raw_model_response``, errors in ``request_error`` and the ``latency_sec`` of all tries.

    A row that fails is tried again ``retries`` times, ``pause`` seconds later each; a failing row doesn't fail its batch."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in jobs.schema) + ", raw_model_response string, request_error string, latency_sec double"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            answers, errors, took = [], [], []
            for row in pdf[schema_cols].to_dict("records"):
                answer, error, began = None, None, time.perf_counter()
                for left in range(retries, -1, -1):
                    try:
                        answer, error = extractor(row), None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of the service is a row's error
                        error = f"request_failed: {type(e).__name__}: {e}"
                        if left:
                            time.sleep(pause)
                answers.append(answer)
                errors.append(error)
                took.append(time.perf_counter() - began)
            yield pdf.assign(raw_model_response=answers, request_error=errors, latency_sec=took)

    return jobs.mapInPandas(run, schema)


def parsed_rows(answers: DataFrame, text: str = "raw_model_response") -> DataFrame:
    """``answers`` with the fields of the JSON in ``text``."""
    return answers.withColumn("_p", P.extract_json(F.col(text))).select(*answers.columns, "_p.*")


def event_rows(events: DataFrame, answers: DataFrame, key: str = "event_id") -> DataFrame:
    """All ``events`` with their answer's fields; an event without an answer isn't lost but has ``vlm_skipped``."""
    joined = events.join(answers.withColumn("_a", F.lit(True)), key, "left")
    said = F.col("_a").isNotNull()
    return joined.withColumns({
        "parsed_ok": F.coalesce("parsed_ok", F.lit(False)), "fee_covered": F.coalesce("fee_covered", F.lit(False)), "needs_review": F.coalesce("needs_review", F.lit(True)),
        "model_error": F.when(~said, F.lit("vlm_skipped")).otherwise(F.coalesce("model_error", F.lit(""))),
    }).drop("_a")


def field_match(kind: str, a: Column, b: Column) -> Column:
    """Similarity of a predicted and a true field: booleans and numbers are equal or not, a ``flag`` too (NULL is false there), strings by blocks, a ``text`` on one line."""
    if kind == "text":
        return P.text_similarity(T.one_line(a), T.one_line(b))
    if kind == "string":
        return P.text_similarity(F.trim(a), F.trim(b))
    if kind == "flag":
        return F.when(F.coalesce(a, F.lit(False)) == F.coalesce(b, F.lit(False)), 1.0).otherwise(0.0)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(0.0)


#: Fields that an evaluation compares, and how.
COMPARED = {"donor": "string", "amount": "number", "currency": "string", "message": "text", "fee_covered": "flag"}


def compared(predictions: DataFrame, truth: DataFrame, fields: list[str] | None = None, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Predictions with ``sim_<field>`` against the truth of their ``file_name``, and the names without a truth.

    Of several truths of a name one counts, the greatest by its fields.  ``fields`` are all
    of :data:`COMPARED` by default; a prediction that failed has NULLs and stays in.

    A structure is sorted to find its greatest, so truths are spread over the ``parts`` (see
    :func:`parts_of`; the shuffle partitions by default) first, and no task sorts what it scans.
    The join merges: sizes that Spark guesses from compressed files would broadcast large sides."""
    fields, parts = fields or list(COMPARED), parts or parts_of(truth.sparkSession, 0)
    known = truth.select("file_name", *fields).repartition(parts, "file_name").groupBy("file_name").agg(F.max(F.struct(*fields)).alias("_t"))
    told = predictions.repartition(parts, "file_name").join(known.hint("merge"), "file_name", "left")
    pairs = told.where("_t IS NOT NULL").withColumns({f"sim_{c}": field_match(COMPARED[c], F.col(c), F.col(f"_t.{c}")) for c in fields})
    return pairs.drop("_t"), told.where("_t IS NULL").select("file_name")


def evaluation_summary(pairs: DataFrame, fields: list[str], latency: str | None = None) -> DataFrame:
    """Per field: share of exact rows and mean similarity, of ``sim_<field>`` columns; the share of rows with all right; and the mean of ``latency``."""
    one = lambda c: F.when(F.col(f"sim_{c}") == 1.0, 1.0).otherwise(0.0)
    every = F.lit(True)
    for c in fields:
        every = every & (F.col(f"sim_{c}") == 1.0)
    aggregates = [F.round(F.avg(one(c)), 6).alias(f"exact_{c}") for c in fields] + [F.round(F.avg(f"sim_{c}"), 6).alias(f"mean_{c}") for c in fields]
    if latency:
        aggregates.append(F.round(F.avg(latency), 6).alias("mean_latency"))
    return pairs.agg(F.count("*").alias("n"), F.round(F.avg(F.when(every, 1.0).otherwise(0.0)), 6).alias("all_correct"), *aggregates)


def reextracted(runs: DataFrame) -> DataFrame:
    """``file_name`` and fields of rows with a crop and an answer that is a JSON object."""
    some = runs.where((F.coalesce(F.col("crop_path"), F.lit("")) != "") & (F.coalesce(F.col("raw_model_response"), F.lit("")) != ""))
    found = some.withColumn("_p", P.extract_json(F.col("raw_model_response"))).where("_p.parsed_ok")
    return found.select(F.element_at(F.split("crop_path", "/"), -1).alias("file_name"), *[F.col(f"_p.{c}").alias(c) for c in "donor amount currency message fee_covered".split()])


def id_places(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``place``: ids that are whole numbers first, by value, then the others by text."""
    number = F.col(column).try_cast("long")
    return global_rank(rows, [number.isNull(), number, F.col(column)])


def span_rates(runs: DataFrame, key: str) -> DataFrame:
    """Per ``key``: best time, wall span of all workers and samples a second over it."""
    span = F.max("t1") - F.min("t0")
    return runs.groupBy(key).agg(F.min(F.col("t1") - F.col("t0")).alias("best_sec"), span.alias("span_sec"), F.sum("samples").alias("samples")).withColumn("rate", F.round(F.when(F.col("span_sec") > 0, F.col("samples") / F.col("span_sec")), 6))


def speedups(runs: DataFrame, key: str, seconds: str, base: str) -> DataFrame:
    """The best run of each ``key`` and how many times as fast as ``base`` it is (as the slowest, where ``base`` has no run)."""
    best = runs.groupBy(key).agg(F.min(seconds).alias("best_sec"))
    whole = Window.partitionBy()  # a row per key
    reference = F.coalesce(F.max(F.when(F.col(key) == base, F.col("best_sec"))).over(whole), F.max("best_sec").over(whole))
    return best.withColumn("speedup", F.round(F.when(F.col("best_sec") > 0, reference / F.col("best_sec")).otherwise(0.0), 6))


def best_setting(runs: DataFrame, setting: str, rate: str, need: float) -> DataFrame:
    """The setting of the highest rate (the least of equals), and how its rate stands to what is needed."""
    best = runs.agg(F.min_by(F.struct(setting, rate), F.struct(-F.col(rate), F.col(setting))).alias("b")).select("b.*")
    return best.withColumn("verdict", F.when(F.col(rate) >= 2 * need, "headroom").when(F.col(rate) >= need, "enough").otherwise("too slow"))


def residual_errors(pairs: DataFrame, fields: list[str], limit: float = 0.97, parts: int | None = None) -> DataFrame:
    """A row per field that is less similar than ``limit``, the worst first; ``pairs`` has ``file_name`` and ``sim_<field>``.

    They are sorted in ``parts`` ranges (see :func:`parts_of`; the shuffle partitions by default)."""
    order = ["similarity", "file_name", "field"]
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"sim_{f}").alias("similarity")) for f in fields])).alias("e")
    return pairs.select("file_name", each).select("file_name", "e.*").where(F.col("similarity") < limit).repartitionByRange(parts or parts_of(pairs.sparkSession, 0), *order).sortWithinPartitions(*order)


def run_counters(events: DataFrame) -> DataFrame:
    """One row: events, errors and duplicates of a finished run, in one pass."""
    return events.agg(F.count("*").alias("events"), F.count_if(F.coalesce("model_error", F.lit("")) != "").alias("error_events"), F.count_if(F.coalesce("is_duplicate", F.lit(False))).alias("duplicates"))


def whole_run_counters(events: DataFrame, detections: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """:func:`run_counters`, what the totals skip, and of ``detections`` (one at least a sampled frame) the frames and, from ``min_confidence`` on, the boxes."""
    zero = F.lit(0).cast("long")
    skipped = ~F.coalesce(F.col("is_duplicate"), F.lit(False)) & ~counted()
    per_frame = detections.groupBy("stream_id", "frame_idx").agg(F.count_if(F.col("confidence") >= min_confidence).alias("n"))
    found = [run_counters(events), events.agg(F.count_if(skipped).alias("skipped")), per_frame.agg(F.count("*").alias("frames"), F.coalesce(F.sum("n"), zero).alias("raw_detections"))]
    names = [c for f in found for c in f.columns]
    rows = [f.select(*[F.col(c) if c in f.columns else zero.alias(c) for c in names]) for f in found]
    return reduce(DataFrame.unionByName, rows).agg(*[F.sum(c).alias(c) for c in names])
