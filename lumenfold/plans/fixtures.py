"""Tables of the engine's schemas, derived from the generated ones by integer arithmetic; each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, HEIGHT, FPS = 1920, 1080, 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(div: str, double: str) -> dict[str, str]:
    """Select lists that differ between Spark and DuckDB in how they divide integers and write doubles."""
    k, kk = f"(event_id {div} 4)", f"(event_id {div} 8)"
    x1, y1 = "(100 + 900 * (user_id % 2) + (event_id * 7) % 5)", "(50 + (event_id * 3) % 4)"
    frame, conf = f"(10 * ({kk} + 12 * ({kk} {div} 9)))", f"((25 + CAST(floor(value * 100) AS BIGINT) % 75) / 100.0{double})"
    detections = f"""event_id % 4 AS stream_id, CAST({frame} AS INT) AS frame_idx, CAST({k} % 2 AS INT) AS det_seq, {frame} / 30.0{double} AS timestamp_sec, {WIDTH} AS frame_w, {HEIGHT} AS frame_h, 0 AS class_id,
 {conf} AS confidence, CAST({x1} AS INT) AS x1, CAST({y1} AS INT) AS y1, CAST({x1} + 400 AS INT) AS x2, CAST({y1} + 100 + 40 * (({kk} {div} 7) % 3) AS INT) AS y2"""
    user = "CAST(user_id % 40 AS VARCHAR(9))"
    donations = f"""event_id, CASE WHEN event_id % 10 = 0 THEN 'Аноним' WHEN event_id % 10 = 1 THEN concat(' USER_', {user}, ' ') ELSE concat('user_', {user}) END AS donor,
 CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 0.5{double} ELSE (user_id % 5 + 1) * 100.0{double} END AS amount,
 CASE event_type WHEN 'error' THEN 'rub' WHEN 'click' THEN 'RUB' WHEN 'view' THEN 'USD' WHEN 'signup' THEN 'EUR' END AS currency,
 CASE event_id % 7 WHEN 0 THEN '[ Ссылка  удалена ]' WHEN 1 THEN NULL WHEN 2 THEN 'Hello   World' ELSE 'hello world' END AS message,
 event_id % 17 <> 0 AS parsed_ok, event_id % 11 = 0 AS needs_review, {conf} AS best_detection_confidence"""
    amount = "CASE WHEN event_id % 6 = 3 THEN 'null' ELSE CAST((user_id % 5 + 1) * 100 AS VARCHAR(9)) END"
    body = f"""concat('{{"donor":"user_', {user}, '","amount":', {amount}, ',"currency":"RUB","message":"hi ', {user}, '","fee_covered":', CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, ',"needs_review":', CASE WHEN event_id % 6 = 4 THEN 'true' ELSE 'false' END, '}}')"""
    responses = f"""event_id, concat('crops/event_', CAST(event_id AS VARCHAR(20)), '_x.png') AS crop_path, CASE event_id % 6 WHEN 1 THEN concat('Answer: ', {body}, ' done') WHEN 2 THEN 'no json here' WHEN 5 THEN '' ELSE {body} END AS raw_model_response"""
    meta = "event_id AS id, CASE WHEN event_type = 'click' AND value < 0.1 THEN '' ELSE concat('event_', CAST(event_id AS VARCHAR(20)), '_best_detector_crop.png') END AS crop"
    return {"detections": detections, "donations": donations, "responses": responses, "meta": meta}


_SPARK, _DUCK = _sql("div", "D"), _sql("//", "::DOUBLE")


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``detections``, ``donations`` or ``responses`` of ``events``."""
    columns = _SPARK[name].replace("{", "{{").replace("}", "}}")
    return spark.sql(f"SELECT {columns} FROM {{e}}", e=table(spark, sf_dir, "events"))


def sql(name: str) -> str:
    """The same for DuckDB, as a subquery."""
    return f"(SELECT {_DUCK[name]} FROM events)"


_CROP = "concat(CASE WHEN event_type = 'error' THEN 'extra_' ELSE 'event_' END, CAST(event_id AS VARCHAR(20)), CASE WHEN event_type = 'error' THEN '.png' ELSE '_best_detector_crop.png' END) AS crop"


def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crop file of every event; those of errors have names without a number."""
    return spark.sql(f"SELECT {_CROP} FROM {{e}}", e=table(spark, sf_dir, "events"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every event but views, some without a crop; and so some names that no crop has."""
    return spark.sql(f"SELECT {_SPARK['meta']} FROM {{e}} WHERE event_type <> 'view'", e=table(spark, sf_dir, "events"))


CROPS_SQL = f"(SELECT {_CROP} FROM events)"
META_SQL = f"(SELECT {_DUCK['meta']} FROM events WHERE event_type <> 'view')"
