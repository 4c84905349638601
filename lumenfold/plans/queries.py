"""Queries over the derived tables, one per operator, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfold.functions import geometry as G
from lumenfold.functions import python as P
from lumenfold.functions import text as T
from lumenfold.operators import dedup, grouping, ocr, rows, training
from lumenfold.plans import fixtures as X
from lumenfold.plans import runs
from lumenfold.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _detections(spark: SparkSession, d: str) -> DataFrame:
    return X.build(spark, d, "detections")


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    return _detections(spark, d).withColumn("b", G.box("x1", "y1", "x2", "y2")).withColumns({"w": F.col("frame_w"), "h": F.col("frame_h")})


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Gap sessions with a candidate score (sharpness from the place of the box)."""
    s = grouping.gap_sessions(_detections(spark, d)).withColumn("b", G.box("x1", "y1", "x2", "y2"))
    padded = G.expand_box(F.col("b"), F.col("frame_w"), F.col("frame_h"))
    score = G.candidate_score(F.col("confidence"), F.col("b"), padded, (F.col("x1") + F.col("y1")).cast("double"), F.col("frame_w"), F.col("frame_h"))
    return s.withColumn("score", F.round(score, 6))


_DET = X.sql("detections")
_SESSIONS = f"""det AS (SELECT * FROM {_DET} WHERE confidence >= 0.5),
lagged AS (SELECT *, CASE WHEN timestamp_sec - lag(timestamp_sec) OVER w <= 3.0 THEN 0 ELSE 1 END AS new FROM det WINDOW w AS (PARTITION BY stream_id ORDER BY frame_idx, det_seq)),
ses AS (SELECT *, (sum(new) OVER (PARTITION BY stream_id ORDER BY frame_idx, det_seq))::BIGINT AS event_id FROM lagged)"""
_PAD = "greatest(0, x1 - 20) AS px1, greatest(0, y1 - 12) AS py1, least(frame_w - 1, x2 + 20) AS px2, least(frame_h - 1, y2 + 12) AS py2"
_SCORE = """round(confidence + least((x2 - x1)::BIGINT * (y2 - y1) / (frame_w * frame_h)::DOUBLE * 10, 0.3::DOUBLE) + least((x1 + y1)::DOUBLE / 500, 0.4::DOUBLE)
 + CASE WHEN (px1 <= 0 AND x1 > 0) OR (py1 <= 0 AND y1 > 0) OR (px2 >= frame_w - 1 AND x2 < frame_w - 1) OR (py2 >= frame_h - 1 AND y2 < frame_h - 1) THEN -0.15::DOUBLE ELSE 0 END, 6)"""
_SCORED = f"{_SESSIONS}, padded AS (SELECT *, {_PAD} FROM ses), scored AS (SELECT *, {_SCORE} AS score FROM padded)"

_KEYS = """raw AS (SELECT *, lower(coalesce(trim(regexp_replace(donor, '\\s+', ' ', 'g')), '')) AS dn,
 lower(regexp_replace(coalesce(trim(regexp_replace(message, '\\s+', ' ', 'g')), ''), '(?i)[{\\[(]\\s*(?:ссылка)\\s+удалена\\s*[}\\])]', '(ссылка удалена)', 'g')) AS mn,
 CASE WHEN upper(trim(coalesce(currency, ''))) = 'NO_CURRENCY' THEN '' ELSE upper(trim(coalesce(currency, ''))) END AS cn FROM """ + X.sql("donations") + """)"""  # fmt: skip
_DEDUP = _KEYS + """, ok AS (SELECT *, parsed_ok AND amount IS NOT NULL AND (dn NOT IN ('', 'аноним', 'анонім', 'anonymous', 'anon') OR mn NOT IN ('', 'link removed', 'сообщение удалено', '(ссылка удалена)', 'ссылка удалена')) AS el FROM raw),
fin AS (SELECT *, el AND event_id > min(event_id) OVER (PARTITION BY el, dn, amount, cn, mn) AS is_duplicate, min(event_id) OVER (PARTITION BY el, dn, amount, cn, mn) AS f FROM ok)"""
_COUNTED = "(parsed_ok AND NOT needs_review AND best_detection_confidence >= 0.5 AND amount IS NOT NULL)"


@query(f"WITH {_DEDUP} SELECT coalesce(currency, 'NO_CURRENCY') AS currency, count(*) AS events_count, count(*) AS amount_count, round(sum(amount), 2) AS amount_sum FROM fin WHERE NOT is_duplicate AND {_COUNTED} GROUP BY 1")
def totals_by_currency(spark: SparkSession, d: str) -> DataFrame:
    return dedup.totals_by_currency(dedup.dedup_donations(X.build(spark, d, "donations")))


@query(f"WITH {_DEDUP} SELECT count(*) FILTER (NOT is_duplicate AND NOT {_COUNTED}) AS skipped, count(*) FILTER (is_duplicate) AS duplicates FROM fin")
def totals_skipped(spark: SparkSession, d: str) -> DataFrame:
    return dedup.totals_skipped(dedup.dedup_donations(X.build(spark, d, "donations")))


@query(f"WITH {_DEDUP} SELECT event_id, is_duplicate, CASE WHEN is_duplicate THEN f END AS duplicate_of_event_id FROM fin")
def dedup_flags(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_donations(X.build(spark, d, "donations")).select("event_id", "is_duplicate", "duplicate_of_event_id")


@query(f"WITH {_KEYS} SELECT event_id, dn AS donor, mn AS message, cn AS currency, amount FROM raw")
def normalize_fields(spark: SparkSession, d: str) -> DataFrame:
    r = X.build(spark, d, "donations")
    return r.select("event_id", T.normalize_donor(F.col("donor")).alias("donor"), T.normalize_message(F.col("message")).alias("message"), T.normalize_currency(F.col("currency")).alias("currency"), T.normalize_amount(F.col("amount")).alias("amount"))


@query("SELECT doc_id, doc_id > f AS is_duplicate, CASE WHEN doc_id > f THEN f END AS duplicate_of FROM (SELECT doc_id, CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) END AS f FROM documents)")
def document_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_documents(X.table(spark, d, "documents"))


@query(f"SELECT DISTINCT stream_id, frame_idx FROM {_DET} WHERE frame_idx % 20 = 0")
def frame_sampling(spark: SparkSession, d: str) -> DataFrame:
    return readers.sample_frames(_detections(spark, d), 20).select("stream_id", "frame_idx").distinct()


@query(f"SELECT DISTINCT stream_id, frame_idx FROM {_DET} WHERE frame_idx % 10 = 0 AND frame_idx < 10 * 50")
def max_processed_frames(spark: SparkSession, d: str) -> DataFrame:
    return readers.sample_frames(_detections(spark, d), 10, 50).select("stream_id", "frame_idx").distinct()


@query(f"SELECT stream_id, count(*) FILTER (confidence >= 0.5) AS confident, count(*) FILTER (confidence >= 0.25 AND confidence < 0.5) AS uncertain FROM {_DET} GROUP BY stream_id")
def conf_split(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("confidence")
    return _detections(spark, d).groupBy("stream_id").agg(F.count_if(c >= 0.5).alias("confident"), F.count_if((c >= 0.25) & (c < 0.5)).alias("uncertain"))


@query(f"SELECT stream_id, frame_idx, det_seq, (x2 - x1)::BIGINT * (y2 - y1) AS area, y2 - y1 AS height, px1, py1, px2, py2 FROM (SELECT *, {_PAD} FROM {_DET})")
def box_geometry(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("b")
    p = _boxes(spark, d).withColumn("p", G.expand_box(b, F.col("w"), F.col("h")))
    return p.select("stream_id", "frame_idx", "det_seq", G.box_area(b).alias("area"), G.box_height(b).alias("height"), *[F.col(f"p.{c}").alias(f"p{c}") for c in ("x1", "y1", "x2", "y2")])


_LAG = "lag({0}) OVER w AS l{0}"
_OVERLAP = "greatest(0, least(x2, lx2) - greatest(x1, lx1))::BIGINT * greatest(0, least(y2, ly2) - greatest(y1, ly1))"


@query(f"""WITH l AS (SELECT *, {', '.join(_LAG.format(c) for c in ('x1', 'y1', 'x2', 'y2'))} FROM {_DET} WINDOW w AS (PARTITION BY stream_id ORDER BY frame_idx, det_seq))
SELECT stream_id, frame_idx, det_seq, round(({_OVERLAP})::DOUBLE / ((x2 - x1) * (y2 - y1) + (lx2 - lx1) * (ly2 - ly1) - {_OVERLAP}), 6) AS iou,
 round(sqrt(((x1 + x2) / 2.0::DOUBLE - (lx1 + lx2) / 2.0::DOUBLE) ** 2 + ((y1 + y2) / 2.0::DOUBLE - (ly1 + ly2) / 2.0::DOUBLE) ** 2) / sqrt((frame_w * frame_w + frame_h * frame_h)::DOUBLE), 6) AS dist FROM l WHERE lx1 IS NOT NULL""")
def pairwise_iou_dist(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("stream_id").orderBy("frame_idx", "det_seq")
    p = _boxes(spark, d).withColumn("l", F.lag("b").over(w)).where("l IS NOT NULL")
    return p.select("stream_id", "frame_idx", "det_seq", F.round(G.box_iou(F.col("b"), F.col("l")), 6).alias("iou"), F.round(G.center_distance(F.col("b"), F.col("l"), F.col("w"), F.col("h")), 6).alias("dist"))


@query(f"""SELECT stream_id, frame_idx, det_seq, coalesce(list_sort(hs)[len(hs) // 2 + 1], 0)::INT AS reference FROM (SELECT *, list(y2 - y1) OVER (PARTITION BY stream_id ORDER BY frame_idx, det_seq ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS hs FROM {_DET})""")
def reference_height_last5(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("stream_id").orderBy("frame_idx", "det_seq").rowsBetween(-5, -1)
    return _boxes(spark, d).withColumn("hs", F.collect_list(G.box_height(F.col("b"))).over(w)).select("stream_id", "frame_idx", "det_seq", G.reference_height(F.col("hs")).alias("reference"))


@query(f"WITH {_SCORED} SELECT stream_id, event_id, frame_idx, det_seq, score FROM scored")
def candidate_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("stream_id", "event_id", "frame_idx", "det_seq", "score")


_PIX = "list_transform(embedding, lambda v: (floor(abs(v) * 1000)::INT % 256))"
_AT = "p[1 + 8 * ({}) + ({})]"
_M = lambda i: f"(CASE WHEN {i} < 0 THEN 1 WHEN {i} > 7 THEN 6 ELSE {i} END)"


@query(f"""WITH px AS (SELECT vec_id, {_PIX} AS p FROM embeddings),
v AS (SELECT vec_id, list_transform(range(64), lambda k: {_AT.format(_M('(k // 8 - 1)'), 'k % 8')} + {_AT.format(_M('(k // 8 + 1)'), 'k % 8')} + {_AT.format('k // 8', _M('(k % 8 - 1)'))} + {_AT.format('k // 8', _M('(k % 8 + 1)'))} - 4 * {_AT.format('k // 8', 'k % 8')}) AS l FROM px)
SELECT vec_id, (64 * list_sum(list_transform(l, lambda x: x * x)) - list_sum(l) ** 2) / 4096.0::DOUBLE AS variance FROM v""")
def laplacian_variance(spark: SparkSession, d: str) -> DataFrame:
    tile = F.transform("embedding", lambda v: F.floor(F.abs(v) * F.lit(1000).cast("float")).cast("int") % 256)  # floats, as in SQL; an integer would make doubles of them
    return X.table(spark, d, "embeddings").select("vec_id", P.tile_sharpness(tile).alias("variance"))


_SHARE = "printf('%.6f %.6f %.6f %.6f', (x1 + x2) / 2.0::DOUBLE / frame_w, (y1 + y2) / 2.0::DOUBLE / frame_h, (x2 - x1)::DOUBLE / frame_w, (y2 - y1)::DOUBLE / frame_h)"


@query(f"SELECT stream_id, frame_idx, det_seq, {_SHARE} AS cxcywh FROM {_DET}")
def cxcywh(spark: SparkSession, d: str) -> DataFrame:
    return _boxes(spark, d).select("stream_id", "frame_idx", "det_seq", G.cxcywh(F.col("b"), F.col("w"), F.col("h")).alias("cxcywh"))


@query(f"SELECT stream_id, frame_idx, string_agg(class_id || ' ' || {_SHARE}, chr(10) ORDER BY det_seq, x1, y1) AS label FROM {_DET} WHERE confidence >= 0.5 GROUP BY ALL")
def yolo_labels(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat_ws(" ", F.col("class_id").cast("string"), G.cxcywh(F.col("b"), F.col("w"), F.col("h")))
    return _boxes(spark, d).where("confidence >= 0.5").groupBy("stream_id", "frame_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("det_seq", "x1", "y1", line.alias("line")))), lambda s: s["line"]), "\n").alias("label"))


@query(f"SELECT stream_id, frame_idx, least(greatest(trunc((x1 * 0.3::DOUBLE + 4 - 4) / 0.3::DOUBLE)::INT, 0), frame_w - 1) AS x FROM {_DET}")
def unletterbox(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("x1") * F.lit(0.3) + 4
    return _detections(spark, d).select("stream_id", "frame_idx", G.unletterbox(x, F.lit(4), F.lit(0.3), F.col("frame_w")).alias("x"))


@query(f"WITH {_SESSIONS} SELECT stream_id, frame_idx, det_seq, event_id FROM ses")
def gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    return grouping.gap_sessions(_detections(spark, d)).select("stream_id", "frame_idx", "det_seq", "event_id")


# one step per detection of a stream; the open events travel as a list of structs
_GROUPED = f"""RECURSIVE det AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY frame_idx, det_seq) AS place FROM {_DET} WHERE confidence >= 0.5),
st AS (SELECT DISTINCT stream_id, 0::BIGINT AS place, NULL::INT AS frame_idx, NULL::INT AS det_seq, 0::BIGINT AS n, NULL::BIGINT AS event_id,
  []::STRUCT(num BIGINT, x1 INT, y1 INT, x2 INT, y2 INT, frame INT, t DOUBLE, hs INT[])[] AS o FROM det
 UNION ALL
 SELECT stream_id, place, frame_idx, det_seq, n + CASE WHEN hit IS NULL THEN 1 ELSE 0 END, coalesce(hit, n + 1),
  CASE WHEN hit IS NULL THEN list_append(o, struct_pack(num := n + 1, x1 := x1, y1 := y1, x2 := x2, y2 := y2, frame := frame_idx, t := timestamp_sec, hs := [y2 - y1]))
   ELSE list_transform(o, lambda e: CASE WHEN e.num = hit THEN struct_pack(num := e.num, x1 := x1, y1 := y1, x2 := x2, y2 := y2, frame := frame_idx, t := timestamp_sec, hs := list_append(e.hs, y2 - y1)[-5:]) ELSE e END) END
 FROM (SELECT *, list_filter(ok, lambda e: e.gain = list_max(list_transform(ok, lambda q: q.gain)))[1].num AS hit
  FROM (SELECT *, list_filter(list_transform(far, lambda e: struct_pack(num := e.num, gain := CASE WHEN (e.iou < 0.25 AND (e.frame = frame_idx OR e.dist > 0.05))
    OR (list_sort(e.hs)[len(e.hs) // 2 + 1] > 0 AND abs(y2 - y1 - list_sort(e.hs)[len(e.hs) // 2 + 1]) > 0.10::DOUBLE * list_sort(e.hs)[len(e.hs) // 2 + 1]) THEN NULL ELSE e.iou - e.dist END)), lambda e: e.gain IS NOT NULL) AS ok
   FROM (SELECT *, list_transform(pairs, lambda e: struct_pack(num := e.num, frame := e.frame, hs := e.hs, dist := e.dist, iou := e.i::DOUBLE / ((x2 - x1)::BIGINT * (y2 - y1) + (e.x2 - e.x1)::BIGINT * (e.y2 - e.y1) - e.i))) AS far
    FROM (SELECT *, list_transform(o, lambda e: struct_pack(num := e.num, frame := e.frame, hs := e.hs, x1 := e.x1, y1 := e.y1, x2 := e.x2, y2 := e.y2,
      dist := sqrt(((e.x1 + e.x2) / 2.0::DOUBLE - (x1 + x2) / 2.0::DOUBLE) ** 2 + ((e.y1 + e.y2) / 2.0::DOUBLE - (y1 + y2) / 2.0::DOUBLE) ** 2) / sqrt((frame_w * frame_w + frame_h * frame_h)::DOUBLE),
      i := greatest(0, least(x2, e.x2) - greatest(x1, e.x1))::BIGINT * greatest(0, least(y2, e.y2) - greatest(y1, e.y1)))) AS pairs
     FROM (SELECT d.*, st.n, list_filter(st.o, lambda e: d.timestamp_sec - e.t <= 3.0::DOUBLE) AS o FROM st JOIN det d ON d.stream_id = st.stream_id AND d.place = st.place + 1))))))"""


@query(f"WITH {_GROUPED} SELECT stream_id, frame_idx, det_seq, event_id FROM st WHERE place > 0")
def group_events(spark: SparkSession, d: str) -> DataFrame:
    return grouping.group_events(_detections(spark, d)).select("stream_id", "frame_idx", "det_seq", "event_id")


@query(f"""WITH {_SESSIONS}, m AS (SELECT *, row_number() OVER (PARTITION BY stream_id, event_id ORDER BY confidence DESC, frame_idx DESC, det_seq DESC) AS r FROM ses)
SELECT stream_id, event_id, min(timestamp_sec) AS start_sec, max(timestamp_sec) AS end_sec, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame, count(*) AS detections_count, max(confidence) AS best_confidence,
 max(timestamp_sec) FILTER (r = 1) AS best_timestamp_sec, max(frame_idx) FILTER (r = 1) AS best_frame_idx FROM m GROUP BY ALL""")
def event_fold(spark: SparkSession, d: str) -> DataFrame:
    return grouping.fold_events(grouping.gap_sessions(_detections(spark, d)))


@query(f"WITH {_SCORED} SELECT stream_id, event_id, frame_idx, det_seq, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY stream_id, event_id ORDER BY score DESC, frame_idx, det_seq) AS rank FROM scored) WHERE rank <= 3")
def top_k_candidates(spark: SparkSession, d: str) -> DataFrame:
    return grouping.top_candidates(_scored(spark, d), 3).select("stream_id", "event_id", "frame_idx", "det_seq", "score", "rank")


@query(f"WITH {_SCORED} SELECT stream_id, event_id, frame_idx, det_seq, score FROM scored QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY score DESC, frame_idx, det_seq) = 1")
def train_best(spark: SparkSession, d: str) -> DataFrame:
    return training.best_frames(_scored(spark, d)).select("stream_id", "event_id", "frame_idx", "det_seq", "score")


_FRAMES = "fr AS (SELECT stream_id, event_id, frame_idx, min(score) AS low, max(score) AS high FROM scored GROUP BY ALL)"


@query(f"WITH {_SCORED}, {_FRAMES} SELECT stream_id, event_id, frame_idx, low AS score FROM fr QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY low, frame_idx) <= 2")
def train_worst(spark: SparkSession, d: str) -> DataFrame:
    return training.worst_frames(_scored(spark, d), 2).select("stream_id", "event_id", "frame_idx", "score")


@query(f"WITH {_SCORED}, {_FRAMES} SELECT stream_id, event_id, frame_idx, high AS score FROM fr QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY md5(concat_ws(':', '0', stream_id, event_id, frame_idx)), frame_idx) = 1")
def train_random(spark: SparkSession, d: str) -> DataFrame:
    return training.random_frames(_scored(spark, d))


_WEAK = f"weak AS (SELECT stream_id, frame_idx, det_seq, confidence FROM {_DET} WHERE confidence >= 0.25 AND confidence < 0.5 QUALIFY row_number() OVER (PARTITION BY stream_id, frame_idx ORDER BY confidence DESC, det_seq) = 1)"


@query(f"WITH {_WEAK} SELECT *, least(frame_idx * 20 // 6000, 19)::INT AS bucket FROM weak QUALIFY row_number() OVER (PARTITION BY stream_id, least(frame_idx * 20 // 6000, 19) ORDER BY md5(concat_ws(':', '0', stream_id, frame_idx)), frame_idx) = 1")
def train_uncertain(spark: SparkSession, d: str) -> DataFrame:
    return training.stratified(training.uncertain_frames(_detections(spark, d)), 20, 6000).select("stream_id", "frame_idx", "det_seq", "confidence", "bucket")


@query(f"""WITH neg AS (SELECT DISTINCT stream_id, frame_idx FROM {_DET} EXCEPT SELECT stream_id, frame_idx FROM {_DET} WHERE confidence >= 0.6)
SELECT stream_id, frame_idx FROM neg QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY md5(concat_ws(':', '0', stream_id, frame_idx)), frame_idx) <= 50""")
def train_negatives(spark: SparkSession, d: str) -> DataFrame:
    det = _detections(spark, d)
    return training.stratified(training.negative_frames(det, det, low=0.6), 50, 0).select("stream_id", "frame_idx")


_WEAKS = "SELECT *, least(frame_idx * 20 // 6000, 19)::INT AS bucket FROM weak QUALIFY row_number() OVER (PARTITION BY stream_id, least(frame_idx * 20 // 6000, 19) ORDER BY md5(concat_ws(':', '0', stream_id, frame_idx)), frame_idx) = 1"
_SAMPLES = f"""{_WEAK}, {_SCORED}, {_FRAMES}, samples AS (
SELECT 'best' AS strategy, stream_id, event_id, frame_idx, score FROM scored QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY score DESC, frame_idx, det_seq) = 1
UNION ALL SELECT 'worst', stream_id, event_id, frame_idx, low FROM fr QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY low, frame_idx) <= 2
UNION ALL SELECT 'random', stream_id, event_id, frame_idx, high FROM fr QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY md5(concat_ws(':', '0', stream_id, event_id, frame_idx)), frame_idx) = 1
UNION ALL SELECT 'uncertain', stream_id, NULL, frame_idx, confidence FROM ({_WEAKS})
UNION ALL SELECT 'negatives', stream_id, NULL, frame_idx, NULL FROM (SELECT stream_id, frame_idx FROM (SELECT DISTINCT stream_id, frame_idx FROM {_DET}) ANTI JOIN (SELECT DISTINCT stream_id, frame_idx FROM {_DET} WHERE confidence >= 0.25) USING (stream_id, frame_idx)
  QUALIFY row_number() OVER (PARTITION BY stream_id, least(frame_idx * 20 // 6000, 19) ORDER BY md5(concat_ws(':', '0', stream_id, frame_idx)), frame_idx) = 1))"""
_COLLECT = runs.RunConfig(strategies=training.STRATEGIES, budget=20, worst_per_event=2)


def _samples(spark: SparkSession, d: str) -> DataFrame:
    det = _detections(spark, d)
    return runs.training_samples(_scored(spark, d), det, det, _COLLECT, total_frames=6000)


@query(f"WITH {_SAMPLES} SELECT strategy, stream_id, event_id, frame_idx, score FROM samples")
def train_samples(spark: SparkSession, d: str) -> DataFrame:
    return _samples(spark, d)


@query(f"WITH {_SAMPLES} SELECT strategy, place, count(stream_id) AS n FROM (VALUES ('best', 0), ('worst', 1), ('random', 2), ('uncertain', 3), ('negatives', 4)) v(strategy, place) LEFT JOIN samples USING (strategy) GROUP BY ALL")
def train_strategy_counts(spark: SparkSession, d: str) -> DataFrame:
    return training.strategy_counts(_samples(spark, d))


_HMS = "printf('%02d:%02d:%06.3f', floor({0})::BIGINT // 3600, floor({0})::BIGINT // 60 % 60, {0} - floor({0} / 60) * 60)"


@query(f"""WITH {_SCORED}, best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY stream_id, event_id ORDER BY score DESC, frame_idx, det_seq) = 1),
boxes AS (SELECT stream_id, frame_idx, count(*)::INT AS n FROM {_DET} WHERE confidence >= 0.5 GROUP BY ALL), b AS (SELECT best.*, n, concat('best_', stream_id, '_', printf('%07d', frame_idx)) AS stem FROM best LEFT JOIN boxes USING (stream_id, frame_idx))
SELECT concat('images/', stem, '.jpg') AS image, 'best' AS strategy, confidence, round_even(score, 4) AS select_score, event_id, frame_idx, {_HMS.format("timestamp_sec")} AS "time", coalesce(n, 0)::INT AS num_boxes,
 concat('[', x1, ',', y1, ',', x2, ',', y2, ']') AS box_xyxy, {_SHARE} AS box_cxcywh, frame_w, frame_h, concat('labels/', stem, '.txt') AS label, concat('previews/', stem, '.jpg') AS preview, 'v.mp4' AS video FROM b""")
def train_manifest(spark: SparkSession, d: str) -> DataFrame:
    labels = _detections(spark, d).where("confidence >= 0.5").groupBy("stream_id", "frame_idx").agg(F.count("*").alias("num_boxes"))
    samples = training.best_frames(_scored(spark, d)).withColumn("strategy", F.lit("best"))
    return training.manifest(samples, labels, "v.mp4")


@query(f"""WITH c AS (SELECT crop, row_number() OVER (ORDER BY crop) - 1 AS place FROM (SELECT DISTINCT crop FROM {X.CROPS_SQL})), m AS (SELECT id, nullif(crop, '') AS crop FROM {X.META_SQL})
SELECT coalesce(c.crop, m.crop) AS crop, coalesce(m.id, TRY_CAST(regexp_extract(c.crop, 'event_([0-9]+)_', 1) AS BIGINT), 1000000000 + place)::BIGINT AS event_id,
 CASE WHEN c.crop IS NULL THEN 'crop_missing' WHEN m.id IS NULL THEN 'no_metadata' ELSE 'ok' END AS state FROM c FULL JOIN m ON c.crop = m.crop""")
def crop_meta_full_join(spark: SparkSession, d: str) -> DataFrame:
    return rows.crop_jobs(X.crops(spark, d), X.meta(spark, d))


_JSON = "regexp_extract(raw_model_response, '\\{.*\\}', 0)"
_PARSED = f"""r AS (SELECT event_id, crop_path, nullif({_JSON}, '') AS j FROM {X.sql('responses')}),
p AS (SELECT event_id, crop_path, j IS NOT NULL AS parsed_ok, j ->> '$.donor' AS donor, (j ->> '$.amount')::DOUBLE AS amount, j ->> '$.currency' AS currency, j ->> '$.message' AS message, coalesce((j ->> '$.fee_covered')::BOOLEAN, false) AS fee_covered, coalesce((j ->> '$.needs_review')::BOOLEAN, true) AS needs_review FROM r)"""


@query(f"WITH {_PARSED} SELECT * EXCLUDE (crop_path) FROM p")
def extract_json(spark: SparkSession, d: str) -> DataFrame:
    return rows.parsed_rows(X.build(spark, d, "responses")).select(*"event_id parsed_ok donor amount currency message fee_covered needs_review".split())


@query(f"""WITH {_PARSED}, a AS (SELECT p.* FROM p JOIN {X.sql('responses')} r USING (event_id) WHERE r.raw_model_response <> '')
SELECT e.event_id, coalesce(parsed_ok, false) AS parsed_ok, donor, amount, coalesce(fee_covered, false) AS fee_covered, coalesce(needs_review, true) AS needs_review, CASE WHEN a.event_id IS NULL THEN 'vlm_skipped' ELSE '' END AS model_error
FROM events e LEFT JOIN a USING (event_id)""")
def event_rows_defaults(spark: SparkSession, d: str) -> DataFrame:
    answers = rows.parsed_rows(X.build(spark, d, "responses").where("raw_model_response <> ''")).withColumn("model_error", F.lit(None).cast("string"))  # an empty answer is none
    return rows.event_rows(X.table(spark, d, "events").select("event_id"), answers).select("event_id", "parsed_ok", "donor", "amount", "fee_covered", "needs_review", "model_error")


_RAW = """CASE event_type WHEN 'click' THEN '"false"' WHEN 'view' THEN 'true' WHEN 'error' THEN '1' WHEN 'signup' THEN 'null' ELSE '"true"' END"""


@query("SELECT event_id, true AS parsed_ok, event_type = 'view' AS fee_covered, event_type = 'view' AS needs_review FROM events")
def answer_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags count where they are ``true`` itself, and not a text or a number that looks like it."""
    e = X.table(spark, d, "events").selectExpr("event_id", f"""concat('{{"needs_review": ', {_RAW}, ', "fee_covered": ', {_RAW}, '}}') AS raw_model_response""")
    return rows.parsed_rows(e).select("event_id", "parsed_ok", "fee_covered", "needs_review")


_TRUTH = f"(SELECT concat('event_', event_id, '_x.png') AS file_name, concat('user_', user_id % 40) AS donor, (user_id % 5 + 1) * 100.0::DOUBLE AS amount, user_id % 3 = 0 AS fee_covered FROM events WHERE event_type <> 'view')"
_LOOKUP = f"""{_PARSED}, k AS (SELECT file_name, max(struct_pack(donor := donor, amount := amount, fee_covered := fee_covered)) AS t FROM {_TRUTH} GROUP BY 1),
m AS (SELECT regexp_extract(crop_path, '[^/]*$', 0) AS file_name, p.*, t FROM p LEFT JOIN k ON k.file_name = regexp_extract(crop_path, '[^/]*$', 0))"""


def _parts(spark: SparkSession, d: str) -> int:
    """For the answers and the truths, one of each an event at most; the number of events is in the footers of their files."""
    return rows.parts_of(spark, 2 * X.table(spark, d, "events").count())


def _compared(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    said = rows.parsed_rows(X.build(spark, d, "responses")).withColumn("file_name", F.element_at(F.split("crop_path", "/"), -1))
    e, user = X.table(spark, d, "events").where("event_type <> 'view'"), F.col("user_id")
    truth = e.select(F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit("_x.png")).alias("file_name"), F.concat(F.lit("user_"), (user % 40).cast("string")).alias("donor"), ((user % 5 + 1) * 100).cast("double").alias("amount"), (user % 3 == 0).alias("fee_covered"))
    return rows.compared(said, truth, ["amount", "fee_covered"], _parts(spark, d))


@query(f"WITH {_LOOKUP} SELECT file_name, CASE WHEN amount IS NULL THEN 0.0::DOUBLE WHEN amount = t.amount THEN 1 ELSE 0 END AS sim_amount, CASE WHEN fee_covered = t.fee_covered THEN 1.0::DOUBLE ELSE 0 END AS sim_fee_covered FROM m WHERE t IS NOT NULL")
def truth_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d)[0].select("file_name", "sim_amount", "sim_fee_covered")


@query(f"WITH {_LOOKUP} SELECT file_name FROM m WHERE t IS NULL")
def truth_missing(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d)[1]


@query(f"WITH {_LOOKUP}, s AS (SELECT file_name, unnest([struct_pack(f := 'amount', v := CASE WHEN amount IS NULL THEN 0.0::DOUBLE WHEN amount = t.amount THEN 1 ELSE 0 END), struct_pack(f := 'fee_covered', v := CASE WHEN fee_covered = t.fee_covered THEN 1.0::DOUBLE ELSE 0 END)]) AS e FROM m WHERE t IS NOT NULL) SELECT file_name, e.f AS field, e.v AS similarity FROM s WHERE e.v < 0.97")
def residual_errors(spark: SparkSession, d: str) -> DataFrame:
    return rows.residual_errors(_compared(spark, d)[0], ["amount", "fee_covered"], parts=_parts(spark, d))


@query(f"""WITH {_DEDUP}, c AS (SELECT count(*) AS events, count(*) FILTER (NOT parsed_ok) AS error_events, count(*) FILTER (is_duplicate) AS duplicates, count(*) FILTER (NOT is_duplicate AND NOT {_COUNTED}) AS skipped FROM fin)
SELECT events, error_events, duplicates, skipped, (SELECT count(DISTINCT (stream_id, frame_idx)) FROM {_DET}) AS frames, (SELECT count(*) FROM {_DET} WHERE confidence >= 0.5) AS raw_detections FROM c""")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    done = dedup.dedup_donations(X.build(spark, d, "donations")).withColumn("model_error", F.when(~F.col("parsed_ok"), "json_parse_failed").otherwise(""))
    return rows.whole_run_counters(done, _detections(spark, d))


@query(f"WITH {_PARSED} SELECT regexp_extract(crop_path, '[^/]*$', 0) AS file_name, donor, amount, currency, message, fee_covered FROM p WHERE parsed_ok")
def reextract_examples(spark: SparkSession, d: str) -> DataFrame:
    return rows.reextracted(X.build(spark, d, "responses"))


_T = "(event_id * 7919 % 90000) / 8.0::DOUBLE"


@query(f"SELECT event_id, printf('%02d:%02d:%06.3f', floor({_T})::BIGINT // 3600, floor({_T})::BIGINT // 60 % 60, {_T} - floor({_T} / 60) * 60) AS t FROM events")
def timestamps(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "events").select("event_id", T.seconds_to_timestamp(F.col("event_id") * 7919 % 90000 / F.lit(8.0)).alias("t"))


@query("SELECT event_id, coalesce(nullif(substr(regexp_replace(regexp_replace(props, '[^A-Za-z0-9а-яА-ЯёЁ._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 90), ''), 'run') AS name FROM events")
def safe_filename(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "events").select("event_id", T.safe_filename(F.col("props")).alias("name"))


@query("SELECT event_id, (event_id % 8) & 1 > 0 AS crops, (event_id % 8) & 2 > 0 AS annotated, (event_id % 8) & 4 > 0 AS original FROM events")
def images_mask(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "events").select("event_id", T.image_kinds((F.col("event_id") % 8).cast("int")).alias("k")).select("event_id", "k.*")


@query(f"SELECT crop, TRY_CAST(regexp_extract(crop, 'event_([0-9]+)_', 1) AS BIGINT) AS event_id FROM {X.CROPS_SQL}")
def crop_id_regex(spark: SparkSession, d: str) -> DataFrame:
    return X.crops(spark, d).select("crop", T.crop_event_id(F.col("crop")).alias("event_id"))


_MIXED = "CASE WHEN event_id % 3 = 0 THEN concat('x', event_id::VARCHAR) ELSE event_id::VARCHAR END"


@query(f"SELECT id, row_number() OVER (ORDER BY TRY_CAST(id AS BIGINT) IS NULL, TRY_CAST(id AS BIGINT), id) AS place FROM (SELECT {_MIXED} AS id FROM events)")
def id_sort(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("event_id").cast("string")
    return rows.id_places(X.table(spark, d, "events").select(F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), s)).otherwise(s).alias("id")), "id")


@query("""WITH p AS (SELECT o_totalprice AS g, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN o_totalprice + 1 ELSE o_totalprice END AS q, o_orderkey % 2 = 0 AS gb, o_orderkey % 6 = 0 AS qb FROM orders),
s AS (SELECT CASE WHEN q IS NULL THEN 0.0::DOUBLE WHEN q = g THEN 1 ELSE 0 END AS sim_amount, CASE WHEN gb = qb THEN 1.0::DOUBLE ELSE 0 END AS sim_fee FROM p)
SELECT count(*) AS n, round(avg(CASE WHEN sim_amount = 1 AND sim_fee = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS all_correct, round(avg(sim_amount), 6) AS exact_amount, round(avg(sim_amount), 6) AS mean_amount, round(avg(sim_fee), 6) AS exact_fee, round(avg(sim_fee), 6) AS mean_fee FROM s""")
def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    o, k = X.table(spark, d, "orders"), F.col("o_orderkey")
    pred = F.when(k % 5 == 1, F.col("o_totalprice") + 1).when(k % 5 != 0, F.col("o_totalprice"))
    pairs = o.select(rows.field_match("number", pred, F.col("o_totalprice")).alias("sim_amount"), rows.field_match("bool", k % 6 == 0, k % 2 == 0).alias("sim_fee"))
    return rows.evaluation_summary(pairs, ["amount", "fee"])


@query()
def eval_text_similarity(spark: SparkSession, d: str) -> DataFrame:
    o = X.table(spark, d, "orders")
    edited = F.when(F.col("o_orderkey") % 5 == 0, F.regexp_replace("o_orderpriority", "-", "  ")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", F.round(rows.field_match("text", edited, F.col("o_orderpriority")), 6).alias("similarity"))


@query("SELECT event_id AS id, concat('event_', event_id::VARCHAR, '.png') AS crop, concat('t', event_id::VARCHAR) AS start_time FROM events")
def events_meta_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id").cast("string")
    events = X.table(spark, d, "events").select("event_id", F.concat(F.lit("event_"), n, F.lit(".png")).alias("crop_path"), F.concat(F.lit("t"), n).alias("start_time"))
    lines = sinks.sidecar_lines(events, {"meta": "minimal", "video": "v"}).select("value", F.col("place").alias("line_no"))
    return readers.sidecar_events(lines).select("id", "crop", "start_time")


@query("SELECT o_orderpriority AS engine, min(b - a) AS best_sec, max(b) - min(a) AS span_sec, sum(s)::BIGINT AS samples, round(sum(s) / (max(b) - min(a)), 6) AS rate FROM (SELECT o_orderpriority, (o_orderkey % 97)::DOUBLE AS a, (o_orderkey % 97 + 1 + o_custkey % 13)::DOUBLE AS b, o_custkey % 100 AS s FROM orders) GROUP BY 1")
def bench_span_aggregate(spark: SparkSession, d: str) -> DataFrame:
    o = X.table(spark, d, "orders")
    runs = o.select(F.col("o_orderpriority").alias("engine"), (F.col("o_orderkey") % 97).cast("double").alias("t0"), (F.col("o_orderkey") % 97 + 1 + F.col("o_custkey") % 13).cast("double").alias("t1"), (F.col("o_custkey") % 100).alias("samples"))
    return rows.span_rates(runs, "engine")


_BEST = "(SELECT o_orderpriority AS engine, min((1 + o_custkey % 13 + o_orderkey % 7)::DOUBLE + length(o_orderpriority)) AS best_sec FROM orders GROUP BY 1)"


@query(f"SELECT engine, best_sec, round((SELECT best_sec FROM {_BEST} WHERE engine = '5-LOW') / best_sec, 6) AS speedup FROM {_BEST}")
def engine_speedups(spark: SparkSession, d: str) -> DataFrame:
    sec = (F.lit(1) + F.col("o_custkey") % 13 + F.col("o_orderkey") % 7).cast("double") + F.length("o_orderpriority")
    return rows.speedups(X.table(spark, d, "orders").select(F.col("o_orderpriority").alias("engine"), sec.alias("sec")), "engine", "sec", "5-LOW")


@query("WITH r AS (SELECT o_orderdate AS setting, round(sum(o_custkey % 100) / 7.0::DOUBLE, 6) AS rate FROM orders GROUP BY 1) SELECT setting, rate, CASE WHEN rate >= 40 THEN 'headroom' WHEN rate >= 20 THEN 'enough' ELSE 'too slow' END AS verdict FROM r ORDER BY rate DESC, setting LIMIT 1")
def sweep_best(spark: SparkSession, d: str) -> DataFrame:
    """The setting of the highest rate: a report of one row."""
    r = X.table(spark, d, "orders").groupBy(F.col("o_orderdate").alias("setting")).agg(F.round(F.sum(F.col("o_custkey") % 100) / 7.0, 6).alias("rate"))
    return rows.best_setting(r, "setting", "rate", 20.0)


# a recognizer's answer of two lines in wrong order, one of them in two blocks and repeated with less confidence
_ANSWER = """concat('{"rec_texts": ["hello ', event_id, '", "user_', user_id % 40, '", "- ', (user_id % 5 + 1) * 100, ' RUB", "user_', user_id % 40, '"], "rec_scores": [0.9, 0.8, 0.7, 0.6], "rec_polys": [[[10, 60], [90, 60], [90, 70], [10, 70]], [[10, 20], [40, 20], [40, 30], [10, 30]], [[50, 21], [90, 21], [90, 31], [50, 31]], [[10, 20], [40, 20], [40, 30], [10, 30]]]}')"""


@query("SELECT event_id, 3 AS n_blocks, concat('user_', user_id % 40, ' - ', (user_id % 5 + 1) * 100, ' RUB') AS first, concat('hello ', event_id) AS second FROM events")
def ocr_lines(spark: SparkSession, d: str) -> DataFrame:
    r = X.table(spark, d, "events").selectExpr("event_id", f"{_ANSWER} AS result", "100 AS height")
    read = ocr.read_results(r, "result", "height")
    return read.select("event_id", F.size("blocks").alias("n_blocks"), F.col("lines")[0].alias("first"), F.col("lines")[1].alias("second"))


@query("""SELECT event_id, concat('user_', user_id % 40) AS donor, CASE WHEN event_type = 'error' THEN '' ELSE ((user_id % 5 + 1) * 100)::VARCHAR END AS amount,
 CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN 'USD' WHEN 'click' THEN 'RUB' WHEN 'signup' THEN '€' ELSE 'RUB' END AS currency, concat('hello ', event_id) AS message FROM events""")
def ocr_rules(spark: SparkSession, d: str) -> DataFrame:
    """The rule parser on plaques whose parts are known: amounts with five currencies, or none."""
    sign = "CASE event_type WHEN 'view' THEN 'usd' WHEN 'click' THEN 'руб.' WHEN 'signup' THEN '€' ELSE 'р' END"
    first = f"concat('user_', user_id % 40, CASE WHEN event_type = 'error' THEN '' ELSE concat(' - ', (user_id % 5 + 1) * 100, ' ', {sign}) END)"
    return ocr.parsed_plaques(X.table(spark, d, "events").selectExpr("event_id", f"array({first}, concat('hello ', event_id)) AS lines"), "lines").drop("lines")


@query("SELECT event_id, TRY_CAST(replace(replace(regexp_extract(l, '([0-9][0-9 ]*(?:[.,][0-9]{1,2})?) *(?:RUB|USD|EUR)', 1), ' ', ''), ',', '.') AS DOUBLE) AS amount FROM (SELECT event_id, concat('user - ', (event_id % 9)::VARCHAR, ' 5', (event_id % 10)::VARCHAR, '0', CASE WHEN event_id % 2 = 0 THEN ',50' ELSE '' END, CASE event_id % 3 WHEN 0 THEN ' RUB' WHEN 1 THEN ' USD' ELSE ' points' END) AS l FROM events)")
def ocr_amount_parse(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    line = F.concat(F.lit("user - "), (n % 9).cast("string"), F.lit(" 5"), (n % 10).cast("string"), F.lit("0"), F.when(n % 2 == 0, ",50").otherwise(""), F.when(n % 3 == 0, " RUB").when(n % 3 == 1, " USD").otherwise(" points"))
    return X.table(spark, d, "events").select("event_id", T.amount_of_line(line).alias("amount"))
