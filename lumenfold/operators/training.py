"""Samples of frames for detector training: five strategies, all deterministic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = tuple("best worst random uncertain negatives".split())


def _draw(seed: int, *cols: str) -> Column:
    """A number per row that looks random and is the same in every run (and in other databases)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def best_frames(scored: DataFrame, key: str = "stream_id") -> DataFrame:
    """The frame of the highest score of each event, the earliest of equals."""
    w = Window.partitionBy(key, "event_id").orderBy(F.desc("score"), "frame_idx", "det_seq")
    return scored.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def worst_frames(scored: DataFrame, n: int = 1, key: str = "stream_id") -> DataFrame:
    """The ``n`` frames of the lowest scores of each event, one row a frame."""
    frame = scored.groupBy(key, "event_id", "frame_idx").agg(F.min_by(F.struct("det_seq", "score"), F.struct("score", "det_seq")).alias("_m"))
    frame = frame.select(key, "event_id", "frame_idx", "_m.det_seq", "_m.score")
    w = Window.partitionBy(key, "event_id").orderBy("score", "frame_idx")
    return frame.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def random_frames(scored: DataFrame, seed: int = 0, key: str = "stream_id") -> DataFrame:
    """One frame of each event, drawn by hash."""
    frame = scored.groupBy(key, "event_id", "frame_idx").agg(F.max("score").alias("score"))
    w = Window.partitionBy(key, "event_id").orderBy(_draw(seed, key, "event_id", "frame_idx"), "frame_idx")
    return frame.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def stratified(frames: DataFrame, budget: int, total_frames: int, seed: int = 0, key: str = "stream_id") -> DataFrame:
    """One frame, drawn by hash, from each of ``budget`` equal stretches of a video.

    Without a known length (``total_frames`` 0) the ``budget`` frames of least hash of each video."""
    draw = _draw(seed, key, "frame_idx")
    if total_frames <= 0:
        w = Window.partitionBy(key).orderBy(draw, "frame_idx")
        return frames.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= budget).drop("_r")
    bucket = F.least(F.floor(F.col("frame_idx") * budget / total_frames), F.lit(budget - 1)).cast("int")
    w = Window.partitionBy(key, "bucket").orderBy(draw, "frame_idx")
    return frames.withColumn("bucket", bucket).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def uncertain_frames(detections: DataFrame, low: float = 0.25, high: float = 0.5, key: str = "stream_id") -> DataFrame:
    """Frames with a weak box; of several the most confident, the first of equals."""
    weak = detections.where((F.col("confidence") >= low) & (F.col("confidence") < high))
    best = F.max_by(F.struct("det_seq", "confidence"), F.struct("confidence", -F.col("det_seq")))
    return weak.groupBy(key, "frame_idx").agg(best.alias("_b")).select(key, "frame_idx", "_b.det_seq", "_b.confidence")


def negative_frames(frames: DataFrame, detections: DataFrame, low: float = 0.25, key: str = "stream_id") -> DataFrame:
    """Sampled frames without any box of at least ``low``."""
    return frames.select(key, "frame_idx").distinct().join(detections.where(F.col("confidence") >= low).select(key, "frame_idx").distinct(), [key, "frame_idx"], "left_anti")


def strategy_counts(manifest: DataFrame) -> DataFrame:
    """Rows of each strategy, 0 for those that have none."""
    every = manifest.sparkSession.createDataFrame([(i, s) for i, s in enumerate(STRATEGIES)], "place int, strategy string")
    n = manifest.groupBy("strategy").agg(F.count("*").alias("n"))
    return F.broadcast(every).join(n, "strategy", "left").select("strategy", "place", F.coalesce("n", F.lit(0)).alias("n"))


def manifest(samples: DataFrame, labels: DataFrame, video: str, key: str = "stream_id") -> DataFrame:
    """Rows of :data:`lumenfold.schemas.MANIFEST` of samples (``strategy, key, frame_idx``, box, scores), sorted by strategy and frame.

    Names are made of strategy, video and frame.  ``labels`` has ``key, frame_idx, num_boxes, label_text``; negatives have neither label boxes nor a preview."""
    from lumenfold.functions import geometry as G
    from lumenfold.functions import text as T

    place = F.array_position(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("strategy"))
    s = samples.join(labels, [key, "frame_idx"], "left").withColumn("place", F.when(place > 0, place).otherwise(len(STRATEGIES) + 1))
    stem = F.concat_ws("_", "strategy", F.col(key).cast("string"), F.format_string("%07d", "frame_idx"))
    drawn = F.col("strategy") != "negatives"
    box, w, h = G.box("x1", "y1", "x2", "y2"), F.col("frame_w"), F.col("frame_h")
    return s.orderBy("place", "frame_idx").select(
        F.concat(F.lit("images/"), stem, F.lit(".jpg")).alias("image"), "strategy", F.bround("confidence", 4).alias("confidence"), F.bround("score", 4).alias("select_score"), "event_id", "frame_idx",
        T.seconds_to_timestamp(F.col("timestamp_sec")).alias("time"), F.coalesce("num_boxes", F.lit(0)).cast("int").alias("num_boxes"), F.when(drawn, T.box_json(box)).alias("box_xyxy"), F.when(drawn, G.cxcywh(box, w, h)).alias("box_cxcywh"),
        "frame_w", "frame_h", F.concat(F.lit("labels/"), stem, F.lit(".txt")).alias("label"), F.when(drawn, F.concat(F.lit("previews/"), stem, F.lit(".jpg"))).alias("preview"), F.lit(video).alias("video"),
    )
