"""Whole runs: detections to reports, and the extraction stage over finished crops."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold import schemas as S
from lumenfold.functions import geometry as G
from lumenfold.functions import text as T
from lumenfold.operators import dedup, grouping, rows, training
from lumenfold.operators.grouping import Matching
from lumenfold.sources import readers, sinks


@dataclass(frozen=True)
class RunConfig:
    """Settings of a run; checked when it is made."""

    min_confidence: float = 0.5
    frame_step: int = 10
    max_frames: int = 0
    pad_x: int = 20
    pad_y: int = 12
    keep_top: int = 1
    matching: Matching = field(default_factory=Matching)
    strategies: tuple[str, ...] = ()
    uncertain_min: float = 0.25
    budget: int = 200
    worst_per_event: int = 1
    engine: str = "python"
    max_tokens: int = 1024
    timeout: float = 300.0
    retries: int = 2

    def __post_init__(self) -> None:
        for name in ("frame_step", "keep_top", "budget", "worst_per_event", "max_tokens", "timeout"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.engine not in ("python", "native"):
            raise ValueError("engine must be python or native")
        if self.engine == "native" and self.strategies:
            raise ValueError("the native engine keeps no candidates, so that it can't collect training data")
        if unknown := set(self.strategies) - set(training.STRATEGIES):
            raise ValueError(f"unknown strategies: {sorted(unknown)}")
        if "uncertain" in self.strategies and not 0 < self.uncertain_min < self.min_confidence:
            raise ValueError("uncertain_min must lie between 0 and min_confidence")

    def extractor(self, url: str, model: str, prompt: str) -> readers.HttpExtractor:
        """What asks a model server, with the run's limits."""
        return readers.HttpExtractor(url, model, prompt, max_tokens=self.max_tokens, timeout=self.timeout)

    @property
    def detect_confidence(self) -> float:
        """What a detector has to report."""
        return self.uncertain_min if "uncertain" in self.strategies else self.min_confidence


def detected(frames: DataFrame, model: Callable, config: RunConfig = RunConfig()) -> DataFrame:
    """Detections of the sampled frames that the run needs (of weak ones too, where a strategy wants them)."""
    found = readers.detect(readers.sample_frames(frames, config.frame_step, config.max_frames), model)
    return found.where(F.col("confidence") >= config.detect_confidence)


def training_samples(scored: DataFrame, detections: DataFrame, frames: DataFrame, config: RunConfig, total_frames: int = 0, seed: int = 0) -> DataFrame:
    """``strategy, stream_id, event_id, frame_idx, score`` of the run's strategies: from scored detections of events, weak ones and sampled frames."""
    weak = training.uncertain_frames(detections, config.uncertain_min, config.min_confidence)
    none = training.negative_frames(frames, detections, config.detect_confidence)
    of = {
        "best": lambda: training.best_frames(scored), "worst": lambda: training.worst_frames(scored, config.worst_per_event), "random": lambda: training.random_frames(scored, seed),
        "uncertain": lambda: training.stratified(weak, config.budget, total_frames, seed).withColumnRenamed("confidence", "score"), "negatives": lambda: training.stratified(none, config.budget, total_frames, seed),
    }
    columns = {"event_id": "long", "score": "double"}
    parts = []
    for name in config.strategies:
        part = of[name]()
        more = [F.col(c) if c in part.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
        parts.append(part.select(F.lit(name).alias("strategy"), "stream_id", more[0], "frame_idx", more[1]))
    return reduce(DataFrame.unionByName, parts)


def detector_rows(detections: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """A row per event with the fields known before extraction (``S.FULL_META``); ``detections`` may have ``sharpness_var``.

    Detections whose padded box is empty are passed over.  Confidence is the event's best, while time, frame, score and boxes are those of its best-scored detection."""
    if "sharpness_var" not in detections.columns:
        detections = detections.withColumn("sharpness_var", F.lit(0.0))
    w, h = F.col("frame_w"), F.col("frame_h")
    padded = G.expand_box(G.box("x1", "y1", "x2", "y2"), w, h, config.pad_x, config.pad_y)
    some = detections.where((padded["x2"] > padded["x1"]) & (padded["y2"] > padded["y1"]))
    grouped = grouping.group_events(some, config.matching, min_confidence=config.min_confidence).withColumn("b", G.box("x1", "y1", "x2", "y2"))
    grouped = grouped.withColumn("p", G.expand_box(F.col("b"), w, h, config.pad_x, config.pad_y))
    grouped = grouped.withColumn("score", G.candidate_score(F.col("confidence"), F.col("b"), F.col("p"), F.col("sharpness_var"), w, h))
    best = grouping.top_candidates(grouped, 1).select("stream_id", "event_id", F.col("timestamp_sec").alias("_t"), F.col("frame_idx").alias("_f"), "score", "b", "p")
    e = grouping.fold_events(grouped).join(best, ["stream_id", "event_id"])
    return e.select(
        "event_id", F.col("stream_id").cast("string").alias("video_name"), T.seconds_to_timestamp(F.col("start_sec")).alias("start_time"), T.seconds_to_timestamp(F.col("end_sec")).alias("end_time"),
        T.seconds_to_timestamp(F.col("end_sec") - F.col("start_sec")).alias("duration"), "first_frame", "last_frame", "detections_count", F.bround("best_confidence", 4).alias("best_detection_confidence"),
        T.seconds_to_timestamp(F.col("_t")).alias("best_detection_time"), F.col("_f").alias("best_detection_frame"), F.bround("score", 4).alias("best_detection_score"),
        T.box_json(F.col("b")).alias("base_box_json"), T.box_json(F.col("p")).alias("padded_box_json"), F.format_string("event_%04d_best_detector_crop.png", "event_id").alias("crop_path"),
    )


def reports(events: DataFrame, answers: DataFrame | None, folder: str, run: dict, *, overwrite: bool = False) -> dict:
    """Writes the reports of a run into ``folder`` and returns its counters.

    ``answers`` has ``event_id, raw_model_response``; without it every event is ``vlm_skipped``."""
    out = sinks.prepare_folder(folder, overwrite)
    spark = events.sparkSession
    if answers is None:
        answers = spark.createDataFrame([], "event_id long, raw_model_response string")
    table = str(Path(folder) / "event_rows.parquet")  # written once, so that nothing is extracted twice
    dedup.dedup_donations(rows.event_rows(events, rows.parsed_rows(answers))).write.parquet(table)
    done = spark.read.parquet(table)
    counts = dedup.totals_skipped(done).first()
    names = [c for c in (*S.FULL_META, *S.ANSWER) if c in done.columns]
    n = sinks.write_csv(done.select(*names).orderBy("event_id"), str(out / "events_summary.csv"))
    sinks.write_csv(dedup.totals_by_currency(done).orderBy("currency"), str(out / "totals_by_currency.csv"))
    jsonl = done.select(F.col("crop_path").alias("file_name"), "parsed_ok", F.col("model_error").alias("error"), *S.JSONL[3:], "event_id").orderBy("event_id").drop("event_id")
    sinks.write_jsonl(jsonl, str(out / "donations.jsonl"))
    sinks.write_sidecar(done, run, str(out / "events_meta.jsonl"), full=run.get("meta") == "full")
    info = run | {"events_count": n, "duplicates": counts["duplicates"], "skipped": counts["skipped"]}
    sinks.write_info(str(out / "run_metadata.json"), info)
    return info


def extraction_stage(crops: DataFrame, meta: DataFrame, extractor: Callable[[dict], str], *, concurrency: int = 8, retries: int = 2, pause: float = 1.0) -> DataFrame:
    """``event_id, crop, state, raw_model_response, request_error, latency_sec`` of finished crops; ``crops`` has ``crop, url``.

    ``concurrency`` tasks ask at a time; metadata without a crop keeps its row.  Neither crops nor metadata is an error."""
    if crops.isEmpty() and meta.isEmpty():
        raise FileNotFoundError("there are neither crops nor metadata, so there is nothing to extract")
    jobs = rows.crop_jobs(crops, meta).join(crops, "crop", "left").repartition(concurrency)
    ready = rows.extract(jobs.where("url IS NOT NULL"), extractor, ["crop", "url"], retries, pause)
    lost = jobs.where("url IS NULL").withColumns({"latency_sec": F.lit(None).cast("double"), "raw_model_response": F.lit(None).cast("string"), "request_error": F.when(F.col("state") == "crop_missing", "crop_missing").otherwise("crop_load_failed")})
    return ready.unionByName(lost).drop("url")
