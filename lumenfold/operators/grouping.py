"""Detections to events: gap sessions, and the full matcher with its ordered state."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.operators.shared import checkpoint

Box = tuple[int, int, int, int]


@dataclass(frozen=True)
class Matching:
    """Thresholds of the matcher."""

    gap_sec: float = 3.0
    iou: float = 0.25
    center: float = 0.05
    split_height: float = 0.10
    heights: int = 5


@dataclass
class _Open:
    """An event that may still grow."""

    number: int
    box: Box
    frame: int
    end: float
    heights: list[int] = field(default_factory=list)


def _overlap(a: tuple, b: tuple) -> float:
    wide, high = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    area = lambda q: max(0, q[2] - q[0]) * max(0, q[3] - q[1])
    union = area(a) + area(b) - wide * high
    return wide * high / union if union > 0 else 0.0


def _apart(a: tuple, b: tuple, diagonal: float) -> float:
    dx, dy = (a[0] + a[2]) / 2 - (b[0] + b[2]) / 2, (a[1] + a[3]) / 2 - (b[1] + b[3]) / 2
    return sqrt(dx * dx + dy * dy) / diagonal


class Grouper:
    """Takes the detections of one video in order and numbers their events from 0."""

    def __init__(self, rules: Matching, number: int = 0, active: list[_Open] | None = None) -> None:
        self.rules, self.number, self.active = rules, number, active or []

    def close(self, now: float) -> None:
        """Events that ended more than the gap ago take no more detections."""
        self.active = [e for e in self.active if now - e.end <= self.rules.gap_sec]

    def add(self, frame: int, now: float, box: Box, width: int, height: int) -> int:
        self.close(now)
        rules, best, most = self.rules, None, -999.0
        tall, diagonal = box[3] - box[1], max(1.0, sqrt(width * width + height * height))
        for e in self.active:
            iou, far = _overlap(e.box, box), _apart(e.box, box, diagonal)
            if iou < rules.iou and (e.frame == frame or far > rules.center):
                continue  # within a frame only overlap counts
            if rules.split_height > 0 and e.heights:
                usual = sorted(e.heights)[len(e.heights) // 2]
                if usual > 0 and abs(tall - usual) > rules.split_height * usual:
                    continue  # another plaque in the same place
            if iou - far > most:
                best, most = e, iou - far
        if best is None:
            best = _Open(self.number, box, frame, now)
            self.number += 1
            self.active.append(best)
        best.box, best.frame, best.end = box, frame, now
        best.heights = (best.heights + [tall])[-rules.heights :]
        return best.number


def with_islands(detections: DataFrame, key: str, gap_sec: float, chunk: int = 100_000) -> DataFrame:
    """``island``: stretches of a video between which no event can live on, numbered in order of time.

    A video is worked on in stretches of ``chunk`` frames, so that one that never ends is
    no single task; a row per stretch tells how they go on."""
    own = detections.withColumn("_c", F.floor(F.col("frame_idx") / chunk))
    w = Window.partitionBy(key, "_c").orderBy("frame_idx", "det_seq")
    t, order = F.col("timestamp_sec"), F.struct("frame_idx", "det_seq")
    own = own.withColumn("_new", F.coalesce(t - F.lag("timestamp_sec").over(w) > gap_sec, F.lit(False)).cast("int"))
    chunks = own.groupBy(key, "_c").agg(F.min_by(t, order).alias("a"), F.max_by(t, order).alias("z"), F.sum("_new").alias("n"))
    along = Window.partitionBy(key).orderBy("_c")
    chunks = chunks.withColumn("n", F.col("n") + F.coalesce(F.col("a") - F.lag("z").over(along) > gap_sec, F.lit(True)).cast("int"))
    chunks = chunks.select(key, "_c", F.sum("n").over(along).alias("_upto"))
    last = Window.partitionBy(key, "_c").orderBy(F.desc("frame_idx"), F.desc("det_seq")).rowsBetween(Window.unboundedPreceding, -1)
    # islands up to the end of the stretch, without those that begin later in it
    return own.withColumn("_later", F.coalesce(F.sum("_new").over(last), F.lit(0))).join(chunks, [key, "_c"]).withColumn("island", F.col("_upto") - F.col("_later")).drop("_c", "_new", "_upto", "_later")


def group_events(detections: DataFrame, rules: Matching = Matching(), *, key: str = "stream_id", min_confidence: float = 0.5) -> DataFrame:
    """``detections`` of at least ``min_confidence`` with ``event_id``, numbered from 1 in each video.

    Islands are independent, so a long video is worked on in parallel: rows go to tasks
    by video and island, sorted by frame and place, and one pass of Python numbers the
    events; its result is checkpointed, so that both their count per island and the rows
    themselves come from that one pass.
    Needs the columns ``key, frame_idx, det_seq, timestamp_sec, x1, y1, x2, y2, frame_w, frame_h``."""
    own = with_islands(detections.where(F.col("confidence") >= min_confidence), key, rules.gap_sec)
    own = own.repartition(key, "island").sortWithinPartitions(key, "island", "frame_idx", "det_seq")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema) + ", local int"

    def number(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, grouper = None, Grouper(rules)
        for pdf in it:
            local = []
            for k, island, f, t, x1, y1, x2, y2, w, h in zip(*(pdf[c] for c in (key, "island", "frame_idx", "timestamp_sec", "x1", "y1", "x2", "y2", "frame_w", "frame_h"))):
                if at != (k, island):
                    at, grouper = (k, island), Grouper(rules)
                local.append(grouper.add(f, t, (x1, y1, x2, y2), w, h))
            yield pdf.assign(local=pd.array(local, dtype="int32"))

    found = checkpoint(own.mapInPandas(number, schema))
    before = found.groupBy(key, "island").agg((F.max("local") + 1).alias("n"))
    w = Window.partitionBy(key).orderBy("island").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(key, "island", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_before"))
    return found.join(before, [key, "island"]).withColumn("event_id", (F.col("_before") + F.col("local") + 1).cast("long")).drop("_before", "local")


def gap_sessions(detections: DataFrame, gap_sec: float = 3.0, *, key: str = "stream_id", min_confidence: float = 0.5) -> DataFrame:
    """``event_id`` by gaps alone: what the matcher does with one place and no height rule."""
    return with_islands(detections.where(F.col("confidence") >= min_confidence), key, gap_sec).withColumnRenamed("island", "event_id")


def fold_events(grouped: DataFrame, *, key: str = "stream_id") -> DataFrame:
    """A row per event; of equal confidences the latest gives time and frame."""
    order: Column = F.struct("confidence", "frame_idx", "det_seq")
    best = F.max_by(F.struct("timestamp_sec", "frame_idx"), order)
    return grouped.groupBy(key, "event_id").agg(
        F.min("timestamp_sec").alias("start_sec"), F.max("timestamp_sec").alias("end_sec"), F.min("frame_idx").alias("first_frame"), F.max("frame_idx").alias("last_frame"),
        F.count("*").alias("detections_count"), F.max("confidence").alias("best_confidence"), best.alias("_b"),
    ).select(key, *"event_id start_sec end_sec first_frame last_frame detections_count best_confidence".split(), F.col("_b.timestamp_sec").alias("best_timestamp_sec"), F.col("_b.frame_idx").alias("best_frame_idx"))


def top_candidates(grouped: DataFrame, keep: int = 1, *, key: str = "stream_id") -> DataFrame:
    """The ``keep`` best-scored detections of each event, earlier ones first among equals; ``rank`` from 1."""
    w = Window.partitionBy(key, "event_id").orderBy(F.desc("score"), "frame_idx", "det_seq")
    return grouped.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)
