"""Events of a detection stream, each emitted once it can't grow any more."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lumenfold.operators.grouping import Grouper, Matching, _Open

#: Stream seconds are counted from here: a row at the epoch itself would be late from the start.
BASE_US = 86_400_000_000
EVENT = "stream_id long, event_id long, start_sec double, end_sec double, first_frame int, last_frame int, detections_count long, best_confidence double, best_timestamp_sec double, best_frame_idx int"
STATE = "state string"


def with_event_time(detections: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """``event_time`` from ``timestamp_sec``, with a watermark; rows later than ``delay`` are dropped."""
    micros = F.round(F.col("timestamp_sec") * 1e6).cast("long") + BASE_US
    return detections.withColumn("event_time", F.timestamp_micros(micros)).withWatermark("event_time", delay)


def group_stream(detections: DataFrame, rules: Matching = Matching(), *, min_confidence: float = 0.5, delay: str = "10 seconds") -> DataFrame:
    """Closed events of a streaming ``detections`` table (a row with a NULL ``frame_idx`` ends its video).

    Rows wait in the state until the watermark has passed them, are taken in order of
    frame and place, and an event is emitted when the stream is past its end by more than
    the gap.  A video's end marker, or the watermark passing its last open event, closes it."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = json.loads(state.get[0]) if state.exists else {"number": 0, "open": [], "rows": [], "ended": False}
        if not state.hasTimedOut:
            for pdf in batches:
                s["ended"] = s["ended"] or bool(pdf["frame_idx"].isna().any())
                cols = ["frame_idx", "det_seq", "timestamp_sec", "confidence", "x1", "y1", "x2", "y2", "frame_w", "frame_h"]
                s["rows"] += [[x.item() if hasattr(x, "item") else x for x in r] for r in pdf.loc[pdf["frame_idx"].notna(), cols].itertuples(index=False)]
        now = (state.getCurrentWatermarkMs() * 1000 - BASE_US) / 1e6
        s["rows"].sort(key=lambda r: (r[0], r[1]))
        ready = s["rows"] if s["ended"] else [r for r in s["rows"] if r[2] < now]
        s["rows"] = s["rows"][len(ready) :]
        events = {e["number"]: e for e in s["open"]}
        grouper = Grouper(rules, s["number"], [_Open(e["number"], tuple(e["box"]), e["last_frame"], e["end"], e["heights"]) for e in s["open"]])
        done = []

        def close(alive: set[int]) -> None:
            done.extend(events.pop(n) for n in sorted(set(events) - alive))

        for f, seq, t, conf, x1, y1, x2, y2, w, h in ready:
            n = grouper.add(int(f), t, (int(x1), int(y1), int(x2), int(y2)), int(w), int(h))
            e = events.setdefault(n, {"number": n, "start": t, "first_frame": int(f), "count": 0, "best": -1.0})
            e |= {"end": t, "last_frame": int(f), "count": e["count"] + 1}
            if conf >= e["best"]:
                e |= {"best": conf, "best_t": t, "best_frame": int(f)}
            close({a.number for a in grouper.active})
        if s["ended"]:
            grouper.active = []
        elif not s["rows"]:
            grouper.close(now)
        close({a.number for a in grouper.active})
        for a in grouper.active:
            events[a.number] |= {"box": list(a.box), "heights": a.heights}
        if events or s["rows"] or not s["ended"]:
            s |= {"number": grouper.number, "open": list(events.values())}
            state.update((json.dumps(s),))
            wait = [r[2] for r in s["rows"]] or [a.end + rules.gap_sec for a in grouper.active]
            if wait:
                state.setTimeoutTimestamp(max(int((max(wait) * 1e6 + BASE_US) / 1000) + 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        names = [c.split()[0] for c in EVENT.split(", ")]
        if done:
            yield pd.DataFrame([(key[0], e["number"] + 1, e["start"], e["end"], e["first_frame"], e["last_frame"], e["count"], e["best"], e["best_t"], e["best_frame"]) for e in done], columns=names)

    kept = with_event_time(detections.where((F.col("confidence") >= min_confidence) | F.col("frame_idx").isNull()), delay)
    return kept.groupBy("stream_id").applyInPandasWithState(step, EVENT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def gap_sessions_stream(detections: DataFrame, *, gap: str = "3 seconds", min_confidence: float = 0.5, delay: str = "10 seconds") -> DataFrame:
    """Sessions by gaps alone, with built-in session windows."""
    kept = with_event_time(detections.where(F.col("confidence") >= min_confidence), delay)
    w = F.session_window("event_time", gap)
    return kept.groupBy("stream_id", w).agg(F.min("timestamp_sec").alias("start_sec"), F.max("timestamp_sec").alias("end_sec"), F.count("*").alias("detections_count"))
