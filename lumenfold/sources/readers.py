"""Readers of the files that a detection run leaves and an extraction run takes."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold import schemas as S
from lumenfold.functions import text as T


def sample_frames(frames: DataFrame, step: int = 10, limit: int = 0) -> DataFrame:
    """Every ``step``-th frame, and of each video the first ``limit`` of these (0: all); both reach the scan as filters."""
    kept = frames.where(F.col("frame_idx") % step == 0)
    return kept.where(F.col("frame_idx") < step * limit) if limit else kept


def probe_videos(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``video_name, path, width, height, fps, total_frames`` of the MP4 and AVI files of a folder that executors share.

    Only headers are read.  Where they don't tell, width and height are NULL, ``fps`` is 30 and ``total_frames`` 0."""
    from lumenfold.functions.media import probe

    names = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")

    def run(it):
        for pdf in it:
            found = [probe(p) for p in pdf["path"]]
            yield pd.DataFrame({"video_name": [p.rsplit("/", 1)[-1] for p in pdf["path"]], "path": pdf["path"], **{c: pd.array([f[k] for f in found], t) for k, (c, t) in enumerate((("width", "Int32"), ("height", "Int32"), ("fps", "float64"), ("total_frames", "int64")))}})

    return names.mapInPandas(run, "video_name string, path string, width int, height int, fps double, total_frames long")


def scan_videos(videos: DataFrame, step: int = 10, limit: int = 0, decode=None, batch: int = 8) -> DataFrame:
    """A row per sampled frame of ``videos`` (:func:`probe_videos`): ``video_name, path, frame_idx, timestamp_sec, frame_w, frame_h``.

    With ``decode(path, frame indexes)``, which yields the frames' bytes in that order (the
    codec is the caller's), there is a column ``data``; no more than ``batch`` frames of a
    video are held at a time.  A video of unknown length has no rows."""
    from pyspark.sql.types import BinaryType

    last = F.floor((F.col("total_frames") - 1) / step)
    last = F.least(last, F.lit(limit - 1)) if limit else last
    frames = videos.where("total_frames > 0").select("video_name", "path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"), "fps", "width", "height")
    frames = frames.select("video_name", "path", (F.col("k") * step).cast("int").alias("frame_idx"), (F.col("k") * step / F.col("fps")).alias("timestamp_sec"), F.col("width").alias("frame_w"), F.col("height").alias("frame_h"))
    if decode is None:
        return frames

    def run(it):
        for pdf in it:
            for path, part in pdf.groupby("path", sort=False):
                indexes = part["frame_idx"].tolist()
                found = iter(decode(path, indexes))
                for a in range(0, len(part), batch):
                    some = part.iloc[a : a + batch]
                    yield some.assign(data=[next(found) for _ in range(len(some))])

    return frames.repartition("path").sortWithinPartitions("path", "frame_idx").mapInPandas(run, frames.schema.add("data", BinaryType()))


def detect(frames: DataFrame, model, schema: str = S.DETECTIONS) -> DataFrame:
    """Table function of a detector: ``model()`` makes, once per task, a function from a pandas batch of frames to one of detections."""

    def run(it):
        detector = model()
        for pdf in it:
            yield detector(pdf)

    return frames.mapInPandas(run, schema)


def read_crops(spark: SparkSession, folder: str) -> DataFrame:
    """``crop, path, height, width, data`` of a folder's PNG files; ``height`` is -1 where one can't be decoded."""
    image = spark.read.format("image").option("pathGlobFilter", "*.png").load(folder).select("image.*")
    return image.select(F.element_at(F.split("origin", "/"), -1).alias("crop"), F.col("origin").alias("path"), "height", "width", "data")


def read_crop_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """``crop, url``: a data URL of each PNG file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("crop"), T.data_url(F.col("content")).alias("url"))


def find_sidecar(folder: str, name: str = "events_meta.jsonl") -> str | None:
    """The sidecar in a crop folder, its parent or its grandparent."""
    here = Path(folder)
    return next((str(d / name) for d in (here, here.parent, here.parent.parent) if (d / name).is_file()), None)


_META = "type string, id long, crop string, t string, " + S.ddl(S.FULL_META)


def sidecar_events(lines: DataFrame) -> DataFrame:
    """Events of a sidecar's lines (``value``, and ``line_no`` to tell which came last).

    Blank lines and run records are passed over; a record with ``event_id`` is a full one,
    else it has ``id, crop, t``; of several with one crop (without a crop: one id) the last counts."""
    r = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", _META)).where("coalesce(r.type, '') <> 'run'")
    full = F.col("r.event_id").isNotNull()
    crop = F.when(full, F.element_at(F.split(F.coalesce("r.crop_path", F.lit("")), "/"), -1)).otherwise(F.coalesce("r.crop", F.lit("")))
    r = r.withColumn("id", F.coalesce("r.event_id", "r.id")).withColumn("crop", crop).withColumn("start_time", F.when(full, F.col("r.start_time")).otherwise(F.col("r.t")))
    key = F.when(F.col("crop") == "", F.concat(F.lit("__no_crop_"), F.col("id").cast("string"))).otherwise(F.col("crop"))
    last = r.groupBy(key.alias("key")).agg(F.max_by(F.struct("id", "crop", "start_time", F.col("r.best_detection_confidence").alias("confidence")), F.col("line_no")).alias("m"))
    return last.select("key", "m.*")


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    numbered = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line_no"))
    return sidecar_events(numbered)


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """A finished run's CSV."""
    whole = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    types = {**S.FULL_META, **S.ANSWER}
    return whole.select(*[F.col(c).try_cast(types.get(c, "string")).alias(c) for c in whole.columns])


def read_detector_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of a detector's JSON document."""
    d = spark.read.schema(f"events array<struct<{', '.join(f'{a}: {b}' for a, b in _fields(S.DETECTOR_EVENT))}>>").json(path, multiLine=True)
    return d.select(F.explode("events").alias("e")).select("e.*")


def _fields(ddl: str) -> list[tuple[str, str]]:
    from pyspark.sql.types import StructType

    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)]


def detector_stream(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, summaries and unreadable lines of a detector's JSON lines (a batch or streaming table with ``value``)."""
    r = lines.withColumn("kind", F.get_json_object("value", "$.type"))
    event = r.where("kind = 'event'").select(F.from_json("value", S.DETECTOR_EVENT).alias("e")).select("e.*")
    summary = r.where("kind = 'summary'").select(F.from_json("value", "video_name string, fps double, total_frames long, sampled_frames_processed long, raw_detections long, events_count long").alias("s")).select("s.*")
    return event, summary, r.where("kind IS NULL AND trim(value) <> ''").select("value")


def the_summary(summaries: DataFrame) -> dict:
    """The last summary of a detector's lines (:func:`detector_stream`); without any the run is broken."""
    found = summaries.tail(1)
    if not found:
        raise RuntimeError("the detector ended without a summary")
    return found[0].asDict()


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth under ``donations`` or ``examples``."""
    row = "array<struct<file_name: string, donor: string, amount: double, currency: string, message: string, fee_covered: boolean>>"
    d = spark.read.schema(f"donations {row}, examples {row}").json(path, multiLine=True)
    return d.select(F.explode(F.coalesce("donations", "examples")).alias("t")).select("t.*")


def load_prompt(name: str, folder: str) -> str:
    """A prompt by version, or any file by path."""
    path = Path(name) if name.endswith(".txt") or "/" in name else Path(folder) / f"{name}.txt"
    if not path.is_file():
        raise FileNotFoundError(f"no prompt {name!r}; there are {sorted(p.stem for p in Path(folder).glob('*.txt'))}")
    return path.read_text(encoding="utf-8").strip()


class HttpExtractor:
    """Sends an image to a chat endpoint and returns the answer's text; for :func:`lumenfold.operators.rows.extract`."""

    FIELDS = {"donor": ["string", "null"], "amount": ["number", "null"], "currency": ["string", "null"], "message": ["string", "null"], "fee_covered": "boolean", "needs_review": "boolean"}

    def __init__(self, url: str, model: str, prompt: str, *, temperature: float = 0.0, max_tokens: int = 1024, timeout: float = 300.0) -> None:
        self.url, self.timeout = url, timeout
        self.payload = dict(model=model, max_tokens=max_tokens, temperature=temperature, response_format=self.answer_format())
        self.prompt = prompt

    def answer_format(self) -> dict:
        schema = {"type": "object", "properties": {k: {"type": t} for k, t in self.FIELDS.items()}, "required": list(self.FIELDS), "additionalProperties": False}
        return dict(type="json_schema", json_schema=dict(strict=True, name="donation", schema=schema))

    def body(self, url: str) -> bytes:
        image = dict(type="image_url", image_url=dict(url=url))
        message = dict(role="user", content=[dict(type="text", text=self.prompt), image])
        return json.dumps(self.payload | dict(messages=[message])).encode()

    def __call__(self, row: dict) -> str:
        from urllib.request import Request, urlopen

        with urlopen(Request(self.url, self.body(row["url"]), {"Content-Type": "application/json"}), timeout=self.timeout) as r:
            first = json.loads(r.read())["choices"][0]
            return first["message"]["content"]
