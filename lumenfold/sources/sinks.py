"""Report writers.  Tables are written by Spark; the single named files are streamed by the driver from sorted rows."""

from __future__ import annotations

import csv
import json
import shutil
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold import schemas as S

UTF8 = {"encoding": "utf-8"}


def prepare_folder(path: str, overwrite: bool = False) -> Path:
    """An output folder; one that isn't empty is removed with ``overwrite`` and an error without."""
    p = Path(path)
    if p.exists() and any(p.iterdir()):
        if not overwrite:
            raise FileExistsError(f"{p} is not empty")
        shutil.rmtree(p)
    p.mkdir(parents=True, exist_ok=True)
    return p


def write_csv(rows: DataFrame, path: str, *, header_if_empty: bool = False) -> int:
    """One CSV file; without rows an empty one (or the header alone).  Rows come from the executors one partition at a time."""
    n = 0
    with open(path, "w", newline="", **UTF8) as f:
        w = csv.writer(f)
        for row in rows.toLocalIterator():
            if not n:
                w.writerow(rows.columns)
            w.writerow(list(row))
            n += 1
        if not n and header_if_empty:
            w.writerow(rows.columns)
    return n


def write_jsonl(rows: DataFrame, path: str) -> int:
    """One JSON object per line, nulls kept, other scripts unescaped."""
    n = 0
    with open(path, "w", **UTF8) as f:
        for row in rows.toLocalIterator():
            f.write(json.dumps(row.asDict(recursive=True), ensure_ascii=False) + "\n")
            n += 1
    return n


def write_csv_table(rows: DataFrame, path: str) -> None:
    """A folder of CSV parts, for any size; booleans as ``True`` and ``False``."""
    cols = [F.initcap(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c) for c, t in rows.dtypes]
    rows.select(*cols).write.mode("overwrite").csv(path, header=True, escape='"')


def write_jsonl_table(rows: DataFrame, path: str) -> None:
    """A folder of JSON-lines parts, nulls kept."""
    rows.write.mode("overwrite").json(path, ignoreNullFields=False)


def sidecar_lines(events: DataFrame, run: dict, *, full: bool = False) -> DataFrame:
    """``place, value``: the run record, then a JSON line per event."""
    spark = events.sparkSession
    record = spark.createDataFrame([(-1, json.dumps({"type": "run", **run}, ensure_ascii=False))], "place long, value string")
    minimal = [F.col("event_id").alias("id"), F.element_at(F.split("crop_path", "/"), -1).alias("crop"), F.col("start_time").alias("t")]
    fields = [F.col(c) for c in S.FULL_META] if full else minimal
    return record.unionByName(events.select(F.col("event_id").alias("place"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")))


def write_sidecar(events: DataFrame, run: dict, path: str, *, full: bool = False) -> None:
    with open(path, "w", **UTF8) as f:
        for row in sidecar_lines(events, run, full=full).orderBy("place").toLocalIterator():
            f.write(row["value"] + "\n")


def write_examples(rows: DataFrame, path: str) -> int:
    """``{"donations": [...]}`` of extracted examples."""
    n = 0
    with open(path, "w", **UTF8) as f:
        f.write('{"donations": [')
        for row in rows.toLocalIterator():
            f.write(("," if n else "") + "\n" + json.dumps(row.asDict(), ensure_ascii=False))
            n += 1
        f.write("\n]}\n")
    return n


def write_info(path: str, info: dict) -> None:
    text = json.dumps(info, indent=2, ensure_ascii=False)
    Path(path).write_text(f"{text}\n", **UTF8)


def write_files(rows: DataFrame, folder: str, name: str, content: str) -> None:
    """A file per row, written by the executors into a folder that they share."""
    def write(it: Iterable) -> None:
        for row in it:
            data = row[content]
            (Path(folder) / row[name]).write_bytes(data.encode() if isinstance(data, str) else bytes(data))

    Path(folder).mkdir(parents=True, exist_ok=True)
    rows.select(name, content).foreachPartition(write)
