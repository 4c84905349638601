"""Grouping, dedup, joins, samples, files and streams."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from lumenfold import schemas as S
from lumenfold.operators import dedup, grouping, rows, training
from lumenfold.operators.grouping import Grouper, Matching
from lumenfold.plans import runs
from lumenfold.sources import readers, sinks
from lumenfold.streaming import events as stream


def video(seed=0, videos=3, frames=120):
    """Two slots that move, disappear and change height."""
    rng, out = random.Random(seed), []
    for v in range(videos):
        for f in range(frames):
            if rng.random() < 0.25 or (f // 17) % 3 == 2:
                continue
            for s in range(rng.randrange(3)):
                x, y, tall = 100 + 900 * s + rng.randrange(40), 50 + rng.randrange(6), 100 + 40 * ((f // 9) % 2)
                out.append((v, f * 10, s, f * 10 / 10.0, 1920, 1080, 0, round(rng.uniform(0.2, 0.99), 2), x, y, x + 300, y + tall))
    return out


def brute_group(rows_, rules, conf=0.5):
    """Events by the rules as they are told, one list of all events per video."""
    out = {}
    for v in {r[0] for r in rows_}:
        events = []
        for r in sorted((r for r in rows_ if r[0] == v and r[7] >= conf), key=lambda r: (r[1], r[2])):
            box, t, frame = r[8:12], r[3], r[1]
            best, most = None, -999.0
            for e in events:
                if t - e["end"] > rules.gap_sec:
                    continue
                a = e["box"]
                inter = max(0, min(a[2], box[2]) - max(a[0], box[0])) * max(0, min(a[3], box[3]) - max(a[1], box[1]))
                iou = inter / ((a[2] - a[0]) * (a[3] - a[1]) + (box[2] - box[0]) * (box[3] - box[1]) - inter)
                far = (((a[0] + a[2] - box[0] - box[2]) / 2) ** 2 + ((a[1] + a[3] - box[1] - box[3]) / 2) ** 2) ** 0.5 / (1920**2 + 1080**2) ** 0.5
                close = iou >= rules.iou or (e["frame"] != frame and far <= rules.center)
                usual = sorted(e["tall"][-5:])[len(e["tall"][-5:]) // 2]
                if close and abs(box[3] - box[1] - usual) <= rules.split_height * usual and iou - far > most:
                    best, most = e, iou - far
            if best is None:
                best = {"tall": []}
                events.append(best)
            best.update(box=box, end=t, frame=frame, tall=best["tall"] + [box[3] - box[1]])
            out[(v, r[1], r[2])] = events.index(best) + 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_grouping_follows_the_rules(spark, seed):
    rules = Matching(gap_sec=3.0)
    det = spark.createDataFrame(video(seed), S.DETECTIONS).repartition(5)
    got = grouping.group_events(det, rules).collect()
    assert {(r["stream_id"], r["frame_idx"], r["det_seq"]): r["event_id"] for r in got} == brute_group(video(seed), rules)


def test_islands_of_a_long_video(spark):
    """Stretches of a video are put together again, with holes before, at and over their ends, and of several videos."""
    rng = random.Random(7)
    rows_ = []
    for v in range(3):
        f = 0
        for _ in range(200):
            f += rng.choice((1, 1, 2, 30, 31, 90, 400))
            rows_ += [(v, f, s, f / 10.0) for s in range(rng.randrange(1, 3))]
    det = spark.createDataFrame(rows_, "stream_id long, frame_idx int, det_seq int, timestamp_sec double").repartition(4)
    want, last = {}, {}
    for v, f, s, t in rows_:
        n, before = last.get(v, (0, None))
        n += before is None or t - before > 3.0
        last[v] = (n, t)
        want[v, f, s] = n
    for chunk in (1, 7, 100, 100_000):
        got = grouping.with_islands(det, "stream_id", 3.0, chunk).collect()
        assert {(r["stream_id"], r["frame_idx"], r["det_seq"]): r["island"] for r in got} == want


def test_python_groups_once(spark):
    grouped = grouping.group_events(spark.createDataFrame(video(1), S.DETECTIONS))
    assert "MapInPandas" not in grouped._jdf.queryExecution().executedPlan().toString()  # it ran already, and its result is read twice


def test_matcher_rules():
    g = Grouper(Matching())
    box = (100, 100, 300, 200)
    assert g.add(0, 0.0, box, 1920, 1080) == 0
    assert g.add(0, 0.0, (110, 100, 310, 200), 1920, 1080) == 0  # overlap within the frame
    assert g.add(0, 0.0, (320, 100, 520, 200), 1920, 1080) == 1  # near, but within the frame
    assert g.add(10, 3.0, (110, 100, 310, 200), 1920, 1080) == 0  # exactly the gap
    assert g.add(20, 3.1, (110, 100, 310, 230), 1920, 1080) == 2  # another height
    assert g.add(90, 6.2, (110, 100, 310, 200), 1920, 1080) == 3  # after the gap


def test_fold_and_top(spark):
    d = spark.createDataFrame([(0, f, s, f / 10.0, 9, 9, 0, c, 0, 0, 1, 1, 1, sc) for f, s, c, sc in [(0, 0, 0.9, 1.0), (10, 0, 0.9, 2.0), (20, 1, 0.5, 2.0)]], S.DETECTIONS + ", event_id long, score double")
    e = grouping.fold_events(d).first()
    assert (e["best_frame_idx"], e["detections_count"], e["end_sec"]) == (10, 3, 2.0)
    assert [(r["frame_idx"], r["rank"]) for r in grouping.top_candidates(d, 2).orderBy("rank").collect()] == [(10, 1), (20, 2)]


def donations(spark):
    row = lambda i, d="bob", a="5", c="RUB", m="hi", ok=True, rev=False, conf=0.9: (i, d, a, c, m, ok, rev, conf)
    return spark.createDataFrame([row(1), row(2, d=" BOB "), row(3, c="rub"), row(4, ok=False), row(5, a="nan"), row(6, a="nan"), row(7, d="anon", m=None), row(8, d="anon", m=None), row(9, conf=0.4, d="z"), row(10, d="z"), row(11, a=None), row(12, rev=True, d="q"), row(13, conf=None, d="k", c=None)],
                                 "event_id long, donor string, amount string, currency string, message string, parsed_ok boolean, needs_review boolean, best_detection_confidence double")


def test_dedup_and_totals(spark):
    marked = dedup.dedup_donations(donations(spark))
    flags = {r["event_id"]: r["duplicate_of_event_id"] for r in marked.collect() if r["is_duplicate"]}
    assert flags == {2: 1, 3: 1, 10: 9}
    skipped = dedup.totals_skipped(marked).first()
    assert (skipped["skipped"], skipped["duplicates"]) == (4, 3)
    totals = {r["currency"]: (r["events_count"], r["amount_sum"]) for r in dedup.totals_by_currency(marked).collect()}
    assert totals["NO_CURRENCY"] == (1, 5.0) and totals["RUB"][0] == 5


def test_crop_join(spark):
    crops = spark.createDataFrame([("event_7_x.png",), ("b.png",), ("a.png",), ("c.png",)], "crop string")
    meta = spark.createDataFrame([(1, "a.png"), (2, "gone.png"), (3, ""), (4, None)], "id long, crop string")
    got = {(r["crop"], r["event_id"], r["state"]) for r in rows.crop_jobs(crops, meta).collect()}
    assert got == {("a.png", 1, "ok"), ("gone.png", 2, "crop_missing"), (None, 3, "crop_missing"), (None, 4, "crop_missing"), ("event_7_x.png", 7, "no_metadata"), ("b.png", 10**9 + 1, "no_metadata"), ("c.png", 10**9 + 2, "no_metadata")}


def test_global_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    got = rows.global_rank(df, [F.col("k")]).orderBy("k").collect()
    assert [r["place"] for r in got] == list(range(1, 1001))


def test_extractor_failures_stay_in_their_row(spark):
    def ask(row):
        if row["n"] == 2:
            raise OSError("down")
        return json.dumps({"donor": f"d{row['n']}", "amount": row["n"]})

    got = {r["n"]: r for r in rows.parsed_rows(rows.extract(spark.range(1, 4).toDF("n"), ask, ["n"], retries=1, pause=0.2)).collect()}
    assert got[2]["latency_sec"] >= 0.2 > got[1]["latency_sec"]  # one pause, between the two tries
    assert got[2]["request_error"] == "request_failed: OSError: down" and got[3]["donor"] == "d3" and got[1]["parsed_ok"]


def test_evaluation(spark):
    pairs = spark.createDataFrame([(1.0, 0.5), (1.0, 1.0)], "sim_a double, sim_b double")
    r = rows.evaluation_summary(pairs, ["a", "b"]).first()
    assert (r["n"], r["all_correct"], r["exact_b"], r["mean_b"]) == (2, 0.5, 0.5, 0.75)


def test_training_samples(spark):
    det = spark.createDataFrame(video(5, 2), S.DETECTIONS)
    weak = training.uncertain_frames(det)
    picked = training.stratified(weak, 10, 1200).collect()
    assert len({(r["stream_id"], r["bucket"]) for r in picked}) == len(picked) <= 20
    assert {(r["stream_id"], r["frame_idx"]) for r in picked} <= {(r["stream_id"], r["frame_idx"]) for r in weak.collect()}
    assert sorted(map(tuple, picked)) == sorted(map(tuple, training.stratified(weak.repartition(3), 10, 1200).collect()))
    frames = spark.createDataFrame([(0, f) for f in (0, 10, 20)], "stream_id long, frame_idx int")
    boxes = spark.createDataFrame([(0, 10, 0, 1.0, 9, 9, 0, 0.3, 0, 0, 1, 1), (0, 20, 0, 2.0, 9, 9, 0, 0.1, 0, 0, 1, 1)], S.DETECTIONS)
    assert sorted(r["frame_idx"] for r in training.negative_frames(frames, boxes).collect()) == [0, 20]
    counts = {r["strategy"]: r["n"] for r in training.strategy_counts(spark.createDataFrame([("best",), ("best",)], "strategy string")).collect()}
    assert counts == {"best": 2, "worst": 0, "random": 0, "uncertain": 0, "negatives": 0}


def test_config_is_checked():
    assert runs.RunConfig(strategies=("uncertain",)).detect_confidence == 0.25 and runs.RunConfig().detect_confidence == 0.5
    for bad in ({"frame_step": 0}, {"strategies": ("x",)}, {"strategies": ("uncertain",), "uncertain_min": 0.7}, {"budget": 0}, {"max_tokens": 0}, {"timeout": 0}, {"engine": "other"}, {"engine": "native", "strategies": ("best",)}):
        with pytest.raises(ValueError):
            runs.RunConfig(**bad)


def test_empty_crops_are_passed_over(spark):
    whole = (0, 0, 0, 0.0, 1920, 1080, 0, 0.9, 10, 10, 300, 90)
    outside = (0, 10, 0, 1.0, 1920, 1080, 0, 0.9, 1990, 10, 2300, 90)
    line = (0, 20, 0, 2.0, 1920, 1, 0, 0.9, 10, 0, 300, 1)
    got = runs.detector_rows(spark.createDataFrame([whole, outside, line], S.DETECTIONS)).collect()
    assert [(r["first_frame"], r["detections_count"]) for r in got] == [(0, 1)]


def test_truth_lookup(spark):
    said = spark.createDataFrame([("a", "bob", 5.0, "RUB", "hi\n there", True), ("b", None, None, None, None, None), ("c", "x", 1.0, "RUB", "m", False)], "file_name string, donor string, amount double, currency string, message string, fee_covered boolean")
    truth = spark.createDataFrame([("a", "bob", 5.0, "RUB", "hi there", True), ("b", "eve", 2.0, "USD", None, False), ("z", "q", 1.0, "RUB", "m", False)], said.schema)
    pairs, untold = rows.compared(said, truth)
    got = {r["file_name"]: r for r in pairs.collect()}
    assert [r["file_name"] for r in untold.collect()] == ["c"] and set(got) == {"a", "b"}
    assert all(got["a"][f"sim_{c}"] == 1.0 for c in rows.COMPARED)
    assert [got["b"][f"sim_{c}"] for c in rows.COMPARED] == [0.0, 0.0, 0.0, 1.0, 1.0]
    r = rows.evaluation_summary(pairs.withColumn("sec", F.lit(2.0)), list(rows.COMPARED), "sec").first()
    assert (r["n"], r["all_correct"], r["mean_latency"], r["exact_message"]) == (2, 0.5, 2.0, 1.0)


def test_counters_of_a_run(spark):
    marked = dedup.dedup_donations(donations(spark)).withColumn("model_error", F.when(~F.col("parsed_ok"), "x"))
    det = spark.createDataFrame(video(2, 1), S.DETECTIONS)
    r = rows.whole_run_counters(marked, det).first()
    assert (r["events"], r["error_events"], r["duplicates"], r["skipped"]) == (13, 1, 3, 4)
    assert (r["frames"], r["raw_detections"]) == (len({x[1] for x in video(2, 1)}), sum(x[7] >= 0.5 for x in video(2, 1)))
    assert tuple(rows.whole_run_counters(marked.limit(0), det.limit(0)).first()) == (0,) * 6


def test_speedups(spark):
    r = spark.createDataFrame([("a", 4.0), ("a", 3.0), ("b", 6.0), ("c", 0.0)], "e string, s double")
    assert {x["e"]: (x["best_sec"], x["speedup"]) for x in rows.speedups(r, "e", "s", "a").collect()} == {"a": (3.0, 1.0), "b": (6.0, 0.5), "c": (0.0, 0.0)}
    assert {x["e"]: x["speedup"] for x in rows.speedups(r, "e", "s", "none").collect()} == {"a": 2.0, "b": 1.0, "c": 0.0}


def test_detection_of_sampled_frames(spark):
    """The table function makes its model once per task and sees sampled frames only."""

    def model():
        import pandas as pd

        def run(pdf):
            n = len(pdf)
            return pd.DataFrame({"stream_id": pdf["stream_id"], "frame_idx": pdf["frame_idx"], "det_seq": [0] * n, "timestamp_sec": pdf["frame_idx"] / 30.0, "frame_w": [9] * n, "frame_h": [9] * n, "class_id": [0] * n, "confidence": [0.3 + f % 20 / 40 for f in pdf["frame_idx"]], **{c: [1] * n for c in ("x1", "y1", "x2", "y2")}})

        return run

    frames = spark.range(100).selectExpr("0L AS stream_id", "CAST(id AS INT) AS frame_idx").repartition(2)
    got = runs.detected(frames, model, runs.RunConfig(max_frames=5)).collect()
    assert sorted(r["frame_idx"] for r in got) == [10, 30]
    got = runs.detected(frames, model, runs.RunConfig(max_frames=5, strategies=("uncertain",))).collect()
    assert sorted(r["frame_idx"] for r in got) == [0, 10, 20, 30, 40]


def png(path, width=3, height=2):
    import struct
    import zlib

    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    body = b"".join(b"\0" + bytes([10, 20, 30]) * width for _ in range(height))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(body)) + part(b"IEND", b""))


def test_crops_are_read(spark, tmp_path):
    png(tmp_path / "event_1.png")
    (tmp_path / "event_2.png").write_bytes(b"no picture")
    (tmp_path / "notes.txt").write_text("x")
    got = {r["crop"]: r for r in readers.read_crops(spark, str(tmp_path)).collect()}
    assert set(got) == {"event_1.png", "event_2.png"} and (got["event_1.png"]["width"], got["event_1.png"]["height"]) == (3, 2) and got["event_2.png"]["height"] == -1
    assert bytes(got["event_1.png"]["data"])[:3] == bytes([30, 20, 10])
    urls = {r["crop"]: r["url"] for r in readers.read_crop_bytes(spark, str(tmp_path)).collect()}
    assert set(urls) == set(got) and urls["event_1.png"].startswith("data:image/png;base64,iVBOR")


def test_http_extractor(spark):
    """Against a server of this process: the payload, the answer, and an error status that is the row's."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(body)
            bad = body["messages"][0]["content"][1]["image_url"]["url"] == "data:bad"
            self.send_response(500 if bad else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": '{"donor": "d", "needs_review": false}'}}]}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ask = runs.RunConfig(max_tokens=77, timeout=20.0).extractor(f"http://127.0.0.1:{server.server_port}/v1", "m", "read it")
    jobs = spark.createDataFrame([("data:ok",), ("data:bad",)], "url string").coalesce(1)
    got = {r["url"]: r for r in rows.parsed_rows(rows.extract(jobs, ask, ["url"], retries=1, pause=0.0)).collect()}
    server.shutdown()
    assert got["data:ok"]["donor"] == "d" and got["data:ok"]["needs_review"] is False and got["data:ok"]["request_error"] is None
    assert got["data:bad"]["request_error"].startswith("request_failed: HTTPError") and len(seen) == 3
    assert (seen[0]["max_tokens"], seen[0]["model"], seen[0]["temperature"]) == (77, "m", 0.0) and seen[0]["response_format"]["json_schema"]["strict"] is True


def mp4(path, frames=250, scale=12800, each=512, width=1280, height=720, wide=False):
    import struct

    box = lambda kind, *parts: struct.pack(">I4s", 8 + sum(map(len, parts)), kind) + b"".join(parts)
    handler = lambda kind: box(b"hdlr", bytes(8), kind, bytes(12))
    header = bytes([1, 0, 0, 0]) + bytes(16) + struct.pack(">IQ", scale, frames * each) if wide else bytes(12) + struct.pack(">II", scale, frames * each)
    sound = box(b"trak", box(b"tkhd", bytes(76), bytes(8)), box(b"mdia", box(b"mdhd", bytes(12), struct.pack(">II", 48000, 9)), handler(b"soun")))
    times = box(b"stts", bytes(4), struct.pack(">III", 1, frames, each))
    video_ = box(b"trak", box(b"tkhd", bytes(76), struct.pack(">II", width << 16, height << 16)), box(b"mdia", box(b"mdhd", header), handler(b"vide"), box(b"minf", box(b"stbl", times))))
    path.write_bytes(box(b"ftyp", b"isom", bytes(4)) + struct.pack(">I4sQ", 1, b"mdat", 116) + bytes(100) + box(b"moov", box(b"mvhd", bytes(100)), sound, video_))


def test_videos_are_probed_and_scanned(spark, tmp_path):
    import struct

    mp4(tmp_path / "a.mp4")
    mp4(tmp_path / "b c.mp4", 30, 30000, 1001, 640, 360, wide=True)
    (tmp_path / "c.avi").write_bytes(b"RIFF" + bytes(4) + b"AVI LIST" + bytes(4) + b"hdrlavih" + struct.pack("<11I", 56, 40000, 0, 0, 0, 75, 0, 1, 0, 320, 240) + bytes(16))
    (tmp_path / "d.mp4").write_bytes(b"not a video")
    videos = readers.probe_videos(spark, str(tmp_path))
    got = {r["video_name"]: (r["width"], r["height"], round(r["fps"], 3), r["total_frames"]) for r in videos.collect()}
    assert got == {"a.mp4": (1280, 720, 25.0, 250), "b c.mp4": (640, 360, 29.97, 30), "c.avi": (320, 240, 25.0, 75), "d.mp4": (None, None, 30.0, 0)}
    frames = readers.scan_videos(videos, 10, 4).collect()
    assert sorted((r["video_name"], r["frame_idx"]) for r in frames) == sorted([("a.mp4", k) for k in (0, 10, 20, 30)] + [("b c.mp4", k) for k in (0, 10, 20)] + [("c.avi", k) for k in (0, 10, 20, 30)])
    assert {r["timestamp_sec"] for r in frames if r["video_name"] == "a.mp4"} == {0.0, 0.4, 0.8, 1.2}
    decoded = readers.scan_videos(videos, 10, 4, decode=lambda path, at: (f"{path[-5:]}:{k}".encode() for k in at), batch=3).collect()
    assert sorted(bytes(r["data"]).decode() for r in decoded) == sorted(f"{r['path'][-5:]}:{r['frame_idx']}" for r in frames)


def test_a_run_writes_its_reports(spark, tmp_path):
    det = spark.createDataFrame(video(1, 1), S.DETECTIONS)
    events = runs.detector_rows(det)
    answers = events.select("event_id", F.format_string('{"donor":"d%d","amount":5,"currency":"RUB","needs_review":false}', F.col("event_id") % 3).alias("raw_model_response")).where("event_id > 1")
    out = tmp_path / "run"
    info = runs.reports(events, answers, str(out), {"meta": "full", "video": "0"})
    with open(out / "events_summary.csv", encoding="utf-8") as f:
        table = list(csv.DictReader(f))
    assert len(table) == info["events_count"] == events.count() and table[0]["model_error"] == "vlm_skipped" and table[1]["parsed_ok"] == "True"
    lines = [json.loads(x) for x in open(out / "donations.jsonl", encoding="utf-8")]
    assert list(lines[0]) == S.JSONL and sum(x["is_duplicate"] for x in lines) == info["duplicates"] > 0
    back = readers.read_sidecar(spark, str(out / "events_meta.jsonl")).collect()
    assert sorted(r["id"] for r in back) == sorted(int(r["event_id"]) for r in table)
    assert readers.find_sidecar(str(out / "a")) == str(out / "events_meta.jsonl")
    assert readers.read_run(spark, str(out / "events_summary.csv")).where("is_duplicate").count() == info["duplicates"]
    with pytest.raises(FileExistsError):
        runs.reports(events, answers, str(out), {})


def test_extraction_stage(spark):
    crops = spark.createDataFrame([("event_1_x.png", "data:1"), ("event_5_x.png", None)], "crop string, url string")
    meta = spark.createDataFrame([(1, "event_1_x.png"), (2, "lost.png")], "id long, crop string")
    got = {r["event_id"]: r for r in runs.extraction_stage(crops, meta, lambda row: row["url"].upper(), concurrency=2).collect()}
    with pytest.raises(FileNotFoundError, match="neither"):
        runs.extraction_stage(crops.limit(0), meta.limit(0), str)
    assert got[1]["raw_model_response"] == "DATA:1" and got[2]["request_error"] == "crop_missing" and got[5]["request_error"] == "crop_load_failed"


def test_files(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, b string")
    assert sinks.write_csv(empty, str(tmp_path / "e.csv")) == 0 and (tmp_path / "e.csv").read_bytes() == b""
    sinks.write_csv(empty, str(tmp_path / "h.csv"), header_if_empty=True)
    assert (tmp_path / "h.csv").read_bytes() == b"a,b\r\n"
    df = spark.createDataFrame([(1, 'say "ж", then', True), (2, None, False)], "a int, b string, c boolean").coalesce(1)
    sinks.write_csv(df, str(tmp_path / "d.csv"))
    assert (tmp_path / "d.csv").read_text(encoding="utf-8").splitlines() == ["a,b,c", '1,"say ""ж"", then",True', "2,,False"]
    sinks.write_csv_table(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), header=True, escape='"').where("c = 'True'").first()["b"] == 'say "ж", then'
    sinks.write_jsonl_table(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).where("value like '%\"b\":null%'").count() == 1
    sinks.write_files(df.select(F.concat("a", F.lit(".txt")).alias("n"), F.coalesce("b", F.lit("")).alias("x")), str(tmp_path / "f"), "n", "x")
    assert (tmp_path / "f" / "1.txt").read_text(encoding="utf-8") == 'say "ж", then'
    sinks.write_examples(df.select("a"), str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text())["donations"] == [{"a": 1}, {"a": 2}]
    (tmp_path / "truth.json").write_text(json.dumps({"examples": [{"file_name": "f", "donor": "d", "amount": 3, "currency": None}]}))
    assert readers.read_truth(spark, str(tmp_path / "truth.json")).first()["amount"] == 3.0
    event = {"event_id": 3, "start_sec": 1.5, "candidates": [{"frame_idx": 7, "base_box": [1, 2, 3, 4]}]}
    (tmp_path / "events.json").write_text(json.dumps({"events": [event]}))
    assert readers.read_detector_events(spark, str(tmp_path / "events.json")).first()["candidates"][0]["base_box"] == [1, 2, 3, 4]
    lines = spark.createDataFrame([(json.dumps({"type": "event", **event}),), ("progress 5%",), (json.dumps({"type": "summary", "events_count": 1}),)], "value string")
    parts = readers.detector_stream(lines)
    assert [p.count() for p in parts] == [1, 1, 1] and parts[0].first()["event_id"] == 3
    assert readers.the_summary(parts[1])["events_count"] == 1
    with pytest.raises(RuntimeError, match="summary"):
        readers.the_summary(parts[1].limit(0))
    (tmp_path / "v1.txt").write_text("read it\n")
    assert readers.load_prompt("v1", str(tmp_path)) == "read it"
    with pytest.raises(FileNotFoundError, match="v1"):
        readers.load_prompt("v2", str(tmp_path))


def test_sampling_reaches_the_scan(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("int").alias("frame_idx"), F.lit(1).alias("x")).write.parquet(str(tmp_path / "f"))
    df = readers.sample_frames(spark.read.parquet(str(tmp_path / "f")), 10, 5)
    assert df.count() == 5 and "LessThan(frame_idx,50)" in df._jdf.queryExecution().toString()


def test_stream_gives_the_events_of_the_batch(spark, tmp_path):
    det = video(4, 2, 60)
    batches = [[r for r in det if lo <= r[1] < lo + 150] for lo in range(0, 600, 150)]
    ends = [(v, None, None, 10_000.0, 1920, 1080, 0, 1.0, 0, 0, 0, 0) for v in range(2)]
    for i, b in enumerate([*batches, ends]):
        spark.createDataFrame(b, S.DETECTIONS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(S.DETECTIONS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.group_stream(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, grouping.fold_events(grouping.group_events(spark.createDataFrame(det, S.DETECTIONS))).collect()))
    assert got == want and len(got) > 3
