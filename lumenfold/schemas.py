"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

DETECTIONS = "stream_id long, frame_idx int, det_seq int, timestamp_sec double, frame_w int, frame_h int, class_id int, confidence double, x1 int, y1 int, x2 int, y2 int"
FULL_META = {
    "event_id": "long", "video_name": "string", "start_time": "string", "end_time": "string", "duration": "string", "first_frame": "int", "last_frame": "int", "detections_count": "long",
    "best_detection_confidence": "double", "best_detection_time": "string", "best_detection_frame": "int", "best_detection_score": "double", "base_box_json": "string", "padded_box_json": "string", "crop_path": "string",
}
ANSWER = {
    "parsed_ok": "boolean", "donor": "string", "amount": "double", "currency": "string", "message": "string", "fee_covered": "boolean", "needs_review": "boolean",
    "raw_model_response": "string", "model_error": "string", "is_duplicate": "boolean", "duplicate_of_event_id": "long",
}
JSONL = "file_name parsed_ok error donor amount currency message fee_covered needs_review is_duplicate duplicate_of_event_id".split()
MANIFEST = "image string, strategy string, confidence double, select_score double, event_id long, frame_idx int, time string, num_boxes int, box_xyxy string, box_cxcywh string, frame_w int, frame_h int, label string, preview string, video string"
CANDIDATE = "frame_idx int, timestamp_sec double, confidence double, class_id int, score double, base_box array<int>, padded_box array<int>, crop_path string, annotated_frame_path string, original_frame_path string"
DETECTOR_EVENT = f"event_id long, start_sec double, end_sec double, first_frame int, last_frame int, detections_count int, best_confidence double, best_timestamp_sec double, best_frame_idx int, candidates array<struct<{', '.join(f'{a}: {b}' for a, b in (f.split(' ', 1) for f in CANDIDATE.split(', ')))}>>"


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{k} {v}" for k, v in fields.items())
