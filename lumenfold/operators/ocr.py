"""Text-recognition results of the older pipelines: blocks, lines, variant scores and the rule parser."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions import text as T

BLOCKS = "array<struct<text: string, confidence: double, x1: double, y1: double, x2: double, y2: double>>"
_CURRENCY = "(" + "|".join(("usd", "eur", "rub", r"руб\.?", r"р\.?", "бит(?:ы|ов)?", "bits?", "[€$₽]")) + ")"
_DASH, _NUMBER, _THOUSANDS = "[:–—-]", r"(\d[0-9.,\s]*)", r"(\d\d?\d?)"
_WITH_DONOR = re.compile(rf"(.{{2,80}}?)\s*{_DASH}+\s*{_NUMBER}\s*!?\s*{_CURRENCY}?", re.I)
_WITH_CURRENCY = re.compile(rf"{_NUMBER}\s*{_CURRENCY}", re.I)
_LENDS = re.compile(rf"{_DASH}\s*{_THOUSANDS}\s*$")
_BEFORE_DASH = re.compile(rf"(.{{2,80}}?)\s*{_DASH}+")


def normalize_ocr(c: Column) -> Column:
    """Lower case without signs that carry no meaning; ``ё`` counts as ``е``."""
    plain = F.regexp_replace(F.translate(F.lower(c), "ё", "е"), r"\s+", " ")
    return F.trim(F.regexp_replace(plain, r"[^a-zа-я0-9 +\-?!;:,.₽€$]+", ""))


#: Words that recognizers often get wrong, in this order: letters of the other alphabet that look alike, or a lost first letter.
REPAIRS = {"M\u0435H\u044f": "меня", "M\u0435\u043d\u044f": "меня", "T\u044b": "Ты", "Бечерний": "Вечерний", " оха": " Тоха"}


def tidy(c: Column) -> Column:
    """Recognized text as it is shown: a line per part, frequent errors mended, no blank before punctuation."""
    parts = F.regexp_replace(c, r" \| ", "\n")
    for wrong, right in REPAIRS.items():
        parts = F.replace(parts, F.lit(wrong), F.lit(right))
    return F.trim(F.regexp_replace(F.regexp_replace(parts, r"\s+([,.!?])", "$1"), r"[ \t]+", " "))


def clean_number(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _is_points(x: object) -> bool:
    return isinstance(x, list) and bool(x) and all(isinstance(p, list) and len(p) == 2 and all(isinstance(v, (int, float)) for v in p) for p in x)


def _bounds(x: object, scale: float) -> tuple[float, ...]:
    if not _is_points(x):
        return (-1.0,) * 4
    return tuple(end(side) / scale for end in (min, max) for side in zip(*x))


def find_blocks(value: object, scale: float = 1.0) -> list[tuple]:
    """Blocks anywhere in a recognizer's answer; of equal text and (whole-pixel) box the most confident.

    Understands tables of texts, scores and polygons, ``[polygon, [text, score]]`` and ``[text, score]``."""

    def number(x: object) -> float:
        return float(x) if isinstance(x, (int, float)) else 0.0

    def walk(x: object) -> Iterator[tuple]:
        if isinstance(x, dict):
            first = lambda *keys: next((x[k] for k in keys if x.get(k)), [])
            texts, scores, boxes = first("rec_texts", "texts"), first("rec_scores", "scores"), first("rec_polys", "dt_polys", "rec_boxes", "boxes")
            for i, text in enumerate(texts if isinstance(texts, list) else []):
                if text:
                    yield (str(text), number(dict(enumerate(scores)).get(i)), *_bounds(boxes[i] if i < len(boxes) else None, scale))
            for k, v in x.items():
                if isinstance(v, (list, dict)) and v is not texts and v is not scores:
                    yield from walk(v)
        elif isinstance(x, list):
            if len(x) >= 2 and _is_points(x[0]) and isinstance(x[1], list) and len(x[1]) >= 2 and isinstance(x[1][0], str) and x[1][0].strip():
                yield (x[1][0].strip(), number(x[1][1]), *_bounds(x[0], scale))
            elif x[1:] and isinstance(x[0], str):
                yield (x[0].strip(), number(x[1]), -1.0, -1.0, -1.0, -1.0)
            else:
                for v in x:
                    yield from walk(v)

    best: dict[tuple, tuple] = {}
    for b in walk(value):
        key = (b[0], *(int(v) for v in b[2:]))
        if key not in best or b[1] > best[key][1]:
            best[key] = b
    return list(best.values())


def group_lines(blocks: list[tuple], height: int) -> list[str]:
    """Texts of the lines that blocks form, from top to bottom and left to right.

    A block joins the first line whose running mean center is within 8 % of the height (12 pixels at least)."""
    some = [b for b in blocks if b[0].strip()]
    if all(b[3] < 0 for b in some):
        return [" ".join(b[0] for b in some)] if some else []
    center = lambda b: (b[3] + b[5]) / 2 if b[3] >= 0 else 1e9
    left = lambda b: b[2] if b[2] >= 0 else 1e9
    near, lines, means = max(12.0, 0.08 * height), [], []
    for b in sorted(some, key=lambda b: (center(b), left(b))):
        i = next((i for i, m in enumerate(means) if abs(center(b) - m) <= near), None)
        if i is None:
            lines.append([b])
            means.append(center(b))
        else:
            lines[i].append(b)
            placed = [center(q) for q in lines[i] if q[3] >= 0]
            means[i] = sum(placed) / len(placed) if placed else means[i]
    return [" ".join(b[0].strip() for b in sorted(line, key=left)) for line in lines]


def read_results(rows: DataFrame, result: str, height: str, scale: Column | None = None) -> DataFrame:
    """``rows`` with ``blocks`` and ``lines`` of the JSON in ``result``; what can't be read has none."""
    own = rows.withColumn("_scale", F.lit(1.0) if scale is None else scale)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", blocks {BLOCKS}, lines array<string>"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            blocks, lines = [], []
            for raw, h, s in zip(pdf[result], pdf[height], pdf["_scale"]):
                try:
                    found = find_blocks(json.loads(raw or "null"), s)
                except ValueError:
                    found = []
                blocks.append([dict(zip(("text", "confidence", "x1", "y1", "x2", "y2"), b)) for b in found])
                lines.append(group_lines(found, int(h)))
            yield pdf.drop(columns="_scale").assign(blocks=blocks, lines=lines)

    return own.mapInPandas(run, schema)


def variant_score(blocks: Column, lines: Column) -> Column:
    """How much a recognized variant tells: confidence, length, digits, a currency and Cyrillic letters."""
    text = F.array_join(F.filter(lines, lambda s: F.trim(s) != ""), " | ")
    sure = F.transform(F.filter(blocks, lambda b: (F.trim(b["text"]) != "") & (b["confidence"] > 0)), lambda b: b["confidence"])
    mean = F.when(F.size(sure) > 0, F.aggregate(sure, F.lit(0.0), lambda a, x: a + x) / F.size(sure)).otherwise(0.0)
    chars = F.length(F.regexp_replace(text, r"\s+", ""))
    flag = lambda c: F.when(c, 0.25).otherwise(0.0)
    return mean * 1.2 + F.least(chars, F.lit(180)) / 120 + flag(text.rlike(r"\d")) + flag(T.has_currency(text)) + F.least(T.cyrillic_count(text), F.lit(120)) / 200


def best_variant(rows: DataFrame, key: str) -> DataFrame:
    """The variant of each ``key`` with the best ``score``, by ``variant`` among equals."""
    best = F.min_by(F.struct("variant", "score", "lines"), F.struct(-F.col("score"), F.col("variant")))
    return rows.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def area_candidate_score(confidence: Column, area: Column, frame: Column) -> Column:
    """Candidate score of the second generation: confidence and area only."""
    return confidence + F.least(area / frame * 10, F.lit(0.5))


def parse_lines(lines: list[str]) -> tuple[str, str, str, str]:
    """Donor, amount, currency and message of a plaque's lines.

    ``donor - amount`` on one of the first three lines counts most; else an amount with a currency, to
    which a line before that ends in ``- 1`` lends its thousands; other lines are the message."""
    lines = [s.strip() for s in lines if s.strip()]
    digits = lambda s: re.sub(r"\D", "", s)
    donor = amount = currency = ""
    at, used = None, set()
    for i, line in enumerate(lines[:3]):
        if m := _WITH_DONOR.match(line):
            donor, amount, currency, at = m[1].strip(" |:–—-"), digits(m[2]), m[3] or "", i
            break
    for i, line in enumerate(lines if at is None else []):
        if m := _WITH_CURRENCY.search(line):
            amount, currency, at = digits(m[1]), m[2], i
            before = _LENDS.search(lines[i - 1]) if i and len(amount) == 3 else None
            if before:
                amount, donor = before[1] + amount, lines[i - 1][: before.start()].strip()
                used.add(i - 1)
            break
    if not donor and lines:
        m = _BEFORE_DASH.match(lines[0])
        donor = m[1].strip() if m else lines[0]
    if at is None:
        used |= {0}
    else:
        used |= {at} | ({at - 1} if at and donor and donor in lines[at - 1] else set())
    upper = currency.strip().upper()
    return donor, amount, "RUB" if upper.rstrip(".") in ("РУБ", "Р") else upper, "\n".join(s for i, s in enumerate(lines) if i not in used)


def parsed_plaques(rows: DataFrame, lines: str) -> DataFrame:
    """``rows`` with ``donor, amount, currency, message`` by :func:`parse_lines` of an array of lines; NULL is no line."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", donor string, amount string, currency string, message string"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = [parse_lines([] if v is None else [s for s in v if s is not None]) for v in pdf[lines]]
            yield pdf.assign(**{c: [p[k] for p in found] for k, c in enumerate(("donor", "amount", "currency", "message"))})

    return rows.mapInPandas(run, schema)
