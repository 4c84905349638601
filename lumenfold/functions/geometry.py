"""Box geometry as column expressions; boxes are structs ``x1, y1, x2, y2`` of integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1: str | Column, y1: str | Column, x2: str | Column, y2: str | Column) -> Column:
    names = zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).cast("int").alias(n) for c, n in names])


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))


def expand_box(b: Column, width: Column, height: Column, pad_x: int = 20, pad_y: int = 12) -> Column:
    """The box with a margin, cut off at the frame's last row and column."""
    zero, right, bottom = F.lit(0), width - 1, height - 1
    return box(clamp(b["x1"] - pad_x, zero, right), clamp(b["y1"] - pad_y, zero, bottom), clamp(b["x2"] + pad_x, zero, right), clamp(b["y2"] + pad_y, zero, bottom))


def box_height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def box_area(b: Column) -> Column:
    side = lambda a, z: F.greatest(F.lit(0), b[z] - b[a]).cast("long")
    return side("x1", "x2") * side("y1", "y2")


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty."""
    wide = F.greatest(F.lit(0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])).cast("long")
    high = F.greatest(F.lit(0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])).cast("long")
    union = box_area(a) + box_area(b) - wide * high
    return F.when(union > 0, (wide * high).cast("double") / union).otherwise(F.lit(0.0))


def center_distance(a: Column, b: Column, width: Column, height: Column) -> Column:
    """Distance of the centers as a share of the frame's diagonal (1 pixel at least)."""
    middle = lambda q, s, e: (q[s] + q[e]) / F.lit(2.0)
    dx, dy = middle(a, "x1", "x2") - middle(b, "x1", "x2"), middle(a, "y1", "y2") - middle(b, "y1", "y2")
    diagonal = F.greatest(F.lit(1.0), F.sqrt((width * width + height * height).cast("double")))
    return F.sqrt(dx * dx + dy * dy) / diagonal


def reference_height(heights: Column) -> Column:
    """Upper median of an array; 0 of an empty one."""
    n = F.size(heights)
    return F.when(n > 0, F.try_element_at(F.array_sort(heights), (F.floor(n / 2) + 1).cast("int"))).otherwise(F.lit(0))


def push_height(heights: Column, height: Column, keep: int = 5) -> Column:
    longer = F.concat(heights, F.array(height))
    return F.slice(longer, F.greatest(F.lit(1), F.size(longer) - keep + 1), F.lit(keep))


def area_score(b: Column, width: Column, height: Column) -> Column:
    return F.least(box_area(b) / (width * height).cast("double") * 10, F.lit(0.3))


def sharpness_score(variance: Column) -> Column:
    return F.least(variance / 500, F.lit(0.4))


def clip_penalty(b: Column, padded: Column, width: Column, height: Column) -> Column:
    """-0.15 where the margin reached an edge of the frame that the box itself doesn't touch."""
    hit = (padded["x1"] <= 0) & (b["x1"] > 0) | (padded["y1"] <= 0) & (b["y1"] > 0) | (padded["x2"] >= width - 1) & (b["x2"] < width - 1) | (padded["y2"] >= height - 1) & (b["y2"] < height - 1)
    return F.when(hit, F.lit(-0.15)).otherwise(F.lit(0.0))


def candidate_score(confidence: Column, b: Column, padded: Column, variance: Column, width: Column, height: Column) -> Column:
    return confidence + area_score(b, width, height) + sharpness_score(variance) + clip_penalty(b, padded, width, height)


def cxcywh(b: Column, width: Column, height: Column) -> Column:
    """Center and size as shares of the frame, 6 decimals; empty where the box or frame is degenerate."""
    good = (b["x2"] > b["x1"]) & (b["y2"] > b["y1"]) & (width > 0) & (height > 0)
    share = lambda x, of: x / F.when(of > 0, of.cast("double"))
    digits = lambda x: F.call_function("format_number", x, F.lit("0.000000"))  # noqa: E731 - rounds like C and Python do, format_string doesn't
    text = F.concat_ws(" ", *map(digits, (share((b["x1"] + b["x2"]) / F.lit(2.0), width), share((b["y1"] + b["y2"]) / F.lit(2.0), height), share((b["x2"] - b["x1"]).cast("double"), width), share((b["y2"] - b["y1"]).cast("double"), height))))
    return F.when(good, text).otherwise(F.lit(""))


def unletterbox(v: Column, pad: Column, scale: Column, size: Column) -> Column:
    """A coordinate of the padded model input as a pixel of the frame, cut toward zero and kept inside."""
    return clamp(((v - pad) / scale).cast("int"), F.lit(0), size - 1)
