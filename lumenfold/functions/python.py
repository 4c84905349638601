"""What built-in expressions can't do, as Arrow-batched functions."""

from __future__ import annotations

import difflib
import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

#: Fields of an answer; built without a parser, since workers import this module without a session.
RESPONSE = StructType()
for _name, _type in zip("parsed_ok donor amount currency message fee_covered needs_review model_error".split(), "bsdssbbs"):
    RESPONSE.add(_name, {"b": BooleanType(), "s": StringType(), "d": DoubleType()}[_type])


def laplacian(gray: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, mirrored at the edges without repeating them."""
    g = np.pad(gray.astype(np.int64), 1, mode="reflect") if min(gray.shape) > 1 else np.pad(gray.astype(np.int64), 1, mode="edge")
    v = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return (v.size * int((v * v).sum()) - int(v.sum()) ** 2) / v.size**2  # in integers, so that it is exact


def gray_of_bgr(data: bytes, height: int, width: int) -> np.ndarray:
    """Fixed-point luminance of packed BGR bytes."""
    p = np.frombuffer(data, np.uint8).reshape(height, width, 3).astype(np.int64)
    return (p[..., 0] * 1868 + p[..., 1] * 9617 + p[..., 2] * 4899 + 8192) >> 14


@F.pandas_udf(DoubleType())
def tile_sharpness(tiles: pd.Series) -> pd.Series:
    """:func:`laplacian` of square tiles given as flat arrays of gray values."""
    return tiles.map(lambda t: None if t is None else laplacian(np.asarray(t).reshape(int(len(t) ** 0.5), -1)))


@F.pandas_udf(DoubleType())
def image_sharpness(data: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """:func:`laplacian` of images in Spark's ``image`` layout; NULL where one couldn't be decoded."""
    return pd.Series([laplacian(gray_of_bgr(d, h, w)) if d and h > 0 and w > 0 else None for d, h, w in zip(data, height, width)], dtype="float64")


def find_json(text: str) -> object:
    """A JSON value: of the whole text, or of what lies between its first and last brace."""
    whole = text.strip()
    a, b = whole.find("{"), whole.rfind("}")
    inner = whole[a : b + 1] if 0 <= a < b else ""
    try:
        return json.loads(whole)
    except ValueError:
        return json.loads(inner)  # raises too where there is nothing


def _amount(x: object) -> float | None:
    try:
        return None if x is None or x == "" else float(x)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None


def parse_response(text: str | None) -> tuple:
    """Fields of :data:`RESPONSE` of one answer of a model.

    Flags are true where the answer says ``true``, not where it says ``"true"`` or 1; ``needs_review`` is true too where it is absent."""
    nothing = (False, None, None, None, None, False, True)
    try:
        found = find_json(text or "")
    except ValueError as e:
        return (*nothing, f"json_parse_failed: {e}")
    if found is None:
        return (*nothing, None)
    if not found:
        found = {}
    if not isinstance(found, dict):
        return (*nothing, "worker_exception: the answer is not an object")
    word = lambda k: None if found.get(k) is None else str(found[k])
    return (True, word("donor"), _amount(found.get("amount")), word("currency"), word("message"), found.get("fee_covered") is True, found.get("needs_review", True) is True, None)


@F.pandas_udf(RESPONSE)
def extract_json(text: pd.Series) -> pd.DataFrame:
    """:func:`parse_response` of each row."""
    return pd.DataFrame([parse_response(t) for t in text], columns=RESPONSE.names).astype({"amount": "float64"})


@F.pandas_udf(DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts; 1 where both are NULL, 0 where one is."""
    one = lambda x, y: 1.0 if x is None and y is None else 0.0 if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def letterbox(image: np.ndarray, height: int, width: int) -> tuple[np.ndarray, float, int, int]:
    """A BGR image scaled into a frame of the model's size: float RGB planes, the scale, and the margins left and above.

    Bilinear with pixel centers, margins of gray 114."""
    h, w = image.shape[:2]
    scale = min(height / h, width / w)
    tall, wide = max(1, round(h * scale)), max(1, round(w * scale))
    at = lambda n, m: np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1)
    y, x = at(tall, h), at(wide, w)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    source = image.astype(np.float32)
    upper = source[y0][:, x0] * (1 - fx) + source[y0][:, x1] * fx
    lower = source[y1][:, x0] * (1 - fx) + source[y1][:, x1] * fx
    left, top = (width - wide) // 2, (height - tall) // 2
    out = np.full((3, height, width), 114 / 255, np.float32)
    out[:, top : top + tall, left : left + wide] = (upper * (1 - fy) + lower * fy)[..., ::-1].transpose(2, 0, 1) / 255
    return out, scale, left, top
