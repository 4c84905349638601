"""Text, time and number formatting as column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

GENERIC_DONORS = ("anon", "anonymous", "анонім", "аноним")
GENERIC_MESSAGES = ("link removed", "сообщение удалено", "(ссылка удалена)", "ссылка удалена")
IMAGE_BITS = {"crops": 1, "annotated": 2, "original": 4}


def collapse(c: Column) -> Column:
    """Runs of (Unicode) white space become one blank, none at the ends."""
    return F.trim(F.regexp_replace(c.cast("string"), r"(?U)\s+", " "))


def normalize_donor(c: Column) -> Column:
    return F.lower(F.coalesce(collapse(c), F.lit("")))


def normalize_message(c: Column) -> Column:
    """Lower case, white space collapsed, every bracketed placeholder of a removed link written the same way."""
    return F.lower(F.regexp_replace(F.coalesce(collapse(c), F.lit("")), r"(?iu)[{\[(]\s*" + r"\s+".join(("ссылка", "удалена")) + r"\s*[}\])]", "(ссылка удалена)"))


def normalize_currency(c: Column) -> Column:
    upper = F.upper(F.coalesce(collapse(c), F.lit("")))
    return F.when(upper == "NO_CURRENCY", F.lit("")).otherwise(upper)


def normalize_amount(c: Column) -> Column:
    """Number of a text; NULL where it isn't one (``5d`` and the like don't count as numbers)."""
    text = c.cast("string")
    number = text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$") | text.rlike(r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$")
    return F.when(number, text.try_cast("double"))


def is_identifying(donor: Column, message: Column) -> Column:
    """Of normalized texts: at least one of them tells people apart."""
    return ~((donor == "") | donor.isin(*GENERIC_DONORS)) | ~((message == "") | message.isin(*GENERIC_MESSAGES))


@F.pandas_udf(StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Full Unicode case folding, which ``lower`` isn't."""
    return s.str.casefold()


def safe_filename(c: Column) -> Column:
    kept = F.regexp_replace(c, "[^._a-zA-ZЁА-Яёа-я0-9-]+", "_")
    kept = F.substring(F.regexp_replace(kept, "^_+|_+$", ""), 1, 90)
    return F.when(F.coalesce(kept, F.lit("")) == "", F.lit("run")).otherwise(kept)


def seconds_to_timestamp(c: Column) -> Column:
    """``HH:MM:SS.mmm``; negative times are 0."""
    s = F.greatest(c.cast("double"), F.lit(0.0))
    whole = F.floor(s)
    return F.format_string("%02d:%02d:%06.3f", F.floor(whole / 3600).cast("int"), (F.floor(whole / 60) % 60).cast("int"), s - F.floor(s / 60) * 60)


def box_json(b: Column) -> Column:
    return F.to_json(F.array(b["x1"], b["y1"], b["x2"], b["y2"]))


def image_kinds(mask: Column) -> Column:
    """Struct of booleans of an artifact mask (0 to 7; others are NULL)."""
    inside = (mask >= 0) & (mask <= 7)
    return F.when(inside, F.struct(*[(mask.bitwiseAND(F.lit(b)) > 0).alias(k) for k, b in IMAGE_BITS.items()]))


def crop_event_id(name: Column) -> Column:
    """Number in ``event_<number>_...``, NULL without one."""
    return F.regexp_extract(name, r"event_(\d+)_", 1).try_cast("long")


def one_line(c: Column) -> Column:
    """Lines joined by blanks, runs of blanks to one."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"\s*[\r\n]+\s*", " "), " {2,}", " ")


def data_url(content: Column, kind: str = "png") -> Column:
    """Data URL of an image's bytes; NULL of an empty one."""
    return F.when(F.length(content) > 0, F.concat(F.lit(f"data:image/{kind};base64,"), F.regexp_replace(F.base64(content), r"\s", "")))


def has_currency(c: Column) -> Column:
    return c.rlike(r"(?iu)(₽|\$|€|₴|\brub\b|\busd\b|\beur\b|руб|грн)")


def cyrillic_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^а-яёА-ЯЁ]", ""))


def amount_of_line(c: Column) -> Column:
    """Amount of a line such as ``donor - 1 500,50 RUB``; NULL without one."""
    found = F.regexp_extract(c, r"(\d[\d ]*(?:[,.]\d\d?)?)\s*(?:USD|EUR|RUB|UAH|[₽$€])", 1)
    return F.regexp_replace(F.regexp_replace(found, " ", ""), ",", ".").try_cast("double")


def parse_image_size(text: str) -> int | tuple[int, int]:
    """``640``, or height and width as in ``384,640`` or ``384x640``."""
    pieces = [p for p in re.split(r"\s*[,x×X]\s*", text.strip())]
    if len(pieces) not in (1, 2) or not all(p.isdigit() and int(p) > 0 for p in pieces):
        raise ValueError(f"image size must be N or H,W: {text!r}")
    return int(pieces[0]) if len(pieces) == 1 else (int(pieces[0]), int(pieces[1]))
