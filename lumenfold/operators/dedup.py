"""First-occurrence dedup, and totals with a count of what they leave out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions import text as T
from lumenfold.operators.shared import checkpoint


def mark_repeats(rows: DataFrame, keys: dict[str, Column], eligible: Column, order: str) -> DataFrame:
    """``is_duplicate`` and ``duplicate_of`` of rows that repeat the keys of a row with a lesser ``order``.

    The least ``order`` of each key is aggregated before the shuffle and joined back, so
    that a very common key needs no single task; rows that aren't eligible are never repeats."""
    names = [f"_k_{k}" for k in keys]
    keyed = rows.withColumns(dict(zip(names, keys.values()))).withColumn("_ok", F.coalesce(eligible, F.lit(False)))
    first = keyed.where("_ok").groupBy(*names).agg(F.min(order).alias("_first")).withColumn("_ok", F.lit(True))
    told = keyed.join(first, [*names, "_ok"], "left")
    again = F.col("_ok") & (F.col(order) > F.col("_first"))
    return told.withColumn("is_duplicate", F.coalesce(again, F.lit(False))).withColumn("duplicate_of", F.when(F.col("is_duplicate"), F.col("_first"))).drop(*names, "_ok", "_first")


def dedup_donations(rows: DataFrame) -> DataFrame:
    """Event rows with ``is_duplicate`` and ``duplicate_of_event_id``: replays of an identifying donation."""
    donor, message, amount = T.normalize_donor(F.col("donor")), T.normalize_message(F.col("message")), T.normalize_amount(F.col("amount"))
    keys = {"donor": donor, "amount": amount, "currency": T.normalize_currency(F.col("currency")), "message": message}
    eligible = F.col("parsed_ok") & amount.isNotNull() & ~F.isnan(amount) & T.is_identifying(donor, message)
    return mark_repeats(rows, keys, eligible, "event_id").withColumnRenamed("duplicate_of", "duplicate_of_event_id")


def counted() -> Column:
    """Whether the totals count a row that isn't a duplicate."""
    number = T.normalize_amount(F.col("amount"))
    low = F.coalesce(F.col("best_detection_confidence") < 0.5, F.lit(False))
    return F.coalesce(F.col("parsed_ok"), F.lit(False)) & ~F.coalesce(F.col("needs_review"), F.lit(False)) & ~low & number.isNotNull()


def totals_by_currency(rows: DataFrame) -> DataFrame:
    """Count and sum per raw currency of rows that aren't duplicates, unreadable, under review or of low confidence."""
    currency = F.coalesce(F.when(F.col("currency") != "", F.col("currency")), F.lit("NO_CURRENCY"))
    kept = rows.where(~F.coalesce(F.col("is_duplicate"), F.lit(False)) & counted())
    n = F.count("*")
    return kept.groupBy(currency.alias("currency")).agg(n.alias("events_count"), n.alias("amount_count"), F.round(F.sum(T.normalize_amount(F.col("amount"))), 2).alias("amount_sum"))


def totals_skipped(rows: DataFrame) -> DataFrame:
    """One row: how many non-duplicate rows the totals leave out, and how many duplicates there are."""
    duplicate = F.coalesce(F.col("is_duplicate"), F.lit(False))
    return rows.agg(F.count_if(~duplicate & ~counted()).alias("skipped"), F.count_if(duplicate).alias("duplicates"))


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, is_duplicate, duplicate_of`` by text in lower case with white space collapsed; NULL texts never repeat.

    Texts are read and hashed once; only ids and hashes are kept for the join."""
    key = F.unhex(F.sha2(F.lower(T.collapse(F.col("text"))), 256))
    own = checkpoint(docs.select("doc_id", key.alias("key")))
    return mark_repeats(own, {"text": F.col("key")}, F.col("key").isNotNull(), "doc_id").select("doc_id", "is_duplicate", "duplicate_of")
