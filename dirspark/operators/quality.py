"""Contact suppression, scores and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirspark.functions.contact import phone_status

SHARE_LIMIT = 3
VALID = ("valid_mobile", "valid_landline")


def has(column: str, points: int) -> Column:
    return F.when(F.col(column).isNotNull(), points).otherwise(0)


def classify_phones(rows: DataFrame) -> DataFrame:
    """Adds phone_status and phone_raw; numbers that aren't valid are no longer public."""
    out = rows.withColumns({"phone_raw": F.col("public_phone"), "phone_status": phone_status(F.col("public_phone"))})
    return hide_phone(out, ~F.col("phone_status").isin(*VALID))


def hide_phone(rows: DataFrame, when: Column) -> DataFrame:
    hidden = {"public_phone": F.when(F.coalesce(when, F.lit(False)), F.lit(None)).otherwise(F.col("public_phone"))}
    if "phone_line_type" in rows.columns:
        hidden["phone_line_type"] = F.when(F.coalesce(when, F.lit(False)), F.lit(None)).otherwise(F.col("phone_line_type"))
    return rows.withColumns(hidden)


def suppress_shared(rows: DataFrame, limit: int = SHARE_LIMIT, only_valid: bool = False) -> DataFrame:
    """A number on more than limit rows is kept in phone_raw, marked shared_number and no longer public.

    Counts are aggregated before they are shuffled, and only shared numbers are joined back, to rows that have a number: rows
    without one go past the join, so no null key gathers them. A number that many rows have is left to the planner's skew join.
    """
    counted = rows.where(F.col("public_phone").isNotNull() & (F.col("phone_status").isin(*VALID) if only_valid else F.lit(True)))
    shared = counted.groupBy("public_phone").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select("public_phone", F.lit(True).alias("_shared"))
    some = F.col("public_phone").isNotNull()
    out = rows.where(some).join(shared, "public_phone", "left").select(*rows.columns, "_shared").unionByName(rows.where(~some).withColumn("_shared", F.lit(None).cast("boolean")))
    old_raw = F.col("phone_raw") if "phone_raw" in rows.columns else F.lit(None).cast("string")
    old_status = F.col("phone_status") if "phone_status" in rows.columns else F.lit(None).cast("string")
    out = out.withColumns({"phone_raw": F.when(F.col("_shared"), F.coalesce(old_raw, "public_phone")).otherwise(old_raw), "phone_status": F.when(F.col("_shared"), "shared_number").otherwise(old_status)})
    return hide_phone(out, F.col("_shared")).drop("_shared")


def completeness(with_hours: bool = True) -> Column:
    out = F.lit(45) + has("public_phone", 20) + has("address", 15) + has("website", 10)
    return (out + has("hours", 10)) if with_hours else out


def confidence() -> Column:
    by_code = F.when(F.col("code_confidence") >= 0.90, 15).when(F.col("code_confidence") >= 0.70, 8).otherwise(0)
    exact = F.when(F.col("location_accuracy") == "building", 10).otherwise(5)
    return F.least(F.lit(95), F.lit(40) + by_code + has("public_phone", 15) + has("address", 10) + exact + has("website", 5))


def charging_confidence() -> Column:
    return F.least(F.lit(95), F.lit(55) + has("public_phone", 15) + has("address", 10))


def freshness(updated_at: Column, as_of: str) -> Column:
    """100 for today, 0 after three years, null without a time; rounded before it is cut to a whole number."""
    days = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(updated_at)).cast("double") / 86400
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - F.round(days / 1095 * 100).cast("int"))).cast("int")
    return F.when(days.isNotNull(), score)  # greatest and least pass over nulls


def tier(with_confidence: bool = True) -> Column:
    held = F.col("code").isNull() | (F.coalesce(F.col("code_confidence") < 0.55, F.lit(False)) if with_confidence else F.lit(False))
    return F.when(held, "HELD").when(F.col("public_phone").isNotNull(), "CONTACTABLE").otherwise("LOCATABLE")


def scored(rows: DataFrame, as_of: str) -> DataFrame:
    return rows.withColumns({"completeness_score": completeness(), "confidence_score": confidence(), "freshness_score": freshness(F.col("updated_at"), as_of), "tier": tier()})
