"""Categories: from tags, from keywords, from names."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirspark import constants as C
from dirspark.functions.text import tokens
from dirspark.operators.relational import any_of

# Tag keys in the order of their weight, and values that say nothing.
TAG_KEYS = ("shop", "amenity", "office", "craft", "healthcare", "tourism", "leisure")
EMPTY_VALUES = ("yes", "no", "true", "1")
DROPPED = "__EXCLUDED__"


def deciding_tag(tags: Column) -> Column:
    """struct(key, value) of the first usable tag. It decides even if no mapping knows it."""
    options = [F.when(tags[k].isNotNull() & (tags[k] != "") & ~tags[k].isin(*EMPTY_VALUES), F.struct(F.lit(k).alias("key"), tags[k].alias("value"))) for k in TAG_KEYS]
    return F.coalesce(*options)


def by_tag(rows: DataFrame, tag_map: DataFrame, tags: str = "tags") -> tuple[DataFrame, DataFrame]:
    """Rows with category, subcategory and business_type from tag_map(key, value, ...), and the counts of unmapped tags."""
    rows = rows.withColumn("_tag", deciding_tag(F.col(tags))).where("_tag IS NOT NULL")
    rows = rows.withColumns({"key": F.col("_tag.key"), "value": F.col("_tag.value")}).drop("_tag")
    hit = rows.join(tag_map, ["key", "value"])
    missed = rows.join(tag_map, ["key", "value"], "left_anti").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return hit.drop("key", "value"), missed.orderBy(F.col("n").desc(), "key", "value").limit(400)


def once(value: Column, told: Callable[[Column], Column]) -> Column:
    """told(value), with value worked out once however often told refers to it."""
    return F.transform(F.array(value), told)[0]


def any_key(keys: tuple[str, ...]) -> Callable[[Column], Column]:
    """Whether a text (hay, and padded: its tokens between blanks) has one of the keys: one pattern for keys that begin or are a token, and substrings for those with _ or a blank."""
    inner = [k for k in keys if "_" in k or " " in k]
    starts = "|".join(re.escape(k) + ("" if len(k) >= 4 else " ") for k in keys if k not in inner)
    return lambda s: any_of([F.contains(s["hay"], F.lit(k)) for k in inner] + ([F.rlike(s["padded"], F.lit(f" (?:{starts})"))] if starts else []))


def resolve(text: Column, rules: list[tuple[tuple[str, ...], str | None]] | None = None) -> Column:
    """The category of one category text: DROPPED if excluded, else by whole tokens, else by the first rule, else null."""

    def told(s: Column) -> Column:
        out = F.lit(None).cast("string")
        for keys, slug in reversed(C.KEYWORD_RULES if rules is None else rules):
            out = F.when(any_key(keys)(s), F.lit(slug)).otherwise(out)
        for token, slug in reversed(C.EXTRA_TOKENS.items()):
            out = F.when(F.contains(s["padded"], F.lit(f" {token} ")), F.lit(slug)).otherwise(out)
        return F.when(any_key(C.EXCLUDED)(s), F.lit(DROPPED)).otherwise(out)

    padded = F.concat(F.lit(" "), F.array_join(tokens(text), " "), F.lit(" "))
    return F.when(text.isNotNull() & (text != ""), once(F.struct(F.lower(text).alias("hay"), padded.alias("padded")), told))


def by_keywords(rows: DataFrame, primary: str, alternates: str, rules: list | None = None) -> DataFrame:
    """Adds category: of the primary text, else of the first alternate that has one; an exclusion on the way makes it null.

    Texts repeat a lot, so distinct ones are resolved once and joined back.
    """
    texts = rows.select(F.explode(F.array_distinct(F.concat(F.array(primary), F.coalesce(F.col(alternates), F.expr("cast(array() as array<string>)"))))).alias("_text")).distinct()
    known = texts.where("_text IS NOT NULL").withColumn("_slug", resolve(F.col("_text"), rules)).where("_slug IS NOT NULL")
    asked = rows.select(primary, alternates).distinct().withColumn("_texts", F.concat(F.array(primary), F.coalesce(F.col(alternates), F.expr("cast(array() as array<string>)"))))
    ranked = asked.select(primary, alternates, F.posexplode("_texts").alias("_pos", "_text")).join(known, "_text").groupBy(primary, alternates).agg(F.min_by("_slug", "_pos").alias("_slug"))
    out = rows.alias("r").join(ranked.alias("k"), F.col(f"r.{primary}").eqNullSafe(F.col(f"k.{primary}")) & F.col(f"r.{alternates}").eqNullSafe(F.col(f"k.{alternates}")), "left")
    return out.select("r.*", F.nullif(F.col("k._slug"), F.lit(DROPPED)).alias("category"))


def by_joined_text(primary: Column, alternates: Column, rules: list | None = None) -> Column:
    """The older rule: substrings in all texts together; first hit wins."""
    has = lambda hay, keys: F.rlike(hay, F.lit("|".join(map(re.escape, keys))))

    def told(hay: Column) -> Column:
        out = F.lit(None).cast("string")
        for keys, slug in reversed(C.KEYWORD_RULES if rules is None else rules):
            out = F.when(has(hay, keys), F.lit(slug)).otherwise(out)
        return F.when(has(hay, C.EXCLUDED), F.lit(None).cast("string")).otherwise(out)

    return once(F.lower(F.concat_ws(" ", primary, alternates)), told)


def fold_name_rules(rows: DataFrame, rules: list[tuple[str, str, str, str]] | None = None, ignore_case: bool = True) -> DataFrame:
    """Rules one after another on category, subcategory and business_type: each fires only where the category differs."""
    matched = []
    for pattern, category, sub, kind in C.NAME_RULES if rules is None else rules:
        to = F.struct(F.lit(category).alias("category"), F.lit(sub).alias("subcategory"), F.lit(kind).alias("business_type"))
        matched.append(F.when(F.rlike("display_name", F.lit("(?i)" * ignore_case + pattern)), to))
    start = F.struct(*[F.col(c).cast("string").alias(c) for c in ("category", "subcategory", "business_type")])
    state = F.aggregate(F.array(*matched), start, lambda s, r: F.when(r.isNull() | s["category"].eqNullSafe(r["category"]), s).otherwise(r))
    others = [c for c in rows.columns if c not in ("category", "subcategory", "business_type")]
    return rows.select(*others, state.alias("_s")).select(*others, "_s.category", "_s.subcategory", "_s.business_type")


def by_script(rows: DataFrame) -> DataFrame:
    """The rules for names in Indian scripts."""
    return fold_name_rules(rows, C.SCRIPT_RULES, ignore_case=False)


def mark_utilities(rows: DataFrame) -> DataFrame:
    return rows.withColumn("business_type", F.when(F.rlike("display_name", F.lit("(?i)" + C.UTILITY_NAME)), "PUBLIC_SERVICE").otherwise(F.col("business_type")))


def quality_flags(rows: DataFrame, flags: str = "quality_flags") -> DataFrame:
    """Adds each flag once, in order: generic_name, no_contact_no_address."""
    old = F.coalesce(F.col(flags), F.expr("cast(array() as array<string>)")) if flags in rows.columns else F.expr("cast(array() as array<string>)")
    none = F.expr("cast(array() as array<string>)")
    generic = F.when(F.rlike("display_name", F.lit("(?i)" + C.GENERIC_NAME)), F.array(F.lit("generic_name"))).otherwise(none)
    bare = F.when(F.col("public_phone").isNull() & F.col("address").isNull() & F.col("website").isNull(), F.array(F.lit("no_contact_no_address"))).otherwise(none)
    return rows.withColumn(flags, F.array_union(F.array_union(old, generic), bare))


def category_changes(rows: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new category of the rows whose category changes, by external_id."""
    joined = rows.select("external_id", F.col("category").alias("old")).join(new.select("external_id", F.col("category").alias("new")), "external_id")
    return joined.where(~F.col("old").eqNullSafe(F.col("new")))
