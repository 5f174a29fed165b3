"""Names, duplicates, registers, coverage, leads, exports, search, enrichment and checks: the directory's own operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark import constants as C
from dirspark.functions.geo import KM_PER_DEGREE, haversine
from dirspark.functions.text import first_hint, gram_similarity, labelled, tokens, trigrams
from dirspark.operators.categorise import DROPPED, resolve
from dirspark.operators.geography import within
from dirspark.operators.relational import any_of, components, first_per_key, fixed, top_per_key, upsert


# names
def ambiguous_names(rows: DataFrame) -> DataFrame:
    """canonical_name and code that more than one row has."""
    named = rows.where(F.col("code").isNotNull() & (F.col("canonical_name") != ""))
    return named.groupBy("canonical_name", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def labels_of(spark: SparkSession, labels: dict[str, str] | None = None) -> DataFrame:
    """category and label; by default those of the constants."""
    return spark.createDataFrame(list((C.LABELS if labels is None else labels).items()), "category string, label string")


def unresolved_names(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows without a resolved_name get name_reason and one; rows that have one stay as they are, but count where names are compared."""
    whole = resolved_names(rows.withColumnsRenamed({"resolved_name": "_old_name", "name_reason": "_old_reason"}), labels)
    done = F.col("_old_name").isNotNull()
    told = whole.withColumns({"name_reason": F.when(done, F.col("_old_reason")).otherwise(F.col("name_reason")), "resolved_name": F.coalesce("_old_name", "resolved_name")})
    return told.select(*rows.columns)


def review_queue(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows for a human to decide: no category at all, a position, a name that hints at one, and an id that known doesn't have.

    rows: external_id, display_name, category, category_alt, lat, lon, phones, address, postcode. A primary category, or an alternate that the rules know, keeps a row out.
    """
    hint = first_hint(F.col("display_name"), C.NAME_HINTS)
    mapped = F.exists(F.coalesce("category_alt", F.expr("cast(array() as array<string>)")), lambda a: F.coalesce(resolve(a), F.lit(DROPPED)) != DROPPED)
    open_ = rows.where(F.col("category").isNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.coalesce("display_name", F.lit("")) != "") & ~mapped)
    open_ = open_.join(known.select("external_id"), "external_id", "left_anti").withColumn("h", hint).where("h IS NOT NULL")
    payload = F.to_json(F.struct("lat", "lon", F.coalesce("phones", F.expr("cast(array() as array<string>)")).alias("phones"), F.col("address").alias("addr"), "postcode"), {"ignoreNullFields": "false"})
    return open_.select("external_id", F.lit("null_category_name_hint").alias("reason"), "display_name", F.col("h.slug").alias("suggested_category"), F.col("h.evidence").alias("evidence"), payload.alias("payload"), F.lit("pending").alias("status"))


def resolved_names(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds name_reason and resolved_name: a label and locality are appended where a name alone doesn't tell (labels: category, label)."""
    out = rows.join(ambiguous_names(rows).select("canonical_name", "code", F.lit(True).alias("_twice")), ["canonical_name", "code"], "left").join(labels, "category", "left")
    chain = F.col("brand_name").isNotNull() & (F.lower("brand_name") == F.lower("display_name"))
    reason = F.when(F.col("_twice"), "ambiguous_in_code").when(chain, "chain_branch").when(~F.rlike("display_name", F.lit("(?i)" + C.CATEGORY_WORD)), "generic_name")
    out = out.withColumn("name_reason", reason)
    full = F.when(F.col("label").isNull(), F.concat(F.col("display_name"), F.coalesce(F.concat(F.lit(", "), F.col("locality")), F.lit("")))).otherwise(labelled(F.col("display_name"), F.col("label"), F.col("locality")))
    return out.withColumn("resolved_name", F.when(F.col("name_reason").isNotNull(), full).otherwise(F.col("display_name"))).drop("_twice", "label")


# duplicates
def new_by_phone(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose phone no existing row has. Rows without a phone go past the join."""
    return without_phones(incoming, existing)


def without_phones(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows but for those whose phone is among the others'. Null phones would all meet in one task of the join, so they don't take part."""
    known = others.where("public_phone IS NOT NULL").select("public_phone").distinct()
    told = rows.where("public_phone IS NOT NULL").join(known, "public_phone", "left_anti")
    return told.select(*rows.columns).unionByName(rows.where("public_phone IS NULL"))


def by_name_and_place(incoming: DataFrame, existing: DataFrame, km: float = 0.15, least: float = 0.55, how: str = "left_anti") -> DataFrame:
    """Incoming rows without (left_anti) or with (left_semi) an existing row near and of a similar name.

    Existing rows only: duplicates within the incoming rows stay. Trigrams are made once for each row.
    """
    left = incoming.withColumn("_grams", trigrams(F.col("canonical_name")))
    right = existing.select(F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), trigrams(F.col("canonical_name")).alias("_r_grams"))
    return within(left, right, km, gram_similarity(F.col("_grams"), F.col("_r_grams")) > least, how).drop("_grams")


def duplicate_links(rows: DataFrame, km: float = 0.15, least: float = 0.55) -> DataFrame:
    """Links (a, b) of rows that are one business, by two causes: one phone, or a similar name nearby. Rows of a phone are linked to its smallest id, not to each other."""
    phones = rows.where("public_phone IS NOT NULL").select("external_id", "public_phone")
    by_phone = phones.join(phones.groupBy("public_phone").agg(F.min("external_id").alias("b")), "public_phone").select(F.col("external_id").alias("a"), "b")
    told = rows.where("canonical_name <> ''").select("external_id", "lat", "lon", "canonical_name")
    # rows of one name at one position are linked to the smallest of them, and that one meets the others
    spots = told.groupBy("lat", "lon", "canonical_name").agg(F.min("external_id").alias("b"))
    at_spot = told.join(spots, ["lat", "lon", "canonical_name"]).select(F.col("external_id").alias("a"), "b")
    left = spots.select(F.col("b").alias("a"), "lat", "lon", trigrams(F.col("canonical_name")).alias("_grams"))
    right = spots.select("b", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), trigrams(F.col("canonical_name")).alias("_r_grams"))
    by_place = within(left, right, km, (F.col("a") > F.col("b")) & (gram_similarity(F.col("_grams"), F.col("_r_grams")) > least), "inner").select("a", "b")
    return by_phone.unionByName(at_spot).unionByName(by_place).where("a <> b").distinct()


def merged_duplicates(rows: DataFrame, km: float = 0.15, least: float = 0.55) -> DataFrame:
    """external_id, survivor and merged_into of each row: links of both causes, and the pointers that rows already have, are followed to their ends.

    The survivor of a group is its most complete row, then the most confident, then the one with the smallest id; merged_into is the survivor for all others and null for itself. Rows without
    a duplicate survive by themselves. A pointer to an id that no row has still joins those that share it.
    """
    old = rows.where("merged_into IS NOT NULL").select(F.col("external_id").alias("a"), F.col("merged_into").alias("b"))
    labels = components(duplicate_links(rows, km, least).unionByName(old.where("a <> b")))
    told = rows.select("external_id", "completeness_score", "confidence_score").join(labels.withColumnRenamed("node", "external_id"), "external_id", "left").withColumn("label", F.coalesce("label", "external_id"))
    order = F.struct((-F.coalesce("completeness_score", F.lit(-1))).alias("x"), (-F.coalesce("confidence_score", F.lit(-1))).alias("y"), F.col("external_id").alias("survivor"))
    best = told.groupBy("label").agg(F.min(order)["survivor"].alias("survivor"))
    return told.join(best, "label").select("external_id", "survivor", F.when(F.col("survivor") != F.col("external_id"), F.col("survivor")).alias("merged_into"))


# registers
def similar_names(left: DataFrame, right: DataFrame, least: float = 0.55) -> DataFrame:
    """Pairs (area, l_name, r_name, similarity) of names of one area whose trigrams are at least so similar; both sides have area and name.

    No radius and no comparison of all with all: trigrams are ordered by how rare they are, and two names as similar as that share one of the first few of either
    (all but least times their number, and one more), so names meet by an equal join on those, if their numbers of trigrams allow the similarity. Equal names are one row.
    """
    def sized(rows: DataFrame, side: str) -> DataFrame:
        named = rows.where("area IS NOT NULL AND name IS NOT NULL").select("area", "name").distinct().withColumn("grams", trigrams(F.col("name"))).where("size(grams) > 0")
        return named.select(F.lit(side).alias("side"), "area", "name", "grams")

    names = sized(left, "l").unionByName(sized(right, "r"))
    each = names.select("side", "area", "name", F.explode("grams").alias("gram"))
    counts = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = each.join(counts, "gram").groupBy("side", "area", "name").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("x")).select("side", "area", "name", F.col("x.gram").alias("grams"), F.size("x").alias("size"))
    # 1e-9: what least times a number is as a double may lie above the whole number that it stands for
    first = ordered.withColumn("gram", F.explode(F.slice("grams", F.lit(1), (F.col("size") - F.ceil(F.lit(least) * F.col("size") - 1e-9) + 1).cast("int"))))
    one = lambda side: first.where(F.col("side") == side).select("area", "gram", F.col("name").alias(f"{side}_name"), F.col("grams").alias(f"{side}_grams"), F.col("size").alias(f"{side}_size"))
    fits = (F.col("l_size") >= F.col("r_size") * least - 1e-9) & (F.col("r_size") >= F.col("l_size") * least - 1e-9)
    pairs = one("l").join(one("r"), ["area", "gram"]).where(fits).withColumn("similarity", gram_similarity(F.col("l_grams"), F.col("r_grams"))).where(F.col("similarity") >= least)
    return pairs.select("area", "l_name", "r_name", "similarity").distinct()


def fuzzy_registry_matches(rows: DataFrame, register: DataFrame, least: float = 0.7, least_length: int = 8) -> DataFrame:
    """external_id with the register's entry of the most similar name in the same district; of equal ones the smallest registry_id. registry_score is the similarity."""
    told = rows.where(F.length("canonical_name") >= least_length).select("external_id", F.lower("district").alias("area"), F.col("canonical_name").alias("name"))
    entries = register.select("registry_id", "trade", F.lower("district").alias("area"), F.col("canonical_name").alias("name"))
    first = entries.groupBy("area", "name").agg(F.min(F.struct("registry_id", "trade")).alias("entry"))
    pairs = similar_names(told, entries, least).join(first.withColumnRenamed("name", "r_name"), ["area", "r_name"])
    best = pairs.groupBy("area", "l_name").agg(F.min(F.struct((-F.col("similarity")).alias("far"), F.col("entry.registry_id").alias("registry_id"), F.col("entry.trade").alias("trade"))).alias("x"))
    found = told.join(best.withColumnRenamed("l_name", "name"), ["area", "name"])
    return found.select("external_id", F.col("x.registry_id").alias("registry_match_id"), F.col("x.trade").alias("registry_trade"), (-F.col("x.far")).alias("registry_score"))


def registry_matches(rows: DataFrame, register: DataFrame, least_length: int = 8) -> DataFrame:
    """external_id with the smallest registry_id of an entry of the same canonical name in the same district."""
    left = rows.where(F.length("canonical_name") >= least_length).select("external_id", "canonical_name", F.lower("district").alias("_d"))
    right = register.select("registry_id", "trade", "canonical_name", F.lower("district").alias("_d"))
    best = left.join(right, ["canonical_name", "_d"]).groupBy("external_id").agg(F.min("registry_id").alias("registry_match_id"), F.min_by("trade", "registry_id").alias("registry_trade"))
    return best.withColumns({"registry_score": F.lit(1.0), "verification_status": F.lit("source_verified")})


def area_gap(register: DataFrame, rows: DataFrame, least: int = 20) -> DataFrame:
    """Registered and mapped counts of each district and area, where at least so many are registered."""
    key = lambda c: F.lower(F.coalesce(c, F.lit("")))
    reg = register.groupBy(F.lower("district").alias("district"), key("area").alias("area")).agg(F.count(F.lit(1)).alias("registered"))
    mapped = rows.groupBy(F.lower("district").alias("district"), key("area").alias("area")).agg(F.count(F.lit(1)).alias("mapped"))
    out = reg.where(F.col("registered") >= least).join(mapped, ["district", "area"], "left").withColumn("mapped", F.coalesce("mapped", F.lit(0)))
    return out.withColumns({"gap": F.greatest(F.col("registered") - F.col("mapped"), F.lit(0)), "coverage_pct": F.round(F.lit(100.0) * F.col("mapped") / F.col("registered"), 1)})


# coverage
def coverage(rows: DataFrame) -> DataFrame:
    """Counts and status of each code and category."""
    kept = rows.where("code IS NOT NULL AND category IS NOT NULL AND tier <> 'HELD'")
    n = F.count(F.lit(1))
    status = F.when(n == 1, "insufficient").when(n == 2, "minimum_reached").when(n == 3, "target_reached").otherwise("over_target")
    return kept.groupBy("code", "category").agg(n.alias("found"), F.count_if(F.col("tier") == "CONTACTABLE").alias("contactable"), F.count_if(F.col("tier") == "LOCATABLE").alias("locatable"), status.alias("status"))


def coverage_gaps(cells: DataFrame) -> DataFrame:
    gap = F.greatest(F.lit(2) - F.col("contactable"), F.lit(0))
    return cells.select("code", "category", F.col("found").alias("mapped"), "contactable", gap.alias("gap"), (gap * 10 + F.least("found", F.lit(5))).alias("priority"))


# leads
def leads(rows: DataFrame, gaps: DataFrame, existing: DataFrame, suppressed: DataFrame, limit: int, extra: Column | None = None) -> DataFrame:
    """The next limit rows to contact: chosen by phone, category and place, then scored in full, with the breakdown as JSON."""
    c = F.col
    kind = F.when(c("category").isin(*C.TIER1), 25).when(c("category").isin(*C.TIER2), 15).otherwise(5)
    parts = {
        "phone": F.when(c("public_phone").isNotNull(), 20).otherwise(0), "mobile_line": F.when(c("phone_line_type") == "mobile", 10).otherwise(0), "web_or_email": F.when(c("website").isNotNull(), 10).otherwise(0),
        "category_priority": kind, "location_confidence": F.when(c("code_confidence") >= 0.90, 20).when(c("code_confidence") >= 0.70, 10).otherwise(0), "geometry": F.when(c("location_accuracy") == "building", 10).otherwise(5),
        "freshness": F.when(c("freshness_score") >= 50, 10).when(c("freshness_score").isNull(), 0).otherwise(3), "coverage_gap": F.least(F.coalesce("gap", F.lit(0)) * 5, F.lit(25)).cast("int"),
    }
    open_ = rows.where("tier <> 'HELD' AND code IS NOT NULL AND category IS NOT NULL").where(F.lit(True) if extra is None else extra)
    open_ = without_phones(open_.join(existing.select("external_id"), "external_id", "left_anti"), suppressed)
    chosen = open_.withColumn("_order", parts["phone"] + kind + F.when(c("code_confidence") >= 0.90, 20).otherwise(0)).orderBy(c("_order").desc(), "external_id").limit(limit)
    chosen = chosen.join(gaps.select("code", "category", "gap"), ["code", "category"], "left").withColumns({f"_{k}": v.cast("int") for k, v in parts.items()})
    total = sum((c(f"_{k}") for k in parts), F.lit(0))
    names = F.struct(*[c(f"_{k}").alias(k) for k in parts], total.alias("total"))
    return chosen.select("external_id", "code", "category", total.alias("score"), F.to_json(names).alias("score_breakdown"), F.when(c("public_phone").isNotNull(), "ready_for_outreach").otherwise("incomplete").alias("status"))


# exports
EXCLUSIONS = {
    "tier_held": "tier = 'HELD'", "no_code": "code IS NULL", "low_code_confidence": "code_confidence < 0.55", "unverified_centroid": "centroid_src = 'unverified'", "no_category": "category IS NULL",
    "merged_away": "merged_into IS NOT NULL", "suppressed": "lifecycle_status IN ('suppressed', 'deletion_requested', 'rejected')", "source_not_redistributable": "coalesce(redistribution_allowed, false) = false",
}


def exclusion_counts(rows: DataFrame) -> DataFrame:
    """How many rows each reason withholds (reasons overlap) and how many any does, in one pass."""
    any_reason = " OR ".join(f"({x})" for x in EXCLUSIONS.values())
    return rows.agg(*[F.count_if(F.expr(x)).alias(k) for k, x in EXCLUSIONS.items()], F.count_if(F.expr(any_reason)).alias("excluded_total"))


def eligible(rows: DataFrame) -> DataFrame:
    """Rows that no reason withholds; an unknown confidence withholds without being a reason."""
    return rows.where("NOT (" + " OR ".join(f"({x})" for x in EXCLUSIONS.values()) + ")")


def export_records(rows: DataFrame) -> DataFrame:
    """The export's fields in order; what the rows lack is null."""
    renamed = {"external_directory_id": "external_id", "pincode": "code", "pincode_confidence": "code_confidence", "pincode_method": "code_method", "latitude": "lat", "longitude": "lon", "opening_hours": "hours", "address_line_1": "address", "last_seen_at": "updated_at"}
    fixed = {"country": F.lit("IN"), "publication_type": F.lit("directory_listing"), **{c: F.lit(True) for c in ("products_disabled", "offers_disabled", "reviews_disabled", "owner_contact_unconfirmed")}}
    have = set(rows.columns)
    field = lambda f: fixed[f] if f in fixed else F.col(renamed.get(f, f)) if renamed.get(f, f) in have else F.lit(None).cast("string")
    return rows.select(*[(F.coalesce("resolved_name", "display_name") if f == "resolved_name" and f in have else F.col("display_name") if f == "resolved_name" else field(f)).alias(f) for f in C.EXPORT_FIELDS])


def export_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("pincode", "category", F.col("confidence_score").desc_nulls_first(), "external_directory_id")


def manifest_sources(records: DataFrame) -> DataFrame:
    return records.groupBy("source_name", "licence_name", "attribution_text").agg(F.count(F.lit(1)).alias("n"))


def manifest_values(records: DataFrame) -> DataFrame:
    """One row of sorted distinct values."""
    return records.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in ("licence_name", "pincode", "category", "attribution_text")])


def push_chunk(rows: DataFrame, per_category: int, limit: int) -> DataFrame:
    """The best rows of each category, in rounds over the categories."""
    ready = rows.where("tier <> 'HELD' AND code IS NOT NULL AND code_confidence >= 0.70 AND centroid_src <> 'unverified' AND merged_into IS NULL AND category IS NOT NULL")
    best = top_per_key(ready, ["category"], [F.col("completeness_score").desc(), F.col("confidence_score").desc(), F.col("external_id").asc()], per_category, "rn")
    return best.orderBy("rn", "category", "external_id").limit(limit)


def protected_upsert(platform: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows replace platform rows by source and record, but for claimed or verified ones; old phones and sites survive nulls."""
    safe = platform.where("claim_status IN ('CLAIMED', 'CLAIM_PENDING') OR verification_status = 'VERIFIED'").select("source_name", "source_record_id")
    return upsert(platform, incoming.join(safe, ["source_name", "source_record_id"], "left_anti"), ["source_name", "source_record_id"], ["public_phone", "website", "claim_status", "verification_status"])


def missing_addresses(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    """Address rows for rows that have none yet."""
    return rows.join(addresses.select("external_id"), "external_id", "left_anti").select("external_id", F.coalesce("address", "locality").alias("line"), "code", "lat", "lon")


def pushable_by_state(rows: DataFrame) -> DataFrame:
    return rows.where("tier <> 'HELD' AND code_confidence >= 0.70").groupBy("state").agg(F.count(F.lit(1)).alias("n"))


# search
def search(rows: DataFrame, term: str, tier: str | None = None, limit: int = 60) -> DataFrame:
    """Rows whose name is similar to the term, or whose place or category holds it, or whose code it is; newest first."""
    like = f"%{term}%"
    hit = (gram_similarity(trigrams(F.col("display_name")), trigrams(F.lit(term))) >= 0.35) | F.coalesce(F.col("locality").ilike(like), F.lit(False)) | F.coalesce(F.col("city").ilike(like), F.lit(False)) | F.coalesce(F.col("category").ilike(like), F.lit(False)) | F.coalesce(F.col("code") == term, F.lit(False))
    found = rows.where(hit & (F.lit(True) if tier is None else F.col("tier") == tier))
    return found.orderBy(F.col("updated_at").desc_nulls_last(), "external_id").limit(limit)


def text_search(rows: DataFrame, query: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """All words must occur; weight 4 in the name, 2 in category and locality. n_found is the number of all hits."""
    words = [w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split() if w]
    name, rest = tokens(F.col("display_name")), tokens(F.concat_ws(" ", "category", "locality"))
    rows = rows.withColumns({"_a": name, "_b": rest})
    where = [F.array_contains("_a", w) | F.array_contains("_b", w) for w in words]
    rank = sum((F.when(F.array_contains("_a", w), 4).otherwise(0) + F.when(F.array_contains("_b", w), 2).otherwise(0) for w in words), F.lit(0))
    hits = rows.where(F.lit(bool(words)) & F.expr("true")).where(any_of([F.lit(False)]) if not words else where[0])
    for w in where[1:]:
        hits = hits.where(w)
    hits = hits.withColumn("rank", rank)
    page = hits.orderBy(F.col("rank").desc(), "external_id").offset(offset).limit(limit).drop("_a", "_b")
    return page.join(F.broadcast(hits.agg(F.count(F.lit(1)).alias("n_found"))))  # one number


def radius_search(rows: DataFrame, query: str, lat: float, lon: float, km: float = 10.0, limit: int = 20, least: float = 0.3) -> DataFrame:
    """Rows within km of a point that hold all words, by rank (4 in the name, 2 in category and locality), nearness and id; where none does and the query has four characters or more, those with a similar name.

    A box around the circle goes to the scan, so only what lies near is measured.
    """
    high = km / KM_PER_DEGREE
    wide = high / max(math.cos(math.radians(min(abs(lat) + high, 89.0))), 1e-3)
    near = rows.where(F.col("lat").between(lat - high, lat + high) & F.col("lon").between(lon - wide, lon + wide))
    near = near.withColumn("d_km", haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))).where(F.col("d_km") <= km)
    words = [w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split() if w]
    told = near.withColumns({"_a": tokens(F.col("display_name")), "_b": tokens(F.concat_ws(" ", "category", "locality"))})
    rank = sum((F.when(F.array_contains("_a", w), 4).otherwise(0) + F.when(F.array_contains("_b", w), 2).otherwise(0) for w in words), F.lit(0))
    hits = told.withColumn("rank", rank.cast("double"))
    for w in words:
        hits = hits.where(F.array_contains("_a", w) | F.array_contains("_b", w))
    if len(query) < 4:
        return hits.drop("_a", "_b").orderBy(F.col("rank").desc(), "d_km", "external_id").limit(limit)
    alike = told.withColumn("rank", gram_similarity(trigrams(F.col("display_name")), trigrams(F.lit(query)))).where(F.col("rank") >= least)
    alike = alike.join(F.broadcast(hits.agg(F.count(F.lit(1)).alias("_n")))).where("_n = 0").drop("_n")
    return hits.unionByName(alike).drop("_a", "_b").orderBy(F.col("rank").desc(), "d_km", "external_id").limit(limit)


# enrichment
def enrich(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with blanks filled from found(external_id, public_phone, hours, email), and a provenance row for each value used."""
    f = found.select("external_id", F.col("public_phone").alias("f_phone"), F.col("hours").alias("f_hours"))
    out = rows.join(f, "external_id", "left")
    used = out.select("external_id", F.explode(F.array(
        F.when(F.col("public_phone").isNull() & F.col("f_phone").isNotNull(), F.struct(F.lit("public_phone").alias("field"), F.col("f_phone").alias("value"))),
        F.when(F.col("hours").isNull() & F.col("f_hours").isNotNull(), F.struct(F.lit("hours").alias("field"), F.col("f_hours").alias("value"))),
    )).alias("v")).where("v IS NOT NULL").select("external_id", "v.field", "v.value", F.lit(0.85).alias("confidence"))
    return out.withColumns({"public_phone": F.coalesce("public_phone", "f_phone"), "hours": F.coalesce("hours", "f_hours")}).drop("f_phone", "f_hours"), used


def enrichment_candidates(rows: DataFrame, limit: int) -> DataFrame:
    return rows.where("website IS NOT NULL AND (public_phone IS NULL OR hours IS NULL)").orderBy(F.col("confidence_score").desc(), "external_id").limit(limit)


def purge_payloads(raw: DataFrame, as_of: str) -> DataFrame:
    due = F.col("purge_after").isNotNull() & (F.col("purge_after") < F.lit(as_of).cast("timestamp"))
    return raw.withColumn("payload", F.when(due, "{}").otherwise(F.col("payload")))


def permanent_ids(rows: DataFrame, mint) -> DataFrame:
    """Ids for rows without one: numbers in the order of external_id go on from the largest. Ranges are numbered apart and moved by prefix sums."""
    todo = rows.where("number IS NULL").select("external_id")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: the borders of the ranges come from a sample, and both uses must see the same.
    parts = fixed(todo.repartitionByRange(n, "external_id").withColumn("_p", F.spark_partition_id()))
    parts = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy("external_id")))
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    last = rows.agg(F.coalesce(F.max("number"), F.lit(0)).alias("_last"))
    new = parts.join(starts, "_p").join(F.broadcast(last)).select("external_id", (F.col("_last") + F.col("_start") + F.col("_i")).alias("_new"))
    out = rows.join(new, "external_id", "left").withColumn("number", F.coalesce("number", "_new")).drop("_new")
    return out.withColumn("permanent_id", mint(F.col("number")))


# checks
def violations(rows: DataFrame, codes: DataFrame, sources: DataFrame, exports: DataFrame, export_rows: DataFrame, leads: DataFrame) -> DataFrame:
    """check and violations: the directory's rules as counts that should be 0, in one pass over each table. leads: external_id, consent."""
    count = lambda e: F.count_if(F.expr(e)).cast("long")
    by_row = {
        "business_has_source": "source IS NULL", "business_has_attribution": "attribution_text IS NULL", "no_self_verification": "coalesce(verification_status NOT IN ('unverified', 'source_verified'), false)", "nothing_claimed": "coalesce(claim_status <> 'unclaimed', false)",
        "inside_box": "NOT (lat BETWEEN 6 AND 37.6 AND lon BETWEEN 68 AND 97.5)", "no_null_island": "lat = 0 AND lon = 0", "banned_method_absent": "code_method = 'nearest_pincode'",
        "phone_format": r"public_phone IS NOT NULL AND NOT public_phone RLIKE '^\\+91[1-9][0-9]{9}$'", "no_tollfree": r"public_phone RLIKE '^\\+91(1800|1860|1900|140)'",
        "suppressed_kept": "phone_status IN ('shared_number', 'tollfree', 'malformed') AND phone_raw IS NULL", "no_descriptions": "description IS NOT NULL", "hours_plausible": "lower(hours) IN ('sunrise-sunset', 'dawn-dusk', 'sunset-sunrise')",
    }
    by_code = {"centroid_moved_sanely": "centroid_offset_km > 100", "unverified_not_targetable": "centroid_src = 'unverified' AND targetable"}
    by_source = {
        "no_denylisted_source": " OR ".join(f"contains(lower(slug), '{d}') OR contains(lower(coalesce(base_url, '')), '{d}')" for d in C.DENYLIST), "enabled_are_approved": "enabled AND status NOT IN ('approved', 'approved_with_restrictions')",
        "enabled_have_licence": "enabled AND licence_name IS NULL", "redistributable_have_attribution": "enabled AND redistribution_allowed AND attribution_text IS NULL",
    }
    by_export = {"exports_have_checksum": "status = 'complete' AND sha256 IS NULL", "exports_have_attribution": "status = 'complete' AND coalesce(attribution, '') = ''"}

    def told(df: DataFrame, rules: dict[str, str]) -> DataFrame:
        one = df.agg(*[count(e).alias(k) for k, e in rules.items()])
        return one.select(F.explode(F.create_map(*[x for k in rules for x in (F.lit(k), F.col(k))])).alias("check", "violations"))

    worst = rows.where("public_phone IS NOT NULL").groupBy("public_phone").count().agg(F.lit("phone_shared_by_few").alias("check"), F.count_if(F.col("count") > 3).cast("long").alias("violations"))
    held = export_rows.join(rows.where("tier = 'HELD'").select("external_id"), "external_id").agg(F.lit("held_never_exported").alias("check"), F.count(F.lit(1)).alias("violations"))
    unasked = export_rows.join(leads.where("consent <> 'granted'").select("external_id"), "external_id").agg(F.lit("leads_never_exported").alias("check"), F.count(F.lit(1)).alias("violations"))
    personal = rows.sparkSession.createDataFrame([("no_personal_columns", sum(any(w in c.lower() for w in ("employer", "proprietor", "owner_name", "aadhaar", "pan_")) for c in rows.columns))], "check string, violations long")
    out = told(rows, by_row)
    for more in (told(codes, by_code), told(sources, by_source), told(exports, by_export), worst, held, unasked, personal):
        out = out.unionByName(more)
    return out


def distinct_by_id(rows: DataFrame, ident: str, order: list[Column]) -> DataFrame:
    return first_per_key(rows, [ident], order)


def without_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(known.select(*keys).distinct(), keys, "left_anti")


