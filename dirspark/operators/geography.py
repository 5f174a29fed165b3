"""Places and codes: nearest neighbours, radius joins, centroids and the ladder that assigns codes."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dirspark import constants as C
from dirspark.functions.geo import EARTH_KM, KM_PER_DEGREE, WIDEST, cell, cube_key, cubes, haversine, neighbours, on_sphere
from dirspark.operators.relational import first_per_key, mode


def nearest(probes: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """Each probe (key, lat, lon) with its nearest point (point, p_lat, p_lon) and d_km; ties go to the smallest point.

    Space is halved into cubes, on the sphere's own coordinates, so nothing has to wrap. The smallest cube that holds the probe and a point, of edge w, has that point within
    w * sqrt(3) < 2 w, so the nearest one lies in the 3 x 3 x 3 cubes of edge 2 w around the probe: cells are small where points are dense, and one
    equal join by cube finds all candidates. Cubes that the sphere doesn't pass through, or that lie farther than that point can, are left out before the join. Points at one position
    count once. Probes and points without a position have no result.
    """
    x = [F.col(c) for c in ("_x", "_y", "_z")]
    points = points.where("p_lat IS NOT NULL AND p_lon IS NOT NULL").groupBy("p_lat", "p_lon").agg(F.min("point").alias("point"))
    told = points.select("point", "p_lat", "p_lon", F.inline(cubes(on_sphere(F.col("p_lat"), F.col("p_lon")))))
    rows = probes.where("lat IS NOT NULL AND lon IS NOT NULL").select(key, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    sphere = on_sphere(F.col("_lat"), F.col("_lon"))
    smallest = rows.select(key, "_lat", "_lon", F.inline(cubes(sphere))).join(told.select("cube").distinct(), "cube", "left_semi").groupBy(key, "_lat", "_lon").agg(F.max("level").alias("level"))
    block = smallest.withColumns({"level": F.greatest(F.col("level") - 1, F.lit(0)), **dict(zip(("_x", "_y", "_z"), sphere, strict=True))}).withColumn("_w", F.lit(WIDEST) / F.pow(F.lit(2.0), "level"))
    steps = F.array(*[F.struct(*[F.lit(d).alias(a) for d, a in zip(step, "ijk", strict=True)]) for step in itertools.product((-1, 0, 1), repeat=3)])
    block = block.withColumn("_step", F.explode(steps))
    indexes = [F.floor(c / F.col("_w")).cast("long") + F.col(f"_step.{a}") for c, a in zip(x, "ijk", strict=True)]
    middles = [(i + 0.5) * F.col("_w") for i in indexes]
    apart = sum(F.pow(F.greatest(F.abs(c - m) - F.col("_w") / 2, F.lit(0.0)), F.lit(2.0)) for c, m in zip(x, middles, strict=True))
    from_centre = F.sqrt(sum(F.pow(m - WIDEST / 2, F.lit(2.0)) for m in middles))
    half_diagonal = math.sqrt(3) / 2 * F.col("_w") * 1.000001
    block = block.where((apart <= F.pow(half_diagonal, F.lit(2.0))) & (F.abs(from_centre - EARTH_KM) <= half_diagonal))
    near = block.select(key, "_lat", "_lon", cube_key(F.col("level"), indexes).alias("cube")).join(told, "cube")
    near = near.withColumn("d_km", haversine(F.col("_lat"), F.col("_lon"), F.col("p_lat"), F.col("p_lon")))
    best = near.groupBy(key, "_lat", "_lon").agg(F.min(F.struct("d_km", "point")).alias("best"))
    return best.select(key, "best.point", "best.d_km")


def nearest_by_all(probes: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """The same by comparing everything: for a handful of points, and as the grid's test."""
    pairs = probes.select(key, F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).join(F.broadcast(points))
    pairs = pairs.withColumn("d_km", haversine(F.col("_lat"), F.col("_lon"), F.col("p_lat"), F.col("p_lon")))
    return pairs.groupBy(key).agg(F.min_by(F.struct("point", "d_km"), F.struct("d_km", "point")).alias("best")).select(key, "best.point", "best.d_km")


def within(left: DataFrame, right: DataFrame, km: float, extra: Column | None = None, how: str = "left_semi") -> DataFrame:
    """Semi, anti or inner join of rows (lat, lon) with rows (r_lat, r_lon) within km and, if given, extra.

    Cells are wide enough for km at 60 degrees; the right side goes to the 3 x 3 cells around, so the join is an equal one. Nearer to the
    poles rows are dealt by latitude alone.
    """
    width = max(2 * km / KM_PER_DEGREE, 1e-4)
    near = haversine(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")) <= km

    def met(rows: DataFrame, others: DataFrame, lon: Column, r_lon: Column) -> DataFrame:
        spread = others.withColumn("_cell", F.explode(neighbours(F.col("r_lat"), r_lon, width)))
        condition = (F.col("_own") == F.col("_cell")) & near
        return rows.withColumn("_own", cell(F.col("lat"), lon, width)).join(spread, condition if extra is None else condition & extra, how).drop("_own", "_cell")

    polar = F.coalesce(F.abs("lat") > 60 - width / 2, F.lit(False))
    return met(left.where(~polar), right, F.col("lon"), F.col("r_lon")).unionByName(met(left.where(polar), right.where(F.abs("r_lat") > 60 - width), F.lit(0.0), F.lit(0.0)))


def collapse_codes(offices: DataFrame) -> DataFrame:
    """One row for each code from its offices (code, place, district, state, mandal, lat, lon, seq).

    Mean position, most frequent name and district, first state and first mandal that isn't empty (by seq), radius 1.25 times the
    largest distance and at least 2 km, and whether other codes have the same rounded position.
    """
    base = offices.groupBy("code").agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count(F.lit(1)).alias("n_offices"), F.min_by("state", "seq").alias("state"),
        F.min_by(F.nullif("mandal", F.lit("")), F.when(F.col("mandal") != "", F.col("seq"))).alias("mandal"),
    )
    far = offices.select("code", F.col("lat").alias("o_lat"), F.col("lon").alias("o_lon")).join(base.select("code", "lat", "lon"), "code")
    far = far.groupBy("code").agg(F.max(haversine(F.col("lat"), F.col("lon"), F.col("o_lat"), F.col("o_lon"))).alias("spread"))
    out = base.join(far, "code").join(mode(offices, "code", "place", "name"), "code").join(mode(offices, "code", "district", "district"), "code")
    same = Window.partitionBy(F.round("lat", 4), F.round("lon", 4))
    out = out.withColumn("cluster_size", F.count(F.lit(1)).over(same)).withColumn("search_radius_km", F.greatest(F.round(F.col("spread") * 1.25, 2), F.lit(2.0)))
    return out.withColumns({"shares_coordinate": F.col("cluster_size") > 1, "targetable": F.col("cluster_size") == 1}).drop("spread")


def stated_postcode_centroids(codes: DataFrame, places: DataFrame) -> DataFrame:
    """Codes that a place states move to the most populous such place (postcode, place, lat, lon, population)."""
    best = first_per_key(places.where("postcode IS NOT NULL"), ["postcode"], [F.coalesce("population", F.lit(0)).desc(), F.col("place").asc()])
    best = best.select(F.col("postcode").alias("code"), F.col("lat").alias("n_lat"), F.col("lon").alias("n_lon"))
    moved = codes.join(best, "code", "left")
    offset = F.round(haversine(F.col("lat"), F.col("lon"), F.col("n_lat"), F.col("n_lon")), 2)
    hit = F.col("n_lat").isNotNull()
    return moved.withColumns({"centroid_offset_km": offset, "centroid_src": F.when(hit, "stated_postcode").otherwise(F.lit("source")), "lat": F.coalesce("n_lat", "lat"), "lon": F.coalesce("n_lon", "lon"), "targetable": hit | F.col("targetable")}).drop("n_lat", "n_lon")


def district_anchors(codes: DataFrame) -> DataFrame:
    """Medians of the positions of codes verified by a stated postcode, in districts with two or more."""
    sure = codes.where("centroid_src = 'stated_postcode'").groupBy("district", "state").agg(F.median("lat").alias("a_lat"), F.median("lon").alias("a_lon"), F.count(F.lit(1)).alias("_n"))
    return sure.where("_n >= 2").drop("_n")


def bounded_name_centroids(codes: DataFrame, names: DataFrame, places: DataFrame, move_km: float = 60.0, district_km: float = 120.0) -> DataFrame:
    """Codes still at their source's position move to a place of one of their names (code, name), near them and their district.

    Best by kind of place, population and nearness. What finds none and shares its position is no longer targetable.
    """
    rank = F.coalesce(*[F.when(F.col("place_kind") == k, F.lit(r)) for k, r in C.KIND_RANK.items()], F.lit(0))
    todo = codes.where("centroid_src = 'source'").select("code", "lat", "lon", "district", "state").join(names.where(F.length("name") >= 4).distinct(), "code")
    found = places.select(F.col("name"), F.col("place"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), F.coalesce("population", F.lit(0)).alias("pop"), rank.alias("rank"))
    near = todo.join(found, "name").withColumn("d", haversine(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))).where(F.col("d") <= move_km)
    near = near.join(district_anchors(codes), ["district", "state"], "left")
    near = near.where(F.col("a_lat").isNull() | (haversine(F.col("a_lat"), F.col("a_lon"), F.col("p_lat"), F.col("p_lon")) <= district_km))
    best = first_per_key(near, ["code"], [F.col("rank").desc(), F.col("pop").desc(), F.col("d").asc(), F.col("place").asc()]).select("code", F.col("p_lat").alias("n_lat"), F.col("p_lon").alias("n_lon"), F.round("d", 2).alias("n_off"))
    out = codes.join(best, "code", "left")
    hit, lost = F.col("n_lat").isNotNull(), (F.col("centroid_src") == "source") & F.col("shares_coordinate")
    return out.withColumns(
        {
            "centroid_src": F.when(hit, "name_match").when(lost, "unverified").otherwise(F.col("centroid_src")),
            "targetable": F.when(hit, F.lit(True)).when(lost, F.lit(False)).otherwise(F.col("targetable")),
            "lat": F.coalesce("n_lat", "lat"), "lon": F.coalesce("n_lon", "lon"), "centroid_offset_km": F.coalesce("n_off", "centroid_offset_km"),
        }
    ).drop("n_lat", "n_lon", "n_off")


#: By source: thresholds in km and confidence, whether the near ones ask for a corrected centroid, and the rest's confidence.
LADDERS = {
    "osm": ([(3, 0.80, True), (8, 0.70, True), (15, 0.55, False)], 0.40),
    "overture": ([(3, 0.80, False), (8, 0.70, False), (15, 0.55, False)], 0.40),
    "ocm": ([(3, 0.80, False), (8, 0.70, False)], 0.55),
}


def nearest_confidence(d_km: Column, corrected: Column, source: str) -> Column:
    steps, rest = LADDERS[source]
    out = F.lit(rest)
    for km, confidence, needs in reversed(steps):
        out = F.when((d_km <= km) & (corrected if needs else F.lit(True)), F.lit(confidence)).otherwise(out)
    return out


def code_ladder(rows: DataFrame, codes: DataFrame, source: str = "osm") -> DataFrame:
    """Adds code, code_method and code_confidence to rows (external_id, lat, lon, stated_code).

    A stated code that exists counts: 0.97 if within 25 km of its centre (one source: always), else 0.55. Other rows get the
    nearest targetable code, with a confidence that falls with distance.
    """
    known = codes.select(F.col("code").alias("stated_code"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))
    first = rows.join(known, "stated_code", "left")
    near_enough = F.lit(True) if source == "ocm" else haversine(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon")) <= 25
    stated = first.where("c_lat IS NOT NULL").select("external_id", F.col("stated_code").alias("code"), F.lit("stated_code").alias("code_method"), F.when(near_enough, 0.97).otherwise(0.55).alias("code_confidence"))
    points = codes.where("targetable").select(F.col("code").alias("point"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    near = nearest(first.where("c_lat IS NULL"), points, "external_id").join(codes.select(F.col("code").alias("point"), (F.col("centroid_src") != "source").alias("corrected")), "point")
    near = near.select("external_id", F.col("point").alias("code"), F.lit("nearest_code").alias("code_method"), nearest_confidence(F.col("d_km"), F.col("corrected"), source).alias("code_confidence"))
    return rows.join(stated.unionByName(near), "external_id", "left")


def locality_labels(rows: DataFrame, places: DataFrame, most_km: float | None = 12.0) -> DataFrame:
    """Adds locality, the nearest place's name (place, name, place_kind, lat, lon) within most_km; fills city from cities and towns."""
    points = places.select(F.col("place").alias("point"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    near = nearest(rows, points, "external_id")
    near = near if most_km is None else near.where(F.col("d_km") <= most_km)
    named = near.join(places.select(F.col("place").alias("point"), F.col("name").alias("locality"), F.when(F.col("place_kind").isin("city", "town"), F.col("name")).alias("_city")), "point")
    out = rows.join(named.select("external_id", "locality", "_city"), "external_id", "left")
    return out.withColumn("city", F.coalesce("city", "_city") if "city" in rows.columns else F.col("_city")).drop("_city")


def way_centroids(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean of the nodes' positions of each way (way, node_ids)."""
    members = ways.select("way", F.explode("node_ids").alias("node"))
    return members.join(nodes, "node").groupBy("way").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
