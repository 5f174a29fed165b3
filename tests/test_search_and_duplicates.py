"""The persisted index, nearest points on the sphere, duplicate clusters and the fuzzy register join, against plain versions."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from dirspark.operators import directory, geography, searchindex
from dirspark.operators.searchindex import SearchIndex, build_index


def grams(s):
    return {w[i : i + 3] for x in re.split("[^a-z0-9]+", (s or "").lower()) if x for w in [f"  {x} "] for i in range(len(w) - 2)}


def alike(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 0.0


# nearest
def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, x)))


def test_nearest_on_the_whole_sphere(spark):
    rng = random.Random(2)
    anywhere = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(60)]
    city = [(17.38 + rng.gauss(0, 0.01), 78.48 + rng.gauss(0, 0.01)) for _ in range(400)]
    seams = [(0.0, 179.9), (0.0, -179.9), (0.0, 178.0), (89.99, 10.0), (89.99, -170.0), (-90.0, 0.0), (10.0, 180.0), (10.0, -180.0)]
    points = [(i, *p) for i, p in enumerate(anywhere + city + seams + city[:50])]
    near = [(lat + rng.uniform(-0.05, 0.05), lon + rng.uniform(-0.05, 0.05)) for lat, lon in city[:150]]
    probes = [(i, *p) for i, p in enumerate([(0.0, 179.95), (0.0, -179.95), (88.0, 95.0), (-89.0, 120.0), (10.0, 179.99), (-10.0, -180.0), (90.0, 0.0), (17.0, 78.0), *near, *[(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(80)], *city[:20]])]
    df = spark.createDataFrame(probes + [(9999, None, 1.0)], "k int, lat double, lon double")
    at = spark.createDataFrame(points + [(-1, None, None)], "point int, p_lat double, p_lon double")
    got = {r.k: (r.point, r.d_km) for r in geography.nearest(df, at, "k").collect()}
    assert len(got) == len(probes)
    for k, lat, lon in probes:
        best = min(km((lat, lon), p[1:]) for p in points)
        assert abs(got[k][1] - best) < 1e-6 and abs(km((lat, lon), points[got[k][0]][1:]) - best) < 1e-6


def test_nearest_is_one_round_and_small_cells_where_dense(spark):
    points = spark.range(40000).selectExpr("id AS point", "17 + (id % 200) / 2000.0D AS p_lat", "78 + floor(id / 200) / 2000.0D AS p_lon")
    probes = spark.range(2000).selectExpr("id AS k", "17 + (id % 40) / 401.0D AS lat", "78 + floor(id / 40) / 503.0D AS lon")
    found = geography.nearest(probes, points, "k")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Cartesian" not in plan
    assert found.count() == 2000 and found.agg(F.max("d_km")).first()[0] < 0.04
    assert geography.nearest(probes, points.where("false"), "k").count() == 0


# index
NAMES = ["Sri Durga Medicals", "Durga Medical Hall", "Royal Hotel", "Hotel Royal Palace", "Kirana Stores", "City Kirana", "Astro Vision", "Ünique & Söns", "", None, "hotel hotel", "Medi Clinic", "Royal Medicals"]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [(f"c:{i}", rng.choice(NAMES), rng.choice(["pharmacy", "hotel", None]), rng.choice(["old town", "Royal street", None]), rng.uniform(17.9, 18.1), rng.uniform(79.4, 79.7), i) for i in range(600)]
    rows += [("c:null", "Royal Null", None, None, None, None, 1)] + [(f"r:{i}", f"Word{i} Rare{i}", "x", "y", 10.0, 70.0 + i / 1000, i) for i in range(300)]
    df = spark.createDataFrame(rows, "external_id string, display_name string, category string, locality string, lat double, lon double, n int")
    path = str(tmp_path_factory.mktemp("index"))
    build_index(df, path, 8)
    return SearchIndex(spark, path, 8), rows


def plain_hits(rows, query, point=None, within=10.0, least=0.3):
    words = list(dict.fromkeys(w for w in re.split("[^a-z0-9]+", query.lower()) if w))
    split = lambda *x: set(re.split("[^a-z0-9]+", " ".join(v for v in x if v is not None).lower())) - {""}
    near = [(r, km(point, r[4:6]) if point and r[4] is not None else None) for r in rows]
    near = [(r, d) for r, d in near if point is None or (d is not None and d <= within)]
    hits = []
    for r, d in near:
        a, b = split(r[1]), split(r[2], r[3])
        if words and all(w in a or w in b for w in words):
            hits.append((-sum(4 * (w in a) + 2 * (w in b) for w in words), d or 0, r[0]))
    if not hits and words and len(query) >= 4:
        hits = [(-alike(r[1], query), d or 0, r[0]) for r, d in near if alike(r[1], query) >= least]
    return sorted(hits)


@pytest.mark.parametrize("query", ["Royal", "hotel pharmacy royal", "medicl", "ro", "xqzv", " !", "unique söns"])
@pytest.mark.parametrize("point", [None, (18.0, 79.55)])
def test_pages_equal_a_scan(shop, query, point):
    index, rows = shop
    want = plain_hits(rows, query, point, 5.0)
    for limit, offset in ((7, 2),):
        got = [(r.external_id, round(r["rank"], 6)) for r in index.search(query, limit, offset, point, 5.0).collect()]
        assert got == [(x[2], round(-x[0], 6)) for x in want[offset : offset + limit]]


def test_only_the_lists_of_the_query_are_read(shop, spark):
    index, _ = shop
    every = set(spark.read.parquet(f"{index.path}/postings").inputFiles())
    lists = index.lists("postings", "word", ["kirana", "city"])
    metrics = lists.select("external_id", "weight")
    metrics.collect()
    node = metrics._jdf.queryExecution().executedPlan().toString()
    shards = {searchindex.zlib.crc32(w.encode()) % index.shards for w in ("kirana", "city")}
    read = [f for f in every if "kind=word" in f and any(f"/shard={s}/" in f for s in shards)]
    assert 0 < len(read) <= 0.25 * len(every) and "PartitionFilters" in node.replace(" ", "") or "shard" in node
    scan = spark.read.parquet(f"{index.path}/postings").where((F.col("kind") == "word") & F.col("shard").isin(sorted(shards)) & F.col("term").isin(["kirana", "city"]))
    touched = {r[0] for r in scan.select(F.input_file_name()).distinct().collect()}
    assert {f.rpartition("/")[2] for f in touched} <= {f.rpartition("/")[2] for f in read}


def test_full_pages_of_names_leave_other_lists_unread(shop, monkeypatch):
    index, rows = shop
    asked = []
    matches = SearchIndex.matches
    monkeypatch.setattr(SearchIndex, "matches", lambda self, words, point=None, km=10.0, impact=None: asked.append(impact) or matches(self, words, point, km, impact))
    assert index.search("royal", 5).count() == 5 and set(asked) == {"name"}
    asked.clear()
    index.search("royal", 5000).collect()
    assert None in asked


def test_found_counts_all(shop):
    index, rows = shop
    assert index.found("royal hotel").first().n_found == len(plain_hits(rows, "royal hotel"))


# duplicates
def test_clusters_follow_both_causes_and_old_pointers(spark):
    m = 0.0009  # about 100 m
    rows = [
        ("a", "green hotel", 10.0, 70.0, "+911", None, 10, 5), ("b", "green hotels", 10.0 + m, 70.0, "+912", None, 90, 5), ("c", "other name", 11.0, 71.0, "+912", None, 20, 5),  # a ~ b by name, b - c by phone
        ("d", "green hotel", 10.5, 70.5, None, None, 50, 5), ("e", "", 10.0, 70.0, None, None, 50, 5), ("f", "green hotel", None, None, None, "g", 1, 1), ("g", "x", 1.0, 1.0, None, "h", 2, 1), ("h", "y", 2.0, 2.0, None, None, 3, 1),
        ("i", "lone", 3.0, 3.0, None, "gone", 3, 1), ("j", "lone too", 4.0, 4.0, None, "gone", 3, 2), ("k", "same", 5.0, 5.0, None, None, None, None), ("l", "same", 5.0, 5.0, None, None, None, None), ("m", "same", 5.0, 5.0, None, None, None, 1),
    ]
    df = spark.createDataFrame(rows, "external_id string, canonical_name string, lat double, lon double, public_phone string, merged_into string, completeness_score int, confidence_score int")
    got = {r.external_id: (r.survivor, r.merged_into) for r in directory.merged_duplicates(df).collect()}
    want = {"a": "b", "b": "b", "c": "b", "d": "d", "e": "e", "f": "h", "g": "h", "h": "h", "i": "j", "j": "j", "k": "m", "l": "m", "m": "m"}
    assert got == {k: (v, v if v != k else None) for k, v in want.items()}
    assert directory.merged_duplicates(df.where("false")).count() == 0
    # a phone is on one survivor only, once merged rows are gone
    kept = df.join(directory.merged_duplicates(df), "external_id").where(F.col("survivor") == F.col("external_id"))
    assert kept.where("public_phone IS NOT NULL").groupBy("public_phone").count().where("count > 1").isEmpty()


def test_hot_phone_links_grow_with_rows_only(spark):
    rows = spark.range(3000).selectExpr("concat('x', id) AS external_id", "concat('n', id) AS canonical_name", "cast(id % 50 as double) AS lat", "cast(id as double) / 20 AS lon", "'+91' AS public_phone")
    assert directory.duplicate_links(rows).count() < 3100


# register
def test_similar_names_equal_all_pairs(spark):
    rng = random.Random(9)
    parts = ["sri", "durga", "medical", "medicals", "stores", "store", "royal", "hotel", "hotels", "x", "ganesh", "ganesha"]
    name = lambda: " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 4)))
    left, right = ([(rng.choice(["d1", "d2", None]), rng.choice([name(), name(), None])) for _ in range(n)] for n in (150, 200))
    for least in (0.4, 0.8, 1.0):
        a, b = (spark.createDataFrame(x, "area string, name string") for x in (left, right))
        got = {(r.area, r.l_name, r.r_name) for r in directory.similar_names(a, b, least).collect()}
        assert got == {(p, x, y) for p, x in left for q, y in right if p and p == q and x and y and alike(x, y) >= least}


def test_rare_trigrams_keep_candidates_few(spark):
    rows = spark.range(4000).selectExpr("'d' AS area", "concat('sri venkateswara ', substr(sha2(cast(id as string), 256), 1, 8), ' medical stores') AS name")
    counted = {}
    inner = directory.gram_similarity
    try:
        directory.gram_similarity = lambda a, b: F.lit(1.0)  # every candidate becomes a pair
        counted["pairs"] = directory.similar_names(rows.limit(2000), rows, 0.9).count()
    finally:
        directory.gram_similarity = inner
    assert counted["pairs"] < 0.02 * 2000 * 4000


def test_null_phones_go_past_the_join(spark):
    rows = spark.range(1000).selectExpr("concat('x', id) AS external_id", "CASE WHEN id % 10 = 0 THEN concat('+', id) END AS public_phone")
    known = spark.createDataFrame([("+0",), ("+10",), (None,)], "public_phone string")
    out = directory.new_by_phone(rows, known)
    assert out.count() == 998 and out.columns == rows.columns and out.where("public_phone IS NULL").count() == 900
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1
