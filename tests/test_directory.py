"""Every query with a SQL twin, and the operators that SQL can't express, on small tables."""

import json
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from dirspark import constants as C
from dirspark.functions import contact, geo, ident, text
from dirspark.operators import categorise, directory, geography, quality
from dirspark.plans.queries import QUERIES, SQL
from dirspark.sources import readers, sinks
from dirspark.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    rel = oracle.execute(SQL[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    got = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    want = sorted(repr([plain(r[columns.index(c)]) for c in order]) for r in rel.fetchall())
    assert got == want


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("raw,form,want", [("Caféteria & Store", "names", "cafe teria"), ("M/S Sri New Traders Pvt Ltd", "register", "traders"), ("ज्योतिष", "names", ""), ("Ram Nagar B.O", "places", "ram nagar"), ("Old Town (East) S.O.", "bounded_places", "old town"), (" A  b ", "plain", "a b"), (None, "names", None)])
def test_canon(spark, raw, form, want):
    assert one(spark, lambda c: text.canon(c, form), raw) == want
    if form == "names":
        assert one(spark, lambda c: text.canon(c, form, exact=True), raw) == want


def test_cleaning_and_similarity(spark):
    assert one(spark, lambda c: text.clean(c, 4), "a\nb  c d e") == "ab c"
    assert one(spark, lambda c: text.clean(c, 5), " \t ") is None
    assert round(one(spark, lambda c: text.similarity(c, F.lit("two words")), "word"), 4) == 0.3636
    assert one(spark, lambda c: text.similarity(c, F.lit("")), "") == 0.0


@pytest.mark.parametrize("raw,want", [("+91 98480 22338", ("+919848022338", "mobile")), ("0091-4023456789", ("+914023456789", "landline")), ("18001234567", None), ("9999999123", None), ("12345", None), (None, None)])
def test_strict_phone(spark, raw, want):
    got = one(spark, contact.strict_phone, raw)
    assert (tuple(got) if got else None) == want


def test_phone_status_order(spark):
    for raw, want in [("+911800123456", "tollfree"), ("+919848022338", "valid_mobile"), ("+914023456789", "valid_landline"), ("+9101111111", "suspicious_pattern"), ("+91012", "malformed"), (None, None)]:
        assert one(spark, contact.phone_status, raw) == want


def test_ids(spark):
    made = one(spark, lambda c: ident.mint(c, "ID-"), 1, "long")
    assert made == "ID-0000-0012"
    assert one(spark, lambda c: ident.is_valid(c, "ID-"), made.lower().replace("-", "")) and not one(spark, lambda c: ident.is_valid(c, "ID-"), "ID-0000-00U2")


def test_nearest_grid_equals_brute_force(spark):
    probes = spark.range(400).selectExpr("id AS k", "8 + (id * 7919 % 28000) / 1000D AS lat", "69 + (id * 104729 % 28000) / 1000D AS lon")
    points = spark.range(60).selectExpr("id AS point", "8 + (id * 613 % 2800) / 100D AS p_lat", "69 + (id * 3571 % 2800) / 100D AS p_lon")
    a = geography.nearest(probes, points, "k").select("k", "point").collect()
    b = geography.nearest_by_all(probes, points, "k").select("k", "point").collect()
    assert sorted(a) == sorted(b) and len(a) == 400


def test_distance_of_nulls_is_null(spark):
    assert spark.range(1).select(geo.haversine(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("d")).first().d is None


def test_later_rules_override(spark):
    rows = spark.createDataFrame([("x Tent House Xerox", "other", None, None), ("Kirana", "grocery-and-kirana", "old", "OLD")], "display_name string, category string, subcategory string, business_type string")
    got = {r.display_name: (r.category, r.subcategory) for r in categorise.fold_name_rules(rows).collect()}
    assert got == {"x Tent House Xerox": ("printing-and-stationery", "photocopy"), "Kirana": ("grocery-and-kirana", "old")}


def test_suppression_is_idempotent(spark):
    rows = spark.createDataFrame([(i, "+919848000000" if i < 5 else f"+91984800000{i}") for i in range(8)], "id int, public_phone string")
    once = quality.suppress_shared(rows)
    assert sorted(once.collect(), key=repr) == sorted(quality.suppress_shared(once).select(once.columns).collect(), key=repr) and once.where("public_phone IS NULL AND phone_raw IS NOT NULL").count() == 5


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"osm_type":"n","osm_id":1,"lat":1.0,"lon":2.0,"tags":{"name":"x","shop":"y","odd":"z"}}\nnot json\n{"osm_id":2,"tags":{"place":"city","name":"t"}}\n')
    rows = readers.json_lines(spark, str(tmp_path / "a.jsonl"))
    assert rows.where(readers.is_business(F.col("tags"))).count() == 1 and rows.where(readers.is_place(F.col("tags"))).count() == 1
    assert rows.where("osm_id = 1").select(readers.kept_tags(F.col("tags")).alias("t")).first().t == {"name": "x", "shop": "y"}
    (tmp_path / "b.tsv").write_text("IN\t500001\tA\tS\t1\tD\t2\tM\t3\t17.1\t78.2\t4\nIN\t500002\tB\tS\t1\tD\t2\tM\t3\t\t\t4\n")
    assert [(r.code, r.lat) for r in readers.postal_tsv(spark, str(tmp_path / "b.tsv")).collect()] == [("500001", 17.1)]
    (tmp_path / "c.csv").write_bytes("Name , District,Owner_Name\n caf\xe9 ,X,me\n".encode("latin-1"))
    table = readers.csv_any_encoding(spark, str(tmp_path / "c.csv"))
    assert table.select(readers.pick(table, "title", "NAME").alias("n")).first().n == "café"
    assert readers.without_personal_columns(table).columns == ["Name", "District"]
    assert json.loads(table.select(readers.row_as_json(table).alias("j")).first().j) == {"Name": "café", "District": "X", "Owner_Name": "me"}


def test_nested_parquet(spark, tmp_path):
    spark.sql("SELECT 'a' AS id, named_struct('primary', 'N') AS names, named_struct('primary', 'hotel', 'alternate', array('cafe')) AS categories, array('1') AS phones, array('w') AS websites, 0.5D AS confidence, array(named_struct('freeform', 'f', 'locality', 'l', 'postcode', '500001', 'country', 'IN')) AS addresses, named_struct('xmin', 78D, 'xmax', 78D, 'ymin', 17D, 'ymax', 17D) AS bbox").write.parquet(str(tmp_path / "p"))
    df = readers.places_parquet(spark, str(tmp_path / "p"))
    assert df.first().postcode == "500001"
    assert "GreaterThanOrEqual(bbox.ymin" in df._jdf.queryExecution().toString()


def test_export_bundle(spark, tmp_path):
    rows = QUERIES["o38_export_records"](spark, SF).withColumns({"source_name": F.lit("s"), "licence_name": F.lit("l"), "attribution_text": F.lit("by"), "latitude": F.lit(1.0), "longitude": F.lit(2.0), "confidence_score": F.lit(1)})
    for form in ("csv", "jsonl", "json", "geojson"):
        sinks.write_records(rows, str(tmp_path / form), form)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == rows.count()
    sinks.write_document(rows, str(tmp_path / "data.geojson"), "geojson")
    document = json.loads((tmp_path / "data.geojson").read_text(encoding="utf-8"))
    assert document["features"][0]["geometry"]["coordinates"] == [2.0, 1.0] and "latitude" not in document["features"][0]["properties"]
    (sums,) = sinks.checksums(spark, str(tmp_path / "csv")).collect()
    head, each = sinks.ledger(rows, "e1", sums.sha256)
    assert len(sums.sha256) == 64 and head.first().n == each.count() == rows.count()
    assert json.loads(sinks.manifest(rows, spark.sql("SELECT 3 AS tier_held"), "2024"))["record_count"] == rows.count()
    with pytest.raises(ValueError):
        sinks.write_records(rows, str(tmp_path / "x"), "x")


def test_stream_of_new_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.run_new(incremental.new_files(spark, str(tmp_path / "in"), "k long"), lambda d: d.withColumn("two", F.col("k") * 2), str(tmp_path / "out"), str(tmp_path / "check"))
    (tmp_path / "in" / "1.json").write_text('{"k": 1}\n')
    run()
    (tmp_path / "in" / "2.json").write_text('{"k": 2}\n')
    run()
    assert sorted(r.two for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 4]


def test_jobs(spark):
    jobs = spark.sql("SELECT 1 AS job_id, 'queued' AS status, timestamp '2024-01-01' AS run_after, 1 AS attempts, 3 AS max_attempts, 5 AS priority")
    assert incremental.due_jobs(jobs, "2024-01-02", 5).count() == 1
    again = incremental.after_failure(jobs, "2024-01-02").first()
    assert again.attempts == 2 and again.status == "queued" and str(again.run_after) == "2024-01-02 00:01:00"
    assert incremental.throughput(spark.sql("SELECT 's' AS source, 1 AS polled_at, 10 AS n UNION ALL SELECT 's', 2, 30")).agg(F.max("rate")).first()[0] == 5.0


def test_leads_have_a_breakdown(spark):
    from dirspark.plans.queries import lead_rows

    rows = lead_rows(spark, SF)
    found = directory.leads(rows, directory.coverage_gaps(directory.coverage(rows)), rows.limit(0), spark.createDataFrame([], "public_phone string"), 5).collect()
    assert len(found) == 5 and all(json.loads(r.score_breakdown)["total"] == r.score for r in found)


def test_all_category_rules_are_built_in(spark):
    assert len(C.KEYWORD_RULES) == 57 and sum(len(keys) for keys, _ in C.KEYWORD_RULES) == 416 and len(C.SCRIPT_RULES) == 18
    want = {"physician": "hospitals-and-clinics", "diagnostic_center": "hospitals-and-clinics", "ayurvedic": "hospitals-and-clinics", "lighting": "electrical-stores", "plumber": "plumbing-services", "home_baker": "home-businesses", "footwear": "footwear-stores", "community_center": None, "bazaar": "other-local-businesses"}
    rows = spark.createDataFrame([(k, [None]) for k in want], "first string, others array<string>")
    assert {r["first"]: r.category for r in categorise.by_keywords(rows, "first", "others").collect()} == want
    assert {r["first"]: r.c for r in rows.select("first", categorise.by_joined_text(F.col("first"), F.col("others")).alias("c")).collect()} == want


def test_script_rules(spark):
    names = {"శ్రీ శివశక్తి జ్యోతిష్యాలయం": ("professional-services", "astrologer"), "राम मेडिकल": ("medical-stores-and-pharmacies", "chemist"), "दवाखाना": ("hospitals-and-clinics", "clinic"), "किराना मोबाइल": ("mobile-stores", "mobile-phone-store"), "राशन": ("grocery-and-kirana", "old"), "Ram Stores": ("grocery-and-kirana", "old")}
    rows = spark.createDataFrame([(n, "grocery-and-kirana", "old", "x") for n in names], "display_name string, category string, subcategory string, business_type string")
    assert {r.display_name: (r.category, r.subcategory) for r in categorise.by_script(rows).collect()} == names


def test_nearest_without_positions_and_far_away(spark):
    probes = spark.createDataFrame([("a", None, 1.0), ("b", 10.0, 20.0), ("c", -80.0, 170.0), ("d", 10.0, None)], "k string, lat double, lon double")
    points = spark.createDataFrame([(5, 10.2, 20.1), (6, None, 2.0), (7, 60.0, -100.0)], "point long, p_lat double, p_lon double")
    got = {r.k: r.point for r in geography.nearest(probes, points, "k").collect()}
    want = {r.k: r.point for r in geography.nearest_by_all(probes.where("lat IS NOT NULL AND lon IS NOT NULL"), points.where("p_lat IS NOT NULL"), "k").collect()}
    assert got == want and set(got) == {"b", "c"}
    assert geography.nearest(probes, points.where("false"), "k").count() == 0


@pytest.mark.parametrize("km", [0.15, 140.0, 500.0])
def test_within_at_all_latitudes(spark, km):
    rng = random.Random(int(km))
    near = lambda lat, lon: (lat + rng.uniform(-1, 1) * km / 80, lon + rng.uniform(-1, 1) * km / 80 / max(0.05, math.cos(math.radians(lat))))
    left = [(i, rng.uniform(-85, 85), rng.uniform(-20, 20)) for i in range(150)] + [(200, 59.9, 1.0), (201, 60.1, 1.0), (202, None, 1.0)]
    right = [(i, *near(lat, lon)) for i, lat, lon in left if lat is not None]
    a = spark.createDataFrame(left, "i long, lat double, lon double")
    b = spark.createDataFrame(right, "j long, r_lat double, r_lon double")
    want = {(r.i, r.j) for r in a.crossJoin(b).where(geo.haversine(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")) <= km).collect()}
    got = [(r.i, r.j) for r in geography.within(a, b, km, how="inner").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert {r.i for r in geography.within(a, b, km, how="left_anti").collect()} == {x[0] for x in left} - {i for i, _ in want}


def test_csv_files_have_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Name,District\n"two\nlines",X\n\n')
    (tmp_path / "b.csv").write_bytes("\ufeffDistrict , Name,More\nY,\u00e9,z,beyond\n".encode())
    (tmp_path / "c.csv").write_bytes(b"")
    got = {tuple(r) for r in readers.csv_any_encoding(spark, str(tmp_path)).select("Name", "District", "More").collect()}
    assert got == {("two\nlines", "X", None), ("é", "Y", "z")}


def test_attribution_names_every_source(spark):
    rows = spark.createDataFrame([("by b",), ("by a",), ("by b",), (None,)], "attribution_text string").withColumns({c: F.lit("x") for c in ("licence_name", "pincode", "category")})
    assert sinks.attribution(rows) == "by a\nby b"


def test_numbers_beyond_the_width_raise(spark):
    ids = lambda n: spark.createDataFrame([(n,)], "n long").select(ident.mint(F.col("n")).alias("x")).first().x
    assert len({ids(0), ids((1 << 35) - 1)}) == 2 and ids(None) is None
    for n in (1 << 35, -1):
        with pytest.raises(Exception, match="no room for number"):
            ids(n)


def test_suppression_keeps_rows_without_a_number(spark):
    rows = spark.createDataFrame([(i, "+919848000000" if i < 5 else None, None, None) for i in range(9)], "id int, public_phone string, phone_raw string, phone_status string")
    got = {r.id: (r.public_phone, r.phone_raw, r.phone_status) for r in quality.suppress_shared(rows).collect()}
    assert got == {i: (None, "+919848000000", "shared_number") if i < 5 else (None, None, None) for i in range(9)}


def test_residential_flag(spark):
    rows = spark.createDataFrame([('[{"Description":"d","NIC5DigitId":"1"}]', "H.No 5"), (None, "Main Road"), ("x", None)], "activities string, address string")
    assert [(r.trade, r.residential) for r in readers.register_activities(rows).collect()] == [("d", True), (None, False), (None, False)]


def test_freshness_without_a_time_is_null(spark):
    times = "SELECT k, CAST(t AS timestamp) AS t FROM VALUES (1, '1999-01-01'), (2, NULL), (3, '1980-01-01'), (4, '2001-01-01'), (5, '1998-07-02') AS v(k, t)"
    assert [r[0] for r in spark.sql(times).orderBy("k").select(quality.freshness(F.col("t"), "1999-01-01")).collect()] == [100, None, 0, 100, 83]
