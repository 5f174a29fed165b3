import json

import pytest

from dirspark.functions.contact import looks_residential
from dirspark.functions.text import canon
from dirspark.streaming import paged
from dirspark.streaming.incremental import run_new


def page(folder, at, rows, form="records"):
    (folder / f"offset={at}.json").write_text(json.dumps({"records": rows} if form == "records" else rows, ensure_ascii=False), encoding="utf-8")


def test_killed_and_resumed_without_loss_or_repeats(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()
    run = lambda: paged.load_register(spark, str(folder), out, checkpoint, 2)
    names = lambda: sorted(r["name"] for r in spark.read.parquet(out).collect())
    page(folder, 0, [{"EnterpriseName": "a"}, {"EnterpriseName": "b"}])
    page(folder, 2, [{"EnterpriseName": "c"}, {"EnterpriseName": " "}], "list")
    page(folder, 6, [{"EnterpriseName": "g"}])  # page 4 isn't there yet
    (folder / "offset=4.json").write_text("")
    (folder / "_offset=8.json").write_text("[]")
    run()
    assert names() == ["a", "b", "c"]
    page(folder, 4, [{"EnterpriseName": "e"}, {"EnterpriseName": "f"}])
    with pytest.raises(Exception, match="killed"):  # written, but not committed

        def broken(batch):
            paged.register_entries(batch).write.mode("overwrite").parquet(f"{out}/batch=1")
            raise ValueError("killed")

        run_new(paged.paged(spark, str(folder), 2), broken, out, checkpoint)
    page(folder, 8, [{"EnterpriseName": "h"}])  # not part of the batch that is repeated
    run()
    assert names() == ["a", "b", "c", "e", "f", "g"]
    run()
    assert names() == ["a", "b", "c", "e", "f", "g", "h"]
    run()
    assert names() == ["a", "b", "c", "e", "f", "g", "h"]


def test_entries(spark):
    told = {"EnterpriseName": "M/s.  Sri Lakshmi\tTraders & Enterprises ", "State": "telangana", "District": " Medak ", "Pincode": "502001.0", "CommunicationAddress": "H.No 5,  X Colony", "RegistrationDate": "2021-01-01"}
    rows = [
        (0, 0, json.dumps(told | {"Activities": [{"Description": "Tea", "NIC5DigitId": "56301"}, {"Description": "Other"}]})), (0, 1, json.dumps(told | {"Activities": '[{"Description":"Tea","NIC5DigitId":"56301"}]', "Pincode": 502001})),
        (0, 2, json.dumps(told | {"Activities": "none", "State": "Goa", "Pincode": "5020"})), (0, 3, "{broken"), (0, 4, None), (0, 5, "{}"), (0, 6, '{"EnterpriseName":"x","Extra":1}'),
    ]
    df = spark.createDataFrame(rows, "page_offset long, place int, record string")
    got = {r.place: r for r in paged.register_entries(df).collect()}
    assert sorted(got) == [0, 1, 2, 6] and sorted(r.place for r in paged.register_entries(df, ["TELANGANA"]).collect()) == [0, 1]
    for k in (0, 1):
        assert (got[k].nature, got[k].category_hint, got[k].code, got[k].district, got[k].address) == ("Tea", "56301", "502001", "Medak", "H.No 5, X Colony")
    assert got[0].name == "M/s. Sri LakshmiTraders & Enterprises" and got[2].code is got[2].nature is None and got[0].source_file == "udyam_offset_0"
    assert json.loads(got[0].extra) == {"state": "telangana", "nic": "56301", "home_address_suspected": True} and json.loads(got[6].extra) == {"state": None, "nic": None, "home_address_suspected": False}
    assert paged.register_entries(df.where("false")).count() == 0


def test_words_as_typed_from_the_register(spark):
    names = [("M/s New Sri Durga Traders Pvt. Ltd.", "durga"), ("The Shri Enterprise & Trading Store", "store"), ("Newton Msc Traderson", "newton msc traderson"), ("", ""), (None, None)]
    df = spark.createDataFrame(names, "a string, b string")
    assert all(r.got == r.b for r in df.select("b", canon(df.a, "udyam").alias("got")).collect())
    homes = [("H.NO 1", True), ("HNO 2", True), ("House  No 3", True), ("doorno 4", True), ("Rao Nagar Colony", True), ("Green Villa", True), ("Behind  house", True), ("apt 5", True), ("Plot no 6", False), ("Flatiron road", False), ("Shop 7", False)]
    df = spark.createDataFrame(homes, "a string, b boolean")
    assert all(r.got == r.b for r in df.select("b", looks_residential(df.a).alias("got")).collect())
