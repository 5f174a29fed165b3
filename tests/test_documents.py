import csv
import hashlib
import io
import json

import pytest

from dirspark.sources import sinks

COLUMNS = "external_directory_id string, pincode string, category string, confidence_score double, latitude double, longitude double, display_name string, source_name string, licence_name string, attribution_text string"


@pytest.fixture(scope="module")
def rows(spark):
    names = ["plain", 'quo"ted, with a comma', "two\nlines", "é ü", "", None]
    return spark.createDataFrame([(f"i{k:03}", f"50000{k % 3}", None if k % 7 == 0 else f"c{k % 2}", k / 10, 17.0, 78.0 + k, names[k % 6], f"s{k % 2}", None if k % 2 else "l", "by a" if k % 2 else None) for k in range(60)], COLUMNS).repartition(5)


def wanted(rows):
    return [r.asDict() for r in sinks.export_order(rows).collect()]


def read_back(path, form):
    text = path.read_bytes().decode()
    if form == "csv":
        return list(csv.DictReader(io.StringIO(text, newline="")))
    return [json.loads(x) for x in text.rstrip("\n").split("\n")] if form == "jsonl" else json.loads(text)


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
@pytest.mark.parametrize("form", ["csv", "jsonl", "json", "geojson"])
def test_one_file_in_order(spark, rows, tmp_path, monkeypatch, form, size):
    monkeypatch.setattr(sinks, "CHUNK", size)
    path = tmp_path / f"data.{form}"
    done = sinks.write_document(rows, str(path), form)
    again = sinks.write_document(rows, str(path), form)
    data, want = path.read_bytes(), wanted(rows)
    assert done == again and (done.file, done.n_bytes, done.sha256) == (path.name, len(data), hashlib.sha256(data).hexdigest())
    assert [x.name for x in tmp_path.iterdir() if x.name.startswith(".")] == []
    got = read_back(path, form)
    if form == "geojson":
        assert [f["geometry"]["coordinates"] for f in got["features"]] == [[r["longitude"], r["latitude"]] for r in want]
        assert [f["properties"] for f in got["features"]] == [{k: v for k, v in r.items() if k not in ("latitude", "longitude")} for r in want]
    elif form == "csv":
        assert [(r["external_directory_id"], r["display_name"]) for r in got] == [(r["external_directory_id"], r["display_name"] or "") for r in want]
    else:
        assert got == want


def test_separators_at_the_edges_of_chunks():
    for text in (b"", b"a\n", b"a\nb\n", b"a", b"\n\n"):
        for size in (1, 2, 3):
            got = b"".join(sinks.with_separators((text[i : i + size] for i in range(0, len(text), size)), b",\n"))
            assert got == (text[:-1] if text.endswith(b"\n") else text).replace(b"\n", b",\n")


def test_nothing_to_export(spark, rows, tmp_path):
    for form, want in (("json", []), ("geojson", {"type": "FeatureCollection", "features": []})):
        sinks.write_document(rows.where("false"), str(tmp_path / form), form)
        assert json.loads((tmp_path / form).read_text()) == want
    sinks.write_document(rows.where("false"), str(tmp_path / "csv"), "csv")
    assert (tmp_path / "csv").read_text() == ",".join(rows.columns) + "\n"
    with pytest.raises(ValueError):
        sinks.write_document(rows, str(tmp_path / "x"), "x")


def test_bundle(spark, rows, tmp_path):
    done = sinks.write_bundle(rows, spark.sql("SELECT 3L AS tier_held, 0L AS other"), str(tmp_path / "b"), "jsonl", "2024-01-01T00:00:00Z", "e1", "me", {"state": "x", "limit": 0})
    told = json.loads((tmp_path / "b" / "manifest.json").read_text())
    assert set(told) == {
        "export_id", "schema_version", "created_at", "created_by", "format", "filters", "record_count", "excluded_count", "exclusion_reasons", "source_summary", "licence_summary",
        "attribution_requirements", "pincodes", "categories", "defaults_applied", "notes", "data_file", "sha256",
    }
    assert (told["record_count"], told["excluded_count"], told["exclusion_reasons"], told["filters"]) == (60, 3, {"tier_held": 3}, {"state": "x"})
    assert told["licence_summary"] == ["l", "unknown"] and told["attribution_requirements"] == ["by a"] and told["pincodes"] == ["500000", "500001", "500002"] and told["categories"] == ["c0", "c1"]
    assert [(x["source"], x["records"]) for x in told["source_summary"]] == [("s0", 30), ("s1", 30)]
    assert (tmp_path / "b" / "SHA256SUMS").read_text() == f"{told['sha256']}  data.jsonl\n" == f"{done.sha256}  data.jsonl\n" and (tmp_path / "b" / "ATTRIBUTION.txt").read_text() == "by a\n"


def test_checksums_of_files_beyond_two_gigabytes(spark, tmp_path):
    size = (1 << 31) + 5
    with (tmp_path / "part-00000").open("wb") as f:
        f.truncate(size)  # sparse: takes no disk
    (tmp_path / "part-00001").write_bytes(b"x")
    want = hashlib.sha256()
    for at in range(0, size, 1 << 26):
        want.update(bytes(min(1 << 26, size - at)))
    got = {r.file: r.sha256 for r in sinks.checksums(spark, str(tmp_path)).collect()}
    assert got == {"part-00000": want.hexdigest(), "part-00001": hashlib.sha256(b"x").hexdigest()}
