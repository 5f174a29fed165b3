"""Flags kept by deltas against full runs; pushes that crash, conflict, repeat or arrive damaged."""

import random

import pytest
from pyspark.sql import functions as F

from dirspark.operators import push
from dirspark.streaming.upkeep import DerivedFlags, keep_flags

SCHEMA = "external_id string, public_phone string, canonical_name string, code string"
RULES = {"shared": (["public_phone"], 4), "ambiguous": (["canonical_name", "code"], 2)}


def full(rows):
    out = {}
    for i, phone, name, code in rows.values():
        shared = bool(phone) and sum(r[1] == phone for r in rows.values()) >= 4
        twice = bool(name) and bool(code) and sum(r[2:] == (name, code) for r in rows.values()) >= 2
        out[i] = (shared, twice)
    return out


def state(flags):
    return {r.external_id: (r.shared, r.ambiguous) for r in flags.current().collect()}


def test_batches_equal_a_full_run_and_touch_few_rows(spark, tmp_path):
    rng = random.Random(6)
    flags, rows = DerivedFlags(spark, str(tmp_path / "a"), SCHEMA, "external_id", RULES), {}
    for number in range(4):
        batch = [(f"x{rng.randrange(120) if k % 3 else 1000 * number + k}", rng.choice([None, "", *"pqrstuvw"]), rng.choice([None, "", "n1", "n2", "n3", "n4"]), rng.choice([None, "c1", "c2", "c3"]), number > 0 and rng.random() < 0.2) for k in range(60)]
        batch = list({r[0]: r for r in batch}.values())
        before = full(rows)
        for r in batch:
            rows.pop(r[0], None)
            if not r[4]:
                rows[r[0]] = r[:4]
        after = full(rows)
        written = flags.apply(spark.createDataFrame(batch, SCHEMA + ", deleted boolean"), number)
        assert state(flags) == after
        ids = {r[0] for r in batch}
        crossed = {i for i in after if i not in ids and before[i] != after[i]}
        assert written >= len(batch) + len(crossed)
        # rows outside the batch are written only if a key of theirs crossed a threshold
        log = {r.external_id for r in flags.log("rows").where(F.col("batch") == number).collect()}
        assert log - ids == crossed and written == len(log)
        assert flags.apply(spark.createDataFrame(batch, SCHEMA + ", deleted boolean"), number) == written and state(flags) == after
    again = flags.compacted(str(tmp_path / "b"))
    assert state(again) == full(rows) and again.committed() == [3]
    assert again.apply(spark.createDataFrame([("new", "p", "n1", "c1")], SCHEMA), 4) >= 1
    rows["new"] = ("new", "p", "n1", "c1")
    assert state(again) == full(rows)


def test_a_batch_cut_off_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    flags = DerivedFlags(spark, str(tmp_path), SCHEMA, "external_id", RULES)
    flags.apply(spark.createDataFrame([("a", "p", "n", "c")], SCHEMA), 0)
    write = DerivedFlags.write

    def crash(self, rows, table, number):
        if table == "commits":
            raise OSError("lost")
        write(self, rows, table, number)

    more = spark.createDataFrame([("b", "q", "n", "c")], SCHEMA)
    monkeypatch.setattr(DerivedFlags, "write", crash)
    with pytest.raises(OSError):
        flags.apply(more, 1)
    monkeypatch.undo()
    assert state(flags) == {"a": (False, False)}
    flags.apply(more, 1)
    assert state(flags) == {"a": (False, True), "b": (False, True)}


def test_stream_of_batches(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([(f"r{n}{k}", "p", f"n{k}", "c") for k in range(2)], SCHEMA).write.json(str(tmp_path / f"in/{n}"))
    flags = DerivedFlags(spark, str(tmp_path / "state"), SCHEMA, "external_id", RULES)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in/*"))
    keep_flags(stream, flags, str(tmp_path / "check"))
    assert state(flags) == {f"r{n}{k}": (True, True) for n in range(3) for k in range(2)}


# push
CHUNK = "source_name string, source_record_id string, name string, business_type string, public_phone string, website string, claim_status string, verification_status string, address string, locality string, code string, lat double, lon double"


def row(record, name="n", kind="RETAIL_STORE", phone=None, site=None, claim=None, verified=None, address=None, locality=None):
    return ("osm", record, name, kind, phone, site, claim, verified, address, locality, "500001", 17.0, 78.0)


def pushed(spark, table, tmp_path, *rows):
    place, sent = push.send(spark.createDataFrame(list(rows), CHUNK), str(tmp_path / "out"))
    return push.receive(table, place, sent), place, sent


def test_push_keeps_protected_rows_and_links_addresses(spark, tmp_path):
    table = push.VersionedTable(spark, str(tmp_path / "t"))
    pushed(spark, table, tmp_path, row("1", phone="+1", address="a street"), row("2", claim="CLAIMED", kind="HOSPITALITY", locality="loc"), row("3"))
    version, place, sent = pushed(spark, table, tmp_path, row("1", "new", kind="FOOD_SERVICE", site="s"), row("2", "stolen"), row("3", "three", address="b"), row("4", kind=None))
    assert version == 2
    got = {r.source_record_id: r for r in table.read("businesses").collect()}
    assert (got["1"].name, got["1"].public_phone, got["1"].website, got["1"].business_type) == ("new", "+1", "s", "OTHER")
    assert (got["2"].name, got["2"].business_type) == ("n", "OTHER") and got["3"].name == "three" and got["4"].business_type == "OTHER"
    lines = {r.address_id: r.line for r in table.read("addresses").collect()}
    assert {k: lines.get(r.address_id) for k, r in got.items()} == {"1": "a street", "2": "loc", "3": "b", "4": None} and len(lines) == 3
    assert push.receive(table, place, sent) == 2 and table.version() == 2  # the same chunk again
    assert {r.source_record_id for r in table.read("businesses", 1).collect()} == {"1", "2", "3"}


def test_damaged_chunks_are_refused(spark, tmp_path):
    table = push.VersionedTable(spark, str(tmp_path / "t"))
    place, sent = push.send(spark.createDataFrame([row("1"), row("2")], CHUNK), str(tmp_path / "out"))
    for damaged in ([row("1")], [row("1"), row("2", name="N")], [row("1"), row("2"), row("2")], [row("1"), row("2", phone="")]):
        spark.createDataFrame(damaged, CHUNK).write.mode("overwrite").parquet(str(tmp_path / "bad"))
        with pytest.raises(push.ChecksumMismatch):
            push.receive(table, str(tmp_path / "bad"), sent)
    assert table.version() == 0
    assert push.receive(table, place, sent) == 1


@pytest.mark.parametrize("step", ["stage", "commit"])
def test_a_crash_leaves_the_old_version(spark, tmp_path, monkeypatch, step):
    table = push.VersionedTable(spark, str(tmp_path / "t"))
    pushed(spark, table, tmp_path, row("1"))
    place, sent = push.send(spark.createDataFrame([row("1", "new"), row("2", address="x")], CHUNK), str(tmp_path / "out"))

    def crash(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(push.VersionedTable, step, crash)
    with pytest.raises(OSError):
        push.receive(table, place, sent)
    monkeypatch.undo()
    assert table.version() == 1 and [r.name for r in table.read("businesses").collect()] == ["n"] and table.read("addresses").count() == 0
    assert push.receive(table, place, sent) == 2 and table.read("businesses").count() == 2


def test_of_two_writers_the_second_starts_again(spark, tmp_path, monkeypatch):
    table = push.VersionedTable(spark, str(tmp_path / "t"))
    pushed(spark, table, tmp_path, row("1"))
    commit, other = push.VersionedTable.commit, push.VersionedTable(spark, str(tmp_path / "t"))
    lost = []

    def late(self, base, tables, **told):
        if not lost:
            lost.append(base)
            place = self.stage({"businesses": other.read("businesses").withColumn("name", F.lit("theirs"))})
            commit(other, base, place)
        return commit(self, base, tables, **told)

    monkeypatch.setattr(push.VersionedTable, "commit", late)
    version, *_ = pushed(spark, table, tmp_path, row("2", "mine"))
    assert version == 3 and lost == [1]
    assert sorted(r.name for r in table.read("businesses").collect()) == ["mine", "theirs"]
