"""Each key once: files opened, lost loads, repeated loads, null keys, folding."""

from datetime import datetime

from pyspark.sql import functions as F

from lodestrata.operators.merge import insert_if_absent
from lodestrata.sinks import keyindex
from lodestrata.sinks.keyindex import KeyIndex
from lodestrata.sinks.tables import append_new
from lodestrata.streaming.epochs import append_once, write_epoch


def messages(spark, keys, day=1):
    at = datetime(2024, 1, day)
    return spark.createDataFrame([(k, at) for k in keys], "raw_id string, ingested_at timestamp_ntz")


def stored(spark, path):
    return sorted(r.raw_id or "null" for r in spark.read.parquet(path).collect())


def test_a_load_opens_only_files_that_may_hold_its_keys(spark, scratch):
    path = f"{scratch}/t"
    for load in range(4):
        append_once(messages(spark, [f"{load}-{i}" for i in range(400)], load + 1), f"q-{load}", path)
    index = KeyIndex(spark, path, "raw_id")
    assert set(index.loads()) == {f"q-{i}" for i in range(4)}
    assert index.new_rows(messages(spark, [f"new-{i}" for i in range(50)]), "q-9").count() == 50
    assert len(index.opened) <= 1  # of 64
    fresh = index.new_rows(messages(spark, ["2-17", "2-18", "x"], 9), "q-9")
    assert stored_keys(fresh) == ["x"]
    assert {p.split("/")[-2] for p in index.opened} == {"q-2"} and len(index.opened) <= 2


def stored_keys(df):
    return sorted(r.raw_id for r in df.collect())


def test_null_is_one_key(spark, scratch):
    for day in (1, 2, 3):
        append_new(messages(spark, [None, None, "a"], day), f"{scratch}/t")
    assert stored(spark, f"{scratch}/t") == ["a", "null"]
    rows = messages(spark, [None, "a"])
    assert insert_if_absent(insert_if_absent(rows, rows, ["raw_id"]), rows, ["raw_id"]).count() == 2


def test_a_lost_load_is_known_by_its_rows(spark, scratch):
    path = f"{scratch}/t"
    append_once(messages(spark, ["a"]), "q-1", path)
    # dies after its rows, before they are indexed
    index = KeyIndex(spark, path, "raw_id")
    index.begin("q-2")
    write_epoch(messages(spark, ["b"]).withColumn("ingest_date", F.to_date("ingested_at")), "q-2", path, ("ingest_date",))
    index.begin("q-3")  # and one that has no rows yet
    append_once(messages(spark, ["a", "b", "c"], 5), "q-4", path)
    assert stored(spark, path) == ["a", "b", "c"]
    # run again, the lost load writes over its rows
    append_once(messages(spark, ["b", "d"]), "q-2", path)
    assert stored(spark, path) == ["a", "b", "c", "d"]
    assert "q-2" in KeyIndex(spark, path, "raw_id").loads()


def test_small_loads_are_folded(spark, scratch, monkeypatch):
    monkeypatch.setattr(keyindex, "MOST_LOADS", 4)
    path = f"{scratch}/t"
    for load in range(7):
        append_once(messages(spark, ["same", f"k{load}"], load + 1), f"q-{load}", path)
    assert len(KeyIndex(spark, path, "raw_id").loads()) <= 5
    assert stored(spark, path) == sorted(["same", *[f"k{i}" for i in range(7)]])


def test_empty_load(spark, scratch):
    path = f"{scratch}/t"
    for keys in ([], ["a"], []):
        append_new(messages(spark, keys), path)
    assert stored(spark, path) == ["a"]
