"""Bucketed tables: merges, bytes written, lost runs, two writers, vacuum."""

import os

import pytest
from pyspark.sql import functions as F

from lodestrata.sinks.store import Store, Table

TABLES = {
    "users": Table("id BIGINT, name STRING, seen INT", ("id",), updates=("seen",)),
    "facts": Table("id BIGINT, v STRING", ("id",)),
    "log": Table("word STRING, id BIGINT", by=("word",)),
}


def store(spark, root, buckets=8):
    return Store(spark, root, TABLES, buckets)


def users(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, seen int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_merge_follows_the_tables_rule(spark, scratch):
    s = store(spark, scratch)
    change = s.change()
    change.merge("users", users(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)]))
    change.merge("facts", spark.createDataFrame([(1, "x")], "id long, v string"))
    change.commit()
    change = s.change()
    change.merge("users", users(spark, [(2, "z", 9), (3, "c", 2)]))
    change.merge("facts", spark.createDataFrame([(1, "y"), (2, "w")], "id long, v string"))
    assert rows(s.read("facts")) == [(1, "x")]  # not before the commit
    change.commit()
    again = store(spark, scratch, buckets=99)  # the stored number of buckets holds
    assert again.buckets == 8
    assert rows(again.read("users")) == [(1, "a", 1), (2, "b", 9), (3, "c", 2), (None, "n", 1)]
    assert rows(again.read("facts")) == [(1, "x"), (2, "w")]
    assert rows(again.read("log")) == []


def test_a_batch_rewrites_touched_buckets_only(spark, scratch):
    s = store(spark, scratch, buckets=32)
    change = s.change()
    many = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(0).alias("seen"))
    change.merge("users", many)
    change.commit()
    whole, before = size(f"{scratch}/users"), set(s.files("users"))
    change = s.change()
    touched = change.merge("users", users(spark, [(5, "q", 7)]))
    change.commit()
    assert len(touched) == 1
    assert size(f"{scratch}/users") - whole < whole / 16
    assert len(before - set(s.files("users"))) == 1
    assert s.read("users").where("seen = 7").count() == 1 and s.read("users").count() == 20_000


def test_a_lost_run_changes_no_table(spark, scratch):
    s = store(spark, scratch)
    change = s.change()
    change.merge("users", users(spark, [(1, "a", 1)]))
    change.commit()
    lost = store(spark, scratch).change()
    lost.merge("users", users(spark, [(1, "a", 2), (4, "d", 1)]))
    # dies here, or within the commit, before its success marker
    spark.createDataFrame([("users", 0, "none", 8)], "name string, bucket int, folder string, buckets int").write.parquet(
        f"{scratch}/_states/{2:012d}"
    )
    os.remove(f"{scratch}/_states/{2:012d}/_SUCCESS")
    after = store(spark, scratch)
    assert rows(after.read("users")) == [(1, "a", 1)]
    change = after.change()
    change.merge("users", users(spark, [(4, "d", 3)]))
    change.commit()
    assert rows(store(spark, scratch).read("users")) == [(1, "a", 1), (4, "d", 3)]


def test_two_writers(spark, scratch):
    one, two = store(spark, scratch).change(), store(spark, scratch).change()
    one.append("log", spark.createDataFrame([("a", 1)], "word string, id long"))
    two.append("log", spark.createDataFrame([("a", 2)], "word string, id long"))
    one.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()
    assert rows(store(spark, scratch).read("log")) == [("a", 1)]


def test_append_compact_vacuum(spark, scratch):
    s = store(spark, scratch, buckets=4)
    for i in range(3):
        change = s.change()
        change.append("log", spark.createDataFrame([("a", i), ("b", i)], "word string, id long"))
        change.commit()
    a = s.touched("log", spark.createDataFrame([("a",)], "word string"))
    assert len(s.files("log", a)) == 3
    change = s.change()
    assert set(change.compact("log")) >= set(a)
    change.commit()
    assert len(s.files("log", a)) == 1
    assert rows(s.read("log", a).where("word = 'a'")) == [("a", 0), ("a", 1), ("a", 2)]
    assert s.vacuum(keep=1) > 0
    assert rows(store(spark, scratch).read("log")) == sorted((w, i) for w in "ab" for i in range(3))
    change = s.change()
    change.replace("log", s.read("log").limit(0))
    change.commit()
    assert store(spark, scratch).read("log").count() == 0
