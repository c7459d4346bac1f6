"""As-of joins, silent runs, profiles, nested elements."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import is_json
from lodestrata.functions.html import elements
from lodestrata.operators import backlog, monitoring, profile
from lodestrata.operators.asof import asof_join
from tests.conftest import column

START = datetime(2024, 1, 1)


def minutes(n):
    return START + timedelta(minutes=n)


@pytest.mark.parametrize("seconds", [60, 3_600, 10**6])
def test_asof_equals_plain(spark, seconds):
    rnd = random.Random(seconds)
    keys = ["hot"] * 6 + ["a", "b", None]
    asked = [(i, rnd.choice(keys), minutes(rnd.randint(0, 400)) if i % 17 else None) for i in range(150)]
    given = [(rnd.choice(keys), minutes(rnd.randint(50, 380)), f"v{i}") for i in range(90)]
    given += [("hot", minutes(100), "tie-a"), ("hot", minutes(100), "tie-b"), ("a", None, "never")]
    rows = spark.createDataFrame(asked, "i int, k string, at timestamp_ntz")
    history = spark.createDataFrame(given, "k string, since timestamp_ntz, v string")
    got = asof_join(rows, history, "k", "at", "since", ["v"], seconds).collect()

    def newest(k, at):
        found = [(s, v) for g, s, v in given if at and s and k is not None and g == k and s <= at]
        return max(found)[1] if found else None

    assert sorted((r.i, r.entry.v if r.entry else None) for r in got) == [(i, newest(k, at)) for i, k, at in asked]
    assert asof_join(rows, history.limit(0), "k", "at", "since").filter("entry IS NULL").count() == len(asked)


def test_cache_as_of(spark):
    asked = spark.createDataFrame([("q", minutes(m)) for m in (0, 10, 60, 2_000)] + [("z", minutes(5))], "query string, at timestamp_ntz")
    key = spark.range(1).select(F.concat(F.lit("crawler:spotify:"), F.md5(F.lit("q"))).alias("k")).first().k
    cache = spark.createDataFrame(
        [(key, '[{"id":1}]', minutes(10)), (key, "[]", minutes(30))], "cache_key string, response_items string, stored_at timestamp_ntz"
    )
    got = backlog.cache_status_at(asked, cache, "spotify", "at").orderBy("query", "at").collect()
    assert [r.status for r in got] == ["MISS", "HIT", "STALE", "MISS", "MISS"]
    assert [r.response_items for r in got][1] == '[{"id":1}]' and got[2].response_items is None


def test_silent_runs(spark):
    day = lambda n: date(2020, 1, 1) + timedelta(days=n)
    rows = [("a", day(0), 5), ("a", day(4), 5), ("b", day(2), 0), ("c", day(1), 1), ("d", day(9), 0), ("e", day(0), 0), ("e", day(1), 3)]
    totals = spark.createDataFrame(rows, "source string, date_id date, raw long")
    got = sorted(map(tuple, monitoring.silent_runs(totals, F.lit(day(8))).collect()))
    assert got == [
        ("a", day(1), day(3), 3), ("a", day(5), day(8), 4), ("b", day(2), day(8), 7), ("c", day(2), day(8), 7), ("e", day(0), day(0), 1), ("e", day(2), day(8), 7),
    ]
    # years of silence are one row
    late = monitoring.silent_runs(totals.filter("source = 'c'"), F.lit(date(2030, 1, 1))).collect()
    assert len(late) == 1 and late[0].days > 3_000


def test_steps_are_near(spark):
    values = [0.0, 0.004, 0.01, -3.456, 99.99, 12_345.678, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    steps = [float(r.s) / 100 for r in df.select(profile.step(F.col("v")).alias("s")).collect()]
    assert all(abs(s - v) <= max(0.1 * abs(v), 0.01) for s, v in zip(steps, values, strict=True))


def test_profiles_add_up_and_tell_a_shift(spark):
    rows = []
    for d in range(10):
        for i in range(100):
            value = 10.0 + i % 7 if d != 8 else 40.0 + i % 7
            rows.append((START + timedelta(days=d), None if d == 9 and i < 60 else value, "x" if i % 10 else None))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double, s string")
    whole = profile.profile(df, "ts", ["s"], ["v"])
    halves = [profile.profile(df.filter(F.crc32(F.col("v").cast("string").cast("binary")) % 2 == k), "ts", ["s"], ["v"]) for k in (0, 1)]
    halves.append(profile.profile(df.filter("v IS NULL"), "ts", ["s"], ["v"]))
    added = profile.merged(halves[0].unionByName(halves[1]).unionByName(halves[2])).filter("n > 0")
    assert sorted(map(str, added.collect())) == sorted(map(str, whole.filter("n > 0").collect()))
    warned = {(r.day.day, r["column"], r.metric) for r in profile.anomalies(whole).filter("status = 'warn'").collect()}
    assert warned == {(9, "v", "p50"), (9, "v", "p90"), (10, "v", "null_share")}
    assert profile.anomalies(whole).filter("status = 'new'").select("day").distinct().count() == 3
    assert profile.anomalies(whole.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "tag", "inner"),
    [
        ("<div>a<div>b</div>c</div>", "div", ["a<div>b</div>c", "b"]),
        ("<div>a</div></div><div>b</div>", "div", ["a", "b"]),
        ("<div>a<div>b", "div", ["a<div>b", "b"]),
        ("<!-- <div>x</div> --><div>y<!-- </div> -->z</div>", "div", ["y<!-- </div> -->z"]),
        ("<script>'<div>'</script><DIV class='a'>q</Div >", "div", ["q"]),
        ("<p>one<p>two</p>three", "p", ["one", "two"]),
        ("<span><spanner>x</spanner></span>", "span", ["<spanner>x</spanner>"]),
        ("a<br>b", "br", []),
        ("<script>if (a<b) '</div>'</script>", "script", ["if (a<b) '</div>'"]),
        ("<ul><li>a<ul><li>b</li></ul></li><li></li></ul>", "li", ["a<ul><li>b</li></ul>", "b", ""]),
        ("", "div", []),
        (None, "div", None),
    ],
)
def test_nested_elements(spark, html, tag, inner):
    assert column(spark, elements("x", tag), html) == inner


@pytest.mark.parametrize(("text", "valid"), [('1,"b":2', False), ('1,"2"', False), ("1", True), ('"]"', True), ("1]", False), ("[1,2]", True), ('{"a":[1]}', True), ("", False), ('{"a":1},', False)])
def test_one_json_value(spark, text, valid):
    assert column(spark, is_json("x"), text) is valid
