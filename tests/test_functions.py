import hashlib
import re
import unicodedata
from datetime import date, datetime

import pytest
from conftest import column
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata import functions as X
from lodestrata.functions.html import embedded_json, elements


def python_normal_form(text):
    """Definition of the matching form, in Python."""
    if not text:
        return ""
    kept = "".join(c for c in text.lower().strip() if c.isspace() or c == "_" or c.isalnum())
    return re.sub(r"\s+", " ", kept)


TEXTS = [
    None,
    "",
    "  Hello,   World! ",
    "foo !",
    "!!!",
    "don't stop_me\tnow\n",
    "Ünï cödé – dash",
    "日本語 の 歌 (Live)",
    "a b c",
    "x\x1cy\x1fz",
    "café",
    "हिन्दी गीत",
    "½ + ² = ?",
]


def test_normalize_cases(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {r.i: r.n for r in df.select("i", X.normalize("t").alias("n")).collect()}
    assert got == {i: python_normal_form(t) for i, t in enumerate(TEXTS)}
    assert got[3] == "foo "


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(st.characters(max_codepoint=0x07FF, blacklist_categories=["Cs"]), max_size=30),
        min_size=30,
        max_size=60,
    )
)
def test_normalize_any_text(spark, texts):
    texts = [t.replace("\x00", "").replace("İ", "") for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.n for r in df.select("i", X.normalize("t").alias("n")).collect()}
    assert got == {i: python_normal_form(t) for i, t in enumerate(texts)}


def test_ids(spark):
    pair = X.song_id(F.lit("title"), F.lit("artist"))
    assert column(spark, pair) == hashlib.md5(b"title|artist").hexdigest()[:16]
    assert column(spark, X.generate_id(F.lit(7))) == hashlib.md5(b"7").hexdigest()
    assert column(spark, X.cache_key("spotify", F.lit("q"))) == "crawler:spotify:" + hashlib.md5(b"q").hexdigest()
    null_key, empty_key = X.natural_key(F.lit(None)), X.natural_key(F.lit(""))
    assert column(spark, null_key) != column(spark, empty_key)


@pytest.mark.parametrize(
    "text, plain, scaled",
    [
        ("138,106,461 views", 138106461, 138106461),
        ("1.2M views", 12, 1200000),
        ("3K views", 3, 3000),
        ("2B views", 2, 2000000000),
        ("No views", 0, 0),
        ("", 0, 0),
        (None, 0, 0),
        ("12 Kilometres", 12, 12),
        ("99999999999999999999", 0, 0),
    ],
)
def test_view_counts(spark, text, plain, scaled):
    assert column(spark, X.parse_view_count("x"), text) == plain
    assert column(spark, X.parse_view_count("x", suffix=True), text) == scaled


@pytest.mark.parametrize(
    "text, plain, hms",
    [
        ("4:05", 245, 245),
        ("45", 0, 0),
        ("1:02:03", 0, 3723),
        ("a:b", 0, 0),
        (" 4 : 05 ", 245, 245),
        ("", 0, 0),
        (None, 0, 0),
        ("1:2:3:4", 0, 0),
    ],
)
def test_durations(spark, text, plain, hms):
    assert column(spark, X.parse_duration("x"), text) == plain
    assert column(spark, X.parse_duration("x", hms=True), text) == hms


@pytest.mark.parametrize(
    "text, expected",
    [
        ("8 years ago", datetime(2016, 2, 29, 10)),
        ("1 month ago", datetime(2024, 1, 29, 10)),
        ("an hour ago", datetime(2024, 2, 29, 9)),
        ("Streamed 2 weeks ago", datetime(2024, 2, 15, 10)),
        ("30 seconds ago", datetime(2024, 2, 29, 9, 59, 30)),
        ("2009-10-25T06:57:33Z", datetime(2009, 10, 25, 6, 57, 33)),
        ("2009-10-25", datetime(2009, 10, 25)),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_published(spark, text, expected):
    reference = F.lit("2024-02-29 10:00:00").cast("timestamp_ntz")
    assert column(spark, X.parse_published("x", reference), text) == expected


@pytest.mark.parametrize(
    "text, precision, expected",
    [
        ("1999", "year", date(1999, 1, 1)),
        ("1999-07", "month", date(1999, 7, 1)),
        ("1999-07-09", "day", date(1999, 7, 9)),
        ("1999-07-09", "", date(1999, 7, 9)),
        ("1999", "day", None),
        (None, "day", None),
    ],
)
def test_release_date(spark, text, precision, expected):
    assert column(spark, X.release_date("x", F.lit(precision)), text) == expected


def test_rates_and_times(spark):
    assert float(column(spark, X.success_rate(F.lit(1), F.lit(3)))) == 33.33
    assert float(column(spark, X.success_rate(F.lit(1), F.lit(0)))) == 0
    assert float(column(spark, X.success_rate(F.lit(None), F.lit(None)))) == 0
    instant = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert column(spark, X.wall_clock_stamp(instant)) == "2024-01-01T07:00:00"
    a, b = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01", "2024-01-02 00:00:01.9"))
    assert column(spark, X.elapsed_seconds(a, b)) == 86401


def test_urls(spark):
    url = "http://a.b/c?x=1&y=%41+b&x=2&z=&w=%%#frag?n=1"
    assert column(spark, X.query_map("x"), url) == {"y": "A b", "x": "2", "w": "%%"}
    assert column(spark, X.query_map("x"), "http://a.b/c") == {}
    built = X.build_url("http://h", "/p", {"q": F.lit("a b&c"), "n": X.clamp(F.lit(77), 1, 50)})
    assert column(spark, built) == "http://h/p?q=a+b%26c&n=50"
    assert column(spark, X.clamp(F.lit(0), 1, 50)) == 50
    assert column(spark, X.clamp(F.lit(9), 1, 50)) == 9


def test_small_text_helpers(spark):
    assert column(spark, X.strip_at("x"), "@@name@x") == "name@x"
    assert column(spark, X.strip_space("x"), "  a b \n") == "a b"
    text = "Ünï ① ﬁn – ж"
    expected = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    assert column(spark, X.ascii_fold("x"), text) == expected
    assert column(spark, X.ascii_fold("x"), None) is None


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<script>var t="</p>";</script><script a="1">var ytInitialData = {"a":1};</script>', '{"a":1}'),
        ('<script>window["ytInitialData"] = {"b":2} ; </script>', '{"b":2}'),
        ('<script>ytInitialData={"c":3}</script>', '{"c":3}'),
        ('<script>ytInitialData = {bad</script><script>ytInitialData = {"d":4};</script>', '{"d":4}'),
        ("<script>ytInitialData = {bad</script>", None),
        ("<p>ytInitialData = {}</p>", None),
        (None, None),
    ],
)
def test_embedded_json(spark, html, expected):
    assert column(spark, embedded_json("x"), html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        # the assignment inside of a title is data
        (
            '<script>var ytInitialData = {"t":"how var ytInitialData = works; "};</script>',
            '{"t":"how var ytInitialData = works; "}',
        ),
        ('<script>var ytInitialData = {"a":1};var b=2</script>', None),
        ('<script>x(); var ytInitialData = {"a":1};</script>', None),
    ],
)
def test_embedded_json_is_taken_as_it_stands(spark, html, expected):
    assert column(spark, embedded_json("x"), html) == expected


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a":1,"a":2}', True),
        (' [1, {"b": null}]\n', True),
        ('"x"', True),
        ("3", True),
        ('{"a":1} {"b":2}', False),
        ('{"a":1};', False),
        ('{"a":1}}', False),
        ('{"a":1},"seal":"x"} tail', False),
        ("{'a':1}", False),
        ('{"a":', False),
        ("", False),
        ("{broken", False),
        (None, False),
    ],
)
def test_is_json(spark, text, valid):
    assert column(spark, X.is_json("x"), text) is valid


def test_is_json_has_no_size_limit(spark):
    big = spark.range(1).select(F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), 30_000_000), F.lit('"}')).alias("x"))
    assert big.select(X.is_json("x")).first()[0] is True
    deep = spark.range(1).select(F.concat(F.repeat(F.lit("["), 2_000), F.repeat(F.lit("]"), 2_000)).alias("x"))
    assert deep.select(X.is_json("x")).first()[0] is True


def test_elements(spark):
    html = "<ul><li class='a'>one</li><LI>two\nlines</LI><link>no</link></ul>"
    assert column(spark, elements("x", "li"), html) == ["one", "two\nlines"]


def test_instants_do_not_depend_on_the_session_zone(spark):
    texts = ["2024-03-10 02:30:00", "2024-11-03 05:30:00", "2024-11-03 06:30:00.123456", "1969-12-31 23:59:59"]
    wall = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            instant = X.utc_instant("t")
            rows = wall.select(
                "t", X.utc_wall(instant).alias("back"), X.wall_clock(instant).alias("local")
            ).collect()
            assert all(r.t == r.back and (r.local - r.t).total_seconds() == 7 * 3600 for r in rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ascii_fold_looks_characters_up(spark):
    """Every character with a form, alone and among others; no class of thousands is tried one by one."""
    forms = [chr(p) for p in range(0x80, 0x30000) if unicodedata.normalize("NFKD", chr(p)).encode("ascii", "ignore")]
    texts = [*forms, "".join(forms), "plain \x7f text", "", "漢字 ½ cup of ﬂour — naïve 😀\x80"]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", X.ascii_fold("x").alias("y"))
    for r in rows.collect():
        assert r.y == unicodedata.normalize("NFKD", r.x).encode("ascii", "ignore").decode(), r.x
    assert "RLIKE" not in rows._jdf.queryExecution().analyzed().toString()
