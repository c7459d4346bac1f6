import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, kinds, rows_of

# One query per area; tools/check_oracles.py runs them all.
SAMPLE = [
    "silver_track",
    "silver_video",
    "song_mapping",
    "contains_match_blocked",
    "dim_song",
    "dim_artist",
    "ingestion_summary",
    "alerts",
    "upsert_merge",
    "dq_log",
    "catalogue_enrich",
    "page_items",
    "stream_upsert",
]


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].youtube_video_count >= rows[-1].youtube_video_count


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert rows_of(df.columns, got) == rows_of(columns, want)
    assert kinds(df.columns, got) == kinds(columns, want)
