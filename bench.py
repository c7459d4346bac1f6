"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up the JVM code paths it shares with the others,
and is then timed from building the plan to the last row; short ones three times, of
which the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestrata.catalog import QUERIES  # noqa: E402
from lodestrata.session import local_session  # noqa: E402

HEADLINE = [
    "silver_track",
    "silver_video",
    "silver_artist",
    "normalize_text",
    "contains_match_long",
    "contains_match_blocked",
    "song_mapping",
    "dim_song",
    "dim_artist",
    "dim_album",
    "q1_top",
    "q2_top",
    "snapshot_change",
    "ingestion_summary",
    "alerts",
    "dq_log",
    "upsert_merge",
    "catalogue_enrich",
    "page_items",
    "stream_upsert",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


#: Seconds below which a query is timed three times.
SHORT = 5


def timed(spark, name: str, sf_dir: str) -> float:
    times = [run(spark, name, sf_dir)]
    if times[0] < SHORT:
        times += [run(spark, name, sf_dir) for _ in range(2)]
    return round(sorted(times)[len(times) // 2], 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            run(spark, name, warm_dir)
    times = {name: timed(spark, name, sf_dir) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
