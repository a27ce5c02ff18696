"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated)
a choice of queries. Each query is declared and run in full three times; the best run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from snapmart.catalog import QUERIES
from snapmart.session import build_session

HEADLINE = (
    "market_overview", "momentum_daily", "rank_movers", "sector_performance", "entity_explorer", "snapshot_join",
    "bridge", "latest_per_key", "latest_per_key_day", "rank_in_day", "daily_join", "join_using",
    "latest_by_max_join", "fk_orphans", "filtered_agg", "row_count_per_day", "duplicate_keys", "dq_report",
    "missing_pct", "snapshot_equal", "snapshot_commits", "same_day_commit", "stream_ingest", "explode_flatten",
    "envelope_read", "csv_roundtrip", "fn_string", "top_k",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    with tempfile.TemporaryDirectory(prefix="snapmart-bench-") as shared:  # local mode: one machine
        run(folder, cpus, chosen, shared)


def run(folder: str, cpus: str, chosen: list[str], shared: str) -> None:
    spark = build_session(cpus, **{"spark.checkpoint.dir": shared})
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "union_labelled", folder)
    times = {name: round(min(seconds(spark, name, folder) for _ in range(3)), 3) for name in chosen}
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
