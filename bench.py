"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each batch query is forced to completion with the ``noop`` sink (the full
plan runs, nothing is collected to the driver). One warm-up pass, then the
median of $BENCH_REPEAT timed runs per query; ``value`` is their sum. The
streaming forms (``stream_*``: start a query, process the whole table
folder with availableNow, read back its table) are timed once after a
warm-up and reported apart under ``stream_queries`` (BENCH_STREAMS=0 skips
them).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rillet.plans.catalog import QUERIES, STREAM_QUERIES  # noqa: E402
from rillet.session import build_session  # noqa: E402

#: Registered for the oracle only: variants of a headline query, or sources and sinks by themselves.
NOT_TIMED = {"pair_average_chunked", "pair_average_global_chunked", "record_runs_chunked", "flag_runs_chunked", "running_sum_nulls",
             "changelog_sum_nulls", "running_xor", "changelog_json", "json_decode", "json_quarantine", "document_ids", "epoch_millis",
             "text_lines", "csv_lines", "text_rows", "dash_d2_recent", "dash_d3_recent", "dash_d6_recent",
             "stream_pair_average_global", "stream_record_runs_global", "stream_signal_qa_json", "stream_word_count_changelog",
             "stream_changelog_json", "stream_late_rows", "stream_idle_sources", "stream_arrival_order", "sql_team_spend", "table_by_name",
             "literal_lookup", "stream_restarts", "stream_recovery"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="rillet-bench")
    errors: dict[str, str] = {}

    def timed(name, fn, runs):
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            out = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                out.append(time.perf_counter() - t0)
            return round(statistics.median(out), 3)
        except Exception as e:  # report and go on with the other queries
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            return None

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if name in only or not only and name not in NOT_TIMED:
            t = timed(name, fn, repeat)
            if t is not None:
                times[name] = t
    stream_times: dict[str, float] = {}
    if os.environ.get("BENCH_STREAMS", "1") != "0":
        for name, fn in STREAM_QUERIES.items():
            if name in only or not only and name not in NOT_TIMED:
                t = timed(name, fn, 1)
                if t is not None:
                    stream_times[name] = t
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "stream_queries": stream_times,
                      "errors": errors, "sf": sf, "cpus": cpus, "repeat": repeat,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
