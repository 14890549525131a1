"""Run a job from the command line, batch or streaming.

    python -m rillet <job> --input DIR --output DIR [--stream] [--checkpoint DIR]
                           [--available-now] [--trigger-seconds N] [--restarts N]
                           [--messages DIR]

``<job>`` is one of the registered batch queries (``python -m rillet list``).
The streaming jobs are word_count, team_spend, pair_average, record_runs
and signal_qa. Batch mode writes the query's result as parquet to
``OUTPUT/<job>``. Streaming mode starts the job's streaming queries over the
table folder and runs until stopped; with ``--available-now`` it
processes what is there and exits. Under ``spark-submit`` the submitter's master and
settings are used.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from rillet.functions.time import to_ntz
from rillet.plans.catalog import QUERIES
from rillet.schemas import BITS, SIGNAL
from rillet.session import build_session, checkpoint_dir
from rillet.sources.json_stream import read_json_stream, split_quarantine, with_event_time
from rillet.sources.tables import load, role_bits, role_lines, role_payments, role_signal, role_teams
from rillet.streaming import jobs as SJ
from rillet.streaming.queries import run_with_restarts, stream_table
from rillet.streaming.sinks import append_sink

STREAM_JOBS = ("word_count", "team_spend", "pair_average", "record_runs", "signal_qa")
#: A signal message above this value is flagged.
FLAG_ABOVE = 80.0


def _messages(spark, job: str, folder: str, out: str, ckpt: str, trigger: dict):
    """Rows of a job's messages, and the query that writes the bad ones aside."""
    schema, needed = (SIGNAL, ("ts", "baselineId")) if job == "signal_qa" else (BITS, ("ts",))
    rows = with_event_time(read_json_stream(spark, schema, "text", folder), "createTime")
    good, bad = split_quarantine(rows, needed)
    aside = append_sink(bad, f"{out}/{job}-quarantine", f"{ckpt}/{job}-quarantine", trigger)
    ts = to_ntz(F.col("ts"))
    if job == "signal_qa":
        value = F.col("signalValue")
        return good.select(ts.alias("ts"), F.xxhash64("createTime", "baselineId", value).alias("event_id"), F.col("baselineId").alias("user_id"),
                           value.alias("value"), (value > FLAG_ABOVE).cast("int").alias("flag")), aside
    return good.select(ts.alias("ts"), F.xxhash64("createTime").alias("event_id"), F.lit(0).cast("long").alias("user_id"), F.col("binaryInt").alias("bit")), aside


def _start_stream(spark, job: str, src: str, out: str, ckpt: str, trigger: dict, messages: str | None = None):
    if messages:
        if job not in ("pair_average", "record_runs", "signal_qa"):
            raise SystemExit(f"{job} takes no messages")
        rows, aside = _messages(spark, job, messages, out.rstrip("/"), ckpt.rstrip("/"), trigger)
        to, at = f"{out.rstrip('/')}/{job}", f"{ckpt.rstrip('/')}/{job}"
        if job == "signal_qa":
            return [aside, *SJ.start_signal_qa(rows, to, at, trigger=trigger).values()]
        start = SJ.start_pair_average if job == "pair_average" else SJ.start_record_runs
        return [aside, start(rows, to, at, None, trigger)]

    def table(name):
        return stream_table(spark, src, name, load(spark, src, name).schema)

    out, ckpt = out.rstrip("/"), ckpt.rstrip("/")
    if job == "word_count":
        return [SJ.start_word_count(role_lines(table("documents")), f"{out}/{job}", f"{ckpt}/{job}", trigger)]
    if job == "team_spend":
        return [SJ.start_team_spend(role_payments(table("customer")), role_teams(load(spark, src, "nation")),
                                    f"{out}/{job}", f"{ckpt}/{job}", trigger)]
    if job == "pair_average":
        return [SJ.start_pair_average(role_bits(table("events")), f"{out}/{job}", f"{ckpt}/{job}", None, trigger)]
    if job == "record_runs":
        return [SJ.start_record_runs(role_bits(table("events")), f"{out}/{job}", f"{ckpt}/{job}", None, trigger)]
    if job == "signal_qa":
        return list(SJ.start_signal_qa(role_signal(table("events")), f"{out}/{job}", f"{ckpt}/{job}",
                                       trigger=trigger).values())
    raise SystemExit(f"no streaming form for {job}; streaming jobs: {', '.join(STREAM_JOBS)}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m rillet", description=__doc__.split("\n")[0])
    p.add_argument("job", help="job name, or 'list'")
    p.add_argument("--input", help="folder of input parquet tables")
    p.add_argument("--output", help="folder for results")
    p.add_argument("--stream", action="store_true", help="run the streaming form")
    p.add_argument("--messages", help="streaming: folder of JSON text lines to read instead of a table")
    p.add_argument("--checkpoint", help="checkpoint folder (default: spark.checkpoint.dir)")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--trigger-seconds", type=float, default=1.0)
    p.add_argument("--restarts", type=int, default=0,
                   help="streaming: restart the job's queries from their checkpoints up to N times")
    p.add_argument("--restart-delay", type=float, default=2.0, help="seconds between restarts")
    p.add_argument("--master", help="Spark master when not under spark-submit, e.g. local[8]")
    a = p.parse_args(argv)
    if a.job == "list":
        print("batch:", " ".join(QUERIES))
        print("stream:", " ".join(STREAM_JOBS))
        return 0
    if not (a.input or a.messages) or not a.output:
        p.error("--input (or --messages) and --output are required")
    spark = build_session(a.master)
    if not a.stream:
        if a.job not in QUERIES:
            p.error(f"unknown job {a.job}")
        QUERIES[a.job](spark, a.input).write.mode("overwrite").parquet(f"{a.output.rstrip('/')}/{a.job}")
        return 0
    trigger = {"availableNow": True} if a.available_now else {"processingTime": f"{a.trigger_seconds} seconds"}
    ckpt = a.checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/rillet-{a.job}"
    return run_with_restarts(lambda: _start_stream(spark, a.job, a.input, a.output, ckpt, trigger, a.messages),
                             a.restarts, a.restart_delay)


if __name__ == "__main__":
    sys.exit(main())
