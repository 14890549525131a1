"""The reference's streaming jobs, started as Structured Streaming queries.

Each ``start_*`` takes a streaming input (from a file folder, or Kafka via
:func:`rillet.sources.read_json_stream`), an output folder and a checkpoint
folder, and returns the running queries. Trigger every second by default
(the reference checkpoints every second); pass ``{"availableNow": True}`` to
process what is there and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillet.operators.lookup import lookup
from rillet.operators.words import words_by_block
from rillet.plans.jobs import SIGNAL_ORDER, WINDOW
from rillet.streaming.queries import (
    stream_changes, stream_pair_average, stream_record_runs, stream_signal_state, stream_window_summary, stream_word_count,
)
from rillet.streaming.sinks import append_sink, fan_out, upsert_batch, upsert_sink, write_batch


def start_word_count(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Running word counts, upserted by word."""
    return upsert_sink(stream_word_count(lines), out, checkpoint, ["word"], ["count"], trigger=trigger)


def start_word_changes(docs: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                       doc_id: str = "doc_id", line: str = "line") -> StreamingQuery:
    """J1 with the change-record sink: every change of every word's count, in (document, position) order
    inside a micro-batch (``plans.jobs.word_count_changelog`` as a stream). Documents without id are left out."""
    places = words_by_block(docs.where(F.col(doc_id).isNotNull()), doc_id, line)
    return append_sink(stream_changes(places, "word", [doc_id, "pos"], places=True), out, checkpoint, trigger)


def start_team_spend(payments: DataFrame, teams: DataFrame, out: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Stream-static lookup of the team name, running spend per team, upserted by team.

    Update mode gives one row per changed team and micro-batch; the upsert
    table keeps the row of the latest micro-batch.
    """
    named = lookup(payments, teams, "team_id")
    spend = named.groupBy("team").agg(F.sum(F.col("pay_amount").cast("decimal(18,2)")).cast("double")
                                      .alias("pay_amount"))
    return upsert_sink(spend, out, checkpoint, ["team"], ["pay_amount"], trigger=trigger)


def start_pair_average(bits: DataFrame, out: str, checkpoint: str, key: str | None = None,
                       trigger: dict | None = None) -> StreamingQuery:
    """Pair averages appended as they complete (``key=None``: one sequence)."""
    return append_sink(stream_pair_average(bits, key, SIGNAL_ORDER, "bit", "ts"), out, checkpoint, trigger)


def start_record_runs(bits: DataFrame, out: str, checkpoint: str, key: str | None = None,
                      trigger: dict | None = None) -> StreamingQuery:
    """Record-setting runs appended as they happen."""
    return append_sink(stream_record_runs(bits, key, SIGNAL_ORDER, "bit", "ts"), out, checkpoint, trigger)


def start_signal_qa(signal: DataFrame, out: str, checkpoint: str, size: str = WINDOW,
                    delay: str = "3 seconds", trigger: dict | None = None, only: str | None = None) -> dict[str, StreamingQuery]:
    """The three outputs of the QA job from the flagged stream, as two queries.

    ``summary``: window summaries (append, watermark ``delay``).
    ``events``: one read and one state; each micro-batch feeds two sinks, completed flag runs
    (read them with ``read_batches``) and the current flag per key (upserted). ``only``
    names one of the two.
    """
    out, checkpoint = out.rstrip("/"), checkpoint.rstrip("/")
    at = [F.col(f"o{i}").alias(c) for i, c in enumerate(SIGNAL_ORDER)]

    def runs(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.where("kind = 'run'").select("user_id", "n_samples", "end_time"), batch_id, f"{out}/runs")

    def current(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch.where("kind = 'current'").select("user_id", "flag", *at), batch_id, f"{out}/current", ["user_id"], SIGNAL_ORDER)

    start = {
        "summary": lambda: append_sink(stream_window_summary(signal, "user_id", "ts", "value", "flag", size, delay),
                                       f"{out}/summary", f"{checkpoint}/summary", trigger),
        "events": lambda: fan_out(stream_signal_state(signal, "user_id", SIGNAL_ORDER, "flag", "ts"), {"runs": runs, "current": current},
                                  f"{checkpoint}/events", trigger=trigger),
    }
    return {name: begin() for name, begin in start.items() if only in (None, name)}
