"""Structured Streaming: stateful processors, stream forms of the jobs, sinks."""

from rillet.streaming.processors import (
    ChangeProcessor, FlagRunProcessor, PairAverageProcessor, RecordRunProcessor, SignalStateProcessor,
)
from rillet.streaming.queries import (
    append_to_table, run_available, run_with_restarts, stream_changes, stream_flag_runs, stream_latest, stream_pair_average,
    stream_record_runs, stream_signal_state, stream_table, stream_window_summary, stream_word_count, upsert_to_table,
)
from rillet.streaming.sinks import (
    ProgressTotals, append_sink, as_text_lines, changelog_records, console_sink, fan_out, observed, progress_report, read_batches,
    read_upserted, text_rows_sink, upsert_batch, upsert_sink, write_batch, write_changelog_json, write_text_rows,
)

__all__ = [
    "ChangeProcessor", "FlagRunProcessor", "PairAverageProcessor", "RecordRunProcessor", "SignalStateProcessor",
    "append_to_table", "run_with_restarts", "run_available", "stream_changes", "stream_flag_runs", "stream_latest",
    "stream_pair_average", "stream_record_runs", "stream_signal_state", "stream_table", "stream_window_summary",
    "stream_word_count", "upsert_to_table", "append_sink", "as_text_lines", "text_rows_sink", "write_text_rows",
    "changelog_records", "console_sink", "fan_out", "observed", "progress_report", "read_upserted", "upsert_batch",
    "upsert_sink", "write_changelog_json", "ProgressTotals", "read_batches", "write_batch",
]
