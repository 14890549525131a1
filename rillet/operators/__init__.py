"""Operators: functions from DataFrame to DataFrame."""

from rillet.operators.aggregates import (
    changelog, exact_sum, keyed_sum, running_aggregate, running_folds, spread, window_summary, word_count,
)
from rillet.operators.lookup import lookup
from rillet.operators.scan import chunking, scan
from rillet.operators.sequences import flag_runs, keys_with_flag_runs, latest_by_key, pair_average, record_runs
from rillet.operators.topk import restrict_to_top_keys, top_by_metric, top_keys

__all__ = [
    "changelog", "exact_sum", "keyed_sum", "running_aggregate", "running_folds", "spread", "window_summary",
    "word_count", "lookup", "chunking", "scan", "flag_runs",
    "keys_with_flag_runs", "latest_by_key", "pair_average", "record_runs", "restrict_to_top_keys", "top_by_metric", "top_keys",
]
