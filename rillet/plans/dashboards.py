"""The monitoring dashboards' aggregations over the jobs' outputs.

Each panel reads a job's output table. ``as_of`` with ``minutes`` restricts a
panel to its time range (``now-15m..now`` in the saved panels); ``None``
reads the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.functions.flags import status_level
from rillet.functions.time import last_interval, second_bucket
from rillet.operators.topk import restrict_to_top_keys, top_by_metric, top_keys

TOP_KEYS = 5
TOP_TEAMS = 7
TOP_AVERAGES = 5


def _range(df: DataFrame, ts: str, as_of, minutes: int) -> DataFrame:
    return df if as_of is None else last_interval(df, ts, as_of, minutes)


def _top(df: DataFrame, key: str, keys_from: DataFrame | None) -> DataFrame:
    """Rows of ``df`` of the 5 largest keys. ``keys_from`` is a cheaper table
    with the same key set (e.g. the job's input when every input key has an
    output row): the keys are then found without recomputing ``df``."""
    if keys_from is None:
        return restrict_to_top_keys(df, key, TOP_KEYS)
    return df.join(F.broadcast(top_keys(keys_from, key, TOP_KEYS)), key, "left_semi")


def current_flag_panel(current: DataFrame, key: str = "user_id", keys_from: DataFrame | None = None) -> DataFrame:
    """Max current flag of the 5 largest keys, with a two-level status."""
    top = _top(current, key, keys_from)
    g = top.groupBy(key).agg(F.max("flag").alias("max_flag"))
    return g.select(key, "max_flag", status_level(F.col("max_flag")).alias("status"))


def signal_panel(summary: DataFrame, key: str = "user_id", as_of=None, minutes: int = 15,
                 keys_from: DataFrame | None = None) -> DataFrame:
    """Per (top-5 key, second of window start): max of window max, mean and min.
    ``keys_from`` (the signal) applies to the whole history only."""
    s = _top(_range(summary, "window_start", as_of, minutes), key, keys_from if as_of is None else None)
    return (s.groupBy(key, second_bucket("window_start").alias("second"))
             .agg(F.max("max").alias("max_signal"), F.max("mean").alias("mean_signal"),
                  F.max("min").alias("min_signal")))


def top_key_rows(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among the 5 largest of ``keys``."""
    return df.join(F.broadcast(top_keys(keys, key, TOP_KEYS)), key, "left_semi")


def run_panel(runs: DataFrame, key: str = "user_id", as_of=None, minutes: int = 15,
              keys_from: DataFrame | None = None) -> DataFrame:
    """D3: longest finished flag run per (top-5 key, second of its end).
    ``keys_from``: the keys that have runs (whole history only)."""
    r = _top(_range(runs, "end_time", as_of, minutes), key, keys_from if as_of is None else None)
    return r.groupBy(key, second_bucket("end_time").alias("second")) \
        .agg(F.max("n_samples").alias("max_samples"))


def spend_sum_panel(spend: DataFrame) -> DataFrame:
    """D4 (first panel): total spend of the 7 teams with the largest total."""
    return top_by_metric(spend, "team", {"sum_pay_amount": F.sum("pay_amount")}, "sum_pay_amount", TOP_TEAMS)


def spend_max_panel(spend: DataFrame) -> DataFrame:
    """D4 (second panel): largest spend document of the 7 top teams by it."""
    return top_by_metric(spend, "team", {"max_pay_amount": F.max("pay_amount")}, "max_pay_amount", TOP_TEAMS)


def average_distribution_panel(pairs: DataFrame) -> DataFrame:
    """Number of pairs per average value, 5 most frequent."""
    return top_by_metric(pairs, "average", {"n_pairs": F.count(F.lit(1))}, "n_pairs", TOP_AVERAGES)


def record_run_panel(records: DataFrame, as_of=None, minutes: int = 15) -> DataFrame:
    """Longest record run per second, one bucket per filter ``value = 0`` / ``value = 1``."""
    r = _range(records, "create_time", as_of, minutes)
    r = r.where(F.col("value").isin(0, 1))
    return r.groupBy("value", second_bucket("create_time").alias("second")) \
        .agg(F.max("run_length").alias("max_run_length"))
