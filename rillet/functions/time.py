"""Time helpers: per-second buckets, trailing intervals, NTZ round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_ntz(c: Column) -> Column:
    """Cast back to TIMESTAMP_NTZ (what Parquet holds and SQL engines compare)."""
    return c.cast("timestamp_ntz")


def second_bucket(ts: Column | str) -> Column:
    """Start of the 1-second bucket of ``ts`` (date histogram, interval ``s``, F9)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return to_ntz(F.date_trunc("second", c))


def epoch_millis(text: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Milliseconds since the epoch of a text time (F8); unparsable text -> NULL."""
    c = F.col(text) if isinstance(text, str) else text
    return F.unix_millis(F.try_to_timestamp(c, F.lit(fmt)))


def last_interval(df: DataFrame, ts: str, as_of, minutes: int = 15) -> DataFrame:
    """Rows with ``as_of - minutes < ts <= as_of`` (a dashboard time range, P9).

    ``as_of`` is a parameter (a timestamp literal or Column), never the wall
    clock, so the filter is reproducible and pushes down to the scan.
    """
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    start = end - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return df.where((F.col(ts) > start) & (F.col(ts) <= end))
