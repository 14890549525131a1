"""Flags, status levels, document ids and the truncating mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the sinks' document ids: key delimiter and null literal.
KEY_DELIMITER = "$"
NULL_LITERAL = "n/a"


def with_flag(df: DataFrame, flag: Column, name: str = "flag") -> DataFrame:
    """Append a 0/1 flag computed by any boolean rule.

    The rule should be deterministic: then every branch of a fan-out sees
    the same flags without materialising them (see plans.jobs.fan_out).
    """
    return df.withColumn(name, flag.cast("boolean").cast("int"))


def status_level(value: Column, threshold: float = 0.5,
                 low: str = "ok", high: str = "bad") -> Column:
    """Two-level colour range: ``[0, threshold)`` -> low, ``[threshold, ...)`` -> high."""
    return F.when(value.isNull(), F.lit(None)).when(value >= F.lit(threshold), F.lit(high)).otherwise(F.lit(low))


def document_id(*keys: Column | str) -> Column:
    """Composite document id: key texts joined by ``$``, NULL written ``n/a`` (K6)."""
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit(NULL_LITERAL))
             for k in keys]
    return F.concat_ws(KEY_DELIMITER, *parts)


def truncating_mean(total: Column, n: Column | int) -> Column:
    """``int(total / n)``: the mean truncated toward zero (F4), not floored."""
    d = F.lit(n) if isinstance(n, int) else n
    return (total / d).cast("int")
