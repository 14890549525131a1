"""Top-k terms of dashboard panels (L1-L3).

A top-k is the feature here, so a limit is right. ``orderBy().limit(k)``
plans as ``TakeOrderedAndProject``: each task keeps its own k best rows and
only those reach the final merge, so no task sees the whole input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_keys(df: DataFrame, key: str, k: int, descending: bool = True) -> DataFrame:
    """The ``k`` largest (or smallest) distinct non-NULL keys (terms ordered by key)."""
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    o = F.col(key).desc() if descending else F.col(key).asc()
    return keys.orderBy(o).limit(k)


def restrict_to_top_keys(df: DataFrame, key: str, k: int, descending: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is among the top ``k`` keys (then further buckets).

    The k keys are joined back with a broadcast: their size is bounded by k.
    """
    return df.join(F.broadcast(top_keys(df, key, k, descending)), key, "left_semi")


def top_by_metric(df: DataFrame, key: str, metrics: dict[str, Column], order_by: str, k: int) -> DataFrame:
    """Group by ``key``, compute ``metrics``, keep the ``k`` groups with the largest
    ``order_by`` metric; ties broken by key ascending; NULL keys dropped and no
    "other" bucket (terms ordered by a metric)."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in metrics.items()])
    return g.orderBy(F.col(order_by).desc(), F.col(key).asc()).limit(k)
