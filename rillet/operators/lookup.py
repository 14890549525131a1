"""Dimension lookup by id (N1): a join, never a Python function per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left join ``df`` to ``dim`` on an id: unknown, negative or NULL ids get
    NULL attributes and never fail the job.

    The dimension is reduced to one attribute row per id. Spark broadcasts it when
    its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (or AQE
    measures it so); beyond, it is a shuffle join that AQE splits where skewed.
    """
    dim_key = dim_key or key
    # One attribute row per id, chosen deterministically (the smallest), so
    # a recomputed task picks the same row.
    others = [c for c in dim.columns if c != dim_key]
    d = dim.groupBy(dim_key).agg(F.min(F.struct(*others)).alias("_a")).select(dim_key, "_a.*")
    if dim_key != key:
        d = d.withColumnRenamed(dim_key, key)
    return df.join(d, key, "left")
