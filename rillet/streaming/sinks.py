"""Sinks: append, upsert by key, one-source-to-many fan-out, change records (K1-K9).

Every sink writes under a checkpoint location so a restarted query resumes
where it stopped. ``foreachBatch`` may replay a micro-batch after a failure;
the sinks here write each batch as partition ``_batch=<id>`` of a parquet table with Spark's
dynamic partition overwrite, so a replay replaces the earlier attempt instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rillet.schemas import CHANGE_OPS
from rillet.sources.tables import path_kind

BATCH_COL = "_batch"


def _start(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def append_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                fmt: str = "parquet") -> StreamingQuery:
    """Every result row becomes a new record (K4); exactly once with the file sink."""
    w = df.writeStream.outputMode("append").format(fmt).option("path", path) \
        .option("checkpointLocation", checkpoint)
    return _start(w, trigger)


def as_text_lines(df: DataFrame) -> DataFrame:
    """Each row as one text line ``(v1,v2,...)`` (a row's plain string form)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")).alias("value"))


def write_text_rows(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Row file sink (K3): one record per line, in as many part files as the result has partitions."""
    as_text_lines(df).write.mode(mode).text(path)


def text_rows_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Streaming form of :func:`write_text_rows` (append mode)."""
    w = as_text_lines(df).writeStream.outputMode("append").format("text").option("path", path) \
        .option("checkpointLocation", checkpoint)
    return _start(w, trigger)


def console_sink(df: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Print each micro-batch (K1)."""
    w = df.writeStream.outputMode(mode).format("console").option("truncate", "false") \
        .option("checkpointLocation", checkpoint)
    return _start(w, trigger)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one greatest in ``order`` (a partial/final aggregate)."""
    cols = [c for c in df.columns if c not in key]
    o = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), o).alias("_r"))
    return agg.select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch's rows as partition ``_batch`` of the table, replacing an earlier attempt of it."""
    (df.withColumn(BATCH_COL, F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(path))


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All rows that :func:`write_batch` left, with the micro-batch in ``_batch``. With
    ``schema`` (of the rows), a table no batch has written yet reads as empty."""
    if schema is None:
        return spark.read.parquet(path).withColumn(BATCH_COL, F.col(BATCH_COL).cast("long"))
    schema = (T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))).add(BATCH_COL, "long")
    if path_kind(spark, path) is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def upsert_batch(batch: DataFrame, batch_id: int, path: str, key: Sequence[str], order: Sequence[str]) -> None:
    """Write one micro-batch of an upsert sink (K5): its last row per key."""
    write_batch(latest_per_key(batch, key, order), batch_id, path)


def upsert_sink(df: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: Sequence[str],
                mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """Last write per key wins (K5). Read the current table with :func:`read_upserted`."""
    key, order = list(key), list(order)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: upsert_batch(batch, batch_id, path, key, order))
    return _start(w, trigger)


def read_upserted(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str], schema=None) -> DataFrame:
    """The state of an upsert table: per key the row of the latest batch, then greatest ``order``, by
    one partial/final aggregate over the changes. Like any table of changes it grows with them;
    write what this returns to a new table to start afresh."""
    return latest_per_key(read_batches(spark, path, schema), list(key), [BATCH_COL, *order]).drop(BATCH_COL)


def fan_out(df: DataFrame, writers: dict[str, Callable[[DataFrame, int], None]], checkpoint: str,
            mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """One source read, many per-batch sinks (K9): each micro-batch is persisted
    once, handed to every writer, then released. Writers must be idempotent
    per ``batch_id`` (a replayed batch is written again)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for write in writers.values():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(run)
    return _start(w, trigger)


def changelog_records(changes: DataFrame, op_col: str = "op", data_cols: Sequence[str] | None = None) -> DataFrame:
    """Change rows -> one JSON text per change (K2): ``{"data":[row],"type":...}``,
    INSERT for ``+I``/``+U`` and DELETE for ``-U``/``-D`` (an update is a DELETE
    of the old row followed by an INSERT of the new one)."""
    cols = list(data_cols) if data_cols else [c for c in changes.columns if c != op_col]
    kind = F.when(F.col(op_col).isin(CHANGE_OPS[0], CHANGE_OPS[2]), F.lit("INSERT")).otherwise(F.lit("DELETE"))
    env = F.struct(F.array(F.struct(*[F.col(c) for c in cols])).alias("data"), kind.alias("type"))
    return changes.select(F.to_json(env).alias("value"))


def write_changelog_json(changes: DataFrame, path: str, op_col: str = "op",
                         data_cols: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Batch write of :func:`changelog_records` as text lines."""
    changelog_records(changes, op_col, data_cols).write.mode(mode).text(path)


class ProgressTotals(StreamingQueryListener):
    """Rows read and rows dropped as late over the whole life of a session's queries.

    Add it with ``spark.streams.addListener`` before the queries start: Spark itself
    keeps the progress of the latest batches only. ``totals[name or id]`` is
    (rows read, rows dropped by the watermark)."""

    def __init__(self):
        self.totals: dict[str, tuple[int, int]] = {}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = p.name or str(p.id)
        rows, late = self.totals.get(at, (0, 0))
        self.totals[at] = (rows + p.numInputRows, late + sum(op.numRowsDroppedByWatermark for op in p.stateOperators))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(query: StreamingQuery, name: str) -> dict:
    """Sums of the numbers that ``df.observe(name, ...)`` gave in a query's recent batches, and the rows dropped as late."""
    out: dict = {"dropped": 0}
    for p in query.recentProgress:
        out["dropped"] += sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
        found = p.get("observedMetrics", {}).get(name)
        for k, v in (found.asDict() if found else {}).items():
            out[k] = out.get(k, 0) + (v or 0)
    return out


def progress_report(query: StreamingQuery) -> dict:
    """Rows in, rows dropped as late by the watermark, and the watermark, of a
    query's latest batch (totals: :class:`ProgressTotals`)."""
    p = query.lastProgress or {}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
    return {"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"), "dropped_by_watermark": dropped,
            "watermark": (p.get("eventTime") or {}).get("watermark")}
