"""Streaming forms of the jobs (W1-W16): the same transforms as batch where the
semantics allow, stateful processors where they do not.

Streaming results are written by a query (with its own checkpoint) and read
back as a table; :func:`run_available` runs a query over everything present
(``availableNow``) for tests and backfills.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillet.operators.aggregates import changes, each_place, window_summary, word_count
from rillet.operators.scan import _as_list
from rillet.schemas import EVENTS
from rillet.session import scratch_path
from rillet.sources.tables import path_kind
from rillet.streaming.processors import (
    BucketFlagRuns, BucketRecordRuns, ChangeProcessor, FlagRunProcessor, PairAverageProcessor, RecordRunProcessor,
)
from rillet.streaming.sinks import append_sink, read_upserted, upsert_sink

GLOBAL_KEY = "__all"

#: Buckets that the keys of a stateful stream are dealt to: one call, and one task, per bucket and micro-batch.
BUCKETS = 64

#: Cells of a bucket: the counts of a cell's keys are one entry of the state.
CELLS = 256

#: Files a micro-batch takes unless the caller says otherwise, so a backfill is many bounded batches.
FILES_PER_TRIGGER = 64


def stream_table(spark: SparkSession, folder: str, name: str, schema: T.StructType = EVENTS,
                 max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Table ``name`` of a folder as a stream; files are taken oldest first.

    The table is a directory ``<name>.parquet/`` of part files (as Spark writes it),
    or the file ``<name>.parquet`` and files ``<name>-*.parquet`` in ``folder``. Any
    path Spark can read will do; if nothing is there, an error is raised.
    """
    folder = folder.rstrip("/")
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
    table = f"{folder}/{name}.parquet"
    if path_kind(spark, table) == "dir":
        return r.parquet(table)
    pattern = f"{{{name},{name}-*}}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
        raise FileNotFoundError(f"no table {name!r} in {folder}")
    return r.option("pathGlobFilter", pattern).parquet(folder)


def _keyed(df: DataFrame, key):
    keys = _as_list(key)
    if keys:
        return df, keys, keys
    return df.withColumn(GLOBAL_KEY, F.lit(0)), [GLOBAL_KEY], []


def _schema_of(df: DataFrame, cols: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType) for c in cols]


def _bucketed(df: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int = BUCKETS):
    """``df``'s keys and ``cols``, grouped by a hash of the keys, with the keys' DDL and the integers among them."""
    own = T.StructType(_schema_of(df, keys))
    rows = df.select(*dict.fromkeys([*keys, *cols]), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket"))
    return rows.groupBy("__bucket"), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own), [f.name for f in own if isinstance(f.dataType, T.IntegralType)]


def _drop_global(out: DataFrame, keys_out: list[str]) -> DataFrame:
    return out if keys_out else out.drop(GLOBAL_KEY)


def stream_pair_average(df: DataFrame, key, order: Sequence[str], value: str, time_col: str,
                        size: int = 2) -> DataFrame:
    """T1 on a stream (append): keyed value state in Spark's state store. The rows of one key in
    one micro-batch meet in one task, also those of ``key=None``; the source's rate limit
    (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds them."""
    df, keys, keys_out = _keyed(df, key)
    schema = T.StructType(_schema_of(df, keys) + [T.StructField("create_time", df.schema[time_col].dataType),
                                                  T.StructField("average", T.IntegerType())])
    proc = PairAverageProcessor(keys, order, value, time_col, size)
    out = df.groupBy(*keys).transformWithStateInPandas(proc, schema, "Append", "None")
    return _drop_global(out, keys_out)


def stream_record_runs(df: DataFrame, key, order: Sequence[str], value: str, time_col: str) -> DataFrame:
    """T2 on a stream (append): the open run and the longest run of each value in state. Keys are
    dealt to buckets by hash, and a bucket's keys are handled in one call; ``key=None`` is one sequence, one task."""
    df, keys, keys_out = _keyed(df, key)
    vtype = df.schema[value].dataType
    schema = T.StructType(_schema_of(df, keys) + [T.StructField("create_time", df.schema[time_col].dataType),
                                                  T.StructField("value", vtype),
                                                  T.StructField("run_length", T.IntegerType())])
    if keys_out:
        rows, ddl, whole = _bucketed(df.where(F.col(value).isNotNull()), keys, [*order, value, time_col])
        proc = BucketRecordRuns(keys, ddl, order, value, time_col, vtype.simpleString(), whole)
        return rows.transformWithStateInPandas(proc, schema, "Append", "None")
    proc = RecordRunProcessor(keys, order, value, time_col, vtype.simpleString())
    out = df.groupBy(*keys).transformWithStateInPandas(proc, schema, "Append", "None")
    return _drop_global(out, keys_out)


def stream_flag_runs(df: DataFrame, key, order: Sequence[str], flag: str, time_col: str,
                     emit_empty_first: bool = True) -> DataFrame:
    """T3 on a stream (append): the open run in state, keys dealt to buckets as in :func:`stream_record_runs`."""
    df, keys, keys_out = _keyed(df, key)
    schema = T.StructType(_schema_of(df, keys) + [T.StructField("n_samples", T.IntegerType()),
                                                  T.StructField("end_time", df.schema[time_col].dataType)])
    if keys_out:
        rows, ddl, whole = _bucketed(df.where(F.col(flag).isNotNull()), keys, [*order, flag, time_col])
        proc = BucketFlagRuns(keys, ddl, order, flag, time_col, whole, emit_empty_first)
        return rows.transformWithStateInPandas(proc, schema, "Append", "None")
    proc = FlagRunProcessor(keys, order, flag, time_col, emit_empty_first)
    out = df.groupBy(*keys).transformWithStateInPandas(proc, schema, "Append", "None")
    return _drop_global(out, keys_out)


def stream_signal_state(df: DataFrame, key, order: Sequence[str], flag: str, time_col: str) -> DataFrame:
    """T3 and T4 of a signal in one stateful pass: see :class:`~rillet.streaming.processors.BucketFlagRuns`.
    The order columns of the latest flag are named ``o0``, ``o1``, ..."""
    keys = _as_list(key)
    schema = T.StructType(_schema_of(df, keys) + [T.StructField("kind", T.StringType()), T.StructField("n_samples", T.IntegerType()),
                                                  T.StructField("end_time", df.schema[time_col].dataType), T.StructField("flag", T.IntegerType())]
                          + [T.StructField(f"o{i}", df.schema[c].dataType) for i, c in enumerate(order)])
    rows, ddl, whole = _bucketed(df.where(F.col(flag).isNotNull()), keys, [*order, flag, time_col])
    return rows.transformWithStateInPandas(BucketFlagRuns(keys, ddl, order, flag, time_col, whole, latest=True), schema, "Append", "None")


def stream_changes(df: DataFrame, key, order: Sequence[str], buckets: int = BUCKETS, places: bool = False) -> DataFrame:
    """A5 on a stream (append): every change of each key's running count, in ``order`` inside a micro-batch.
    Columns: key..., op, count, order..., change_seq, as :func:`rillet.operators.changelog` has them.
    Rows without the first order column are left out.

    Keys are dealt to ``buckets`` by hash, and a bucket's rows of a micro-batch meet in one task, which numbers
    them; the records are made of the numbered rows. ``places``: a row holds several rows of its key, the
    order columns as lists without NULLs; what is numbered is then dealt to all tasks again, so that a frequent key's records are made by many."""
    keys, order = _as_list(key), list(order)
    own = T.StructType(_schema_of(df, keys))
    schema = T.StructType([*own.fields, T.StructField("n", T.LongType()), *_schema_of(df, order)])
    h = F.xxhash64(*keys)
    rows = df.where(F.col(order[0]).isNotNull()).select(
        *keys, *order, F.pmod(h, F.lit(buckets)).cast("int").alias("__bucket"), F.pmod(F.shiftright(h, 24), F.lit(CELLS)).cast("int").alias("__cell"))
    ddl = ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in own)
    whole = [f.name for f in own if isinstance(f.dataType, T.IntegralType)]
    found = rows.groupBy("__bucket").transformWithStateInPandas(ChangeProcessor(keys, ddl, order, whole, places), schema, "Append", "None")
    if not places:
        return changes(found.withColumnRenamed("n", "__cur"), keys, order, F.col("__cur") == 1, F.col("__cur") - 1, "count")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = each_place(found.repartition(tasks), keys, F.col("n"), order, "__cur")
    return changes(each, keys, order, F.col("__cur") == 1, F.col("__cur") - 1, "count")


def stream_window_summary(df: DataFrame, key: str, ts: str, value: str, flag: str,
                          size: str = "15 seconds", delay: str = "3 seconds") -> DataFrame:
    """W1/W4 + A4: event-time windows closed by a bounded-out-of-orderness
    watermark; append mode emits a window once the watermark passes its end
    and drops rows that arrive behind it."""
    ev = df.withColumn("__ets", F.col(ts).cast("timestamp")).withWatermark("__ets", delay)
    out = window_summary(ev, key, "__ets", value, flag, size)
    return out


def stream_latest(df: DataFrame, key, order: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """T4 on a stream: update mode, latest value per key (max by order)."""
    keys = _as_list(key)
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(F.col(value).alias("v"), o.alias("o")), o).alias("__l")) \
        .select(*keys, F.col("__l.v").alias(out or value), *[F.col(f"__l.o.{c}").alias(c) for c in order])


def stream_word_count(lines: DataFrame) -> DataFrame:
    """J1 on a stream: running counts per word (update mode). Only partial counts are
    shuffled; how many tasks tokenise a micro-batch follows from the source's splits."""
    return word_count(lines)


def run_available(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; raise its error if it failed.
    Only a caller's own ``timeout_s`` stops it earlier."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def append_to_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None,
                    checkpoint: str | None = None) -> DataFrame:
    """Run an append-mode stream over all available input into a parquet table
    and return the table as a batch DataFrame."""
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    run_available(append_sink(df, path, checkpoint, trigger={"availableNow": True}))
    return spark.read.parquet(path)


def upsert_to_table(spark: SparkSession, df: DataFrame, name: str, key: Sequence[str], order: Sequence[str],
                    path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run an update-mode stream over all available input into an upsert table
    and return its current state."""
    path = path or scratch_path(spark, name)
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    run_available(upsert_sink(df, path, checkpoint, key, order, trigger={"availableNow": True}))
    return read_upserted(spark, path, key, order)


def run_with_restarts(start: Callable[[], list[StreamingQuery]], restarts: int, delay_s: float) -> int:
    """Run a job's queries; when one fails, stop the others and start them all
    again from their checkpoints (W14: fixed delay, at most ``restarts`` times). Returns 0, or 1 when the last attempt failed."""
    for attempt in range(restarts + 1):
        queries = start()
        failed = None
        # Poll every query, so a failure of any one is seen while the others run.
        while failed is None and any(q.isActive for q in queries):
            for q in queries:
                try:
                    q.awaitTermination(0.5)
                except Exception as e:  # the query failed
                    failed = e
                if failed is None and q.exception() is not None:
                    failed = q.exception()
                if failed is not None:
                    break
        if failed is None:
            return 0
        for q in queries:
            if q.isActive:
                q.stop()
        print(f"attempt {attempt + 1} failed: {failed}", file=sys.stderr)
        if attempt < restarts:
            time.sleep(delay_s)
    return 1
