"""Order-sensitive keyed sequence operators (the reference's state machines).

Batch forms over the segmented prefix scan of :mod:`rillet.operators.scan`;
the streaming forms are in :mod:`rillet.streaming.processors`. Order is
given explicitly (``order``, e.g. ``[ts, event_id]``) because event times
tie; ``key=None`` treats the whole input as one sequence without putting it
into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.functions.flags import truncating_mean
from rillet.operators.scan import (
    C, DEFAULT_ROWS_PER_CHUNK, K, _as_list, before, carried, chunking, global_columns, in_chunk, keep_last_row, last_row,
    run_columns, running, scan,
)


def _order_struct(order: Sequence[str]):
    return F.struct(*[F.col(o) for o in order])


def pair_average(df: DataFrame, key, order: Sequence[str], value: str, time_col: str,
                 size: int = 2, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                 time_alias: str = "create_time", out: str = "average") -> DataFrame:
    """Tumbling count window (T1): each run of ``size`` consecutive rows of a key
    gives one row (time of its last row, ``int(sum / size)``); pairs do not
    overlap and an incomplete tail is never emitted.

    A group's row comes from its last row: the sum of the ``size`` rows up to it, by a window
    inside the chunk. Of a group that began in an earlier chunk the chunk carries
    in the sum, from the last ``size - 1`` values of the chunks before it.
    """
    keys, order = _as_list(key), list(order)
    df = df.where(F.col(value).isNotNull())  # a NULL value is not part of the sequence
    df = df.select(*dict.fromkeys([*keys, *order, value, time_col]))
    chunked, cut = chunking(df, key, order, rows_per_chunk)
    w = in_chunk(order)
    v = F.col(value).cast("long")
    rows = chunked.withColumns({"__lrn": F.row_number().over(w), "__sum": F.sum(v).over(w.rowsBetween(1 - size, Window.currentRow)),
                                "__tail": F.lead(F.lit(1), max(size - 1, 1)).over(w).isNull()})
    position, total = F.col("__lrn"), F.col("__sum")
    if cut:
        tail = F.transform(F.array_sort(F.collect_list(F.when(F.col("__tail") & F.lit(size > 1), F.struct(F.col("__lrn"), v.alias("v"))))), lambda x: x["v"])
        s = keep_last_row(rows.groupBy(K, C).agg(F.count(F.lit(1)).alias("__cnt"), last_row(df.columns), tail.alias("__end")))
        ws = Window.partitionBy(K).orderBy(C)
        # every chunk has a row, so the open group's rows lie in the size - 1 chunks before
        s = s.withColumns({"__off": F.coalesce(F.sum("__cnt").over(before(ws)), F.lit(0)).cast("long"),
                           "__ends": F.flatten(F.collect_list("__end").over(ws.rowsBetween(1 - max(size, 2), -1)))})
        n_open = (F.col("__off") % size).cast("int")
        opened = F.aggregate(F.slice("__ends", F.size("__ends") - n_open + 1, n_open), F.lit(0).cast("long"), lambda a, x: a + x)
        s = s.where(F.col("__off") > 0).select(K, C, "__off", F.when(n_open > 0, opened).otherwise(0).alias("__open"))
        rows = rows.join(s, [K, C], "left")
        position = F.coalesce("__off", F.lit(0)) + F.col("__lrn")
        total = total + F.when(F.col("__lrn") < size, F.coalesce("__open", F.lit(0))).otherwise(0)
    return rows.where(position % size == 0).select(*keys, F.col(time_col).alias(time_alias), truncating_mean(total, size).alias(out))


def record_runs(df: DataFrame, key, order: Sequence[str], value: str, time_col: str,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                time_alias: str = "create_time") -> DataFrame:
    """Record-setting runs (T2): a row each time a run of equal values becomes
    longer than every earlier run of that value in the key (one value alone is
    not a run, so lengths start at 2).

    A row at run position ``n`` is a record when ``n >= 2`` and ``n`` exceeds
    every earlier position of its value in the key. Inside its chunk that is
    a running max (a window on the chunk partitioning, no exchange). A chunk's summary
    lists the longest run of each of its values; what it carries in, and the longest run of a value
    in earlier chunks, are prefix windows over such summaries, joined back on the
    rows' own partitioning, so no task ever gathers the rows of a value.
    """
    keys, order = _as_list(key), list(order)
    df = df.where(F.col(value).isNotNull())  # a NULL value is not part of the sequence
    df = df.select(*dict.fromkeys([*keys, *order, value, time_col]))
    chunked, cut = chunking(df, key, order, rows_per_chunk)
    rows = run_columns(chunked, order, value)
    bar = F.lit(1)
    if cut:
        # one row per chunk and value, on the rows' own partitioning; then one per chunk with its values
        per_value = keep_last_row(rows.groupBy(K, C, value).agg(last_row(df.columns), F.max("__ln").alias("__max"), *(
            F.max(x).alias(y) for x, y in ((F.struct("__lrn", "__ln", F.col(value).alias("v")), "__lastrun"), ("__lisl", "__isl"))),
            F.min("__lrn").alias("__from"), F.count(F.lit(1)).alias("__rows"),
            F.max(F.when(F.col("__lisl") == 1, F.col("__ln"))).alias("__lead")))
        end = F.max("__lastrun")
        s = carried(per_value.groupBy(K, C).agg(
            F.sum("__rows").alias("__cnt"), F.min_by(value, "__from").alias("__first"), end["v"].alias("__last"),
            end["__ln"].alias("__trail"), F.max("__isl").alias("__nisl"),
            F.collect_list(F.struct(F.col(value).alias("v"), F.col("__max").alias("n"), F.col("__lead").alias("lead"))).alias("__values")))
        flat = s.select(K, C, "__off", "__cv", "__cl", F.explode("__values").alias("__v"))
        # the chunk's first run goes on from the run that is open at its start
        longer = F.when(F.col("__v.lead").isNotNull() & F.col("__cl").isNotNull() & F.col("__cv").eqNullSafe(F.col("__v.v")),
                        F.col("__v.lead") + F.col("__cl"))
        longest = F.greatest(F.col("__v.n"), longer)
        earlier = before(Window.partitionBy(K, "__w").orderBy(C))
        info = flat.select(K, C, "__off", "__cv", "__cl", F.col("__v.v").alias("__w"), longest.alias("__l")).withColumn("__best", F.max("__l").over(earlier))
        info = info.where(F.col("__off") > 0).select(F.col(K).alias("__ik"), F.col(C).alias("__ic"), "__w", "__off", "__cv", "__cl", "__best")
        rows = rows.join(info, (F.col(K) == F.col("__ik")) & (F.col(C) == F.col("__ic")) & (F.col(value) == F.col("__w")), "left")
        bar = F.coalesce("__best", bar)
    rows = global_columns(rows, value)
    in_value = before(Window.partitionBy(K, C, value).orderBy(*[F.col(o) for o in order]))
    rows = rows.withColumn("__pm", F.max("__n").over(in_value))
    return (rows.where((F.col("__n") >= 2) & (F.col("__n") > F.coalesce("__pm", F.lit(1))) & (F.col("__n") > bar))
            .select(*keys, F.col(time_col).alias(time_alias), F.col(value).alias("value"), F.col("__n").cast("int").alias("run_length")))


def flag_runs(df: DataFrame, key, order: Sequence[str], flag: str, time_col: str,
              emit_empty_first: bool = True, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, chunked: bool | None = None) -> DataFrame:
    """Completed flag runs (T3): when the flag falls to 0 after a run of 1s, emit
    the run's length with the time of the 0 row. A run still open is not
    emitted; 0 after 0 emits nothing. With ``emit_empty_first`` a key whose
    first row has flag 0 emits a run of length 0 (the reference's behaviour).
    ``chunked``: see :func:`rillet.operators.scan.scan`.
    """
    keys = _as_list(key)
    if chunked is not None:
        # a filter above a window stays above the shuffle, so that others can share it
        seen = [F.count(c).over(running(in_chunk(order))).alias(f"__seen{i}") for i, c in enumerate(df.columns) if not c.startswith("__")]
        df = df.select("*", *seen)
        df = df.where(F.least(*(F.col(c) for c in df.columns if c.startswith("__seen"))) >= 0)
    df = df.where(F.col(flag).isin(0, 1))  # other flag values (and NULL) change nothing
    rows = scan(df, key, order, flag, rows_per_chunk, [time_col], chunked)
    first = F.col("__rn") == 1
    after_run = ~first & (F.col("__pv") == 1)
    ends = (F.col(flag) == 0) & (after_run | (first & F.lit(emit_empty_first)))
    length = F.when(first, F.lit(0)).otherwise(F.col("__pn"))
    return rows.where(ends).select(*keys, length.cast("int").alias("n_samples"), F.col(time_col).alias("end_time"))


def keys_with_flag_runs(df: DataFrame, key, order: Sequence[str], flag: str,
                        emit_empty_first: bool = True) -> DataFrame:
    """The keys for which :func:`flag_runs` emits at least one row, from one
    partial/final aggregate (no ordering of the rows): with ``emit_empty_first``
    every key that has a 0 flag; otherwise every key where some 1 precedes
    some 0."""
    keys = _as_list(key)
    flags = df.where(F.col(flag).isin(0, 1))
    if emit_empty_first:
        return flags.where(F.col(flag) == 0).select(*keys).distinct()
    o = _order_struct(order)
    agg = flags.groupBy(*keys).agg(F.min(F.when(F.col(flag) == 1, o)).alias("__first1"),
                                   F.max(F.when(F.col(flag) == 0, o)).alias("__last0"))
    return agg.where(F.col("__first1") < F.col("__last0")).select(*keys)


def latest_by_key(df: DataFrame, key, order: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Last value per key by ``order`` (T4). A partial/final aggregate, so a
    hot key is pre-reduced on every map task."""
    keys = _as_list(key)
    return df.groupBy(*keys).agg(F.max_by(F.col(value), _order_struct(order)).alias(out or value))


__all__ = ["pair_average", "record_runs", "flag_runs", "keys_with_flag_runs", "latest_by_key"]
