"""Keyed aggregates, running folds, change streams and event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.functions.text import split_blanks
from rillet.functions.time import to_ntz
from rillet.operators.scan import C, Cuts, DEFAULT_ROWS_PER_CHUNK, K, _as_list, chunking

# Exact money: sums of two-decimal amounts are taken as decimals, so the
# result does not depend on the order rows are added in.
MONEY = "decimal(18,2)"


def exact_sum(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(MONEY)).cast("double")


def keyed_sum(df: DataFrame, key, value: str, out: str = "total") -> DataFrame:
    """Sum per key (A1); partial sums on the map side, one shuffle of one row
    per key and task."""
    return df.groupBy(*_as_list(key)).agg(exact_sum(value).alias(out))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when it is read in far fewer pieces than there are cores.

    A parquet row group is one task, so a table of one row group would be tokenised by one core. Such a table is dealt
    out by a shuffle; it is at most half as many splits as cores, so a few splits a core at most. A
    table with more splits, a stream, and what comes out of a shuffle stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def word_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """Tokens of every line counted (J1: tokenise, group, count).

    ``explode`` stays in the JVM; the count is pre-aggregated per task, so a
    very frequent word costs one row per task in the shuffle.
    """
    words = spread(lines.select(line)).select(F.explode(split_blanks(line)).alias("word"))
    # A plain filter after explode stays in generated code (a lambda filter
    # would not).
    words = words.where(F.col("word") != F.lit(""))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def _both(f):
    """Combine two folds of which either may be NULL (nothing folded yet)."""
    return lambda before, here: F.coalesce(f(before, here), before, here)


#: name: (fold of rows, fold of folds, combination of the fold before a chunk with the one inside it)
FOLDS = {
    "sum": (F.sum, F.sum, _both(lambda a, b: a + b)),
    "count": (F.count, F.sum, _both(lambda a, b: a + b)),
    "max": (F.max, F.max, F.greatest),
    "min": (F.min, F.min, F.least),
}


def running_folds(df: DataFrame, key, order: Sequence[str], folds: dict[str, tuple],
                  rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, cuts: Cuts | None = None) -> DataFrame:
    """Several running folds in one pass: ``folds = {out: (fold, value)}``.

    Each is the fold of a row with all earlier rows of its key. ``fold`` is a name of
    FOLDS or a triple like its values, so any fold that merges can be run: two
    aggregate functions and how to combine two of their results. A running
    window inside each chunk plus the fold of all earlier chunks (a prefix over
    per-chunk totals, a few rows per key), so a hot key is never one task. The
    type is that of the plain aggregate, however the rows are chunked.
    """
    order = list(order)
    chunked, cut = chunking(df, key, order, rows_per_chunk, cuts)
    w = Window.partitionBy(K, C).orderBy(*[F.col(o) for o in order]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ws = Window.partitionBy(K).orderBy(C).rowsBetween(Window.unboundedPreceding, -1)
    locs, tots, pres, ends = {}, [], [], []
    for i, (fold, value) in enumerate(folds.values()):
        inner, outer, combine = FOLDS[fold] if isinstance(fold, str) else fold
        val = F.lit(1) if value is None else F.col(value)
        locs[f"__loc{i}"] = inner(val).over(w)
        tots.append(inner(val).alias(f"__tot{i}"))
        pres.append(outer(f"__tot{i}").over(ws).alias(f"__pre{i}"))
        ends.append(combine)
    rows = chunked.withColumns(locs)
    kinds = [rows.schema[f"__loc{i}"].dataType for i in range(len(folds))]
    if cut:
        # Chunk totals need no order: a partial/final hash aggregate straight off
        # the input shuffles one row per chunk and task, not the rows. Only
        # chunks after a key's first carry a prefix.
        has_prev = F.lag(C).over(Window.partitionBy(K).orderBy(C)).isNotNull()
        tot = chunked.groupBy(K, C).agg(*tots).select(K, C, *pres, has_prev.alias("__has"))
        rows = rows.join(tot.where(F.col("__has")).drop("__has"), [K, C], "left")
        ends = [combine(F.col(f"__pre{i}").cast(kind), F.col(f"__loc{i}")).cast(kind) for i, (combine, kind) in enumerate(zip(ends, kinds, strict=True))]
    else:
        ends = [F.col(f"__loc{i}") for i in range(len(folds))]
    rows = rows.withColumns(dict(zip(folds, ends, strict=True)))
    return rows.drop(K, C, *(f"__{p}{i}" for i in range(len(folds)) for p in ("loc", "pre")))


def running_aggregate(df: DataFrame, key, order: Sequence[str], value: str | None, fn="sum",
                      out: str = "running", rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """The running fold of ``value`` per key in ``order`` (A3, the reference's
    ``key_by(...).reduce(...)`` emitting every intermediate value)."""
    return running_folds(df, key, order, {out: (fn, value)}, rows_per_chunk)


def running_count_of_places(df: DataFrame, key: str, chunk: str, places: Sequence[str], out: str) -> DataFrame:
    """The running count of a key, from rows that hold all places of a key in a chunk, in order: lists of one length, one
    per order column. Chunks follow each other in the order. Columns: key, out, places... of each place.

    One row per key and chunk is shuffled, not one per place; the counts of a key's earlier chunks
    are a prefix over light rows and joined back, so a key in all chunks is spread over tasks."""
    # The branches of the rows and of their counts share this shuffle: both read every list, and the filter is the
    # one that Spark would add for exploding them.
    rows = df.select(key, chunk, *places).where((F.size(places[0]) > 0) & F.col(places[0]).isNotNull()).repartition(key, chunk)
    n = F.greatest(F.lit(0), *(F.size(p) for p in places)).cast("long")
    earlier = F.sum("__n").over(Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1))
    tot = rows.select(key, chunk, n.alias("__n")).select(key, chunk, earlier.alias("__pre")).where(F.col("__pre").isNotNull())
    rows = rows.join(tot, [key, chunk], "left")
    return each_place(rows, [key], F.coalesce("__pre", F.lit(0)), places, out)


def each_place(rows: DataFrame, keys: list[str], before: Column, places: Sequence[str], out: str) -> DataFrame:
    """A row for each entry of the lists ``places``, with its number after ``before`` in ``out``."""
    first, *rest = places
    each = rows.select(*keys, before.alias("__before"), F.posexplode(first).alias("__i", first), *(F.col(p).alias(f"__all_{p}") for p in rest))
    return each.select(*keys, (F.col("__before") + F.col("__i") + 1).alias(out), first, *(F.get(f"__all_{p}", "__i").alias(p) for p in rest))


def changelog(df: DataFrame, key, order: Sequence[str], value: str | None, fn: str = "count", out: str = "value",
              rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK, cuts: Cuts | None = None, chunk: str | None = None) -> DataFrame:
    """The change stream of a keyed running ``sum``/``count`` (A5).

    The first row of a key inserts its value (``+I``); every later row
    retracts the previous value (``-U``) and adds the new one (``+U``).
    Columns: ``key..., op, out, order..., change_seq`` (0 for a retraction,
    1 for a new value) so consumers replay changes in order. The previous
    value is the current one minus the row's own contribution, so no
    look-back across chunks is needed; a sum is NULL until a value came.

    ``chunk``: a row of ``df`` holds all rows of a key in the chunk that this column names, the order columns as
    lists (:func:`running_count_of_places`); for a count of rows by one non-NULL key.
    """
    if fn not in ("sum", "count"):
        raise ValueError("changelog supports sum and count")
    keys = _as_list(key)
    order = list(order)
    if chunk is not None:
        if value is not None or fn != "count" or len(keys) != 1:
            raise ValueError("rows of places can only be counted, by one key")
        runs = running_count_of_places(df, keys[0], chunk, order, "__cur")
        return changes(runs, keys, order, F.col("__cur") == 1, F.col("__cur") - 1, out)
    folds = {"__cur": (fn, value), "__pos": ("count", None)}
    summed = fn == "sum" and value is not None
    if summed:
        folds["__seen"] = ("count", value)
    runs = running_folds(df, key, order, folds, rows_per_chunk, cuts)
    if summed:
        had = F.col("__seen") - F.col(value).isNotNull().cast("long")
        prev = F.when(had > 0, F.col("__cur") - F.coalesce(F.col(value), F.lit(0)))
    else:
        prev = F.col("__cur") - (F.lit(1) if value is None or fn == "sum" else F.col(value).isNotNull().cast("long"))
    return changes(runs, keys, order, F.col("__pos") == 1, prev.cast(runs.schema["__cur"].dataType), out)


def changes(runs: DataFrame, keys: list[str], order: list[str], first: Column, prev: Column, out: str) -> DataFrame:
    """The records of each row of ``runs``: it inserts ``__cur``, or retracts ``prev`` and adds ``__cur``."""
    entry = lambda op, v, seq: F.struct(F.lit(op).alias("op"), v.alias("v"), F.lit(seq).alias("change_seq"))
    entries = F.when(first, F.array(entry("+I", F.col("__cur"), 1))) \
        .otherwise(F.array(entry("-U", prev, 0), entry("+U", F.col("__cur"), 1)))
    ex = runs.select(*keys, *order, F.explode(entries).alias("__e"))
    return ex.select(*keys, F.col("__e.op").alias("op"), F.col("__e.v").alias(out), *order,
                     F.col("__e.change_seq").alias("change_seq"))


def window_summary(df: DataFrame, key: str, ts: str, value: str, flag: str,
                   size: str = "15 seconds", shared: Sequence[str] = ()) -> DataFrame:
    """Per key and tumbling event-time window: mean/max/min of the value (as
    FLOAT, the sink's type), row count and number of flags (A4/W4).

    Batch or streaming input; a streaming caller sets the watermark first.
    ``shared``: all columns of a batch input whose shuffle other outputs use too; the summary then reads
    them all and drops rows without a time only after aggregating, so its plan below the shuffle is the same.
    """
    v = F.col(value).cast("float")
    ts_col = F.coalesce(F.col(ts), F.lit("1900-01-01").cast(df.schema[ts].dataType)) if shared else F.col(ts)
    win = F.window(ts_col, size)
    agg = (df.groupBy(F.col(key), win.alias("w"))
             .agg(F.avg(v).cast("float").alias("mean"),
                  F.max(v).alias("max"),
                  F.min(v).alias("min"),
                  F.count(F.col(key)).alias("n_elements"),
                  F.sum(F.col(flag).cast("long")).alias("n_flags"), *(F.count(c).alias(f"__{c}") for c in shared)))
    if shared:
        agg = agg.where((F.col(f"__{ts}") > 0) & (F.least(*(F.col(f"__{c}") for c in shared)) >= 0))
    return agg.select(key, "mean", "max", "min", "n_elements", "n_flags",
                      to_ntz(F.col("w.start")).alias("window_start"),
                      to_ntz(F.col("w.end")).alias("window_end"))
