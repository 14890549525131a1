"""Segmented prefix scan: ordered per-key analytics without one task per key.

A window ``partitionBy(key).orderBy(seq)`` puts a whole key into one task,
and a constant key (the reference's ``key_by(lambda row: 1)``) puts the whole
input there. Here the rows are range-partitioned: a key with many rows is cut into *chunks* of
about ``rows_per_chunk`` consecutive rows, a smaller key is one chunk.

0. One pass over key and order columns takes the same sample that a range partitioner
   takes: one row in ``rows_per_chunk / SAMPLES``, chosen by hash. Inside Spark, every
   ``SAMPLES``-th sampled row of a key becomes a cut; only those come to the
   driver, at most about one per ``rows_per_chunk`` rows. The cuts are a literal of the plan, so
   every branch and every recomputed task agrees on them. Chunks so small that there would be more than
   ``MAX_CUTS`` cuts are made in two steps: the cuts part the rows into ``MAX_CUTS`` ranges, and a
   window numbers the rows of a (key, range), which is parted every ``rows_per_chunk`` rows.
   The number of chunks has no limit, what the driver holds has.
1. Rows are shuffled once, by (key, chunk), and numbered inside their chunk
   by window functions (run ids, position in run).
2. Each chunk is summarised in one row: its first and last segment (count, first and last
   value, length of its trailing run, whether the whole chunk is a single run).
3. Window functions over the summaries (a few rows per key) give each chunk
   its offset (rows in earlier chunks of the key) and its carry-in (the run
   still open at the end of the previous chunk, with its global length).
4. The summaries of chunks that follow another chunk are joined back on
   (key, chunk): a small side, while the big side is already partitioned by
   (key, chunk), so the big side is not shuffled again.

Without a cut (no key is large) steps 2 to 4 fall away: the plan is one scan, one shuffle and
windows. What differs with the data is only where chunks end, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = "__k"
C = "__c"
DEFAULT_ROWS_PER_CHUNK = 1_000_000
#: Sampled rows per chunk: a chunk's size is off by about a fifth.
SAMPLES = 20
#: About how many cuts the driver holds and a plan carries, when chunks are smaller than the default.
MAX_CUTS = 4096
#: About how many rows are sampled to cut a table by size.
SAMPLED_ROWS = 200_000

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
# microseconds, so that cuts keep what the order columns hold
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _key_surrogate(df: DataFrame, keys: list[str], order: str) -> Column:
    """A never-NULL grouping value for ``keys``: NULL keys form their own group.

    Plain equality on it lets the join-back reuse the (key, chunk)
    partitioning; a null-safe join would re-shuffle on rewritten keys.
    """
    if not keys:
        # always 0, but not a literal: Spark would drop the join key
        return F.pmod(F.xxhash64(F.col(order)), F.lit(1))
    parts = []
    for k in keys:
        dt = df.schema[k].dataType
        if isinstance(dt, _NUMERIC):
            dflt = F.lit(0).cast(dt)
        elif isinstance(dt, T.BooleanType):
            dflt = F.lit(False)
        elif isinstance(dt, T.StringType):
            dflt = F.lit("")
        else:
            parts += [F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit(""))]
            continue
        parts += [F.col(k).isNull(), F.coalesce(F.col(k), dflt)]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


class Cuts:
    """Cuts of a table: ascending points, as one literal.

    With ``key`` a point is a key (column ``K``) and its order columns, and every key is cut for
    itself; without, it is the order columns alone, and the table is cut as one sequence."""

    def __init__(self, df: DataFrame, order: Sequence[str], rows_per_chunk: int, key: bool = True):
        self.by = [K] * key + list(order)
        per = max(1, min(SAMPLES, rows_per_chunk))
        rows = self._sample(df.select(*self.by), rows_per_chunk // per)
        nth = F.row_number().over(Window.partitionBy(*[K] * key).orderBy(*order))
        self._take(rows.withColumn("__i", nth).where(F.col("__i") % per == 0))

    @classmethod
    def by_size(cls, df: DataFrame, order: Sequence[str], size: Column, most: int, parts: int) -> Cuts:
        """Cuts of a table as one sequence into ranges of about equal sums of ``size``: about ``parts`` ranges, more where
        these would be over ``most``, and about ``MAX_CUTS`` at the most. Sums are taken over a sample of rows."""
        cuts = cls.__new__(cls)
        cuts.by = list(order)
        sized = df.select(*cuts.by, F.coalesce(size, F.lit(0)).cast("long").alias("__size"))
        n, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("__size"), F.lit(0))).first()
        rate = max(1, n // SAMPLED_ROWS)
        per = max(min(most, total // parts + 1), total // MAX_CUTS + 1)
        upto = F.sum("__size").over(Window.orderBy(*order)) * rate
        rows = cuts._sample(sized, rate).withColumn("__upto", upto)
        cuts._take(rows.where(F.floor(F.col("__upto") / per) > F.floor((F.col("__upto") - F.col("__size") * rate) / per)))
        return cuts

    def _sample(self, rows: DataFrame, rate: int) -> DataFrame:
        return rows.where(F.pmod(F.xxhash64(*self.by), F.lit(rate)) == 0) if rate > 1 else rows

    def _take(self, rows: DataFrame) -> None:
        marks = rows.select(self._point().alias("p"))
        self.kind = T.ArrayType(marks.schema["p"].dataType)
        found = marks.agg(F.array_sort(F.collect_set("p")).alias("p")).select(F.size("p"), F.to_json("p", _JSON)).first()
        self.n, self.text = int(found[0]), found[1]

    def _point(self) -> Column:
        return F.struct(*(F.col(c).alias(f"p{i}") for i, c in enumerate(self.by)))

    def __bool__(self) -> bool:
        return self.n > 0

    def rank(self) -> Column:
        """How many cuts are at or before the row (binary search): a number that never falls along key and order."""
        cuts, here = F.from_json(F.lit(self.text), self.kind, _JSON), self._point()
        bits = F.array(*(F.lit(1 << i) for i in reversed(range(self.n.bit_length()))))

        def step(at, bit):
            return F.when((at + bit <= self.n) & (F.get(cuts, at + bit - 1) <= here), at + bit).otherwise(at)
        return F.aggregate(bits, F.lit(0), step)


def chunking(df: DataFrame, key, order: Sequence[str], rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
             cuts: Cuts | None = None) -> tuple[DataFrame, bool]:
    """``df`` with the (key, chunk) columns ``__k``, ``__c``, and whether any key has a second chunk.

    Chunks follow each other in the order of the rows. A caller that has cuts along
    ``order`` already (the same for all keys, say) passes them; no sample is taken then."""
    order = list(order)
    keyed = df.withColumn(K, _key_surrogate(df, _as_list(key), order[0]))
    per_range = rows_per_chunk
    if cuts is None:
        if rows_per_chunk < DEFAULT_ROWS_PER_CHUNK:
            per_range = max(rows_per_chunk, -(-df.count() // MAX_CUTS))
        cuts = Cuts(keyed, order, per_range)
    keyed = keyed.withColumn(C, cuts.rank().cast("long") if cuts else F.lit(0).cast("long"))
    if per_range == rows_per_chunk:
        return keyed, bool(cuts)
    # equal rows have one rank, so every branch puts them into the same chunk
    inner = F.floor((F.rank().over(in_chunk(order)) - 1) / rows_per_chunk)
    return keyed.withColumn(C, F.shiftleft(C, 32) + inner), True


def last_row(columns: Sequence[str]) -> Column:
    """The chunk's last row (all input columns) as one struct.

    Referencing every column here keeps the summary branch and the row branch
    reading the same columns, so both hang off one (key, chunk) shuffle that
    Spark reuses instead of shuffling the input twice.
    """
    cols = [c for c in columns if not c.startswith("__")]
    return F.max_by(F.struct(*[F.col(c) for c in cols]), "__lrn").alias("__lastrow")


def keep_last_row(summary: DataFrame) -> DataFrame:
    """Keep ``__lastrow`` live through column pruning (every chunk has one)."""
    return summary.where(F.col("__lastrow").isNotNull()).drop("__lastrow")


def in_chunk(order: Sequence[str]):
    """The window over a chunk's rows in their order."""
    return Window.partitionBy(K, C).orderBy(*[F.col(o) for o in order])


def running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def run_columns(rows: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """Columns of the runs inside each chunk: ``__lrn`` row number, ``__lisl`` run number,
    ``__ln`` position in the run; ``__plv``, ``__pln``, ``__plisl`` the same of the row before."""
    w, v = in_chunk(order), F.col(value)
    # withColumns: one analysis per step; steps only where a window reads the output of another
    rows = rows.withColumns({
        "__lrn": F.row_number().over(w),
        "__st": (F.row_number().over(w) == 1) | ~F.lag(v).over(w).eqNullSafe(v),
        "__plv": F.lag(v).over(w)})
    rows = rows.withColumns({
        "__lisl": F.sum(F.col("__st").cast("int")).over(running(w)),
        "__ln": F.col("__lrn") - F.max(F.when(F.col("__st"), F.col("__lrn"))).over(running(w)) + 1})
    return rows.withColumns({"__pln": F.lag("__ln").over(w), "__plisl": F.lag("__lisl").over(w)})


def run_summary(value: str) -> list[Column]:
    """What a chunk's summary says of its runs (aggregates over :func:`run_columns`)."""
    return [F.count(F.lit(1)).alias("__cnt"), F.min_by(value, "__lrn").alias("__first"), F.max_by(value, "__lrn").alias("__last"),
            F.max_by("__ln", "__lrn").alias("__trail"), F.max("__lisl").alias("__nisl")]


def carried(summary: DataFrame) -> DataFrame:
    """``summary`` (:func:`run_summary` per key and chunk) with ``__off`` rows before the chunk and the run open
    at its start: ``__cv`` its value, ``__cl`` its length."""
    ws = Window.partitionBy(K).orderBy(C)
    # A chunk that is one run continuing the previous chunk's last value
    # extends that run; any other chunk starts a new segment. The run open
    # at a chunk's start is the sum of trailing run lengths
    # since the start of the previous chunk's segment.
    cont = (F.lag("__cnt").over(ws).isNotNull() & (F.col("__nisl") == 1) & F.col("__first").eqNullSafe(F.lag("__last").over(ws)))
    s = summary.withColumns({"__off": F.coalesce(F.sum("__cnt").over(before(ws)), F.lit(0)).cast("long"),
                             "__cv": F.lag("__last").over(ws), "__cont": cont, "__tin": F.sum("__trail").over(running(ws))})
    s = s.withColumn("__base", F.max(F.when(~F.col("__cont"), F.col("__tin") - F.col("__trail"))).over(running(ws)))
    return s.withColumn("__cl", F.lag(F.col("__tin") - F.col("__base")).over(ws))


def global_columns(rows: DataFrame, value: str) -> DataFrame:
    """Positions in the whole key from those in the chunk and what the chunk carries in: ``__rn`` row number,
    ``__n`` position in the run, ``__pv`` / ``__pn`` value and run position of the row before (NULL for the first)."""
    if "__cl" not in rows.columns:
        return rows.withColumns({"__rn": F.col("__lrn"), "__n": F.col("__ln"), "__pv": F.col("__plv"), "__pn": F.col("__pln")})

    def carry(run, v):
        ok = (F.col(run) == 1) & F.col("__cl").isNotNull() & F.col("__cv").eqNullSafe(F.col(v))
        return F.when(ok, F.col("__cl")).otherwise(F.lit(0))
    first = F.col("__lrn") == 1
    return rows.withColumns({
        "__rn": F.coalesce(F.col("__off"), F.lit(0)) + F.col("__lrn"),
        "__n": F.col("__ln") + carry("__lisl", value),
        "__pv": F.when(first, F.col("__cv")).otherwise(F.col("__plv")),
        "__pn": F.when(first, F.col("__cl")).otherwise(F.col("__pln") + carry("__plisl", "__plv"))})


def scan(df: DataFrame, key, order: Sequence[str], value: str, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
         keep: Sequence[str] = (), chunked: bool | None = None) -> DataFrame:
    """Rows of ``df`` with the columns of :func:`global_columns`, computed chunk-parallel.

    Keeps ``__k``/``__c``; callers drop every ``__`` column. Only the key, order, value and
    ``keep`` columns pass through (the caller must use them all, so that the summary and the
    rows read the same columns and share one shuffle). ``chunked``: ``df`` has its (key, chunk) columns
    already, and whether there are cuts; it is taken with all its columns."""
    order = list(order)
    if chunked is None:
        df = df.select(*dict.fromkeys([*_as_list(key), *order, value, *keep]))
        rows, cut = chunking(df, key, order, rows_per_chunk)
    else:
        rows, cut = df, chunked
    rows = run_columns(rows, order, value)
    if cut:
        # Run lengths need the ordered rows: group on the window's own
        # partitioning (no exchange; the row shuffle is reused).
        s = carried(keep_last_row(rows.groupBy(K, C).agg(last_row(df.columns), *run_summary(value))))
        # Only chunks after a key's first carry anything: the later chunks of
        # large keys, a small table on the rows' own partitioning.
        rows = rows.join(s.where(F.col("__off") > 0).select(K, C, "__off", "__cv", "__cl"), [K, C], "left")
    return global_columns(rows, value)
