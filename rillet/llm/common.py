"""Shared helpers: tables in the shared folder, whole-text word splitting on Arrow.

Words are ``[^\\x20\\x09-\\x0D]+``. The six separators are ASCII bytes that never
occur inside a multi-byte UTF-8 character, so splitting (and lower-casing A-Z)
works on the bytes, for a whole slice of texts at once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillet.session import scratch_path

#: Rows per Arrow batch handed to Python: long texts must not add up to gigabytes.
BATCH_ROWS = 200
#: Bytes of text handled at once inside a batch (a longer text is a slice of its own).
SLICE_BYTES = 1 << 18
#: A text above this many bytes is hashed, counted and cut into words in blocks of this size.
BLOCK_BYTES = 1 << 20
#: Values sorted at once where repeats among the words or lines of a text are sought.
SORTED_AT_ONCE = 1 << 22


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: lineage ends here, and
    an executor lost later costs no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Columns of ``documents``; an operator's own names never equal these.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shielded(step):
    """A step over documents whose caller's other columns can't clash with names inside it: they are
    renamed for the step and get their names back in its result."""
    @functools.wraps(step)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        named = {*DOCUMENT_COLUMNS, *(x for x in (*args, *options.values()) if isinstance(x, str))}
        away = {c: f"given{i}__" for i, c in enumerate(docs.columns) if c not in named}
        out = step(docs.withColumnsRenamed(away), *args, **options)
        return out.withColumnsRenamed({v: k for k, v in away.items()})
    return run


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


# ------------------------------------------------------------------ whole texts in Arrow batches

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(cls, name, np.multiply.accumulate(p))
        return cls.up[:n], cls.down[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte values times powers of the base (one longer than data)."""
    up, _ = _Powers.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each pair, from the prefix sums."""
    _, down = _Powers.get(len(prefix))
    h = (prefix[end] - prefix[start]) * down[start]
    return mix64(h ^ (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if len(bufs) > 2 and bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs


def text_slices(col: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of bounded size."""
    data, offs = text_buffers(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE_BYTES, "right")) - 1)
        part = data[offs[i]:offs[j]]
        yield i, j, LOWER[part] if lower else part, offs[i:j + 1] - offs[i]
        i = j


def _bounds_long(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one text, found block by block."""
    flips, inside = [], False
    for a in range(0, len(data), BLOCK_BYTES):
        now = member[data[a:a + BLOCK_BYTES]]
        flips.append(np.flatnonzero(now != np.append(inside, now[:-1])) + a)
        inside = now[-1]
    flips = np.concatenate([*flips, [len(data)]] if inside else flips)
    return flips[0::2], flips[1::2]


def word_bounds(data: np.ndarray, offs: np.ndarray, member: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (maximal run of bytes in ``member``); ``offs`` are the rows' offsets."""
    if len(offs) == 2 and len(data) > BLOCK_BYTES:
        starts, ends = _bounds_long(data, member)
        return starts, ends, np.zeros(len(starts), np.int64)
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    cut = offs[1:-1]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def _spans_in_blocks(data, start, end):
    """(block's offset, block, i, j, from, to): the parts of spans i..j-1 that lie in each block.

    Spans are in order, not empty, and don't overlap; one may run through many blocks."""
    for a in range(0, len(data), BLOCK_BYTES):
        block = data[a:a + BLOCK_BYTES]
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(start, a + len(block))
        if i < j:
            yield a, block, i, j, np.maximum(start[i:j] - a, 0), np.minimum(end[i:j] - a, len(block))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``span_hash`` of ordered spans that don't overlap, with prefix sums of one block at a time."""
    out = np.zeros(len(start), np.uint64)
    for a, block, i, j, lo, hi in _spans_in_blocks(data, start, end):
        prefix = prefix_hash(block)
        part = (prefix[hi] - prefix[lo]) * _Powers.get(len(prefix))[1][lo]
        if start[i] < a:  # goes on from the block before: its powers do, too
            part[:1] *= np.uint64(pow(int(_BASE), int(a - start[i]), 1 << 64))
        out[i:j] += part
    return mix64(out ^ (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def span_counts(data: np.ndarray, start: np.ndarray, end: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Number of bytes in ``member`` in ordered spans that don't overlap."""
    out = np.zeros(len(start), np.int64)
    for _, block, i, j, lo, hi in _spans_in_blocks(data, start, end):
        total = np.zeros(len(block) + 1, np.int64)
        np.cumsum(member[block], out=total[1:])
        out[i:j] += total[hi] - total[lo]
    return out


def byte_counts(data: np.ndarray, offs: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Number of bytes in ``member`` in each text of a slice."""
    if len(offs) == 2:
        return np.array([sum(np.count_nonzero(member[data[a:a + BLOCK_BYTES]]) for a in range(0, len(data), BLOCK_BYTES))], np.int64)
    return span_sums(member[data], offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(data, starts, ends)


def occurrences(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two masks: the first one of each value, and those whose value occurs twice or more.

    Many values are dealt by their low bits, so that only a part of them is sorted at once."""
    first, twice = np.zeros(len(values), bool), np.zeros(len(values), bool)
    parts = 1 if len(values) <= SORTED_AT_ONCE else 16
    for p in range(parts):
        at = np.flatnonzero(values & np.uint64(15) == p) if parts > 1 else np.arange(len(values))
        if not len(at):
            continue
        at = at[np.argsort(values[at], kind="stable")]
        now = values[at]
        same = now[1:] == now[:-1]
        first[at[np.append(True, ~same)]] = True
        twice[at[1:][same]] = True
        twice[at[:-1][same]] = True
    return first, twice


def per_row(row: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts (or sums of weights) by row number, as int64."""
    return np.bincount(row, weights, minlength=n).astype(np.int64)


def span_sums(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of true values between neighbouring offsets."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def add_columns(df: DataFrame, columns: dict[str, str], fn, text_col: str = "text") -> DataFrame:
    """``df`` with columns {name: Spark type} that ``fn(data, offsets)`` computes.

    ``fn`` gets the bytes and offsets of a slice of texts and returns one array
    for each column; it runs once per slice of an Arrow batch."""
    small_batches(df.sparkSession)
    names = df.columns
    at = names.index(text_col)
    schema = df.limit(0).select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items())).schema

    def run(batches):
        for b in batches:
            parts = [[] for _ in columns]
            for _, _, data, offs in text_slices(b.column(at)):
                for p, x in zip(parts, fn(data, offs), strict=True):
                    p.append(x)
            new = [pa.array(np.concatenate(p) if p else np.zeros(0, np.int64)) for p in parts]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*names, *columns])

    return df.mapInArrow(run, schema)


def count_words(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    _, _, row = word_bounds(data, offs)
    return [per_row(row, len(offs) - 1)]


def numbered_chunks(df: DataFrame, group: list[str], chunk: str, weight: Column | str, out: str) -> DataFrame:
    """``df`` with the running total of ``weight`` before each row's chunk.

    Two levels, so that no task holds a whole group: totals of (group, chunk)
    first, then a window over those totals only."""
    w = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, chunk).agg(F.sum(weight).alias("_sum"))
    before = sums.select(*group, chunk, F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias(out))
    return df.join(before, [*group, chunk])
