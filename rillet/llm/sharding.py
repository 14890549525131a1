"""Sharding by histogram sort (DataFrame functions only).

Rows are ordered by a 62-bit key: the upper bits hash the text (so equal texts
are neighbours), the lower ones the identifier (so that a text shared by a
third of all rows can still be cut). Splitters of that order are found without
sorting: each round counts the exact bytes and rows below equally spaced probes
inside the key intervals that still hold an open splitter, and narrows each
interval to the two probes around its target. When every splitter meets
its tolerance the rows are exchanged once, each to its range.

Only the splitters between shards are refined, so what a round brings to the driver depends
on the number of shards, never on the rows. A shard's rows are numbered in *pieces* of about
``ROWS_PER_PIECE`` rows, dealt by the identifier's hash (so a text that a third of all rows share
spreads over all of them); where a piece begins is a running sum over the pieces' counts, inside the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import written

KEY_BITS = 62
TEXT_BITS = 38
PROBE_BITS = 10
#: Rows of a shard that are numbered in one task, about; each shard has at least PIECES of them.
ROWS_PER_PIECE = 1_000_000
PIECES = 4


def order_key(id_col: Column, text: Column) -> Column:
    """Non-negative 62-bit key: text hash above, identifier hash below."""
    low = KEY_BITS - TEXT_BITS
    upper = F.shiftrightunsigned(F.xxhash64(text, F.lit(7)), 64 - TEXT_BITS)
    lower = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(11)), 64 - low)
    return F.shiftleft(upper, low).bitwiseOR(lower)


@dataclass
class Open:
    """A splitter being refined: it lies at a key in [lo, lo + 2^bits)."""

    target: float
    slack: float
    lo: int = 0
    bits: int = KEY_BITS
    below: int = 0
    cut: int | None = None


def _refine(keys: DataFrame, todo: list[Open]) -> None:
    """One round: exact bytes below the probes of each distinct open interval."""
    for bits in sorted({o.bits for o in todo}):
        same = [o for o in todo if o.bits == bits]
        step = max(0, bits - PROBE_BITS)
        heads = sorted({o.lo >> bits for o in same})
        within = keys if bits == KEY_BITS else keys.where(F.shiftright("_key", bits).isin(heads))
        # at most (open splitters) x 2^PROBE_BITS rows come back
        hist = sorted((r[0], r[1]) for r in within.groupBy(F.shiftright("_key", step)).agg(F.sum("_size")).collect())
        for o in same:
            total, lo, hi = o.below, o.lo >> step, (o.lo + (1 << bits)) >> step
            for probe, size in hist:
                if lo <= probe < hi:
                    if total + size >= o.target:
                        break
                    total += size
            else:
                o.cut = o.lo + (1 << bits)
                continue
            # the target lies inside this probe's interval: before or after it, if either is near enough
            near_lo, near_hi = o.target - total, total + size - o.target
            if min(near_lo, near_hi) <= o.slack or step == 0:
                o.cut = (probe if near_lo <= near_hi else probe + 1) << step
            else:
                o.lo, o.bits, o.below = probe << step, step, total


def splitters(keys: DataFrame, total: int, shards: int, tolerance: float) -> list[int]:
    """Keys that begin the shards after the first: refined until the bytes below them are within
    ``tolerance`` of a shard's share, or no key lies nearer."""
    points = [Open(total * k / shards, total / shards * tolerance) for k in range(1, shards)]
    while todo := [o for o in points if o.cut is None]:
        _refine(keys, todo)
    return [o.cut for o in points]


def _range_of(key: Column, starts: list[int], lo: int, hi: int) -> Column:
    """Number of the shard that holds the key: a balanced tree of comparisons."""
    if hi - lo == 1:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key < starts[mid], _range_of(key, starts, lo, mid)).otherwise(_range_of(key, starts, mid, hi))


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          tolerance: float = 0.0005, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, all by default) with ``_size``, ``_shard`` and ``_slot``.

    Size: UTF-8 bytes of the text (null: none) plus 8. Shards have nearly
    equal sizes; ``_slot`` numbers a shard's rows from 0, piece by piece and in key order there. Repeated
    rows share a key and so a shard. Of fewer rows than shards some shards are
    empty; an empty table gives an empty result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    measured = docs.select(*(keep or docs.columns), (F.octet_length(text) + 8).cast("long").alias("_size"),
                           order_key(F.col(id_col), text).alias("_key"))
    keys = written(measured.select("_key", "_size"), "shard-keys")
    total, rows = keys.agg(F.sum("_size"), F.count(F.lit(1))).first()
    starts = [0, *(splitters(keys, total or 0, shards, tolerance) if rows else [])]
    pieces = max(PIECES, -(-rows // (ROWS_PER_PIECE * shards)))
    piece = F.pmod(F.col("_key").bitwiseAND((1 << (KEY_BITS - TEXT_BITS)) - 1), F.lit(pieces)).cast("int")
    dealt = lambda df: df.withColumns({"_shard": _range_of(F.col("_key"), starts, 0, len(starts)).cast("int"), "_piece": piece})
    counts = dealt(keys).groupBy("_shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_begin"))
    w = Window.partitionBy("_shard", "_piece").orderBy("_key", id_col)
    return (dealt(measured).withColumn("_place", F.row_number().over(w) - 1).join(begins, ["_shard", "_piece"])
            .withColumn("_slot", F.col("_begin") + F.col("_place")).drop("_piece", "_place", "_begin", "_key"))


def shard_table(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32 (0 for a null text), law, shard, slot, grown_shard (null)."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    slim = docs.select("doc_id", "text", crc.alias("_crc"))
    return shard(slim, shards, keep=["doc_id", "_crc"]).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
