"""Removal of repeated byte strings by sorting sampled suffixes.

Every byte covered by a string of LENGTH bytes that also starts elsewhere (in
another document or the same one) is removed. Sorting the suffixes of all positions
would move each byte hundreds of times, so only anchors are sorted: positions whose
K-byte string has the least hash among W = LENGTH - K + 1 neighbours. The choice depends
on nothing but the LENGTH bytes it is made from, so two equal strings have
their anchors at the same place, and each string belongs to one anchor.

Suffixes are range-partitioned by their leading bytes (Spark samples the splitters;
ties are split further by the rest of the key, so a passage that a third of all
documents share spreads over many buckets). A bucket is ordered by multikey
quicksort and every suffix compared with its neighbours; the first and last of each bucket
are compared across the boundary. This is done at three levels:

1. anchors: the core is the K-byte string, the span all strings of the anchor;
2. cells of CELL neighbouring strings, for anchors whose core repeats but whose span doesn't;
3. single strings, for cells whose core repeats but whose span doesn't.

A repeated span gives the removed interval at once. A suffix whose core is unique holds
no repeat. Only what lies between goes on, with one or two members of each repeated span of the same core to be
compared with. Equality is that of two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import prefix_hash, small_batches, span_hash, text_buffers, written

LENGTH = 400
CELL = 16
#: Suffixes of a bucket (about 40 bytes each), and positions of a text handled at once.
BUCKET_ROWS = 250_000
CHUNK = 1 << 18
_LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(core hash, position, first, last) of the anchors of a text: the strings that start
    at first..last (both included) have this anchor."""
    k = length // 4
    w = length - k + 1
    strings = len(data) - length + 1
    parts = []
    for a in range(0, max(strings, 0), CHUNK):
        n = min(CHUNK, strings - a)
        part = data[a:a + n + length - 1]
        at = np.arange(len(part) - k + 1)
        h = span_hash(prefix_hash(part), at, at + k)
        # 40 bits of hash above the position: the least is the leftmost of equals
        key = (h & ~_LOW) | at.astype(np.uint64)
        padded = np.full(-(-len(key) // w) * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(key)] = key
        rows = padded.reshape(-1, w)
        left = np.minimum.accumulate(rows, axis=1).reshape(-1)
        right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        pos = (np.minimum(right[:n], left[w - 1:w - 1 + n]) & _LOW).astype(np.int64)
        lo = np.flatnonzero(np.append(True, pos[1:] != pos[:-1]))
        parts.append((h[pos[lo]], pos[lo] + a, lo + a, np.append(lo[1:] - 1, n - 1) + a))
    if not parts:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    h, pos, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
    new = np.append(True, pos[1:] != pos[:-1])  # an anchor on both sides of a chunk's end is one
    last = np.append(np.flatnonzero(new)[1:] - 1, len(pos) - 1)
    return h[new], pos[new], lo[new], hi[last]


def _leading(raw: bytes, at: int) -> int:
    """The first eight bytes of a suffix, in an order that signed integers keep."""
    return int.from_bytes(raw[at:at + 8].ljust(8, b"\0"), "big") - (1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several columns: multikey quicksort with a column as character,
    in which every step only reorders the rows that are still equal."""
    order = np.argsort(columns[0], kind="stable")
    if not len(order):
        return order
    group = np.cumsum(np.append(0, columns[0][order][1:] != columns[0][order][:-1]))
    for c in columns[1:]:
        tied = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((c[rows], group[tied]))]
        value = c[order]
        group = np.cumsum(np.append(0, (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
    return order


_ROW = "_p long, _g long, _s long, _key long, _at long"
_COLS = ["_p", "_g", "_s", "_key", "_at"]


def _bucket(batches):
    """One bucket: sort, compare neighbours; the outermost rows keep what they don't know open."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    cols = [table.column(c).to_numpy() for c in _COLS]
    order = multikey_order(cols)
    p, g, s, key, at = (c[order] for c in cols)
    n = len(g)
    same_g = np.append(False, (g[1:] == g[:-1]) & (p[1:] == p[:-1]))
    same_s = same_g & np.append(False, s[1:] == s[:-1])
    # 1, 2: core, span equal to those of the row before; 4, 8: of the row after; 16, 32: first, last of the bucket
    flags = same_g + 2 * same_s + 4 * np.append(same_g[1:], False) + 8 * np.append(same_s[1:], False)
    flags[0] += 16
    flags[-1] += 32
    keep = flags > 0
    part = np.full(int(keep.sum()), TaskContext.get().partitionId(), np.int64)
    yield pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in (p, g, s, key, at)), pa.array(flags[keep].astype(np.int32)), pa.array(part)],
                                     names=[*_COLS, "_flags", "_part"])


def compared(rows: DataFrame, expected: int, name: str) -> DataFrame:
    """(_g, _key, _at, _full, _open) of the suffixes whose core occurs twice or more.

    ``rows``: leading bytes, core and span hash, document key and place of
    suffixes. ``_full``: the span repeats; ``_open``: to be refined (the span is
    unique, or it stands next to another one of the same core)."""
    buckets = max(1, -(-expected // BUCKET_ROWS))
    marked = written(rows.repartitionByRange(buckets, *_COLS).mapInArrow(_bucket, _ROW + ", _flags int, _part long"), name)
    flag = lambda bit: F.col("_flags").bitwiseAND(bit) > 0
    # two rows of each bucket; buckets follow the order of the suffixes, so equal ones stand together, and a row has
    # an equal neighbour across its bucket's edge exactly if an equal one stands before (behind) it anywhere
    edge = marked.where(F.col("_flags") >= 16).withColumn("_pos", F.struct("_part", flag(32).cast("int").alias("_last")))
    for name, cols in (("core", ["_p", "_g"]), ("span", ["_p", "_g", "_s"])):
        edge = edge.join(edge.groupBy(*cols).agg(F.min("_pos").alias(f"_first_{name}"), F.max("_pos").alias(f"_last_{name}")), cols)
    bit = lambda cond, value: F.when(cond, value).otherwise(0)
    before, behind = (lambda n: F.col(f"_first_{n}") < F.col("_pos")), (lambda n: F.col(f"_last_{n}") > F.col("_pos"))
    bits = (F.col("_flags").bitwiseAND(15)
            .bitwiseOR(bit(flag(16) & before("core"), 1)).bitwiseOR(bit(flag(16) & before("span"), 2))
            .bitwiseOR(bit(flag(32) & behind("core"), 4)).bitwiseOR(bit(flag(32) & behind("span"), 8)))
    edge = edge.withColumn("_flags", bits).select(marked.columns)
    known = marked.where(F.col("_flags") < 16).unionByName(edge).where("_flags > 0")
    full = flag(2) | flag(8)
    return known.select("_g", "_key", "_at", full.alias("_full"),
                        (~full | (flag(1) & ~flag(2)) | (flag(4) & ~flag(8))).alias("_open"))


def _anchor_rows(length: int):
    def run(batches):
        for b in batches:
            data, offs = text_buffers(b.column(1))
            keys = b.column(0).to_numpy()
            out = [[] for _ in range(5)]
            for i in np.flatnonzero(np.diff(offs) >= length):
                text = data[offs[i]:offs[i + 1]]
                raw = text.tobytes()
                g, pos, lo, hi = anchors(text, length)
                out[0].append(np.array([_leading(raw, x) for x in pos.tolist()], np.int64))
                out[1].append(g.view(np.int64))
                out[2].append(np.array([xxhash.xxh3_64_intdigest(raw[x:y + length]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], np.uint64).view(np.int64))
                out[3].append(np.full(len(g), keys[i], np.int64))
                out[4].append((lo << 20) | ((pos - lo) << 10) | (hi - lo))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out], names=_COLS)
    return run


def _unpack(at: int) -> tuple[int, int, int]:
    """(position, first, last) of an anchor."""
    lo = at >> 20
    return lo + (at >> 10 & 1023), lo, lo + (at & 1023)


def _cell_rows(length: int):
    """Cell c of an anchor at q: the strings that start at q - c * CELL - (0 .. CELL - 1)."""
    def run(batches):
        for b in batches:
            key, copy = (b.column(i).to_pylist() for i in (0, 1))
            out = [[] for _ in range(5)]
            for i, found in enumerate(b.column(3).to_pylist()):
                raw = zstandard.decompress(b.column(2)[i].as_py())
                for x in found:
                    if not x["_open"]:
                        continue
                    q, lo, hi = _unpack(x["_at"])
                    for c in range((q - hi) // CELL, (q - lo) // CELL + 1):
                        top = q - c * CELL
                        first = top - CELL + 1
                        core = xxhash.xxh3_64_intdigest(raw[top:first + length], seed=x["_g"] & 0xFFFFFFFFFFFF | c << 48)
                        if first >= lo and top <= hi:
                            span = xxhash.xxh3_64_intdigest(raw[first:top + length], seed=1)
                        else:  # a part of a cell equals no other cell
                            span = xxhash.xxh3_64_intdigest(f"{key[i]} {copy[i]} {q} {c}", seed=2)
                        for o, v in zip(out, (_leading(raw, top), _signed(core), _signed(span), key[i], q << 5 | c), strict=True):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=_COLS)
    return run


def _string_rows(length: int):
    """Every string of the open cells of a document."""
    def run(batches):
        for b in batches:
            key = b.column(0).to_pylist()
            out = [[] for _ in range(5)]
            for i, (found, cells) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                raw = zstandard.decompress(b.column(1)[i].as_py())
                own = {q: (lo, hi) for q, lo, hi in (_unpack(x["_at"]) for x in found if x["_open"])}
                for at in cells:
                    q, c = at >> 5, at & 31
                    lo, hi = own[q]
                    for p in range(max(lo, q - c * CELL - CELL + 1), min(hi, q - c * CELL) + 1):
                        h = xxhash.xxh3_128_intdigest(raw[p:p + length])
                        for o, v in zip(out, (_leading(raw, p), _signed(h >> 64), _signed(h & 0xFFFFFFFFFFFFFFFF), key[i], p), strict=True):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=_COLS)
    return run


def removal(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]]]:
    """(bytes removed, maximal removed runs) of intervals that may overlap or touch."""
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return sum(b - a for a, b in runs), [tuple(r) for r in runs]


def _rest(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


_ANCHORS = "array<struct<_at: bigint, _g: bigint, _full: boolean, _open: boolean>>"
_DONE = "doc_id {id}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, _rest binary"


def _finish(raw: bytes, spans: list[tuple[int, int]], text: bool):
    n, runs = removal(raw, spans)
    rest = _rest(raw, runs)
    return len(raw), n, len(runs), hashlib.sha256(rest).hexdigest(), rest if text else None


def _settle(length: int, text: bool):
    """Finish the documents with no open anchor; hand the others on."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def run(batches):
        for b in batches:
            rows, still = [], []
            for i, found in enumerate(b.column(3).to_pylist()):
                z = b.column(2)[i].as_py()
                still.append(bool(found) and any(x["_open"] for x in found))
                if still[-1]:
                    rows.append((None, None, None, None, None, z))
                    continue
                at = [_unpack(x["_at"]) for x in found or ()]
                rows.append((*_finish(zstandard.decompress(z), [(lo, hi + length) for _, lo, hi in at], text), None))
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            lists = pa.array([x if s else None for x, s in zip(b.column(3).to_pylist(), still, strict=True)], b.column(3).type)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols, lists],
                                             names=["_key", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_rest", "_z", "_found"])
    return run


def _conclude(length: int, text: bool):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for b in batches:
            rows = []
            for i, (found, more) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                spans = [(lo, hi + length) for _, lo, hi in (_unpack(x["_at"]) for x in found if x["_full"])]
                spans += [(x["_from"], x["_to"]) for x in more or ()]
                rows.append(_finish(zstandard.decompress(b.column(1)[i].as_py()), spans, text))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_rest"])
    return run


def _packed_texts(batches):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        data, offs = text_buffers(b.column(2))
        z = [squeeze(data[a:e].tobytes()) for a, e in zip(offs[:-1], offs[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], names=["_key", "doc_id", "_z"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``_rest`` (what is left; null
    unless ``text``) of every row of ``docs``; a null text counts as empty.

    A document is known by the hash of identifier and text, so equal rows have equal
    results; texts shorter than ``length`` bytes are never touched. Cutting by
    bytes can part a character, which is why ``_rest`` is binary."""
    if not 4 * CELL <= length <= 640:
        raise ValueError("length must be between 64 and 640 bytes: places are packed into 10 and 5 bits")
    small_batches(docs.sparkSession)
    given = docs.select(F.xxhash64(id_col, text_col).alias("_key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    size = given.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    rows = given.select("_key", "_text").mapInArrow(_anchor_rows(length), _ROW)
    first = compared(rows, 3 * size // length, "anchors")
    found = first.groupBy("_key").agg(F.collect_list(F.struct("_at", "_g", "_full", "_open")).alias("_found"))

    kind = given.schema["doc_id"].dataType.simpleString()
    packed = given.mapInArrow(_packed_texts, f"_key long, doc_id {kind}, _z binary")
    schema = f"_key long, {_DONE.format(id=kind)}, _z binary, _found {_ANCHORS}"
    settled = written(packed.join(found, "_key", "left").select("_key", "doc_id", "_z", "_found").mapInArrow(_settle(length, text), schema), "settled")
    done = settled.where("_z is null").drop("_key", "_z", "_found")
    left = settled.where("_z is not null")

    n_open = left.agg(F.sum(F.size(F.filter("_found", lambda x: x["_open"])))).first()[0] or 0
    cells = left.select("_key", F.monotonically_increasing_id().alias("_copy"), "_z", "_found").mapInArrow(_cell_rows(length), _ROW)
    second = compared(cells, n_open * (length // CELL), "cells")
    todo = second.where("_open").groupBy("_key").agg(F.collect_set("_at").alias("_cells"))
    strings = left.select("_key", "_z", "_found").join(todo, "_key").select("_key", "_z", "_found", "_cells").mapInArrow(_string_rows(length), _ROW)
    third = compared(strings, n_open * CELL * 2, "strings")

    top = (F.shiftright("_at", 5) - F.col("_at").bitwiseAND(31) * CELL).alias("_top")
    spans = (second.where("_full").select("_key", top).select("_key", (F.col("_top") - (CELL - 1)).alias("_from"), (F.col("_top") + length).alias("_to"))
             .unionAll(third.where("_full").select("_key", F.col("_at"), F.col("_at") + length)))
    spans = spans.groupBy("_key").agg(F.collect_list(F.struct("_from", "_to")).alias("_spans"))
    ended = (left.join(spans, "_key", "left").select("doc_id", "_z", "_found", "_spans")
             .mapInArrow(_conclude(length, text), _DONE.format(id=kind)))
    return done.unionByName(ended)


def repeat_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs, text=False).drop("_rest")
