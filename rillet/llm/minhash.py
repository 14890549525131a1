"""Near-duplicates by fast similarity sketching, banding and exact verification.

A text's set is its distinct word shingles. The sketch has T coordinates and is
filled in rounds: in round ``i`` every shingle is hashed to one coordinate and
leaves its hash there if the coordinate is empty or holds a larger one of
this round. A large set fills its sketch in one or two rounds, so the cost is per
shingle and not per shingle and coordinate. After T rounds, round ``T + j``
sends all shingles to coordinate ``j``: every coordinate fills, for any set. Two
sketches agree in a coordinate with probability equal to the sets' similarity, with
the concentration of T independent draws.

Equal sets are one class from the start. Classes that agree on all rows of a band
share a bucket. First every class is checked against one smaller class, the one with which it
shares most bands, and the links found are contracted. Buckets that still hold
several components are open; those that share a component form a cluster. In
a cluster, the classes outside its largest component are compared with all others, in
blocks: first by sketch, and where that allows it by intersecting the full shingle sets, which
also confirms every link of the first step.

Bounds: a pair of similarity 0.8 misses all bands with probability
(1 - 0.8^5)^40 = 1.3e-7; a sketch that shows less than ``LEAST_AGREE`` of T
equal coordinates is 6 standard deviations away from 0.8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import mix64, shielded, small_batches, text_slices, word_bounds, word_hashes, written
from rillet.llm.components import components

BANDS, BAND_ROWS = 40, 5
T = BANDS * BAND_ROWS
LEAST_AGREE = 126
#: Classes of a bucket compared in one block, and members verified in one group.
BLOCK = 300
VERIFY = 200
#: Shingles sketched at once.
SKETCHED = 150_000
#: Shingles of a long text hashed at once.
HASHED = 1 << 20


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = 2) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a slice (a text of fewer
    words has its whole sequence as one; a text without words has none)."""
    start, end, row = word_bounds(data, offs)
    h = word_hashes(data, start, end)
    first = np.searchsorted(row, np.arange(len(offs)))
    gram = h.copy()
    for k in range(1, width):
        stop = max(len(gram) - k, 0)  # a slice may hold fewer words than a shingle
        for a in range(0, stop, HASHED):
            own = slice(a, min(a + HASHED, stop))
            gram[own] = mix64(gram[own] * np.uint64(0x9E3779B97F4A7C15) + h[own.start + k:own.stop + k])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(gram[a:b - width + 1]))
        elif b > a:
            x = mix64(h[a:a + 1] + np.uint64(b - a))
            for k in range(a + 1, b):
                x = mix64(x * np.uint64(0xD6E8FEB86659FD93) + h[k:k + 1])
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fast_sketch(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """Fast similarity sketch (one row of t uint64) of each non-empty set; empty sets stay at the maximum."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), t), empty)
    sizes = np.array([len(s) for s in sets], np.int64)
    live = np.flatnonzero(sizes > 0)
    if not len(live):
        return out
    x, owner = np.concatenate([sets[i] for i in live]), np.repeat(live, sizes[live])
    flat, t64 = out.reshape(-1), np.uint64(t)
    for i in range(2 * t):
        for a in range(0, len(x), HASHED):
            own = slice(a, a + HASHED)
            h = mix64(x[own] + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            # the round above the hash: a later round never replaces what an earlier one left
            value = (h >> np.uint64(12)) | np.uint64(i << 52)
            coord = (mix64(h ^ np.uint64(0xA0761D6478BD642F)) % t64).astype(np.int64) if i < t else i - t
            np.minimum.at(flat, owner[own] * t + coord, value)
        open_ = (out[live] == empty).any(axis=1)
        if not open_.all():
            live = live[open_]
            if not len(live):
                break
            still = np.zeros(len(sets), bool)
            still[live] = True
            kept = still[owner]
            x, owner = x[kept], owner[kept]
    return out


def _sketched(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    sketch = fast_sketch(sets)
    band = np.zeros((len(sets), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(BAND_ROWS):
        band = mix64(band * np.uint64(0x9E3779B97F4A7C15) + sketch[:, r::BAND_ROWS])
    n = np.array([len(s) for s in sets], np.int64)
    fp = np.array([[s.sum(dtype=np.uint64), mix64(s).sum(dtype=np.uint64)] for s in sets], np.uint64).reshape(-1, 2)
    small = (mix64(sketch) >> np.uint64(48)).astype("<u2")
    return pa.RecordBatch.from_arrays([
        ids, pa.array(n), pa.array(fp[:, 0].view(np.int64)), pa.array(fp[:, 1].view(np.int64)),
        pa.array([r.tobytes() for r in small], pa.binary()),
        pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32), pa.array(band.reshape(-1).view(np.int64))),
    ], names=["_id", "_n", "_f1", "_f2", "_sketch", "_bands"])


def _sketch_rows(batches, width):
    for b in batches:
        sets, first = [], 0
        for _, j, data, offs in text_slices(b.column(1), lower=True):
            sets += shingle_sets(data, offs, width)
            # many texts per sketching, but a bounded number of shingles
            if j == b.num_rows or sum(map(len, sets)) >= SKETCHED:
                yield _sketched(b.column(0).slice(first, j - first), sets)
                sets, first = [], j


SET = ["_n", "_f1", "_f2"]


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(_id, _set: sorted shingle hashes as bytes) of the classes in ``wanted`` (_id and SET)."""
    joined = docs.join(wanted, "_id").select("_id", "_text", *SET)

    def run(batches):
        for b in batches:
            n, f1 = b.column(2).to_numpy(), b.column(3).to_numpy().view(np.uint64)
            for i, j, data, offs in text_slices(b.column(1), lower=True):
                sets = shingle_sets(data, offs, width)
                # rows that share an identifier but not the text were joined crosswise: only the right ones stay
                own = [k for k, s in enumerate(sets) if len(s) == n[i + k] and s.sum(dtype=np.uint64) == f1[i + k]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(pa.array(own, pa.int64())),
                                                  pa.array([sets[k].tobytes() for k in own], pa.binary())], names=["_id", "_set"])

    return joined.mapInArrow(run, "_id long, _set binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union, as (u, v)."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / VERIFY).alias("_parts"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("_parts")).alias("_part"))
    heads = dealt.select("a", "_part").distinct().join(sets, F.col("a") == F.col("_id")).select("a", "_part", F.lit(-1).cast("long").alias("b"), F.lit(0).alias("_role"), "_set")
    rest = dealt.join(sets, F.col("b") == F.col("_id")).select("a", "_part", "b", F.lit(1).alias("_role"), "_set")

    def run(batches):
        key, heads = None, []
        for batch in batches:
            a, part, b, role = (batch.column(i).to_pylist() for i in range(4))
            us, vs = [], []
            for i in range(batch.num_rows):
                if (a[i], part[i]) != key:
                    key, heads = (a[i], part[i]), []
                s = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint64)
                if not role[i]:
                    heads.append(s.copy())
                    continue
                if any(similar(h, s, percent) for h in heads):
                    us.append(a[i])
                    vs.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return (heads.unionAll(rest).repartition("a", "_part").sortWithinPartitions("a", "_part", "_role")
            .mapInArrow(run, "u long, v long"))


def _last_links(members: DataFrame, percent: int, least: int) -> DataFrame:
    """Links (u, v) between different labels of a cluster of open buckets.

    ``members``: (_cluster, _id, _label, _sketch, _set). Members outside the cluster's
    commonest label ask all others. Both sides are dealt to blocks, so a
    large cluster is many groups; inside a block, an asker's candidates are those whose
    sketch allows the similarity, the likeliest first, and their full sets are
    intersected until it has a link to each label or none is left. Only links come out."""
    main = members.groupBy("_cluster").agg(F.mode("_label", True).alias("_main"), F.count(F.lit(1)).alias("_m"))
    seen = members.join(main, "_cluster").withColumn("_ask", F.col("_label") != F.col("_main"))
    asks = seen.where("_ask").groupBy("_cluster").agg(F.count(F.lit(1)).alias("_q"))
    seen = seen.join(asks, "_cluster")
    blocks, turns = F.ceil(F.col("_m") / BLOCK), F.ceil(F.col("_q") / BLOCK)
    own = lambda n: F.pmod(F.xxhash64("_id"), n)
    base = seen.select("_cluster", own(blocks).alias("_block"), F.explode(F.sequence(F.lit(0).cast("long"), turns - 1)).alias("_turn"),
                       F.lit(0).alias("_role"), "_id", "_label", "_sketch", "_set")
    ask = seen.where("_ask").select("_cluster", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("_block"), own(turns).alias("_turn"),
                                    F.lit(1).alias("_role"), "_id", "_label", "_sketch", "_set")

    def run(batches):
        key, held, table = None, [], None
        for batch in batches:
            us, vs = [], []
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for i, (cluster, block, turn, role, x, label) in enumerate(zip(*cols, strict=True)):
                if (cluster, block, turn) != key:
                    key, held, table = (cluster, block, turn), [], None
                sketch = np.frombuffer(batch.column(6)[i].as_buffer(), "<u2")
                full = np.frombuffer(batch.column(7)[i].as_buffer(), np.uint64)
                if not role:
                    held.append((x, label, sketch.copy(), full.copy()))
                    continue
                if not held:
                    continue
                if table is None:
                    table = np.array([h[2] for h in held]), np.array([h[1] for h in held])
                agree = (table[0] == sketch).sum(axis=1)
                hits = np.flatnonzero((agree >= least) & (table[1] != label))
                linked = set()
                for k in hits[np.argsort(-agree[hits], kind="stable")].tolist():
                    y, other, _, theirs = held[k]
                    if other not in linked and similar(full, theirs, percent):
                        linked.add(other)
                        us.append(x)
                        vs.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return (base.unionAll(ask).repartition("_cluster", "_block", "_turn").sortWithinPartitions("_cluster", "_block", "_turn", "_role")
            .mapInArrow(run, "u long, v long"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, width: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_size.

    Sets are of ``width``-word shingles (a text of fewer words is one shingle). A
    document without words is linked with nothing and is its own component. Rows
    that share an identifier are one document for linking. A row without
    identifier can't be named as anybody's partner: its component is null and it is kept.
    ``class_size`` counts the documents with an equal set."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    rows = written(given.mapInArrow(lambda batches: _sketch_rows(batches, width), "_id long, _n long, _f1 long, _f2 long, _sketch binary, _bands array<long>"), "sketches")
    # equal sets: the least identifier stands for the class
    reps = written(rows.where("_n > 0 and _id is not null").groupBy(*SET).agg(
        F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_size"), F.first("_sketch").alias("_sketch"), F.first("_bands").alias("_bands")), "classes")
    bands = reps.select("_id", F.explode("_bands").alias("_key"))
    shared = bands.groupBy("_key").agg(F.min("_id").alias("_pivot"), F.max("_id").alias("_last")).where("_pivot <> _last")
    buckets = written(bands.join(shared.select("_key", "_pivot"), "_key"), "buckets")
    wanted = reps.select("_id", *SET).join(buckets.select("_id").distinct(), "_id", "left_semi")
    sets = written(_sets(given, wanted, width), "shingle-sets")

    best = (buckets.where("_id <> _pivot").groupBy("_id", "_pivot").agg(F.count(F.lit(1)).alias("_c"))
            .groupBy("_id").agg(F.max_by("_pivot", F.struct("_c", -F.col("_pivot"))).alias("_pivot")))
    first = written(_verified(best.select(F.col("_pivot").alias("a"), F.col("_id").alias("b")), sets, percent), "links")
    label = components(first)

    named = buckets.select("_key", "_id").join(label, F.col("_id") == F.col("node"), "left").select(
        "_key", "_id", F.coalesce("label", "_id").alias("_label"))
    mixed = named.groupBy("_key").agg(F.min("_label").alias("_l0"), F.max("_label").alias("_l1")).where("_l0 <> _l1")
    still = written(named.join(mixed.select("_key", "_l0"), "_key").select("_id", "_label", "_l0").distinct(), "open-buckets")
    # open buckets that share a label are one cluster, so a class stands in one place only
    cluster = components(still.select(F.col("_label").alias("u"), F.col("_l0").alias("v")).distinct())
    members = (still.select("_id", "_label").distinct().join(cluster.select(F.col("node").alias("_label"), F.col("label").alias("_cluster")), "_label")
               .join(reps.select("_id", "_sketch"), "_id").join(sets, "_id"))
    second = _last_links(written(members, "open-classes"), percent, LEAST_AGREE)
    links = written(first.unionAll(second), "links")
    label = components(links)

    classes = reps.select(*SET, "_id", "_size").join(label, F.col("_id") == F.col("node"), "left").select(
        *SET, F.coalesce("label", "_id").alias("_component"), F.col("_size").alias("class_size"))
    with_words = rows.where("_n > 0 and _id is not null").select("_id", *SET).join(classes, SET)
    alone = rows.where("_n = 0 or _id is null").select("_id", "_n", F.col("_id").alias("_component"), F.lit(1).cast("long").alias("class_size"))
    return with_words.select("_id", "_n", "_component", "class_size").unionAll(alone).select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_component")).alias("kept"), "class_size")


@shielded
def dedup_near(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the smallest identifier."""
    gone = near_groups(docs, percent=percent, width=width).where("not kept").select(F.col("doc_id").cast("long").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
