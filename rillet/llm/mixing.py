"""Mixing sources to target weights by blocks and index permutations.

The words of a source, its documents one after the other, are cut into blocks of
a fixed number of words, fewer in a source that would have few blocks. A source's target says how many block slots it fills in
the mix. Output shards draw their source counts one after the other from a
multinomial whose probabilities are what each source is still owed, so a shard
looks like an independent draw while the totals meet the targets exactly. A
source numbers its slots through all shards; pass ``e`` over the source maps
slot to block by the ``e``-th pseudorandom permutation of its block indices
(a Feistel network that walks back into range), so no block is taken a second
time before all were taken once. Slots and documents then meet by a join on the
block index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import add_columns, count_words, mix64, numbered_chunks, shielded, small_batches, word_bounds, text_buffers, written

WEIGHTS = (5, 2, 1)
#: A source is repeated at most this often.
MAX_REPEAT = 3
BLOCK_WORDS = 256
#: A source is cut into at least so many blocks, or into single words: its share is rounded to whole blocks.
LEAST_BLOCKS = 64
SHARD_SLOTS = 1 << 16
#: Documents per chunk of a source when offsets are summed up.
CHUNK_DOCS = 4000
SEED = 20_001


def targets(sizes: dict, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> dict:
    """Words each source should give: shares of all words by weight, at most
    ``max_repeat`` times a source's own, the excess reshared by weight.

    Sources in code-point order, null last, have the weights in turn."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, float(sum(sizes.values())), list(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > max_repeat * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = float(max_repeat * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return out


def draw_shards(slots: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source index, first slot, slots) from multinomial draws whose totals are ``slots``."""
    rng = np.random.default_rng(seed)
    owed, given, rows, shard = np.array(slots, np.int64), np.zeros(len(slots), np.int64), [], 0
    while total := int(owed.sum()):
        size = min(shard_slots, total)
        drawn = np.minimum(rng.multinomial(size, owed / total), owed)
        while (rest := size - int(drawn.sum())) > 0:  # a source that gave all it owes: the others fill in
            left = owed - drawn
            drawn += np.minimum(rng.multinomial(rest, left / left.sum()), left)
        rows += [(shard, int(s), int(given[s]), int(drawn[s])) for s in np.flatnonzero(drawn)]
        given, owed, shard = given + drawn, owed - drawn, shard + 1
    return rows


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each index under the pseudorandom permutation of range(size) that ``key`` names."""
    half = np.uint64(1)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(float)) / 2).astype(np.uint64)
    bits = np.maximum(bits + ((half << (bits + bits)) < size.astype(np.uint64)), half)
    mask = (half << bits) - half
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, b, m, k = out[todo], bits[todo], mask[todo], key[todo]
        left, right = x >> b, x & m
        for r in range(4):
            left, right = right, left ^ (mix64(right * np.uint64(4) + np.uint64(r) ^ k) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def shard_slots(plan: DataFrame, blocks: list[int], seed: int) -> DataFrame:
    """(shard, slot, _s, _block): what stands in each slot of each shard. A shard's slots are its sources' draws one
    after the other; a source's draws go on through the permutation of its blocks where the shard before left off."""
    step = 10_000
    # first pieces of a shard's draws, then the slots, so that no row grows a long array
    pieces = plan.select("_shard", "_s", "_base", F.col("_first").alias("_from"), (F.col("_first") + F.col("_count")).alias("_to")).select(
        "_shard", "_s", "_base", "_from", "_to", F.explode(F.sequence("_from", F.col("_to") - 1, F.lit(step).cast("long"))).alias("_a"))
    slots = pieces.select("_shard", "_s", "_base", "_from", F.explode(F.sequence("_a", F.least(F.col("_a") + step, F.col("_to")) - 1)).alias("_n")).select(
        "_shard", (F.col("_base") + F.col("_n") - F.col("_from")).alias("slot"), "_s", "_n")

    def run(batches):
        n = np.array(blocks, np.int64)
        for b in batches:
            s, taken = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            size = n[s]
            turn = (taken // size).astype(np.uint64)
            key = mix64((s.astype(np.uint64) << np.uint64(8)) + turn + mix64(np.full(len(s), seed, np.uint64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array(permuted(taken % size, size, key))],
                                             names=["shard", "slot", "_s", "_block"])

    return slots.mapInArrow(run, "shard long, slot long, _s int, _block long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", block_words: int = BLOCK_WORDS,
             seed: int = SEED, draw=draw_shards) -> tuple[DataFrame, DataFrame]:
    """From a written table with ``_row`` and ``_size``: (documents with source totals and
    ``_off``, the document's first word in its source; pieces of documents in blocks
    with ``_places``, the (shard, slot) of each use of the block in order, at most MAX_REPEAT).
    One row per source comes to the driver, and one per shard and source, of at most 4,096 shards."""
    spark = docs.sparkSession
    per = docs.groupBy(source_col).agg(F.sum("_size"), F.count(F.lit(1))).collect()
    sizes = {r[0]: int(r[1] or 0) for r in per}
    want = targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    words = [max(1, min(block_words, sizes[s] // LEAST_BLOCKS)) for s in order]
    blocks = [-(-sizes[s] // w) for s, w in zip(order, words, strict=True)]
    slots = [min(MAX_REPEAT * n, round(want[s] * n / sizes[s])) if n else 0 for s, n in zip(order, blocks, strict=True)]
    known = spark.createDataFrame([(s, i, sizes[s], want[s], words[i]) for i, s in enumerate(order)],
                                  "_source string, _s int, source_size long, target double, _words long")
    chunks = max(1, -(-sum(r[2] for r in per) // CHUNK_DOCS))
    chunk = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(chunks))
    slim = docs.select(F.col(id_col).alias("_id"), "_row", "_size", F.col(source_col).cast("string").alias("_src"), chunk.alias("_chunk"))
    slim = slim.join(known, F.col("_src").eqNullSafe(F.col("_source"))).drop("_src", "_source")
    w = Window.partitionBy("_s", "_chunk").orderBy("_id", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (numbered_chunks(slim, ["_s"], "_chunk", "_size", "_before")
              .withColumn("_off", F.col("_before") + F.coalesce(F.sum("_size").over(w), F.lit(0)))
              .drop("_before", "_chunk"))
    placed = written(placed, "mix-documents")
    rows, base = [], {}
    for shard, s, first, count in draw(slots, max(SHARD_SLOTS, sum(slots) // 4096), seed):
        rows.append((shard, s, first, count, base.get(shard, 0)))
        base[shard] = base.get(shard, 0) + count
    plan = spark.createDataFrame(rows, "_shard long, _s int, _first long, _count long, _base long")
    uses = (shard_slots(plan.repartition(max(1, spark.sparkContext.defaultParallelism)), blocks, seed)
            .groupBy("_s", "_block").agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("_places")))
    b = F.col("_words")
    parts = placed.where("_size > 0").select(
        "_row", "_s", "_off", "_size", "_words", F.explode(F.sequence(F.floor(F.col("_off") / b), F.floor((F.col("_off") + F.col("_size") - 1) / b))).alias("_block"))
    lo, hi = F.greatest("_off", F.col("_block") * b), F.least(F.col("_off") + F.col("_size"), (F.col("_block") + 1) * b)
    pieces = parts.join(uses, ["_s", "_block"]).select("_row", "_places", (lo - F.col("_off")).alias("_from"), (hi - F.col("_off")).alias("_to"))
    return placed, pieces


def mix_table(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, draw=draw_shards) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_shard, first_slot, n_places of every row of ``docs``.

    ``first_shard`` and ``first_slot``: where the first of its words stand in the mix (null if none is taken);
    ``n_places``: the slots that hold words of it. Texts without words (null, empty) take part with size 0 and give nothing;
    repeated rows count as documents of their own; a null source is a source."""
    sized = add_columns(docs.select("doc_id", "source", "text"), {"_size": "long"}, count_words)
    table = written(sized.select("doc_id", "source", "_size").withColumn("_row", F.monotonically_increasing_id()), "mix-sizes")
    placed, pieces = mix_plan(table, block_words=block_words, seed=seed, draw=draw)
    taken = pieces.groupBy("_row").agg(F.sum(F.size("_places") * (F.col("_to") - F.col("_from"))).alias("taken"),
                                       F.min(F.get("_places", F.lit(0))).alias("_at"), F.sum(F.size("_places")).alias("n_places"))
    return placed.join(taken, "_row", "left").select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("_at.shard").alias("first_shard"), F.col("_at.slot").alias("first_slot"),
        F.coalesce("n_places", F.lit(0)).cast("long").alias("n_places"))


def mix_slots(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, draw=draw_shards) -> DataFrame:
    """The mix slot by slot: (shard, slot, doc_id, source, from_word, to_word), one row per piece of a
    document in a slot. A reader of one shard takes its rows in the order of slot and from_word."""
    sized = add_columns(docs.select("doc_id", "source", "text"), {"_size": "long"}, count_words)
    table = written(sized.select("doc_id", "source", "_size").withColumn("_row", F.monotonically_increasing_id()), "mix-sizes")
    _, pieces = mix_plan(table, block_words=block_words, seed=seed, draw=draw)
    return pieces.select("_row", "_from", "_to", F.explode("_places").alias("_p")).join(table.select("_row", "doc_id", "source"), "_row").select(
        "_p.shard", "_p.slot", "doc_id", "source", F.col("_from").alias("from_word"), F.col("_to").alias("to_word"))


@shielded
def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mixed corpus, in the columns of ``docs``: one row per document and pass over it.

    A row's text is what the pass takes of the document, from the first taken
    word to the last, gaps between taken blocks left out; a pass that takes all
    of a document gives its text as it is. ``n_chars``, if there, is set anew. Inside an output
    file rows come in the order of the first slot they fill: shard, then slot."""
    cols = docs.columns
    table = written(add_columns(docs, {"_size": "long"}, count_words).withColumn("_row", F.monotonically_increasing_id()), "mix-docs")
    _, pieces = mix_plan(table.select("doc_id", "source", "_size", "_row"), block_words=block_words, seed=seed)
    # a document has as many pieces as blocks; one row per document and pass
    passes = (pieces.select("_row", "_from", "_to", F.posexplode("_places").alias("_pass", "_place"))
              .groupBy("_row", "_pass").agg(F.sort_array(F.collect_list(F.struct("_from", "_to"))).alias("_spans"), F.min("_place").alias("_place"))
              .select("_row", "_place", F.col("_spans._from").alias("_from"), F.col("_spans._to").alias("_to")))
    small_batches(docs.sparkSession)
    joined = table.join(passes, "_row").sortWithinPartitions("_place").select(*cols, "_size", "_from", "_to")
    at = cols.index("text")

    def cut(batches):
        for b in batches:
            data, offs = text_buffers(b.column(at))
            size, starts, ends = (b.column(i).to_pylist() for i in range(len(cols), len(cols) + 3))
            texts = []
            for i in range(b.num_rows):
                part = data[offs[i]:offs[i + 1]]
                if sum(ends[i]) - sum(starts[i]) < size[i]:
                    word, end, _ = word_bounds(part, np.array([0, len(part)]))
                    spans, raw = [], part.tobytes()
                    for x, y in zip(starts[i], ends[i], strict=True):
                        if spans and spans[-1][1] == x:
                            spans[-1][1] = y
                        else:
                            spans.append([x, y])
                    texts.append(b"\n".join(raw[word[x]:end[y - 1]] for x, y in spans).decode("utf-8", "replace"))
                else:
                    texts.append(part.tobytes().decode("utf-8", "replace"))
            new = list(b.columns[:len(cols)])
            new[at] = pa.array(texts, pa.string()).cast(b.column(at).type)
            if "n_chars" in cols:
                k = cols.index("n_chars")
                new[k] = pa.array([len(t) for t in texts]).cast(b.column(k).type)
            yield pa.RecordBatch.from_arrays(new, names=cols)

    return joined.mapInArrow(cut, docs.schema)
