"""Packing into length buckets that minimise padding.

The lengths' global histogram (one row per distinct length) is all that the
choice needs: dynamic programming over it finds the bucket boundaries with the
least padding, exactly. Inside a bucket, documents in pseudorandom order
form batches of a token budget, every document padded to the bucket's boundary.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import add_columns, count_words, numbered_chunks, shielded, written

BUCKETS = 16
#: Words (padding included) in a batch; a longer document is a batch of its own.
BATCH_WORDS = 65_536
CHUNK_DOCS = 4000
SEED = 5


def optimal_boundaries(histogram: list[tuple[int, int]], buckets: int) -> tuple[list[int], int]:
    """(upper boundaries, padding) of the best split of a histogram [(length, count)].

    ``best[j]`` with k buckets is the minimum over i < j of ``best[i]`` with k - 1 plus
    the padding of lengths i..j-1 in one bucket. For a fixed j that is a minimum of
    lines in ``length[j - 1]``; slopes only fall and lengths only grow, so the lower
    hull is walked once per bucket: O(buckets x distinct lengths), in integers."""
    h = sorted(histogram)
    lens = [x for x, _ in h]
    count, total = [0], [0]
    for x, n in h:
        count.append(count[-1] + n)
        total.append(total[-1] + x * n)
    m = len(h)
    if not m:
        return [], 0
    best = [0] + [lens[j - 1] * count[j] - total[j] for j in range(1, m + 1)]
    back = [[0] * (m + 1)]
    for _ in range(min(buckets, m) - 1):
        new, frm, hull, at = best[:], [0] * (m + 1), [], 0
        for j in range(1, m + 1):
            i = j - 1  # the line of i becomes available
            slope, base = -count[i], best[i] + total[i]
            while len(hull) >= 2:
                (s1, b1, _), (s2, b2, _) = hull[-2], hull[-1]
                if (base - b1) * (s1 - s2) <= (b2 - b1) * (s1 - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, base, i))
            at = min(at, len(hull) - 1)
            x = lens[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            slope, base, i = hull[at]
            new[j], frm[j] = slope * x + base + x * count[j] - total[j], i
        best = new
        back.append(frm)
    out, j = [], m
    for frm in reversed(back):
        if j:
            out.append(lens[j - 1])
            j = frm[j]
    return out[::-1], best[m]


def _lookup(value: Column, keys: list[int], values: list[int]) -> Column:
    """values[i] of the first keys[i] >= value (a balanced tree of comparisons)."""
    if len(keys) == 1:
        return F.lit(values[0])
    mid = (len(keys) + 1) // 2
    return F.when(value <= keys[mid - 1], _lookup(value, keys[:mid], values[:mid])).otherwise(_lookup(value, keys[mid:], values[mid:]))


def pack(rows: DataFrame, length: str, order: list[str], buckets: int = BUCKETS, batch_tokens: int = BATCH_WORDS,
         seed: int = SEED) -> DataFrame:
    """``rows`` with bucket, padded_length, padding, batch (inside the bucket) and slot.

    ``order`` are columns that tell rows apart; their hash orders a bucket, so
    reruns agree. One row per distinct length comes to the driver. A null length
    counts as 0. An empty table gives an empty result."""
    n = F.coalesce(F.col(length), F.lit(0)).cast("long")
    histogram = [(int(a), int(b)) for a, b in rows.groupBy(n).count().collect()]
    bounds, _ = optimal_boundaries(histogram, buckets)
    bounds = bounds or [0]
    total = sum(c for _, c in histogram)
    chunks = max(1, -(-total // CHUNK_DOCS))
    numbers = list(range(len(bounds)))
    capacity = [max(1, batch_tokens // max(b, 1)) for b in bounds]
    placed = (rows.withColumn("bucket", _lookup(n, bounds, numbers).cast("int"))
              .withColumn("padded_length", _lookup(n, bounds, bounds).cast("long"))
              .withColumn("padding", F.col("padded_length") - n)
              .withColumn("_capacity", _lookup(n, bounds, capacity).cast("long"))
              .withColumn("_order", F.xxhash64(*order, F.lit(seed))))
    placed = placed.withColumn("_chunk", F.pmod(F.xxhash64("_order"), F.lit(chunks)))
    w = Window.partitionBy("bucket", "_chunk").orderBy("_order", *order)
    numbered = numbered_chunks(placed, ["bucket"], "_chunk", F.lit(1), "_before").withColumn(
        "_number", F.col("_before") + F.row_number().over(w) - 1)
    return (numbered.withColumn("batch", F.floor(F.col("_number") / F.col("_capacity")).cast("long"))
            .withColumn("slot", (F.col("_number") % F.col("_capacity")).cast("int"))
            .drop("_capacity", "_order", "_chunk", "_before", "_number"))


def padding_of(bounds: list[int], histogram: list[tuple[int, int]]) -> int:
    """Padding of a histogram in buckets with these boundaries."""
    return sum((bounds[bisect_left(bounds, x)] - x) * n for x, n in histogram)


def pack_table(docs: DataFrame, buckets: int = BUCKETS, batch_words: int = BATCH_WORDS) -> DataFrame:
    """doc_id, n_words, bucket, padded_length, padding, batch, slot of every row (null text: 0 words)."""
    sized = add_columns(docs.select("doc_id", "text"), {"n_words": "long"}, count_words).select("doc_id", "n_words")
    table = written(sized.withColumn("_row", F.monotonically_increasing_id()), "pack-sizes")
    return pack(table, "n_words", ["doc_id", "_row"], buckets, batch_words).drop("_row")


#: Columns that packing adds to documents.
MADE = ["n_words", "bucket", "padded_length", "padding", "batch", "slot"]


def pack_documents(docs: DataFrame, buckets: int = BUCKETS, batch_words: int = BATCH_WORDS) -> DataFrame:
    """``docs`` with the columns of :func:`pack` (and ``n_words``, replacing a column of that name).

    The batches are planned on a written table of row numbers and lengths; the
    texts are read again and joined to their place."""
    return _placed_documents(docs.drop(*MADE), buckets, batch_words)


@shielded
def _placed_documents(docs: DataFrame, buckets: int, batch_words: int) -> DataFrame:
    table = written(add_columns(docs, {"n_words": "long"}, count_words).withColumn("_row", F.monotonically_increasing_id()), "pack-docs")
    placed = pack(table.select("doc_id", "_row", "n_words"), "n_words", ["doc_id", "_row"], buckets, batch_words)
    return table.drop("n_words").join(placed.select("_row", *MADE), "_row").drop("_row")
