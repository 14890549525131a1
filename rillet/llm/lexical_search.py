"""Ranked lexical search by norm buckets (LEMP).

A document is a vector of integer impacts over the terms of the queries, an item
the set of its terms; the score is their inner product. Every partition orders its vectors by
length, longest first, and takes them in buckets (Arrow batches). An item skips
a bucket when the product of the lengths (Cauchy-Schwarz) is below the score of its
50th best document so far. Inside a bucket it looks at a few coordinates, its
rarest terms: their exact part, and Cauchy-Schwarz on the rest of both
vectors, bound each document. What passes is scored exactly in 64-bit integers.
The best of all partitions are ranked in Spark. Bounds never drop a document
whose score equals the threshold, so ties are whole.

Items are the stated query set. They are taken in blocks of bounded
vocabulary, each against all documents; a block's distinct terms are what a task holds.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import LOWER, small_batches, span_hash, prefix_hash, text_slices, word_bounds, written

TOP = 50
#: Distinct terms of a block of items (one item with more is a block of its own).
BLOCK_TERMS = 8192
#: Coordinates of an item that are looked at before a document is scored.
FOCUS = 6
#: Bytes of one text hashed at once; a longer text is cut between terms.
PIECE_BYTES = 1 << 20
#: Room for rounding in the bounds.
SLACK = 1 + 1e-9
#: Stands for a null identifier where ties are ordered: after all others.
NO_ID = (1 << 63) - 1

IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, 64-bit hash) arrays of every term of a slice of texts, long slices in pieces that end between terms."""
    at = 0
    while at < len(data) or at == 0:
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data) and IS_TERM[data[end]]:
            stop = np.flatnonzero(~IS_TERM[data[end:end + PIECE_BYTES]])
            end = end + int(stop[0]) if len(stop) else min(end + PIECE_BYTES, len(data))
        part = LOWER[data[at:end]]
        cut = np.clip(offs, at, end) - at
        start, stop, row = word_bounds(part, cut, IS_TERM)
        yield row, span_hash(prefix_hash(part), start, stop)
        at = max(end, at + 1)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Lists of (item identifier, its distinct term hashes), each list of bounded vocabulary."""
    block, seen = [], set()
    for ident, text in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        raw = np.frombuffer((text or "").encode(), np.uint8)
        h = np.unique(np.concatenate([h for _, h in term_hashes(raw, np.array([0, len(raw)]))]))
        if not len(h):
            continue
        if block and len(seen | set(h.tolist())) > block_terms:
            yield block
            block, seen = [], set()
        block.append((ident, h))
        seen.update(h.tolist())
    if block:
        yield block


def term_vectors(docs: DataFrame, known: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(key, n, terms, tfs) of every row: all its terms counted, those of ``known`` (sorted hashes) listed."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            counts, rows, terms, tfs = np.zeros(b.num_rows, np.int64), [], [], []
            for i, j, data, offs in text_slices(b.column(1)):
                hits = []
                for row, h in term_hashes(data, offs):
                    counts[i:j] += np.bincount(row, minlength=j - i)
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    ok = known[at] == h
                    hits.append(row[ok] * len(known) + at[ok])
                pair, tf = np.unique(np.concatenate(hits), return_counts=True)
                rows.append(i + pair // len(known))
                terms.append(pair % len(known))
                tfs.append(tf)
            size = np.bincount(np.concatenate(rows) if rows else np.zeros(0, np.int64), minlength=b.num_rows)
            offs = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), kind)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts), pa.ListArray.from_arrays(offs, flat(terms, pa.int32())),
                 pa.ListArray.from_arrays(offs, flat(tfs, pa.int64()))], names=["key", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "key long, n long, terms array<int>, tfs array<long>")


def _lists(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of a list column."""
    col = b.column(b.schema.get_field_index(name))
    offs = col.offsets.to_numpy().astype(np.int64)
    return np.diff(offs), col.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]]


def impact_vectors(vectors: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(key, norm, terms, impacts) of the rows that hold a query term."""
    def run(batches):
        for b in batches:
            n = b.column(1).to_numpy(zero_copy_only=False)
            size, term = _lists(b, "terms")
            _, tf = _lists(b, "tfs")
            m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size)))
            square = np.bincount(np.repeat(np.arange(len(n)), size), impact.astype(float) ** 2, minlength=len(n))
            offs = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.sqrt(square)), pa.ListArray.from_arrays(offs, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(offs, pa.array(impact, pa.int64()))], names=["key", "norm", "terms", "impacts"])

    return vectors.where(F.size("terms") > 0).mapInArrow(run, "key long, norm double, terms array<int>, impacts array<long>")


class _Best:
    """The best ``top`` documents of one item so far, ties by identifier."""

    def __init__(self, top: int):
        self.top, self.least = top, 1
        self.score, self.key = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, key: np.ndarray) -> None:
        score, key = np.append(self.score, score), np.append(self.key, key)
        order = np.lexsort((key, -score))[:self.top]
        self.score, self.key = score[order], key[order]
        if len(order) == self.top:
            self.least = max(1, int(self.score[-1]))


def scan_buckets(batches, items: list[np.ndarray], size: int, top: int, focus: int = FOCUS):
    """The best documents of each item in one partition whose batches come longest vector first.

    ``items`` list each item's term numbers, rarest first; ``size`` is the number of terms."""
    best = [_Best(top) for _ in items]
    length = np.sqrt([len(t) for t in items])
    for b in batches:
        key = np.where(b.column(0).is_null().to_numpy(zero_copy_only=False), NO_ID,
                       b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)).astype(np.int64)
        norm = b.column(1).to_numpy(zero_copy_only=False)
        least = np.array([x.least for x in best], float)
        open_ = np.flatnonzero(length * norm[0] * SLACK >= least)  # Cauchy-Schwarz on the whole bucket
        if not len(open_):
            continue
        sizes, term = _lists(b, "terms")
        _, impact = _lists(b, "impacts")
        here = np.unique(term)
        place = np.full(size, -1, np.int64)
        place[here] = np.arange(len(here))
        grid = np.zeros((len(key), len(here)), np.int64)
        grid[np.repeat(np.arange(len(key)), sizes), place[term]] = impact
        for q in open_:
            cols = place[items[q]]
            cols = cols[cols >= 0]
            if not len(cols):
                continue
            bar = best[q].least
            k = int(np.searchsorted(-norm * length[q] * SLACK, -bar, "right"))  # the bucket's prefix that is long enough
            near = grid[:k, cols[:focus]]
            rest = np.maximum(norm[:k] ** 2 * SLACK - (near.astype(float) ** 2).sum(1), 0)
            bound = (near.sum(1) + np.sqrt(max(len(cols) - focus, 0) * rest)) * SLACK
            alive = np.flatnonzero(bound >= bar)
            score = grid[np.ix_(alive, cols)].sum(1)
            keep = score >= bar
            if keep.any():
                best[q].add(score[keep], key[alive][keep])
    for q, x in enumerate(best):
        if len(x.key):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x.key), q, np.int32)), pa.array(x.key), pa.array(x.score)], names=["q", "key", "score"])


def search_block(docs: DataFrame, block: list[tuple[int | None, np.ndarray]], top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    known = np.unique(np.concatenate([h for _, h in block]))
    vectors = written(term_vectors(docs, known, id_col, text_col), "search-vectors")
    n_docs, n_terms = (int(x or 0) for x in vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first())
    df = np.zeros(len(known), np.int64)
    for t, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most one row per query term
        df[t] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    items = []
    for _, h in block:
        t = np.searchsorted(known, h)
        items.append(t[np.argsort(-weight[t], kind="stable")])
    impacts = impact_vectors(vectors, weight, n_docs, n_terms).sortWithinPartitions(F.desc("norm"))
    found = impacts.mapInArrow(functools.partial(scan_buckets, items=items, size=len(known), top=top), "q int, key long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key"))).where(F.col("rank") <= top)
    ids = spark.createDataFrame([(q, ident) for q, (ident, _) in enumerate(block)], "q int, item_id long")
    return ranked.join(ids, "q").select("item_id", "rank", F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best rows of ``docs`` with a score above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z lower-cased, told apart by 64-bit hashes. Rows with equal scores are
    ordered by identifier, one without identifier last; repeated rows are documents of their own.
    A null or empty text has no terms: as a document it is never found, as an
    item it has no rows. Empty tables give an empty result. Other columns are not read."""
    found = [search_block(docs, block, top, id_col, text_col) for block in item_blocks(items, item_id, item_text, block_terms)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionAll, found)
