"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins. Boosting visits the features in turn, again and
again; a visit fits a shallow tree on that feature alone to the current gradient
and adds a small step of it to the feature's lookup table. Afterwards the
pairs of features with the most signal left get two-dimensional tables the same
way. A score is a sum of looked-up numbers through the logistic function.

Features are counted on the executors from whole texts. Only the features of
a bounded sample of labelled documents (``SAMPLE`` rows, those with the smallest
hash of their identifier) come to the driver, where the tables are learnt.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import (
    add_columns, byte_counts, mix64, occurrences, per_row, small_batches, span_counts, word_bounds, word_hashes, written,
)
from rillet.llm.quality_rules import WORD_CHAR, text_stats

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
CUTOFF = 0.7
HELD_OUT = 2

FEATURES = ["log_words", "word_chars", "symbols", "dup_lines", "repeats", "upper", "bangs", "pipes", "digits", "distinct",
            "adjacent", "short_words", "long_words", "full_stops", "commas", "line_words", "non_ascii", "capitals"]


def text_features(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """FEATURES of each text of a slice (all 0 for a text without words)."""
    n = len(offs) - 1
    n_words, chars, symbols, dups, repeats, lines, upper, bangs = (x.astype(float) for x in text_stats(data, offs))
    start, end, row = word_bounds(data, offs)
    h = word_hashes(data, start, end)
    new, _ = occurrences(h ^ mix64(row.astype(np.uint64) + np.uint64(1)))
    lengths = span_counts(data, start, end, WORD_CHAR)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    of = lambda mask: per_row(row[mask], n).astype(float)
    twin = np.zeros(len(row), bool)
    twin[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    first = data[start] if len(start) else np.zeros(0, np.uint8)
    byte = np.arange(256)
    count = lambda member: byte_counts(data, offs, member).astype(float)
    size = np.diff(offs).astype(float)
    return [np.log1p(n_words), share(chars, n_words), share(symbols, n_words), share(dups, lines), share(repeats, n_words),
            share(upper, chars), share(bangs, n_words), share(count(byte == 124), n_words),
            share(count((byte >= 48) & (byte <= 57)), chars), share(of(new), n_words),
            share(of(twin), n_words), share(of(lengths <= 3), n_words), share(of(lengths >= 9), n_words),
            share(count(byte == 46), n_words), share(count(byte == 44), n_words), share(n_words, lines),
            share(count(byte >= 128), size), share(of((first >= 65) & (first <= 90)), n_words)]


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one double column ``_f_<name>`` for each feature."""
    return add_columns(docs, {f"_f_{f}": "double" for f in FEATURES}, text_features, text_col)


@dataclass
class Model:
    """Lookup tables: ``edges[f]`` cut feature f into bins, ``tables[f]`` holds its steps;
    ``pairs`` holds (f, g, edges of f, edges of g, table)."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of features, by adding up bins."""
        z = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += table[np.searchsorted(cuts, x[:, f], "right")]
        for f, g, a, b, table in self.pairs:
            z += table[np.searchsorted(a, x[:, f], "right"), np.searchsorted(b, x[:, g], "right")]
        return 1 / (1 + np.exp(-z))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner edges of quantile bins; a value equal to an edge lies above it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))


def _gain(g: np.ndarray, h: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    return g * g / (h + smooth)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Step of each bin: a tree of at most ``leaves`` leaves over ordered bins, grown best split first."""
    parts = [(0, len(g))]
    cg, ch = np.append(0, np.cumsum(g)), np.append(0, np.cumsum(h))
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            at = np.arange(a + 1, b)
            if len(at):
                left, right = _gain(cg[at] - cg[a], ch[at] - ch[a]), _gain(cg[b] - cg[at], ch[b] - ch[at])
                won = left + right - _gain(cg[b] - cg[a], ch[b] - ch[a])
                i = int(won.argmax())
                best = max(best, (float(won[i]), k, int(at[i])), key=lambda x: x[0])
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1]:best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best four quadrants of a two-dimensional histogram: (gain, step of each cell)."""
    cum = lambda m: np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    cg, ch = cum(g), cum(h)
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    quads = []
    for c in (cg, ch):
        ll, lr = c[i, j], c[i, -1] - c[i, j]
        rl = c[-1, j] - ll
        quads.append((ll, lr, rl, c[-1, -1] - ll - lr - rl))
    gain = sum(_gain(a, b) for a, b in zip(*quads, strict=True)) - _gain(cg[-1, -1], ch[-1, -1])
    if not gain.size:
        return 0.0, np.zeros(g.shape)
    at = np.unravel_index(gain.argmax(), gain.shape)
    ll, lr, rl, rr = (a[at] / (b[at] + 1.0) for a, b in zip(*quads, strict=True))
    out = np.full(g.shape, rr)
    r, c = at[0] + 1, at[1] + 1
    out[:r, :c], out[:r, c:], out[r:, :c] = ll, lr, rl
    return float(gain[at]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn the tables from rows of features and 0/1 labels.

    Without labels of both kinds the model is the smoothed share of ones."""
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    model = Model(base, [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1])
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.edges)]
    model.tables = [np.zeros(len(c) + 1) for c in model.edges]
    z = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            g, h = slopes()
            k = len(model.tables[f])
            step = RATE * _tree(np.bincount(b, g, k), np.bincount(b, h, k))
            model.tables[f] += step
            z += step[b]
    rough = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(rough)]

    def grid(f, g_):
        a, b = len(rough[f]) + 1, len(rough[g_]) + 1
        cell = coarse[f] * b + coarse[g_]
        g, h = slopes()
        return cell, np.bincount(cell, g, a * b).reshape(a, b), np.bincount(cell, h, a * b).reshape(a, b)

    ranked = sorted(((_pair_tree(*grid(f, g)[1:])[0], f, g) for f in range(x.shape[1]) for g in range(f)), reverse=True)
    chosen = [(f, g) for _, f, g in ranked[:PAIRS]]
    tables = [np.zeros((len(rough[f]) + 1, len(rough[g]) + 1)) for f, g in chosen]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(chosen):
            cell, sg, sh = grid(f, g)
            step = RATE * _pair_tree(sg, sh)[1]
            tables[k] += step
            z += step.reshape(-1)[cell]
    model.pairs = [(f, g, rough[f], rough[g], t) for (f, g), t in zip(chosen, tables, strict=True)]
    return model


def is_held_out(id_col: str):
    """crc32 of the identifier as text, modulo 4, is 2 (never for a null identifier)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def learn(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out part."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("_marked")).agg(F.min("quality").alias("_y")))
    names = [f"_f_{f}" for f in FEATURES]
    rows = (features.where(~is_held_out("doc_id")).join(marks, F.col("doc_id") == F.col("_marked"))
            .select("_y", *names, F.xxhash64("doc_id").alias("_order")).orderBy("_order", *names).limit(sample).collect())
    x = np.array([r[1:-1] for r in rows], float).reshape(len(rows), len(names))
    return fit(x, np.array([float(r[0] > 0) for r in rows]))


def with_scores(features: DataFrame, model: Model) -> DataFrame:
    """``features`` with ``_score``, by vectorised bin additions over Arrow batches."""
    small_batches(features.sparkSession)
    at = [features.columns.index(f"_f_{f}") for f in FEATURES]
    names = features.columns

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in at])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x))], names=[*names, "_score"])

    return features.mapInArrow(run, features.withColumn("_score", F.lit(0.0)).schema)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted of every row (a null text counts as empty;
    with several labels a document has its lowest)."""
    features = written(with_features(docs.select("doc_id", "text")).drop("text"), "quality-features")
    scored = with_scores(features, learn(features, labels, sample))
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= cutoff).cast("int").alias("predicted"))
