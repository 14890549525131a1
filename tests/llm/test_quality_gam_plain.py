"""The additive model against a plain version of its fit, table by table, and its ranking on held-out documents."""

import math

import numpy as np
import pytest

from rillet.llm import quality_gam as Q

CHECKS = "/root/testdata/sf0.01"


def gain(g, h):
    return g * g / (h + 1.0)


def plain_tree(g, h, leaves=4):
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best, at = 1e-9, None
        for k, (a, b) in enumerate(parts):
            for c in range(a + 1, b):
                won = gain(sum(g[a:c]), sum(h[a:c])) + gain(sum(g[c:b]), sum(h[c:b])) - gain(sum(g[a:b]), sum(h[a:b]))
                if won > best:
                    best, at = won, (k, c)
        if at is None:
            break
        k, c = at
        a, b = parts[k]
        parts[k:k + 1] = [(a, c), (c, b)]
    return [sum(g[a:b]) / (sum(h[a:b]) + 1.0) for a, b in parts for _ in range(a, b)]


def plain_quadrants(g, h):
    rows, cols = len(g), len(g[0])
    total = lambda m, r, c: sum(m[i][j] for i in r for j in c)
    best, out = None, [[0.0] * cols for _ in range(rows)]
    for i in range(1, rows):
        for j in range(1, cols):
            quads = [(r, c) for r in (range(i), range(i, rows)) for c in (range(j), range(j, cols))]
            won = sum(gain(total(g, *q), total(h, *q)) for q in quads) - gain(total(g, range(rows), range(cols)), total(h, range(rows), range(cols)))
            if best is None or won > best:
                best = won
                out = [[0.0] * cols for _ in range(rows)]
                for r, c in quads:
                    step = total(g, r, c) / (total(h, r, c) + 1.0)
                    for a in r:
                        for b in c:
                            out[a][b] = step
    return best or 0.0, out


def plain_fit(x, y, rounds, pair_rounds, n_pairs, bins, pair_bins):
    n, m = len(y), len(x[0])
    cuts = lambda f, k: sorted({float(np.quantile([r[f] for r in x], q, method="nearest")) for q in np.linspace(0, 1, k + 1)[1:-1]})
    where = lambda edges, v: sum(e <= v for e in edges)
    z = [math.log((sum(y) + 1) / (n - sum(y) + 1))] * n

    def slopes():
        p = [1 / (1 + math.exp(-s)) for s in z]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    edges = [cuts(f, bins) for f in range(m)]
    tables = [[0.0] * (len(e) + 1) for e in edges]
    for _ in range(rounds):
        for f in range(m):
            g, h = slopes()
            sg, sh = [0.0] * len(tables[f]), [0.0] * len(tables[f])
            for i, r in enumerate(x):
                sg[where(edges[f], r[f])] += g[i]
                sh[where(edges[f], r[f])] += h[i]
            step = [Q.RATE * s for s in plain_tree(sg, sh)]
            tables[f] = [a + b for a, b in zip(tables[f], step)]
            z = [s + step[where(edges[f], r[f])] for s, r in zip(z, x)]
    rough = [cuts(f, pair_bins) for f in range(m)]

    def grid(a, b):
        g, h = slopes()
        sg = [[0.0] * (len(rough[b]) + 1) for _ in range(len(rough[a]) + 1)]
        sh = [[0.0] * (len(rough[b]) + 1) for _ in range(len(rough[a]) + 1)]
        for i, r in enumerate(x):
            sg[where(rough[a], r[a])][where(rough[b], r[b])] += g[i]
            sh[where(rough[a], r[a])][where(rough[b], r[b])] += h[i]
        return sg, sh

    ranked = sorted(((plain_quadrants(*grid(a, b))[0], a, b) for a in range(m) for b in range(a)), reverse=True)[:n_pairs]
    pairs = {(a, b): [[0.0] * (len(rough[b]) + 1) for _ in range(len(rough[a]) + 1)] for _, a, b in ranked}
    for _ in range(pair_rounds):
        for (a, b), table in pairs.items():
            step = plain_quadrants(*grid(a, b))[1]
            for i, row in enumerate(step):
                for j, v in enumerate(row):
                    table[i][j] += Q.RATE * v
            z = [s + Q.RATE * step[where(rough[a], r[a])][where(rough[b], r[b])] for s, r in zip(z, x)]
    return tables, pairs, [1 / (1 + math.exp(-s)) for s in z]


def test_fit_against_plain_version(monkeypatch):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=50), rng.integers(0, 4, 50), rng.random(50)])
    y = (x[:, 0] + (x[:, 1] > 1) * (x[:, 2] > 0.5) * 2 + rng.normal(scale=0.4, size=50) > 0.6).astype(float)
    sizes = {"ROUNDS": 6, "PAIR_ROUNDS": 4, "PAIRS": 2, "BINS": 8, "PAIR_BINS": 4}
    for k, v in sizes.items():
        monkeypatch.setattr(Q, k, v)
    model = Q.fit(x, y)
    tables, pairs, scores = plain_fit(x.tolist(), y.tolist(), 6, 4, 2, 8, 4)
    for f, t in enumerate(tables):
        assert model.tables[f] == pytest.approx(t, abs=1e-9)
    assert {(f, g) for f, g, *_ in model.pairs} == set(pairs)
    for f, g, _, _, t in model.pairs:
        assert np.allclose(t, pairs[f, g], atol=1e-9)
    assert model.score(x) == pytest.approx(scores, abs=1e-9)


def test_held_out_ranking(spark):
    """Of two held-out documents with different labels the good one scores higher in nearly all cases."""
    docs, labels = (spark.read.parquet(f"{CHECKS}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r["score"] for r in Q.quality_scores(docs, labels).where("held_out").collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.where("quality is not null").collect()}
    good, bad = ([got[i] for i, q in marks.items() if q == k and i in got] for k in (1, 0))
    assert len(good) > 10 and len(bad) > 10
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad)) > 0.9
