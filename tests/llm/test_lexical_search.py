"""Ranked search against a row-at-a-time version: ties, nulls, long texts, several blocks of items."""

import random

import numpy as np
import pytest

from rillet.llm import lexical_search as S
from tests.llm import brute as B

SCHEMA = "doc_id long, text string, key long, n string, terms int, score string, rank int"


def rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Éa", "été", "ẞx", "x-y", "A1"]
    out = []
    for i in range(150):
        k = rng.choice([0, 3, 20, 80])
        out.append((i, " ".join(rng.choice(vocab[:rng.choice([5, 65])]) for _ in range(k))))
    out += [(200 + i, "tie w1 w2 w3") for i in range(70)]
    out += [(300, None), (301, ""), (302, "...---"), (None, "tie w1 w2 w3"), (303, "w" * 3_000_000 + " w1"), (304, "w7 " * 600_000), (5, "w9 w9 w9"), (5, "w9 w9 w9")]
    return out


ITEMS = [(1, "W1 w2, w3"), (2, "w9"), (3, None), (4, ""), (5, "unknown-word zzz"), (6, "été A1 w40 w41 w42 w43 w44 w45 w46 w47 w48 w49 w50"),
         (7, "w7 w7 w8"), (7, "w7 w7 w8"), (None, "éa"), (8, " ".join(f"w{i}" for i in range(60)))]


@pytest.mark.parametrize("block_terms", [8192, 40])
def test_search(spark, block_terms):
    docs = rows()
    df = spark.createDataFrame([(i, t, 1, "n", 2, "s", 3) for i, t in docs], SCHEMA).repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [tuple(r) for r in S.search(df, items, block_terms=block_terms).collect()]
    assert sorted(got, key=str) == sorted(B.search(docs, ITEMS), key=str)
    assert S.search(df, items, block_terms=block_terms).schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert S.search(none, items).collect() == []
    assert S.search(none, spark.createDataFrame([], "item_id long, text string")).collect() == []
    blank = spark.createDataFrame([(1, None, 1, "n", 2, "s", 3)], SCHEMA)
    assert S.search(blank, items).collect() == []


def test_pruning_is_exact():
    """A bucket scan with a small top keeps exactly the best, whatever the focus."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    for focus in (1, 6, 50):
        vec = rng.integers(0, 50, (400, 30)) * (rng.random((400, 30)) < 0.3)
        norm = np.sqrt((vec ** 2).sum(1))
        order = np.argsort(-norm)
        batches = []
        for part in np.array_split(order, 9):
            terms = [np.flatnonzero(vec[i]) for i in part]
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(norm[part]), pa.array([t.tolist() for t in terms], pa.list_(pa.int32())),
                 pa.array([vec[i][t].tolist() for i, t in zip(part, terms)], pa.list_(pa.int64()))], names=["key", "norm", "terms", "impacts"]))
        items = [rng.permutation(30)[:rng.integers(1, 20)] for _ in range(12)]
        got = {}
        for b in S.scan_buckets(iter(batches), items, 30, 7, focus):
            got[b.column(0)[0].as_py()] = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
        for q, t in enumerate(items):
            score = vec[:, t].sum(1)
            want = [(int(i), int(score[i])) for i in np.lexsort((np.arange(400), -score))[:7] if score[i] > 0]
            assert got.get(q, []) == want
