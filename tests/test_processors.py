"""The streaming state machines, run directly over random micro-batch splits
with an in-memory state handle, against the row-at-a-time transcription."""

import random

import pandas as pd
import pytest

from rillet.streaming.processors import FlagRunProcessor, PairAverageProcessor, RecordRunProcessor
from tests import brute


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = tuple(v)

    def clear(self):
        self.v = None


class _Map:
    def __init__(self):
        self.d = {}

    def containsKey(self, k):
        return k in self.d

    def getValue(self, k):
        return self.d.get(k)

    def updateValue(self, k, v):
        self.d[k] = tuple(v)


class _Handle:
    def getValueState(self, name, schema, ttl=None):
        return _Value()

    def getMapState(self, name, ks, vs, ttl=None):
        return _Map()


def _run(proc, values, cuts, col):
    proc.init(_Handle())
    rows = pd.DataFrame({"seq": range(len(values)), "t": range(len(values)), col: values})
    out = []
    bounds = [0] + sorted(cuts) + [len(values)]
    for a, b in zip(bounds, bounds[1:]):
        if a == b:
            continue
        batch = rows.iloc[a:b].sample(frac=1, random_state=a)  # arrival order inside a batch is arbitrary
        half = len(batch) // 2
        frames = [batch.iloc[:half], batch.iloc[half:]] if half else [batch]
        for pdf in proc.handleInputRows((7,), iter(frames), None):
            out += [tuple(r) for r in pdf.itertuples(index=False)]
    return out


@pytest.mark.parametrize("seed", range(300))
def test_processors_match_transcription(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 80)
    sticky = rnd.random()
    vals, prev = [], rnd.randint(0, 1)
    for _ in range(n):
        prev = prev if rnd.random() < sticky else rnd.randint(0, 1)
        vals.append(prev)
    if seed % 5 == 0:
        vals = [rnd.randint(-3, 3) for _ in range(n)]  # negatives, more than two values
    cuts = [rnd.randint(0, n) for _ in range(rnd.randint(0, 6))]
    timed = list(enumerate(vals))

    got = _run(PairAverageProcessor(["k"], ["t", "seq"], "v", "t"), vals, cuts, "v")
    assert [(t, a) for _, t, a in got] == brute.pair_average(timed)

    got = _run(RecordRunProcessor(["k"], ["t", "seq"], "v", "t"), vals, cuts, "v")
    assert [(t, v, n) for _, t, v, n in got] == brute.record_runs(timed)

    if seed % 5:
        got = _run(FlagRunProcessor(["k"], ["t", "seq"], "f", "t"), vals, cuts, "f")
        assert [(n, t) for _, n, t in got] == brute.flag_runs(timed)
        got = _run(FlagRunProcessor(["k"], ["t", "seq"], "f", "t", emit_empty_first=False), vals, cuts, "f")
        assert [(n, t) for _, n, t in got] == brute.flag_runs(timed, emit_empty_first=False)
