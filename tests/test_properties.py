"""Property tests: the distribution claim of the pair job, and random
sequences through every chunk width (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rillet.operators import flag_runs, pair_average, record_runs
from rillet.plans import jobs as J
from rillet.sources.tables import load, role_bits
from tests import brute


def test_pair_averages_of_fair_bits(spark):
    """Averages of pairs of fair bits are 0 three times in four, 1 once
    (a pair (1,0) or (0,1) averages to 0.5, truncated to 0)."""
    pairs = J.pair_average_job(role_bits(load(spark, "/root/testdata/sf0.1", "events")))
    counts = {r.average: r["count"] for r in pairs.groupBy("average").count().collect()}
    total = sum(counts.values())
    assert total > 40_000
    assert abs(counts.get(0, 0) / total - 0.75) < 0.01
    assert abs(counts.get(1, 0) / total - 0.25) < 0.01


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 1), min_size=1, max_size=60), width=st.integers(1, 12),
       keys=st.integers(1, 3))
def test_random_sequences_any_width(spark, values, width, keys):
    rows = [(i, i % keys, i // keys, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "seq long, k long, t long, v int")
    order = ["t", "seq"]

    def expect(fn):
        out = set()
        for k in range(keys):
            seq = [(r[0], r[3]) for r in rows if r[1] == k]
            out |= {(k,) + tuple(e) for e in fn(seq)}
        return out

    assert {tuple(r) for r in pair_average(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()} \
        == expect(brute.pair_average)
    assert {tuple(r) for r in record_runs(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()} \
        == expect(brute.record_runs)
    assert {(r.k, r.n_samples, r.end_time) for r in flag_runs(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()} \
        == expect(brute.flag_runs)
