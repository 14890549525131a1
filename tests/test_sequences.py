"""Sequence operators: fixture rows, and equality with a row-at-a-time
transcription on random inputs at several chunk widths (so runs and pairs
cross chunk borders), keyed, global and with one hot key."""

import random

import pytest
from pyspark.sql import functions as F

from rillet.operators import flag_runs, latest_by_key, pair_average, record_runs
from rillet.operators.scan import chunking
from tests import brute

SCHEMA = "seq long, k long, t long, v int"


def _df(spark, values, key=1):
    return spark.createDataFrame([(i, key, i, v) for i, v in enumerate(values)], SCHEMA)


def test_pairs_fixture(spark):
    df = _df(spark, [1, 1, 0, 1, 0, 0, 1])
    got = sorted(tuple(r) for r in pair_average(df, "k", ["t", "seq"], "v", "seq", rows_per_chunk=2).collect())
    assert got == [(1, 1, 1), (1, 3, 0), (1, 5, 0)]


def test_pairs_truncate_toward_zero(spark):
    df = _df(spark, [-1, -2])
    assert [tuple(r) for r in pair_average(df, "k", ["t", "seq"], "v", "seq").collect()] == [(1, 1, -1)]


def test_record_runs_fixture(spark):
    df = _df(spark, [0, 0, 1, 1, 1, 0, 0, 0, 1, 1, 1, 1, 0, 0])
    got = sorted((r.create_time, r.value, r.run_length)
                 for r in record_runs(df, "k", ["t", "seq"], "v", "seq", rows_per_chunk=3).collect())
    assert got == [(1, 0, 2), (3, 1, 2), (4, 1, 3), (7, 0, 3), (11, 1, 4)]


def test_flag_runs_fixture(spark):
    df = _df(spark, [1, 1, 0, 0, 1, 0, 1, 1])
    got = sorted(tuple(r)[1:] for r in flag_runs(df, "k", ["t", "seq"], "v", "seq", rows_per_chunk=2).collect())
    assert got == [(1, 5), (2, 2)]
    df = _df(spark, [0, 0, 1, 0])
    got = sorted(tuple(r)[1:] for r in flag_runs(df, "k", ["t", "seq"], "v", "seq").collect())
    assert got == [(0, 0), (1, 3)]
    got = sorted(tuple(r)[1:] for r in flag_runs(df, "k", ["t", "seq"], "v", "seq", emit_empty_first=False).collect())
    assert got == [(1, 3)]


def test_latest_fixture(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (1, 1, 2)], "k long, flag int, seq long")
    assert sorted(tuple(r) for r in latest_by_key(df, "k", ["seq"], "flag").collect()) == [(1, 1), (2, 1)]


def _random_rows(seed, n_keys=6, hot=True):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for k in range(n_keys):
        n = rnd.choice([1, 2, 3, 40, 200])
        if hot and k == 0:
            n = 900  # one key holds about a third or more of all rows
        prev = rnd.randint(0, 1)
        for i in range(n):
            # sticky values make long runs that span many chunks
            v = prev if rnd.random() < 0.7 else rnd.randint(0, 1)
            prev = v
            rows.append((seq, k, i * 5 + rnd.randint(0, 4), v))
            seq += 1
    rnd.shuffle(rows)
    return rows


def _expected(rows, fn, key=True):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] if key else 0, []).append(r)
    out = set()
    for k, rs in groups.items():
        rs.sort(key=lambda r: (r[2], r[0]))
        for e in fn([(r[0], r[3]) for r in rs]):
            out.add(((k,) if key else ()) + tuple(e))
    return out


@pytest.mark.parametrize("width", [3.0, 17.0, 250.0, 1e12])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_equivalence(spark, width, seed):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["t", "seq"]
    got = {tuple(r) for r in pair_average(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()}
    assert got == _expected(rows, brute.pair_average)
    got = {tuple(r) for r in record_runs(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()}
    assert got == _expected(rows, brute.record_runs)
    got = {(r.k, r.n_samples, r.end_time) for r in flag_runs(df, "k", order, "v", "seq", rows_per_chunk=int(width)).collect()}
    assert got == _expected(rows, brute.flag_runs)


@pytest.mark.parametrize("rows_per_chunk", [9, 60])
def test_random_equivalence_per_key_chunks(spark, rows_per_chunk):
    """Default chunking: keys above rows_per_chunk are cut by their own span."""
    rows = _random_rows(5)
    df = spark.createDataFrame(rows, SCHEMA)
    order, kw = ["t", "seq"], {"rows_per_chunk": rows_per_chunk}
    got = {tuple(r) for r in pair_average(df, "k", order, "v", "seq", **kw).collect()}
    assert got == _expected(rows, brute.pair_average)
    got = {tuple(r) for r in record_runs(df, "k", order, "v", "seq", **kw).collect()}
    assert got == _expected(rows, brute.record_runs)
    got = {(r.k, r.n_samples, r.end_time) for r in flag_runs(df, "k", order, "v", "seq", **kw).collect()}
    assert got == _expected(rows, brute.flag_runs)
    got = {tuple(r) for r in pair_average(df, None, order, "v", "seq", **kw).collect()}
    assert got == _expected(rows, brute.pair_average, key=False)


def test_per_key_chunks_split_only_hot_keys(spark):
    rows = _random_rows(4)
    df = spark.createDataFrame(rows, SCHEMA)
    ch, cut = chunking(df, "k", ["t", "seq"], rows_per_chunk=300)
    assert cut
    per_key = {r.k: r.n for r in ch.groupBy("k").agg(F.countDistinct("__c").alias("n")).collect()}
    assert per_key[0] >= 3  # the hot key (900 rows) is cut by its own span
    assert all(n == 1 for k, n in per_key.items() if k != 0)  # the others stay whole


@pytest.mark.parametrize("width", [7.0, 1e12])
def test_global_sequence(spark, width):
    rows = _random_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in pair_average(df, None, ["t", "seq"], "v", "seq", rows_per_chunk=int(width)).collect()}
    assert got == _expected(rows, brute.pair_average, key=False)
    got = {tuple(r) for r in record_runs(df, None, ["t", "seq"], "v", "seq", rows_per_chunk=int(width)).collect()}
    assert got == _expected(rows, brute.record_runs, key=False)


def test_hot_key_is_split_into_chunks(spark):
    rows = _random_rows(4)
    df = spark.createDataFrame(rows, SCHEMA)
    ch, _ = chunking(df, "k", ["t", "seq"], rows_per_chunk=100)
    per_chunk = ch.groupBy("__k", "__c").count()
    assert per_chunk.agg(F.max("count")).first()[0] <= 250
    assert ch.where("k = 0").select("__c").distinct().count() > 5


@pytest.mark.parametrize("size,rows_per_chunk", [(1, 3), (3, 1), (3, 7), (5, 2), (7, 50)])
def test_groups_over_many_chunks(spark, size, rows_per_chunk):
    """Groups that span several chunks: the carried sum comes from all of them."""
    rows = _random_rows(6)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.average for r in pair_average(df, None, ["t", "seq"], "v", "seq", size=size, rows_per_chunk=rows_per_chunk).collect())
    values = [r[3] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
    assert got == sorted(int(sum(values[i:i + size]) / size) for i in range(0, len(values) - size + 1, size))


def test_cuts_have_no_limit(spark):
    """One key of 3,000 rows in chunks of one row: thousands of cuts, by text and NULL order columns too."""
    df = spark.range(3000).selectExpr("IF(id < 5, NULL, concat('t', lpad(cast(id div 2 as string), 5, '0'))) AS t", "id AS seq", "cast(id % 3 = 0 as int) AS v")
    chunked, _ = chunking(df, None, ["t", "seq"], rows_per_chunk=1)
    assert chunked.select("__c").distinct().count() >= 2999
    small = record_runs(df, None, ["t", "seq"], "v", "seq", rows_per_chunk=50)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, record_runs(df, None, ["t", "seq"], "v", "seq").collect()))


def test_null_keys_form_their_own_group(spark):
    rows = [(0, None, 0, 1), (1, None, 1, 1), (2, 1, 2, 1), (3, 1, 3, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.k is None, r.create_time) for r in pair_average(df, "k", ["t", "seq"], "v", "seq").collect())
    assert got == [(False, 3), (True, 1)]


@pytest.mark.parametrize("shape", ["burst", "ties", "nulls", "constant"])
def test_bursts_and_ties_are_split(spark, shape):
    """99 % of the rows at nearly one instant, at exactly one, or without a time: no chunk is far above its target."""
    n = 6000
    t = {"burst": lambda i: i if i < 60 else 10 ** 6 + i % 50, "ties": lambda i: i if i < 60 else 10 ** 6,
         "nulls": lambda i: i if i < 60 else None, "constant": lambda i: 5}[shape]
    rows = [(t(i), 1, i, int(shape != "constant" and i % 3 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "t long, k int, seq long, v int")
    sizes = [r["count"] for r in chunking(df, "k", ["t", "seq"], rows_per_chunk=200)[0].groupBy("__k", "__c").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 440
    got = {tuple(r) for r in record_runs(df, "k", ["t", "seq"], "v", "seq", rows_per_chunk=200).collect()}
    whole = {tuple(r) for r in record_runs(df, "k", ["t", "seq"], "v", "seq").collect()}
    assert got == whole
    got = {tuple(r) for r in pair_average(df, None, ["t", "seq"], "v", "seq", rows_per_chunk=200).collect()}
    assert got == {tuple(r) for r in pair_average(df, None, ["t", "seq"], "v", "seq").collect()}


def test_nulls_and_other_flags_are_not_part_of_the_sequence(spark):
    """Batch and streaming agree: NULL values and flags other than 0/1 are skipped."""
    import pandas as pd

    from rillet.streaming.processors import FlagRunProcessor, RecordRunProcessor
    from tests.test_processors import _Handle

    vals = [1, 1, None, 1, 0, 2, 0, 1, None, 1, 1, 0]
    df = spark.createDataFrame([(i, 1, i, v) for i, v in enumerate(vals)], SCHEMA)
    clean = [(i, v) for i, v in enumerate(vals) if v is not None]
    expect_flags = sorted(brute.flag_runs([(i, v) for i, v in clean if v in (0, 1)]))
    batch = sorted((r.n_samples, r.end_time) for r in flag_runs(df, "k", ["t", "seq"], "v", "seq").collect())
    assert batch == expect_flags
    batch = sorted((r.create_time, r.value, r.run_length) for r in record_runs(df, "k", ["t", "seq"], "v", "seq").collect())
    assert batch == sorted(brute.record_runs(clean))

    pdf = pd.DataFrame({"seq": range(len(vals)), "t": range(len(vals)), "v": pd.array(vals, dtype="Int64")})
    p = FlagRunProcessor(["k"], ["t", "seq"], "v", "t")
    p.init(_Handle())
    got = sorted((r.n_samples, r.end_time) for out in p.handleInputRows((1,), iter([pdf]), None)
                 for r in out.itertuples())
    assert got == expect_flags
    p = RecordRunProcessor(["k"], ["t", "seq"], "v", "t")
    p.init(_Handle())
    got = sorted((r.create_time, r.value, r.run_length) for out in p.handleInputRows((1,), iter([pdf]), None)
                 for r in out.itertuples())
    assert got == sorted(brute.record_runs(clean))


@pytest.mark.parametrize("emit_empty_first", [True, False])
def test_keys_with_flag_runs_matches_output(spark, emit_empty_first):
    from rillet.operators import keys_with_flag_runs

    rows = _random_rows(7)
    rows += [(10_000 + i, 100 + i // 3, i, v) for i, v in enumerate([1, 1, 1, 0, 0, 0, 1, 0, 0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.k for r in keys_with_flag_runs(df, "k", ["t", "seq"], "v", emit_empty_first).collect()}
    out = {r.k for r in flag_runs(df, "k", ["t", "seq"], "v", "seq", emit_empty_first).collect()}
    assert got == out


def test_chunked_equals_whole_on_skewed_events(spark):
    """sf0.1 events keyed by event_type: 5 keys of ~20,000 rows. Cutting each
    key into ~10 chunks gives the same rows as keeping every key whole."""
    from rillet.operators import running_aggregate
    from rillet.sources.tables import load

    ev = load(spark, "/root/testdata/sf0.1", "events")
    df = ev.select("event_id", "ts", "event_type",
                   F.pmod(F.get_json_object("props", "$.k").cast("int"), F.lit(2)).alias("bit"))
    o = ["ts", "event_id"]
    for op in (lambda **kw: pair_average(df, "event_type", o, "bit", "ts", **kw),
               lambda **kw: record_runs(df, "event_type", o, "bit", "ts", **kw),
               lambda **kw: flag_runs(df, "event_type", o, "bit", "ts", **kw),
               lambda **kw: running_aggregate(df, "event_type", o, "bit", "sum", "run", **kw)):
        whole, cut = op(), op(rows_per_chunk=2000)
        assert whole.count() == cut.count()
        assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_chunked_without_aqe_or_broadcasts(spark):
    """With AQE off and no automatic broadcasts the summaries are joined by
    sort-merge; results stay the same as with every key whole."""
    from rillet.operators import running_aggregate
    from rillet.sources.tables import load, role_bits, role_signal

    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = load(spark, "/root/testdata/sf0.001", "events")
        bits, sig, o = role_bits(ev), role_signal(ev), ["ts", "event_id"]
        for op in (lambda **kw: pair_average(bits, "user_id", o, "bit", "ts", **kw),
                   lambda **kw: record_runs(bits, None, o, "bit", "ts", **kw),
                   lambda **kw: flag_runs(sig, "user_id", o, "flag", "ts", **kw),
                   lambda **kw: running_aggregate(ev.select("event_id", "ts", "event_type"), "event_type", o,
                                                  None, "count", "n", **kw)):
            whole, cut = op(), op(rows_per_chunk=9)
            assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["k", None])
def test_small_chunks_leave_the_driver_few_cuts(spark, key, monkeypatch):
    """More chunks than the driver may hold cuts: ties share a chunk, sizes stay near the target, results equal the whole."""
    from rillet.operators.scan import Cuts

    held = []
    monkeypatch.setattr(Cuts, "rank", lambda self, rank=Cuts.rank: held.append(self.n) or rank(self))
    df = spark.range(15000).selectExpr("id div 2 AS t", "IF(id < 14000, 0, id % 3) AS k", "id AS seq", "cast(id % 7 < 3 as int) AS v")
    chunked, cut = chunking(df, key, ["t", "seq"], rows_per_chunk=3)
    sizes = [r["count"] for r in chunked.groupBy("__k", "__c").count().collect()]
    assert cut and sum(sizes) == 15000 and max(sizes) <= 3
    for fn in (pair_average, record_runs, flag_runs):
        got, whole = (sorted(map(tuple, fn(df, key, ["t", "seq"], "v", "seq", **kw).collect())) for kw in ({"rows_per_chunk": 3}, {}))
        assert got == whole
    assert held and max(held) <= 4200
