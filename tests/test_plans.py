"""Physical-plan checks for the properties the operators are built for:
one shuffle of the rows, partial aggregation before a shuffle, pruned scans,
broadcast only of small sides."""

import contextlib
import io
import re

import pytest

from rillet.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _final_exchanges(plan: str) -> list[str]:
    """Partitioning arguments of the shuffles in the executed (final) plan."""
    tree = plan.split("== Initial Plan ==")[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    out = []
    for m in re.finditer(r"^\((\d+)\) Exchange\n(?:.*\n)*?Arguments: (.*)$", plan, re.M):
        if m.group(1) in ids:
            out.append(m.group(2))
    return out


def _sequence_plans(spark):
    """The sequence operators on the sf0.01 events with a small rows_per_chunk,
    so every key (and the global sequence) is cut into several chunks."""
    from rillet.operators import changelog, flag_runs, pair_average, record_runs, running_aggregate
    from rillet.sources.tables import load, role_bits, role_signal

    ev = load(spark, SF, "events")
    bits, sig, o = role_bits(ev), role_signal(ev), ["ts", "event_id"]
    kw = {"rows_per_chunk": 20}
    return {
        "record_runs": (record_runs(bits, "user_id", o, "bit", "ts", **kw), 1),
        "flag_runs": (flag_runs(sig, "user_id", o, "flag", "ts", **kw), 1),
        "record_runs_global": (record_runs(bits, None, o, "bit", "ts", rows_per_chunk=1000), 2),
        "pair_average": (pair_average(bits, "user_id", o, "bit", "ts", **kw), 2),
        "running_count": (running_aggregate(ev.select("event_id", "ts", "event_type"), "event_type", o, None,
                                            "count", "n", rows_per_chunk=500), 2),
        "changelog": (changelog(ev.select("event_id", "ts", "event_type"), "event_type", o, None, "count",
                                rows_per_chunk=500), 2),
    }


@pytest.mark.parametrize("name", ["record_runs", "flag_runs", "record_runs_global", "pair_average",
                                  "running_count", "changelog"])
def test_sequence_queries_shuffle_rows_once(spark, name):
    """Rows are shuffled once by (key, chunk). Order-free totals add one
    shuffle of partial aggregates (one row per chunk and task); run summaries
    reuse the row shuffle instead."""
    df, row_shuffles = _sequence_plans(spark)[name]
    df.collect()  # run this DataFrame's own plan, so explain shows AQE's final plan
    plan = _plan(df)
    by_chunk = [a for a in _final_exchanges(plan) if re.match(r"hashpartitioning\((__k#\d+L?, )?__c#\d+L", a)]
    assert len(by_chunk) == row_shuffles, by_chunk
    if row_shuffles == 1:
        assert "ReusedExchange" in plan


def test_sequence_queries_plan_at_most_two_scans(spark):
    """Rows and summary; without a cut the rows alone. No side is broadcast by force."""
    from rillet.operators import pair_average, record_runs
    from rillet.sources.tables import load, role_bits

    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # a broadcast that remains would be a hint
    try:
        plans = [_plan(df) for df, _ in _sequence_plans(spark).values()]
    finally:
        spark.conf.set(limit, before)
    for plan in plans:
        assert 1 <= len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) <= 2
        assert "BroadcastExchange" not in plan
    bits, o = role_bits(load(spark, SF, "events")), ["ts", "event_id"]
    for df in (pair_average(bits, "user_id", o, "bit", "ts"), record_runs(bits, None, o, "bit", "ts")):
        plan = _plan(df)
        assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
        assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


def test_signal_qa_reads_and_shuffles_the_events_once(spark):
    df = QUERIES["signal_qa"](spark, SF)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Scan parquet", final)) == 1 and final.count("ReusedExchange") == 2


def test_no_nested_loop_joins(spark):
    for df, _ in _sequence_plans(spark).values():
        assert "NestedLoopJoin" not in _plan(df) and "CartesianProduct" not in _plan(df)


def test_record_runs_of_one_value_spread_over_tasks(spark):
    """A constant bit: no stage gathers the rows of the value."""
    from rillet.operators import record_runs

    df = spark.range(40_000).selectExpr("id AS t", "id AS seq", "1 AS v")
    rows = record_runs(df, None, ["t", "seq"], "v", "seq", rows_per_chunk=1000)
    plan = _plan(rows)
    assert not [a for a in _final_exchanges(plan) if re.match(r"hashpartitioning\((__k#\d+L?, )?v#\d+", a) and "__max" not in plan]
    assert rows.count() == 39_999


def test_word_count_pre_aggregates_and_prunes(spark):
    plan = _plan(QUERIES["word_count"](spark, SF))
    assert "partial_count" in plan
    assert re.search(r"ReadSchema: struct<text:string>", plan)


def test_team_spend_broadcasts_dimension_after_aggregating(spark):
    plan = _plan(QUERIES["team_spend"](spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "partial_sum" in plan
    assert re.search(r"ReadSchema: struct<c_nationkey:int,c_acctbal:double>", plan)


def test_window_summary_prunes_columns(spark):
    plan = _plan(QUERIES["window_summary"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", plan)
    assert "partial_avg" in plan
