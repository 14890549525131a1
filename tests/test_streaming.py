"""Streaming forms: equal to batch over several micro-batches with a restart
from the checkpoint in between; watermark behaviour on late rows; sinks."""

import datetime as dt
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rillet.plans import jobs as J
from rillet.sources.tables import role_bits, role_signal
from rillet.streaming import (
    ProgressTotals, append_sink, changelog_records, fan_out, progress_report, read_upserted, run_available, stream_flag_runs,
    stream_latest, stream_pair_average, stream_record_runs, stream_table, stream_window_summary, upsert_batch,
    upsert_sink,
)
from rillet.operators import changelog
from rillet.schemas import EVENTS

SF = "/root/testdata/sf0.001"
ORDER = ["ts", "event_id"]


def _stamp(path, i):
    """The file source takes files oldest first by (millisecond) modification
    time; give each file its own second so arrival order is the file order."""
    t = 1_700_000_000 + 10 * i
    os.utime(path, (t, t))


def _write_slices(spark, src, folder, n):
    """Split events into n files in ts order, written one after another."""
    pdf = src.orderBy("ts", "event_id").toPandas()
    os.makedirs(folder, exist_ok=True)
    size = (len(pdf) + n - 1) // n
    paths = []
    for i in range(n):
        part = pdf.iloc[i * size:(i + 1) * size]
        table = pa.Table.from_pandas(part, preserve_index=False).cast(pa.schema([
            ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()),
            ("event_type", pa.string()), ("value", pa.float64()), ("props", pa.string())]))
        p = os.path.join(folder, f"events-{i:03d}.parquet")
        pq.write_table(table, p)
        _stamp(p, i)
        paths.append(p)
    return paths


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stateful_streams_equal_batch_across_restart(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    paths = _write_slices(spark, events, staging, 4)
    os.makedirs(live)

    def start(name, build):
        ev = stream_table(spark, live, "events", EVENTS, max_files_per_trigger=1)
        out = str(tmp_path / name)
        return append_sink(build(ev), out, str(tmp_path / f"{name}-ckpt"), trigger={"availableNow": True}), out

    builds = {
        "pairs": lambda ev: stream_pair_average(role_bits(ev), "user_id", ORDER, "bit", "ts"),
        "records": lambda ev: stream_record_runs(role_bits(ev), "user_id", ORDER, "bit", "ts"),
        "flags": lambda ev: stream_flag_runs(role_signal(ev), "user_id", ORDER, "flag", "ts"),
        "global_pairs": lambda ev: stream_pair_average(role_bits(ev), None, ORDER, "bit", "ts"),
    }
    for p in paths[:2]:
        os.replace(p, os.path.join(live, os.path.basename(p)))
    outs = {}
    for name, b in builds.items():
        q, outs[name] = start(name, b)
        run_available(q)
    for p in paths[2:]:
        os.replace(p, os.path.join(live, os.path.basename(p)))
    for name, b in builds.items():  # restart from the same checkpoint
        q, _ = start(name, b)
        run_available(q)
        assert progress_report(q)["input_rows"] > 0

    expect = {
        "pairs": J.pair_average_job(role_bits(events)),
        "records": J.record_runs_job(role_bits(events)),
        "flags": J.signal_runs(role_signal(events)),
        "global_pairs": J.pair_average_job(role_bits(events), None),
    }
    for name, exp in expect.items():
        got = spark.read.parquet(outs[name])
        assert _rows(got.select(*exp.columns)) == _rows(exp), name


def _signal_files(folder, batches):
    os.makedirs(folder, exist_ok=True)
    t = lambda s: dt.datetime(2024, 1, 1, 15, 0, s)
    for i, rows in enumerate(batches):
        table = pa.table({"user_id": pa.array([3] * len(rows), pa.int64()),
                          "ts": pa.array([t(s) for s, _, _ in rows], pa.timestamp("us")),
                          "value": pa.array([float(v) for _, v, _ in rows], pa.float64()),
                          "flag": pa.array([f for _, _, f in rows], pa.int32())})
        p = os.path.join(folder, f"sig-{i:03d}.parquet")
        pq.write_table(table, p)
        _stamp(p, i)


BASE = [(0, 1, 0), (14, 3, 1), (15, 5, 1)]
SIG_SCHEMA = "user_id long, ts timestamp_ntz, value double, flag int"


@pytest.mark.parametrize("batches,mean,n,dropped", [
    ([BASE, [(18, 7, 0)], [(20, 2, 0)], [(10, 9, 0)], [(21, 1, 0)]], 2.0, 2, 1),
    ([BASE, [(18, 7, 0)], [(10, 9, 0)], [(20, 1, 0)]], 13 / 3, 3, 0),
    ([BASE + [(18, 7, 0), (20, 2, 0), (10, 9, 0), (21, 1, 0)]], 13 / 3, 3, 0),
])
def test_window_watermark_late_rows(spark, tmp_path, batches, mean, n, dropped):
    folder = str(tmp_path / "sig")
    _signal_files(folder, batches)
    src = spark.readStream.schema(SIG_SCHEMA).option("maxFilesPerTrigger", "1").parquet(folder)
    out = str(tmp_path / "out")
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    q = append_sink(stream_window_summary(src, "user_id", "ts", "value", "flag"), out,
                    str(tmp_path / "ckpt"), trigger={"availableNow": True})
    run_available(q)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1  # the second window stays open
    r = rows[0]
    assert r.window_start == dt.datetime(2024, 1, 1, 15, 0, 0)
    assert r.n_elements == n and r.mean == pytest.approx(mean, rel=1e-6)
    read = sum(len(b) for b in batches)
    for _ in range(50):  # the listener hears of a batch a little later
        if totals.totals.get(str(q.id)) == (read, dropped):
            break
        time.sleep(0.2)
    spark.streams.removeListener(totals)
    assert totals.totals[str(q.id)] == (read, dropped)


def test_latest_stream_upsert(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = str(tmp_path / "ev")
    _write_slices(spark, events, folder, 3)
    ev = stream_table(spark, folder, "events", EVENTS, max_files_per_trigger=1)
    out = str(tmp_path / "latest")
    q = upsert_sink(stream_latest(role_signal(ev), "user_id", ORDER, "flag"), out, str(tmp_path / "ckpt"),
                    ["user_id"], ORDER, trigger={"availableNow": True})
    run_available(q)
    got = read_upserted(spark, out, ["user_id"], ORDER).select("user_id", "flag")
    assert _rows(got) == _rows(J.signal_current(role_signal(events)))


def test_upsert_replay_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    b0 = spark.createDataFrame([(1, 10, 0), (2, 20, 1), (1, 11, 2)], "k long, v long, seq long")
    upsert_batch(b0, 0, path, ["k"], ["seq"])
    upsert_batch(b0, 0, path, ["k"], ["seq"])  # replay of the same batch
    b1 = spark.createDataFrame([(2, 21, 3)], "k long, v long, seq long")
    upsert_batch(b1, 1, path, ["k"], ["seq"])
    got = _rows(read_upserted(spark, path, ["k"], ["seq"]).select("k", "v"))
    assert got == [(1, 11), (2, 21)]


def test_signal_state_gives_runs_and_current_flag(spark, tmp_path):
    """J5's event outputs from one state over several micro-batches, one of them replayed after a restart."""
    from rillet.streaming import read_batches
    from rillet.streaming.jobs import start_signal_qa

    events = spark.read.parquet(f"{SF}/events.parquet")
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    paths = _write_slices(spark, events, staging, 4)
    os.makedirs(live)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        ev = role_signal(stream_table(spark, live, "events", EVENTS, max_files_per_trigger=1))
        run_available(start_signal_qa(ev, out, ckpt, trigger={"availableNow": True}, only="events")["events"])

    for p in paths[:2]:
        os.replace(p, os.path.join(live, os.path.basename(p)))
    run()
    last = max(int(f) for f in os.listdir(f"{ckpt}/events/commits") if f.isdigit())
    for left in (str(last), f".{last}.crc"):  # the last batch is replayed
        os.remove(os.path.join(ckpt, "events", "commits", left))
    for p in paths[2:]:
        os.replace(p, os.path.join(live, os.path.basename(p)))
    run()
    signal = role_signal(events)
    assert _rows(read_batches(spark, f"{out}/runs").select("user_id", "n_samples", "end_time")) == _rows(J.signal_runs(signal))
    got = read_upserted(spark, f"{out}/current", ["user_id"], ORDER).select("user_id", "flag")
    assert _rows(got) == _rows(J.signal_current(signal))


def test_changes_equal_batch_across_restart(spark, tmp_path):
    from rillet.streaming import stream_changes

    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "event_type", F.when(F.col("user_id") > 3, F.col("user_id")).alias("user_id"))
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    paths = _write_slices(spark, events.withColumns({"value": F.lit(0.0), "props": F.lit("")}).select(EVENTS.fieldNames()), staging, 3)
    os.makedirs(live)
    out = str(tmp_path / "out")
    for p in paths:
        os.replace(p, os.path.join(live, os.path.basename(p)))
        ev = stream_table(spark, live, "events", EVENTS, max_files_per_trigger=1)
        run_available(append_sink(stream_changes(ev, ["user_id", "event_type"], ORDER, buckets=3), out, str(tmp_path / "ckpt"), trigger={"availableNow": True}))
    want = changelog(events, ["user_id", "event_type"], ORDER, None, "count", "count")
    rows = lambda df: sorted((tuple(r) for r in df.select(*want.columns).collect()), key=str)
    assert rows(spark.read.parquet(out)) == rows(want)


def test_word_changes_in_batches(spark, tmp_path):
    from rillet.streaming.jobs import start_word_changes

    batches = [[(5, "a b a c"), (3, " a  d"), (4, None), (None, "z")], [(7, "c a"), (6, "e a a"), (6, "a b")]]
    live, out = str(tmp_path / "live"), str(tmp_path / "out")
    for docs in batches:
        spark.createDataFrame(docs, "doc_id long, line string").write.mode("append").parquet(live)
        stream = spark.readStream.schema("doc_id long, line string").parquet(live)
        run_available(start_word_changes(stream, out, str(tmp_path / "ckpt"), {"availableNow": True}))
    docs = spark.createDataFrame([d for b in batches for d in b if d[0] is not None], "doc_id long, line string")
    want = J.word_count_changelog(docs)
    rows = lambda df: sorted((tuple(r) for r in df.select(*want.columns).collect()), key=str)
    assert rows(spark.read.parquet(out)) == rows(want)


def test_change_state_is_asked_by_cell():
    import numpy as np
    import pandas as pd
    from rillet.streaming.processors import ChangeProcessor

    class State(dict):
        asked = 0

        def getValue(self, k):
            self.asked += 1
            return self.get(k)

        updateValue = dict.__setitem__

    proc = ChangeProcessor(["word"], "`word` array<string>", ["doc_id", "pos"], places=True)
    proc.counts = State()
    words = [f"w{i}" for i in range(1000)]
    frame = pd.DataFrame({"word": [*words, "w0"], "doc_id": [np.array([4, 9])] * 1000 + [np.array([2])], "pos": [np.array([1, 0])] * 1000 + [np.array([7])],
                          "__bucket": 0, "__cell": [i % 4 for i in range(1000)] + [0]})
    for n, asked in ((0, 4), (2, 8)):
        out = pd.concat(proc.handleInputRows((0,), iter([frame]), None)).set_index("word")
        assert proc.counts.asked == asked
        assert out.loc["w1", "n"] == n and out.loc["w0", "n"] == (0 if n == 0 else 3)
        assert out.loc["w0", "doc_id"].tolist() == [2, 4, 9] and out.loc["w0", "pos"].tolist() == [7, 1, 0]


def test_segments_arrival_order_and_start(spark, tmp_path):
    from rillet.schemas import BITS
    from rillet.sources import read_json_stream, read_segments

    path = str(tmp_path / "log")
    write = lambda xs: spark.createDataFrame([(f'{{"binaryInt":{x}}}',) for x in xs], "value string").coalesce(1).write.mode("append").parquet(path)
    write([3, 1, 2])
    old = [r["binaryInt"] for r in read_json_stream(spark, BITS, "segments", path, {"startingOffsets": "earliest-offset"}, streaming=False)
           .orderBy("partition", "offset").collect()]
    assert old == [3, 1, 2]
    time.sleep(1.1)
    from datetime import datetime, timezone
    since = datetime.now(timezone.utc).isoformat()
    time.sleep(1.1)
    write([9])
    assert read_segments(spark, path, "latest", since, streaming=False).count() == 1
    assert read_segments(spark, path, "latest", streaming=False).count() == 0
    assert read_segments(spark, path, streaming=False).count() == 4
    with pytest.raises(ValueError):
        read_segments(spark, path, "middle")


def test_fan_out_one_read_many_sinks(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    folder = str(tmp_path / "ev")
    _write_slices(spark, events, folder, 2)
    ev = role_signal(stream_table(spark, folder, "events", EVENTS, max_files_per_trigger=1))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    writers = {
        "raw": lambda df, i: df.write.mode("overwrite").parquet(f"{a}/batch={i}"),
        "flags": lambda df, i: df.groupBy("user_id").agg(F.sum("flag").alias("n"))
                                 .write.mode("overwrite").parquet(f"{b}/batch={i}"),
    }
    run_available(fan_out(ev, writers, str(tmp_path / "ckpt"), trigger={"availableNow": True}))
    assert spark.read.parquet(a).count() == events.count()
    total = spark.read.parquet(b).agg(F.sum("n")).first()[0]
    assert total == events.where("event_type = 'error'").count()


def test_changelog_records(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2)], "word string, seq long")
    ch = changelog(df, "word", ["seq"], None, "count", "count").orderBy("seq", "change_seq")
    recs = [json.loads(r.value) for r in changelog_records(ch.drop("seq", "change_seq")).collect()]
    assert recs == [{"data": [{"word": "a", "count": 1}], "type": "INSERT"},
                    {"data": [{"word": "b", "count": 1}], "type": "INSERT"},
                    {"data": [{"word": "a", "count": 1}], "type": "DELETE"},
                    {"data": [{"word": "a", "count": 2}], "type": "INSERT"}]


def test_json_messages_with_quarantine(spark, tmp_path):
    """Signal messages as JSON lines: bad ones go to a quarantine sink, the
    good ones through the window summary; the query keeps running."""
    from rillet.schemas import SIGNAL
    from rillet.sources import read_json_stream, split_quarantine, with_event_time

    folder = tmp_path / "msgs"
    folder.mkdir()
    good = [{"createTime": f"2024-01-01 15:00:{s:02d}", "baselineId": 3, "signalValue": v}
            for s, v in [(0, 1.0), (14, 3.0), (15, 5.0), (40, 2.0)]]
    lines = [json.dumps(m) for m in good] + ['{"createTime":"junk","baselineId":"x"}', '{"createTime":']
    (folder / "m-000.json").write_text("\n".join(lines) + "\n")
    msgs = with_event_time(read_json_stream(spark, SIGNAL, transport="text", path=str(folder)), "createTime")
    ok, bad = split_quarantine(msgs, required=("ts", "baselineId"))
    signal = ok.select(F.col("baselineId").alias("user_id"), F.col("ts"),
                       F.col("signalValue").alias("value"), F.lit(0).alias("flag"))
    out, qdir = str(tmp_path / "out"), str(tmp_path / "quarantine")
    run_available(append_sink(stream_window_summary(signal, "user_id", "ts", "value", "flag"), out,
                              str(tmp_path / "c1"), trigger={"availableNow": True}))
    run_available(append_sink(bad, qdir, str(tmp_path / "c2"), trigger={"availableNow": True}))
    got = sorted((r.window_start.second, r.n_elements) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (15, 1)]  # the window at 15:00:30 is still open
    assert spark.read.parquet(qdir).count() == 2


def test_stream_table_reads_spark_written_table(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.read.parquet(f"{SF}/events.parquet").write.parquet(f"{folder}/events.parquet")
    ev = stream_table(spark, folder, "events", EVENTS)
    out = str(tmp_path / "out")
    run_available(append_sink(ev.select("event_id"), out, str(tmp_path / "ck"), trigger={"availableNow": True}))
    assert spark.read.parquet(out).count() == 1000


def test_read_upserted_before_any_batch(spark, tmp_path):
    got = read_upserted(spark, str(tmp_path / "none"), ["k"], ["seq"], schema="k long, v long, seq long")
    assert got.count() == 0 and got.columns == ["k", "v", "seq"]
    upsert_batch(spark.createDataFrame([], "k long, v long, seq long"), 0, str(tmp_path / "t"), ["k"], ["seq"])
    assert read_upserted(spark, str(tmp_path / "t"), ["k"], ["seq"], schema="k long, v long, seq long").count() == 0
    with pytest.raises(Exception):
        read_upserted(spark, str(tmp_path / "none"), ["k"], ["seq"])


def test_stream_table_takes_only_its_table(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.range(5)
    for name in ("part", "partsupp", "part-1"):
        rows.toPandas().to_parquet(f"{folder}/{name}.parquet")
    for i, where in enumerate((folder, f"file://{folder}")):
        out = str(tmp_path / f"out{i}")
        run_available(append_sink(stream_table(spark, where, "part", rows.schema), out, str(tmp_path / f"ck{i}"), trigger={"availableNow": True}))
        assert spark.read.parquet(out).count() == 10
    with pytest.raises(FileNotFoundError):
        stream_table(spark, folder, "lineitem", rows.schema)
    spark.range(7).write.parquet(f"{folder}/dir.parquet")
    out = str(tmp_path / "outd")
    run_available(append_sink(stream_table(spark, f"file://{folder}", "dir", rows.schema), out, str(tmp_path / "ckd"), trigger={"availableNow": True}))
    assert spark.read.parquet(out).count() == 7


def test_message_with_null_fields_is_not_corrupt(spark):
    from rillet.sources import decode_json

    raw = spark.createDataFrame([('{"a":null}',), ("{}",), ("[1]",), ('{"a":',), ("nonsense",)], "value string")
    assert [r._corrupt_record is None for r in decode_json(raw, __import__("pyspark").sql.types.StructType.fromDDL("a int")).collect()] \
        == [True, True, False, False, False]


@pytest.mark.parametrize("name", ["stream_pair_average_global", "stream_record_runs_global"])
def test_global_streams_take_bounded_slices(spark, name, monkeypatch):
    """A global sequence over several micro-batches of bounded rows gives what one micro-batch gives."""
    from rillet.plans import catalog

    taken = []
    add = catalog._Slices.add
    monkeypatch.setattr(catalog, "ROWS_PER_SLICE", 200, raising=False)
    monkeypatch.setattr(catalog._Slices, "add", lambda self, rows, start: taken.append(self.table.where(rows).count()) or add(self, rows, start))
    batch = catalog.QUERIES[name.removeprefix("stream_")](spark, SF)
    got = catalog.STREAM_QUERIES[name](spark, SF)
    assert _rows(got.select(*batch.columns)) == _rows(batch)
    assert len(taken) > 2 and max(taken) <= 500


def test_one_call_handles_many_keys(spark, tmp_path, monkeypatch):
    """Keyed record and flag runs, NULL keys too, over several micro-batches: buckets of keys, not one call per key."""
    from rillet.streaming import queries

    monkeypatch.setattr(queries, "BUCKETS", 3, raising=False)
    events = spark.read.parquet(f"{SF}/events.parquet").withColumns({
        "user_id": F.when(F.col("user_id") > 2, F.col("user_id")), "event_type": F.when(F.col("event_id") % 7 > 0, F.col("event_type")),
        "props": F.when(F.col("event_id") % 11 > 0, F.col("props"))})  # NULL keys, flags and bits
    folder = str(tmp_path / "ev")
    _write_slices(spark, events, folder, 3)
    ev = stream_table(spark, folder, "events", EVENTS, max_files_per_trigger=1)
    streams = {"records": (queries.stream_record_runs(role_bits(ev), "user_id", ORDER, "bit", "ts"), J.record_runs_job(role_bits(events))),
               "flags": (queries.stream_flag_runs(role_signal(ev), "user_id", ORDER, "flag", "ts"), J.signal_runs(role_signal(events)))}
    for name, (stream, want) in streams.items():
        assert "__bucket" in stream._jdf.queryExecution().analyzed().toString()
        run_available(append_sink(stream, str(tmp_path / name), str(tmp_path / f"{name}-ckpt"), trigger={"availableNow": True}))
        got = spark.read.parquet(str(tmp_path / name)).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
