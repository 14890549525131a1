"""Registered queries over the driver's tables and their SQL oracles.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE_SQL[name]`` is
the same result written as plain SQL over the tables (a DuckDB dialect), for
an independent check. Column names agree between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillet.functions.text import WHITESPACE_RE2
from rillet.functions.udtf import split_words
from rillet.functions.flags import document_id
from rillet.functions.time import epoch_millis, to_ntz
from rillet.operators.aggregates import changelog, running_aggregate, running_folds, spread
from rillet.operators.lookup import lookup
from rillet.operators.scan import Cuts
from rillet.operators.sequences import keys_with_flag_runs
from rillet.plans import dashboards as D
from rillet.plans import jobs as J
from rillet.session import scratch_path
from rillet.sources.files import from_rows, read_csv_lines, read_text_lines
from rillet.sources.json_stream import ARRIVAL, decode_json, kafka_options_from_connector, read_json_stream, split_quarantine, with_event_time
from rillet.sources.tables import load, register_views, role_bits, role_lines, role_payments, role_signal, role_teams
from rillet.streaming import jobs as SJ
from rillet.streaming.queries import (
    run_available, run_with_restarts, stream_changes, stream_flag_runs, stream_latest, stream_pair_average, stream_table, stream_window_summary,
)
from rillet.streaming.sinks import (
    append_sink, changelog_records, observed, read_batches, read_upserted, upsert_batch, upsert_sink, write_changelog_json, write_text_rows,
)

AVAILABLE = {"availableNow": True}


def _events(spark, d):
    return load(spark, d, "events")


def _signal(spark, d):
    return role_signal(_events(spark, d))


def _bits(spark, d):
    return role_bits(_events(spark, d))


def q_word_count(spark, d):
    return J.word_count_job(role_lines(load(spark, d, "documents")))


def q_word_count_udtf(spark, d):
    return split_words(spread(role_lines(load(spark, d, "documents")))) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def q_word_count_changelog(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.col("text").alias("line"))
    return J.word_count_changelog(docs)


def q_team_spend(spark, d):
    return J.team_spend(role_payments(load(spark, d, "customer")), role_teams(load(spark, d, "nation")))


def q_team_spend_changelog(spark, d):
    payments = load(spark, d, "customer").select(F.col("c_nationkey").alias("team_id"),
                                                  F.col("c_acctbal").alias("pay_amount"),
                                                  F.col("c_custkey").alias("order_id"))
    return J.team_spend_changelog(payments, role_teams(load(spark, d, "nation")))


def q_keyed_sum(spark, d):
    return J.keyed_spend(_signal(spark, d))


def q_running_count(spark, d):
    ev = _events(spark, d).select("event_id", "ts", "event_type")
    r = running_aggregate(ev, "event_type", J.SIGNAL_ORDER, None, "count", "running_count")
    return r.select("event_id", "event_type", "running_count")


def q_changelog(spark, d):
    ev = _events(spark, d).select("event_id", "ts", "event_type")
    return changelog(ev, "event_type", J.SIGNAL_ORDER, None, "count", "value")


def q_window_summary(spark, d):
    return J.signal_summary(_signal(spark, d))


def q_pair_average(spark, d):
    return J.pair_average_job(_bits(spark, d), "user_id")


def q_pair_average_global(spark, d):
    return J.pair_average_job(_bits(spark, d), None)


def q_record_runs(spark, d):
    return J.record_runs_job(_bits(spark, d), "user_id")


def q_record_runs_global(spark, d):
    return J.record_runs_job(_bits(spark, d), None)


def q_flag_runs(spark, d):
    return J.signal_runs(_signal(spark, d))


def q_latest_flag(spark, d):
    return J.signal_current(_signal(spark, d))


def q_signal_qa(spark, d):
    return J.signal_qa_union(_signal(spark, d))


def q_dash_d1(spark, d):
    # Every signal key has a current flag: the top keys come from the signal.
    signal = _signal(spark, d)
    return D.current_flag_panel(J.signal_current(signal), keys_from=signal)


def q_dash_d2(spark, d):
    # Every signal row lands in a window: the top keys come from the signal.
    signal = _signal(spark, d)
    return D.signal_panel(J.signal_summary(signal), keys_from=signal)


def q_dash_d3(spark, d):
    # The keys that have runs come from one aggregate of the signal; the runs
    # are then computed for the 5 largest of them only (runs are per key).
    signal = _signal(spark, d)
    with_runs = keys_with_flag_runs(signal, "user_id", J.SIGNAL_ORDER, "flag")
    return D.run_panel(J.signal_runs(D.top_key_rows(signal, "user_id", with_runs)), keys_from=with_runs)


def q_dash_d4_sum(spark, d):
    return D.spend_sum_panel(q_team_spend(spark, d))


def q_dash_d4_max(spark, d):
    return D.spend_max_panel(q_team_spend(spark, d))


def q_dash_d5(spark, d):
    return D.average_distribution_panel(q_pair_average(spark, d))


def q_dash_d6(spark, d):
    return D.record_run_panel(q_record_runs(spark, d))


# ------------------------------------------------ streaming forms
# Each runs its streaming query over the table folder (availableNow) into a
# table under the checkpoint folder and returns that table.


def _stream(spark, d, name):
    schema = load(spark, d, name).schema
    return stream_table(spark, d, name, schema)


def _run(spark, name, start):
    out, ckpt = scratch_path(spark, name), scratch_path(spark, f"{name}-ckpt")
    run_available(start(out, ckpt))
    return out


def q_stream_word_count(spark, d):
    lines = role_lines(_stream(spark, d, "documents"))
    out = _run(spark, "stream_word_count", lambda o, c: SJ.start_word_count(lines, o, c, AVAILABLE))
    return read_upserted(spark, out, ["word"], ["count"]).select("word", "count")


def q_stream_team_spend(spark, d):
    pays = role_payments(_stream(spark, d, "customer"))
    teams = role_teams(load(spark, d, "nation"))
    out = _run(spark, "stream_team_spend", lambda o, c: SJ.start_team_spend(pays, teams, o, c, AVAILABLE))
    return read_upserted(spark, out, ["team"], ["pay_amount"]).select("team", "pay_amount")


def _pair_stream(spark, d, key):
    bits = role_bits(_stream(spark, d, "events"))
    return spark.read.parquet(_run(spark, "stream_pair_average", lambda o, c: SJ.start_pair_average(bits, o, c, key, AVAILABLE)))


def q_stream_pair_average(spark, d):
    return _pair_stream(spark, d, "user_id").select("user_id", "create_time", "average")


def q_stream_pair_average_global(spark, d):
    out = _in_time_slices(spark, d, "stream_pair_average_global", lambda s, o, c: SJ.start_pair_average(role_bits(s), o, c, None, AVAILABLE))
    return out.select("create_time", "average")


def _record_stream(spark, d, key):
    bits = role_bits(_stream(spark, d, "events"))
    return spark.read.parquet(_run(spark, "stream_record_runs", lambda o, c: SJ.start_record_runs(bits, o, c, key, AVAILABLE)))


def q_stream_record_runs(spark, d):
    return _record_stream(spark, d, "user_id").select("user_id", "create_time", "value", "run_length")


def q_stream_record_runs_global(spark, d):
    out = _in_time_slices(spark, d, "stream_record_runs_global", lambda s, o, c: SJ.start_record_runs(role_bits(s), o, c, None, AVAILABLE))
    return out.select("create_time", "value", "run_length")


def q_stream_window_summary(spark, d):
    signal = role_signal(_stream(spark, d, "events"))
    out = _run(spark, "stream_window_summary", lambda o, c: SJ.start_signal_qa(signal, o, c, trigger=AVAILABLE, only="summary")["summary"])
    return spark.read.parquet(f"{out}/summary")


def q_stream_signal_qa(spark, d):
    """All three outputs of J5 from one run: the event sinks share one read."""
    signal = role_signal(_stream(spark, d, "events"))
    out, ckpt = scratch_path(spark, "stream_signal_qa"), scratch_path(spark, "stream_signal_qa-ckpt")
    for q in SJ.start_signal_qa(signal, out, ckpt, trigger=AVAILABLE).values():
        run_available(q)
    return J.tag_outputs({"summary": spark.read.parquet(f"{out}/summary"), "runs": read_batches(spark, f"{out}/runs"),
                          "current": read_upserted(spark, f"{out}/current", ["user_id"], J.SIGNAL_ORDER).select("user_id", "flag")})


def q_stream_flag_runs(spark, d):
    signal = role_signal(_stream(spark, d, "events"))
    out = _run(spark, "stream_flag_runs",
               lambda o, c: append_sink(stream_flag_runs(signal, "user_id", J.SIGNAL_ORDER, "flag", "ts"), o, c, trigger=AVAILABLE))
    return spark.read.parquet(out).select("user_id", "n_samples", "end_time")


class _Slices:
    """A table handed to a stream slice by slice: each :meth:`add` writes the next rows to the
    stream's folder and runs the query, from its checkpoint, over them (one micro-batch)."""

    def __init__(self, spark, table: DataFrame, name: str):
        self.spark, self.table = spark, table
        self.folder, self.out, self.ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("in", "out", "ckpt"))

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.table.schema).parquet(self.folder)

    def add(self, rows, start):
        self.table.where(rows).write.mode("append").parquet(self.folder)
        return run_available(start(self.stream(), self.out, self.ckpt))


#: Events of a global sequence that one micro-batch, and so one task, holds.
ROWS_PER_SLICE = 1_000_000


def _in_time_slices(spark, d, name, start):
    """The result of a stream that is fed the events in their order, slice by slice, all by one checkpoint:
    a global sequence is one task per micro-batch, so its rows are bounded by the slice."""
    order = ["ts", "event_id"]
    last = {f"__last_{c}": F.col(c).isNull() for c in order}  # rows without a time come last, as in a micro-batch
    events = _events(spark, d).withColumns(last)
    cuts = Cuts(events, [x for c in order for x in (f"__last_{c}", c)], ROWS_PER_SLICE, key=False)
    if not cuts:
        slices = _Slices(spark, events.drop(*last), name)
        slices.add(F.lit(True), start)
        return spark.read.parquet(slices.out)
    return _slice_by_slice(spark, events.withColumn("__slice", cuts.rank()).drop(*last).repartition("__slice"), cuts.n + 1, name, start)


def _slice_by_slice(spark, rows, n, name, start):
    """The result of a stream that is fed the ``n`` slices of ``rows`` (column ``__slice``) one after the other."""
    path = scratch_path(spark, f"{name}-slices")
    rows.write.partitionBy("__slice").parquet(path)
    slices = _Slices(spark, spark.read.parquet(path), name)
    for i in range(n):
        slices.add(F.col("__slice") == i, start)  # reads one folder
    return spark.read.parquet(slices.out)


def _at(events: DataFrame, quarters: int):
    """The time after so many quarters of the events' time span, as a literal."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    return F.lit(first + (last - first) * quarters // 4)


CHANGELOG_CHECKPOINTS = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def q_stream_recovery(spark, d):
    """Record runs over two runs of one query: it stops after the first half and starts again from its
    checkpoint (RocksDB changelog checkpoints); runs that are open at the stop go on (W13)."""
    events = _events(spark, d)
    mid, slices = _at(events, 2), _Slices(spark, events, "stream_recovery")
    start = lambda s, o, c: SJ.start_record_runs(role_bits(s), o, c, "user_id", AVAILABLE)
    before = spark.conf.get(CHANGELOG_CHECKPOINTS, "false")
    spark.conf.set(CHANGELOG_CHECKPOINTS, "true")
    try:
        slices.add(F.col("ts") < mid, start)
        slices.add(F.col("ts") >= mid, start)
    finally:
        spark.conf.set(CHANGELOG_CHECKPOINTS, before)
    return spark.read.parquet(slices.out).select("user_id", "create_time", "value", "run_length")


def q_stream_restarts(spark, d):
    """The latest flag per key from a job that fails in its first attempt, half its output written, and is started
    again from its checkpoint after a fixed delay (W14)."""
    signal = role_signal(_stream(spark, d, "events"))
    out, ckpt = scratch_path(spark, "stream_restarts"), scratch_path(spark, "stream_restarts-ckpt")
    attempts = []

    def start():
        attempts.append(1)
        first = len(attempts) == 1

        def write(batch, batch_id):
            upsert_batch(batch.where("user_id % 2 = 0") if first else batch, batch_id, out, ["user_id"], J.SIGNAL_ORDER)
            if first:
                raise RuntimeError("lost on purpose")
        return [stream_latest(signal, "user_id", J.SIGNAL_ORDER, "flag").writeStream.outputMode("update")
                .option("checkpointLocation", ckpt).foreachBatch(write).trigger(**AVAILABLE).start()]

    if run_with_restarts(start, restarts=2, delay_s=0.2) or len(attempts) != 2:
        raise RuntimeError(f"{len(attempts)} attempts")
    return read_upserted(spark, out, ["user_id"], J.SIGNAL_ORDER).select("user_id", "flag")


LATE = "event_id % 97 = 0"  # these events arrive after all others


def q_stream_late_rows(spark, d):
    """Window summaries of three ordered micro-batches, the third of late rows: those of closed windows are
    dropped, those of open ones count. Two more rows hold what was observed: rows in, (key, window) groups dropped (W6)."""
    events = _events(spark, d)
    mid, slices = _at(events, 2), _Slices(spark, events, "stream_late_rows")

    def start(stream, out, ckpt):
        seen = role_signal(stream).observe("seen", F.count(F.lit(1)).alias("rows"))
        return append_sink(stream_window_summary(seen, "user_id", "ts", "value", "flag"), out, ckpt, AVAILABLE)

    totals = {"rows": 0, "dropped": 0}
    for rows in ((F.col("ts") < mid) & ~F.expr(LATE), (F.col("ts") >= mid) & ~F.expr(LATE), F.expr(LATE)):
        for k, v in observed(slices.add(rows, start), "seen").items():
            totals[k] += v
    windows = spark.read.parquet(slices.out).select(F.lit("window").alias("kind"), "user_id", "window_start", "n_elements", "n_flags")
    noted = spark.createDataFrame([(k, None, None, v, None) for k, v in totals.items()], windows.schema)
    return windows.unionByName(noted)


def _idle(spark, d, policy):
    events = _events(spark, d)
    early = _at(events, 1)
    key = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, policy)
    try:
        parts = []
        for name, rows in (("busy", F.col("user_id") % 2 == 0), ("idle", (F.col("user_id") % 2 == 1) & (F.col("ts") < early))):
            one = _Slices(spark, events.where(rows), f"stream_idle-{name}")
            one.table.write.parquet(one.folder)
            parts.append(role_signal(one.stream()).withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", "0 seconds"))
        counts = parts[0].unionByName(parts[1]).groupBy("user_id", F.window("ets", J.WINDOW).alias("w")).agg(F.count(F.lit(1)).alias("n_elements"))
        rows = counts.select(F.lit(policy).alias("policy"), "user_id", to_ntz(F.col("w.start")).alias("window_start"), "n_elements")
        return spark.read.parquet(_run(spark, "stream_idle", lambda o, c: append_sink(rows, o, c, AVAILABLE)))
    finally:
        spark.conf.set(key, before)


def q_stream_idle_sources(spark, d):
    """Two sources, one of which falls silent early: with the policy ``max`` the busy one's time closes windows, with ``min`` the
    idle one holds them open (W2, W3)."""
    return _idle(spark, d, "max").unionByName(_idle(spark, d, "min"))


#: Bytes of text that one micro-batch of the word changes takes.
TEXT_PER_SLICE = 512 << 20


def q_stream_word_count_changelog(spark, d):
    """Every change record of the streaming word count over three micro-batches, in order (A5, K2); over more where
    these would hold more than ``TEXT_PER_SLICE`` of text."""
    docs = load(spark, d, "documents").select("doc_id", F.col("text").alias("line")).where("doc_id is not null")
    cuts = Cuts.by_size(docs, ["doc_id"], F.octet_length("line"), TEXT_PER_SLICE, 3)
    # a slice is written by as many tasks as there are cores, but for small ones
    part = F.pmod(F.xxhash64("doc_id"), F.lit(spark.sparkContext.defaultParallelism))
    rows = docs.withColumn("__slice", cuts.rank() if cuts else F.lit(0))
    out = _slice_by_slice(spark, rows.repartition("__slice", part), cuts.n + 1, "stream_word_changes", lambda s, o, c: SJ.start_word_changes(s, o, c, AVAILABLE))
    return out.select("word", "op", "count", "doc_id", "pos", "change_seq")


def q_stream_changelog_json(spark, d):
    """The streaming change records as the CDC file's JSON lines, read back (K2)."""
    signal = role_signal(_stream(spark, d, "events"))
    out = _run(spark, "stream_changelog_json", lambda o, c: append_sink(
        changelog_records(stream_changes(signal, "user_id", J.SIGNAL_ORDER).select("op", "user_id", "count")), o, c, AVAILABLE, fmt="text"))
    return spark.read.text(out)


# Messages: the events as JSON text lines, some of them cut off.

CUT_OFF = 50  # every 50th message is cut


def _messages(spark, d):
    events = _events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "user_id", "event_type", "value")
    text = F.to_json(F.struct("*"))
    cut = F.when(F.col("event_id") % CUT_OFF == 0, F.expr("substring(value, 1, length(value) - 3)")).otherwise(F.col("value"))
    path = scratch_path(spark, "messages")
    events.select("event_id", text.alias("value")).select(cut.alias("value")).write.text(path)
    return path


MESSAGE = "event_id bigint, event_time string, user_id bigint, event_type string, value double"


def _decoded(spark, d, streaming):
    schema = StructType.fromDDL(MESSAGE)
    raw = read_json_stream(spark, schema, "text", _messages(spark, d), streaming=streaming)
    return with_event_time(raw, "event_time")


def _segments(spark, d):
    """The events as JSON messages in the files of a log, in an arrival order that is neither time nor identifier."""
    events = _events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "user_id", "event_type", "value")
    path = scratch_path(spark, "segments")
    mixed = F.md5(F.col("event_id").cast("string").cast("binary"))
    (events.select(F.to_json(F.struct("*")).alias("value"), mixed.alias("m")).repartitionByRange(8, "m").sortWithinPartitions("m")
     .select("value").write.parquet(path))
    return path


def q_stream_arrival_order(spark, d):
    """J3 over JSON messages in arrival order: file and row of the file, from the source's metadata, with the
    connector's start mode under its legacy name (S5, S6)."""
    options = kafka_options_from_connector({"connector.startup-mode": "earliest-offset", "connector.topic": "signal"})
    rows = read_json_stream(spark, StructType.fromDDL(MESSAGE), "segments", _segments(spark, d), options)
    bits = rows.select("user_id", *ARRIVAL, F.col("event_id").alias("last_event"), (F.col("event_type") == "error").cast("int").alias("bit"))
    out = _run(spark, "stream_arrival_order", lambda o, c: append_sink(
        stream_pair_average(bits, "user_id", list(ARRIVAL), "bit", "last_event"), o, c, AVAILABLE))
    return spark.read.parquet(out).select("user_id", F.col("create_time").alias("last_event"), "average")


def q_json_quarantine(spark, d):
    """Messages of each kind that decode, and those set aside."""
    good, bad = split_quarantine(_decoded(spark, d, False), ("event_id",))
    ok = good.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max(to_ntz(F.col("ts"))).alias("last"))
    return ok.unionByName(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("(bad)").alias("event_type"), "n", F.lit(None).cast("timestamp_ntz").alias("last")))


def q_json_decode(spark, d):
    props = _events(spark, d).select("event_id", F.col("props").alias("value"))
    return decode_json(props, StructType.fromDDL("k bigint"), keep=("event_id",)).select("event_id", "k", F.col("_corrupt_record").isNull().alias("ok"))


def q_stream_signal_qa_json(spark, d):
    """J5's event outputs from JSON messages: quarantine, event time, flag, runs and current flag."""
    good, _ = split_quarantine(_decoded(spark, d, True), ("event_id", "event_time"))
    signal = role_signal(good.withColumn("ts", to_ntz(F.col("ts"))))
    out, ckpt = scratch_path(spark, "stream_signal_qa_json"), scratch_path(spark, "stream_signal_qa_json-ckpt")
    run_available(SJ.start_signal_qa(signal, out, ckpt, trigger=AVAILABLE, only="events")["events"])
    runs = read_batches(spark, f"{out}/runs").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_runs"), F.max("n_samples").alias("longest"))
    current = read_upserted(spark, f"{out}/current", ["user_id"], J.SIGNAL_ORDER).select("user_id", "flag")
    return current.join(runs, "user_id", "left")


# Small chunks: the same results when every key is cut into many.

SMALL = 500


def q_pair_average_chunked(spark, d):
    return J.pair_average_job(_bits(spark, d), "user_id", rows_per_chunk=7)


def q_record_runs_chunked(spark, d):
    return J.record_runs_job(_bits(spark, d), "user_id", rows_per_chunk=7)


def q_record_runs_global_chunked(spark, d):
    return J.record_runs_job(_bits(spark, d), None, rows_per_chunk=SMALL)


def q_pair_average_global_chunked(spark, d):
    return J.pair_average_job(_bits(spark, d), None, rows_per_chunk=SMALL)


def q_flag_runs_chunked(spark, d):
    return J.signal_runs(_signal(spark, d), rows_per_chunk=7)


def _with_nulls(spark, d):
    ev = _events(spark, d)
    amount = F.when(F.col("event_id") % 3 != 0, F.col("event_id").cast("decimal(18,2)"))
    return ev.select("event_id", "ts", "event_type", F.when(F.col("user_id") % 5 != 0, amount).alias("amount"))


def q_running_sum_nulls(spark, d):
    r = running_aggregate(_with_nulls(spark, d), "event_type", J.SIGNAL_ORDER, "amount", "sum", "running", rows_per_chunk=SMALL)
    return r.select("event_id", F.col("running").cast("double").alias("running"))


def q_changelog_sum_nulls(spark, d):
    c = changelog(_with_nulls(spark, d), "event_type", J.SIGNAL_ORDER, "amount", "sum", "total", rows_per_chunk=SMALL)
    return c.select("event_type", "op", F.col("total").cast("double").alias("total"), "event_id", "change_seq")


def q_running_xor(spark, d):
    """A fold of the caller's own: the running bitwise exclusive or."""
    xor = (F.bit_xor, F.bit_xor, lambda a, b: F.coalesce(a.bitwiseXOR(b), a, b))
    r = running_folds(_events(spark, d).select("event_id", "ts", "event_type"), "event_type", J.SIGNAL_ORDER, {"folded": (xor, "event_id")}, rows_per_chunk=SMALL)
    return r.select("event_type", "event_id", "folded")


# Sources, sinks and helpers by themselves.


def q_document_ids(spark, d):
    ev = _events(spark, d)
    return ev.select("event_id", document_id("user_id", "event_type", F.when(F.col("event_id") % 2 == 0, F.col("event_id"))).alias("id"))


def q_epoch_millis(spark, d):
    ev = _events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return ev.select("event_id", epoch_millis(F.when(F.col("event_id") % 7 == 0, F.lit("no time")).otherwise(F.col("t"))).alias("ms"))


#: The panels' range over runs and records: their saved 15 minutes hold no run of the given tables.
RECENT_MINUTES = 3 * 24 * 60


def _as_of(spark, d):
    return _events(spark, d).agg(F.max("ts")).scalar()


def q_dash_d2_recent(spark, d):
    return D.signal_panel(J.signal_summary(_signal(spark, d)), as_of=_as_of(spark, d), minutes=15)


def q_dash_d3_recent(spark, d):
    return D.run_panel(J.signal_runs(_signal(spark, d)), as_of=_as_of(spark, d), minutes=RECENT_MINUTES)


def q_dash_d6_recent(spark, d):
    return D.record_run_panel(J.record_runs_job(_bits(spark, d), "user_id"), as_of=_as_of(spark, d), minutes=RECENT_MINUTES)


def q_literal_lookup(spark, d):
    """The current flags with their names, from a table written as literal rows."""
    names = from_rows(spark, [(0, "fine"), (1, "flagged")], "flag int, name string")
    return lookup(q_latest_flag(spark, d), names, "flag").select("user_id", "name")


def q_text_lines(spark, d):
    """Part names written as text lines, read back and counted by word."""
    path = scratch_path(spark, "lines")
    load(spark, d, "part").select("p_name").write.text(path)
    return J.word_count_job(read_text_lines(spark, path))


def q_csv_lines(spark, d):
    """Lines with commas, quoted as CSV, read back whole (S3)."""
    path = scratch_path(spark, "csv")
    line = F.concat_ws(", ", "p_name", F.lit('a "quoted" word'), F.col("p_partkey").cast("string"))
    load(spark, d, "part").select(line.alias("line")).write.option("quoteAll", True).option("escape", '"').csv(path)
    return read_csv_lines(spark, path)


def q_text_rows(spark, d):
    """Spend per team in whole cents through the row file, all columns (K3)."""
    path = scratch_path(spark, "rows")
    spend = J.team_spend(role_payments(load(spark, d, "customer")), role_teams(load(spark, d, "nation")))
    write_text_rows(spend.select("team", F.round(F.col("pay_amount") * 100).cast("long").alias("cents")), path)
    return spark.read.text(path)


#: J2 as a user of the catalog writes it: tables declared by DDL, the lookup by name, the job as SQL text.
TEAM_SPEND_DDL = {
    "payments_source": "CREATE OR REPLACE TEMPORARY VIEW payments_source (c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE) USING parquet OPTIONS (path '{d}/customer.parquet')",
    "teams_source": "CREATE OR REPLACE TEMPORARY VIEW teams_source (n_nationkey INT, n_name STRING) USING parquet OPTIONS (path '{d}/nation.parquet')"}
TEAM_SPEND_SQL = """
SELECT t.n_name AS team, CAST(sum(CAST(p.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS pay_amount
FROM payments_source p LEFT JOIN teams_source t ON p.c_nationkey = t.n_nationkey GROUP BY t.n_name"""


def q_sql_team_spend(spark, d):
    """J2 as DDL and SQL text over declared tables."""
    for ddl in TEAM_SPEND_DDL.values():
        spark.sql(ddl.format(d=d.rstrip("/")))
    return spark.sql(TEAM_SPEND_SQL)


def q_table_by_name(spark, d):
    """The current flag from a table looked up by name."""
    register_views(spark, d, ["events"])
    return J.signal_current(role_signal(spark.table("events")))


def q_changelog_json(spark, d):
    ch = q_changelog(spark, d).select("op", "event_type", "value")
    return changelog_records(ch)


def q_stream_latest_flag(spark, d):
    signal = role_signal(_stream(spark, d, "events"))
    out = _run(spark, "stream_latest_flag",
               lambda o, c: upsert_sink(stream_latest(signal, "user_id", J.SIGNAL_ORDER, "flag"), o, c,
                                        ["user_id"], J.SIGNAL_ORDER, trigger=AVAILABLE))
    return read_upserted(spark, out, ["user_id"], J.SIGNAL_ORDER).select("user_id", "flag")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_word_count": q_stream_word_count,
    "stream_team_spend": q_stream_team_spend,
    "stream_pair_average": q_stream_pair_average,
    "stream_record_runs": q_stream_record_runs,
    "stream_flag_runs": q_stream_flag_runs,
    "stream_latest_flag": q_stream_latest_flag,
    "stream_window_summary": q_stream_window_summary,
    "stream_pair_average_global": q_stream_pair_average_global,
    "stream_record_runs_global": q_stream_record_runs_global,
    "stream_signal_qa": q_stream_signal_qa,
    "stream_signal_qa_json": q_stream_signal_qa_json,
    "stream_word_count_changelog": q_stream_word_count_changelog,
    "stream_changelog_json": q_stream_changelog_json,
    "stream_recovery": q_stream_recovery,
    "stream_restarts": q_stream_restarts,
    "stream_late_rows": q_stream_late_rows,
    "stream_idle_sources": q_stream_idle_sources,
    "stream_arrival_order": q_stream_arrival_order,
}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": q_word_count,
    "word_count_udtf": q_word_count_udtf,
    "word_count_changelog": q_word_count_changelog,
    "team_spend": q_team_spend,
    "team_spend_changelog": q_team_spend_changelog,
    "keyed_sum": q_keyed_sum,
    "running_count": q_running_count,
    "changelog": q_changelog,
    "window_summary": q_window_summary,
    "pair_average": q_pair_average,
    "pair_average_global": q_pair_average_global,
    "record_runs": q_record_runs,
    "record_runs_global": q_record_runs_global,
    "flag_runs": q_flag_runs,
    "latest_flag": q_latest_flag,
    "signal_qa": q_signal_qa,
    "dash_d1": q_dash_d1,
    "dash_d2": q_dash_d2,
    "dash_d3": q_dash_d3,
    "dash_d4_sum": q_dash_d4_sum,
    "dash_d4_max": q_dash_d4_max,
    "dash_d5": q_dash_d5,
    "dash_d6": q_dash_d6,
    "pair_average_chunked": q_pair_average_chunked,
    "pair_average_global_chunked": q_pair_average_global_chunked,
    "record_runs_chunked": q_record_runs_chunked,
    "record_runs_global_chunked": q_record_runs_global_chunked,
    "flag_runs_chunked": q_flag_runs_chunked,
    "running_sum_nulls": q_running_sum_nulls,
    "changelog_sum_nulls": q_changelog_sum_nulls,
    "running_xor": q_running_xor,
    "changelog_json": q_changelog_json,
    "json_decode": q_json_decode,
    "json_quarantine": q_json_quarantine,
    "document_ids": q_document_ids,
    "epoch_millis": q_epoch_millis,
    "text_lines": q_text_lines,
    "csv_lines": q_csv_lines,
    "literal_lookup": q_literal_lookup,
    "text_rows": q_text_rows,
    "sql_team_spend": q_sql_team_spend,
    "table_by_name": q_table_by_name,
    "dash_d2_recent": q_dash_d2_recent,
    "dash_d3_recent": q_dash_d3_recent,
    "dash_d6_recent": q_dash_d6_recent,
}

# ---------------------------------------------------------------- oracles

_BIT = "CAST(json_extract_string(props, '$.k') AS INTEGER) % 2"
_FLAG = "CAST(event_type = 'error' AS INTEGER)"

_WORDS = f"""
SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '{WHITESPACE_RE2}')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

_WORD_CHANGES = f"""
WITH t AS (SELECT doc_id, unnest(a) AS word, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos
           FROM (SELECT doc_id, regexp_split_to_array(text, '{WHITESPACE_RE2}') AS a FROM documents)),
r AS (SELECT word, doc_id, pos,
             count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS c
      FROM t WHERE word <> '')
SELECT word, '+I' AS op, c AS count, doc_id, pos, 1 AS change_seq FROM r WHERE c = 1
UNION ALL
SELECT word, '-U' AS op, c - 1 AS count, doc_id, pos, 0 AS change_seq FROM r WHERE c > 1
UNION ALL
SELECT word, '+U' AS op, c AS count, doc_id, pos, 1 AS change_seq FROM r WHERE c > 1
"""

_TEAM_SPEND = """
SELECT n.n_name AS team, CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS pay_amount
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""

_TEAM_CHANGES = """
WITH p AS (SELECT n.n_name AS team, c.c_custkey AS order_id, CAST(c.c_acctbal AS DECIMAL(18,2)) AS amt
           FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
r AS (SELECT team, order_id, amt,
             sum(amt) OVER (PARTITION BY team ORDER BY order_id ROWS UNBOUNDED PRECEDING) AS cur,
             row_number() OVER (PARTITION BY team ORDER BY order_id) AS pos
      FROM p)
SELECT team, '+I' AS op, CAST(cur AS DOUBLE) AS pay_amount, order_id, 1 AS change_seq FROM r WHERE pos = 1
UNION ALL
SELECT team, '-U' AS op, CAST(cur - amt AS DOUBLE) AS pay_amount, order_id, 0 AS change_seq FROM r WHERE pos > 1
UNION ALL
SELECT team, '+U' AS op, CAST(cur AS DOUBLE) AS pay_amount, order_id, 1 AS change_seq FROM r WHERE pos > 1
"""

_SUMMARY = f"""
SELECT user_id,
       CAST(avg(CAST(value AS FLOAT)) AS FLOAT) AS mean,
       max(CAST(value AS FLOAT)) AS "max",
       min(CAST(value AS FLOAT)) AS "min",
       count(user_id) AS n_elements,
       CAST(sum({_FLAG}) AS BIGINT) AS n_flags,
       time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01') + INTERVAL 15 SECOND AS window_end
FROM events
GROUP BY user_id, time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01')
"""


def _pairs(partition: str) -> str:
    part = f"PARTITION BY {partition}" if partition else ""
    key_sel = f"{partition}, " if partition else ""
    return f"""
WITH b AS (SELECT user_id, ts, event_id, {_BIT} AS bit,
                  row_number() OVER ({part} ORDER BY ts, event_id) AS rn
           FROM events),
g AS (SELECT {key_sel}(rn - 1) // 2 AS grp, count(*) AS c, sum(bit) AS s, arg_max(ts, rn) AS create_time
      FROM b GROUP BY {key_sel}(rn - 1) // 2)
SELECT {key_sel}create_time, CAST(trunc(s / 2) AS INTEGER) AS average FROM g WHERE c = 2
"""


def _records(partition: str) -> str:
    p = f"PARTITION BY {partition}" if partition else ""
    pk = f"{partition}, " if partition else ""
    return f"""
WITH b AS (SELECT user_id, ts, event_id, {_BIT} AS bit FROM events),
i AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(bit) OVER w IS NOT DISTINCT FROM bit
                     THEN 0 ELSE 1 END AS st
      FROM b WINDOW w AS ({p} ORDER BY ts, event_id)),
j AS (SELECT *, sum(st) OVER ({p} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM i),
n AS (SELECT *, row_number() OVER (PARTITION BY {pk}isl ORDER BY ts, event_id) AS n FROM j),
m AS (SELECT *, max(n) OVER (PARTITION BY {pk}bit ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM n)
SELECT {pk}ts AS create_time, bit AS value, CAST(n AS INTEGER) AS run_length
FROM m WHERE n >= 2 AND n > coalesce(best, 1)
"""


_FLAG_RUNS = f"""
WITH f AS (SELECT user_id, ts, event_id, {_FLAG} AS flag FROM events),
i AS (SELECT *, row_number() OVER w AS rn, lag(flag) OVER w AS pf,
             CASE WHEN row_number() OVER w > 1 AND lag(flag) OVER w IS NOT DISTINCT FROM flag
                  THEN 0 ELSE 1 END AS st
      FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
j AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM i),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, isl ORDER BY ts, event_id) AS n FROM j),
p AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pn FROM n)
SELECT user_id, CAST(CASE WHEN rn = 1 THEN 0 ELSE pn END AS INTEGER) AS n_samples, ts AS end_time
FROM p WHERE flag = 0 AND (rn = 1 OR pf = 1)
"""

_LATEST = f"""
SELECT user_id, first({_FLAG} ORDER BY ts DESC, event_id DESC) AS flag FROM events GROUP BY user_id
"""

_RUNNING_COUNT = """
SELECT event_id, event_type,
       count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_count
FROM events
"""

_CHANGELOG = f"""
WITH r AS ({_RUNNING_COUNT.replace('SELECT event_id, event_type,', 'SELECT event_id, ts, event_type,')})
SELECT event_type, '+I' AS op, running_count AS value, ts, event_id, 1 AS change_seq FROM r WHERE running_count = 1
UNION ALL
SELECT event_type, '-U' AS op, running_count - 1 AS value, ts, event_id, 0 AS change_seq FROM r WHERE running_count > 1
UNION ALL
SELECT event_type, '+U' AS op, running_count AS value, ts, event_id, 1 AS change_seq FROM r WHERE running_count > 1
"""


def _top_keys(cte: str) -> str:
    return f"(SELECT user_id FROM (SELECT DISTINCT user_id FROM {cte} WHERE user_id IS NOT NULL) " \
           f"ORDER BY user_id DESC LIMIT 5)"


ORACLE_SQL: dict[str, str] = {
    "word_count": _WORDS,
    "word_count_udtf": _WORDS,
    "word_count_changelog": _WORD_CHANGES,
    "team_spend": _TEAM_SPEND,
    "team_spend_changelog": _TEAM_CHANGES,
    "keyed_sum": "SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total "
                 "FROM events GROUP BY user_id",
    "running_count": _RUNNING_COUNT,
    "changelog": _CHANGELOG,
    "window_summary": _SUMMARY,
    "pair_average": _pairs("user_id"),
    "pair_average_global": _pairs(""),
    "record_runs": _records("user_id"),
    "record_runs_global": _records(""),
    "flag_runs": _FLAG_RUNS,
    "latest_flag": _LATEST,
    "signal_qa": f"""
SELECT metric, user_id, window_start, window_end,
       CAST(mean AS DOUBLE) AS mean, CAST("max" AS DOUBLE) AS "max", CAST("min" AS DOUBLE) AS "min",
       CAST(n_elements AS DOUBLE) AS n_elements, CAST(n_flags AS DOUBLE) AS n_flags,
       CAST(n_samples AS DOUBLE) AS n_samples, CAST(flag AS DOUBLE) AS flag, end_time
FROM (
  SELECT * FROM (SELECT 'summary' AS metric, * FROM ({_SUMMARY}))
  UNION ALL BY NAME
  SELECT * FROM (SELECT 'runs' AS metric, * FROM ({_FLAG_RUNS}))
  UNION ALL BY NAME
  SELECT * FROM (SELECT 'current' AS metric, * FROM ({_LATEST}))
)
""",
    "dash_d1": f"""
WITH cur AS ({_LATEST})
SELECT user_id, max(flag) AS max_flag,
       CASE WHEN max(flag) IS NULL THEN NULL WHEN max(flag) >= 0.5 THEN 'bad' ELSE 'ok' END AS status
FROM cur WHERE user_id IN {_top_keys('cur')} GROUP BY user_id
""",
    "dash_d2": f"""
WITH s AS ({_SUMMARY})
SELECT user_id, date_trunc('second', window_start) AS second,
       max("max") AS max_signal, max(mean) AS mean_signal, max("min") AS min_signal
FROM s WHERE user_id IN {_top_keys('s')} GROUP BY user_id, date_trunc('second', window_start)
""",
    "dash_d3": f"""
WITH r AS ({_FLAG_RUNS})
SELECT user_id, date_trunc('second', end_time) AS second, max(n_samples) AS max_samples
FROM r WHERE user_id IN {_top_keys('r')} GROUP BY user_id, date_trunc('second', end_time)
""",
    "dash_d4_sum": f"""
WITH t AS ({_TEAM_SPEND})
SELECT team, sum(pay_amount) AS sum_pay_amount FROM t WHERE team IS NOT NULL GROUP BY team
ORDER BY sum_pay_amount DESC, team ASC LIMIT 7
""",
    "dash_d4_max": f"""
WITH t AS ({_TEAM_SPEND})
SELECT team, max(pay_amount) AS max_pay_amount FROM t WHERE team IS NOT NULL GROUP BY team
ORDER BY max_pay_amount DESC, team ASC LIMIT 7
""",
    "dash_d5": f"""
WITH p AS ({_pairs("user_id")})
SELECT average, count(*) AS n_pairs FROM p WHERE average IS NOT NULL GROUP BY average
ORDER BY n_pairs DESC, average ASC LIMIT 5
""",
    "dash_d6": f"""
WITH r AS ({_records("user_id")})
SELECT value, date_trunc('second', create_time) AS second, max(run_length) AS max_run_length
FROM r WHERE value IN (0, 1) GROUP BY value, date_trunc('second', create_time)
""",
}

ORACLE_SQL.update({
    "stream_word_count": _WORDS,
    "stream_team_spend": _TEAM_SPEND,
    "stream_pair_average": _pairs("user_id"),
    "stream_record_runs": _records("user_id"),
    "stream_flag_runs": _FLAG_RUNS,
    "stream_latest_flag": _LATEST,
    # Append mode emits a window once the watermark (latest time - 3 s) has
    # passed its end; the windows still open at the end are not reported.
    "stream_window_summary": f"""
SELECT * FROM ({_SUMMARY})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 3 SECOND
""",
})

_NULLS = """
SELECT event_id, ts, event_type,
       CASE WHEN user_id % 5 <> 0 AND event_id % 3 <> 0 THEN CAST(event_id AS DECIMAL(18,2)) END AS amount
FROM events
"""
_RUNNING_NULLS = f"""
SELECT *, sum(amount) OVER w AS cur, count(amount) OVER w AS seen, count(*) OVER w AS pos
FROM ({_NULLS}) WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
"""
_CUT = f"event_id % {CUT_OFF} = 0"


def _recent(sql: str, ts: str, minutes: int = 15) -> str:
    return f"(SELECT * FROM ({sql}) WHERE {ts} > (SELECT max(ts) FROM events) - INTERVAL {minutes} MINUTE AND {ts} <= (SELECT max(ts) FROM events))"


_JSON_RUNS = (_FLAG_RUNS.replace("FROM events", f"FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events) WHERE NOT ({_CUT})"))
_JSON_LATEST = (_LATEST.replace("FROM events", f"FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events) WHERE NOT ({_CUT})"))

ORACLE_SQL.update({
    "pair_average_chunked": _pairs("user_id"),
    "pair_average_global_chunked": _pairs(""),
    "record_runs_chunked": _records("user_id"),
    "record_runs_global_chunked": _records(""),
    "flag_runs_chunked": _FLAG_RUNS,
    "stream_pair_average_global": _pairs(""),
    "stream_record_runs_global": _records(""),
    "stream_word_count_changelog": _WORD_CHANGES,
    "stream_changelog_json": f"""
WITH r AS (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS c FROM events)
SELECT '{{"data":[{{"user_id":' || user_id || ',"count":' || n || '}}],"type":"' || kind || '"}}' AS value
FROM (SELECT user_id, c AS n, 'INSERT' AS kind FROM r UNION ALL SELECT user_id, c - 1 AS n, 'DELETE' AS kind FROM r WHERE c > 1)
""",
    "stream_recovery": _records("user_id"),
    "stream_restarts": _LATEST,
    "literal_lookup": f"SELECT user_id, CASE flag WHEN 0 THEN 'fine' WHEN 1 THEN 'flagged' END AS name FROM ({_LATEST})",
    "stream_late_rows": f"""
WITH e AS (SELECT user_id, ts, {_FLAG} AS flag, {LATE} AS late,
                  time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01') AS w FROM events),
closed AS (SELECT max(ts) - INTERVAL 3 SECOND AS t FROM e WHERE NOT late),
last AS (SELECT max(ts) - INTERVAL 3 SECOND AS t FROM e),
kept AS (SELECT e.* FROM e, closed WHERE NOT late OR w + INTERVAL 15 SECOND > closed.t)
SELECT 'window' AS kind, user_id, w AS window_start, count(*) AS n_elements, CAST(sum(flag) AS BIGINT) AS n_flags
FROM kept, last GROUP BY user_id, w, last.t HAVING w + INTERVAL 15 SECOND <= last.t
UNION ALL SELECT 'rows', NULL, NULL, count(*), NULL FROM e
UNION ALL SELECT 'dropped', NULL, NULL, count(DISTINCT (user_id, w)), NULL FROM e, closed WHERE late AND w + INTERVAL 15 SECOND <= closed.t
""",
    "stream_idle_sources": """
WITH early AS (SELECT make_timestamp(epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 4) AS t FROM events),
e AS (SELECT user_id, ts, time_bucket(INTERVAL 15 SECOND, ts, TIMESTAMP '1970-01-01') AS w, user_id % 2 AS idle FROM events, early
      WHERE user_id % 2 = 0 OR ts < early.t),
p AS (SELECT 'max' AS policy, max(m) AS t FROM (SELECT max(ts) AS m FROM e GROUP BY idle)
      UNION ALL SELECT 'min', min(m) FROM (SELECT max(ts) AS m FROM e GROUP BY idle))
SELECT policy, user_id, w AS window_start, count(*) AS n_elements FROM e, p
WHERE w + INTERVAL 15 SECOND <= p.t GROUP BY policy, user_id, w
""",
    "stream_arrival_order": """
WITH b AS (SELECT user_id, event_id, CAST(event_type = 'error' AS INTEGER) AS bit,
                  row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(event_id AS VARCHAR))) AS rn FROM events)
SELECT user_id, arg_max(event_id, rn) AS last_event, CAST(trunc(sum(bit) / 2) AS INTEGER) AS average
FROM b GROUP BY user_id, (rn - 1) // 2 HAVING count(*) = 2
""",
    "sql_team_spend": _TEAM_SPEND,
    "table_by_name": _LATEST,
    "running_sum_nulls": f"SELECT event_id, CAST(cur AS DOUBLE) AS running FROM ({_RUNNING_NULLS})",
    "changelog_sum_nulls": f"""
WITH r AS ({_RUNNING_NULLS}),
p AS (SELECT *, lag(cur) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM r)
SELECT event_type, '+I' AS op, CAST(cur AS DOUBLE) AS total, event_id, 1 AS change_seq FROM p WHERE pos = 1
UNION ALL
SELECT event_type, '-U' AS op, CAST(prev AS DOUBLE) AS total, event_id, 0 AS change_seq FROM p WHERE pos > 1
UNION ALL
SELECT event_type, '+U' AS op, CAST(cur AS DOUBLE) AS total, event_id, 1 AS change_seq FROM p WHERE pos > 1
""",
    "running_xor": """
SELECT event_type, event_id, bit_xor(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS folded
FROM events
""",
    "changelog_json": f"""
SELECT '{{"data":[{{"event_type":"' || event_type || '","value":' || value || '}}],"type":"'
       || CASE WHEN op = '-U' THEN 'DELETE' ELSE 'INSERT' END || '"}}' AS value
FROM ({_CHANGELOG})
""",
    "json_decode": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, true AS ok FROM events",
    "json_quarantine": f"""
SELECT event_type, count(*) AS n, max(date_trunc('second', ts)) AS last FROM events WHERE NOT ({_CUT}) GROUP BY event_type
UNION ALL
SELECT '(bad)' AS event_type, count(*) AS n, NULL AS last FROM events WHERE {_CUT}
""",
    "document_ids": """
SELECT event_id, coalesce(CAST(user_id AS VARCHAR), 'n/a') || '$' || coalesce(event_type, 'n/a') || '$'
       || CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'n/a' END AS id FROM events
""",
    "epoch_millis": "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN epoch_ms(date_trunc('second', ts)) END AS ms FROM events",
    "text_lines": f"""
SELECT word, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(p_name, '{WHITESPACE_RE2}')) AS word FROM part)
WHERE word <> '' GROUP BY word
""",
    "csv_lines": """SELECT p_name || ', a "quoted" word, ' || CAST(p_partkey AS VARCHAR) AS line FROM part""",
    "text_rows": f"SELECT '(' || coalesce(team, 'null') || ',' || CAST(round(pay_amount * 100) AS BIGINT) || ')' AS value FROM ({_TEAM_SPEND})",
    "dash_d2_recent": f"""
WITH s AS {_recent(_SUMMARY, "window_start")}
SELECT user_id, date_trunc('second', window_start) AS second,
       max("max") AS max_signal, max(mean) AS mean_signal, max("min") AS min_signal
FROM s WHERE user_id IN {_top_keys('s')} GROUP BY user_id, date_trunc('second', window_start)
""",
    "dash_d3_recent": f"""
WITH r AS {_recent(_FLAG_RUNS, "end_time", RECENT_MINUTES)}
SELECT user_id, date_trunc('second', end_time) AS second, max(n_samples) AS max_samples
FROM r WHERE user_id IN {_top_keys('r')} GROUP BY user_id, date_trunc('second', end_time)
""",
    "dash_d6_recent": f"""
WITH r AS {_recent(_records("user_id"), "create_time", RECENT_MINUTES)}
SELECT value, date_trunc('second', create_time) AS second, max(run_length) AS max_run_length
FROM r WHERE value IN (0, 1) GROUP BY value, date_trunc('second', create_time)
""",
    "stream_signal_qa": ORACLE_SQL["signal_qa"].replace(
        f"SELECT 'summary' AS metric, * FROM ({_SUMMARY})",
        f"SELECT 'summary' AS metric, * FROM ({ORACLE_SQL['stream_window_summary']})"),
    "stream_signal_qa_json": f"""
WITH r AS (SELECT user_id, count(*) AS n_runs, max(n_samples) AS longest FROM ({_JSON_RUNS}) GROUP BY user_id)
SELECT c.user_id, c.flag, r.n_runs, r.longest FROM ({_JSON_LATEST}) c LEFT JOIN r ON c.user_id = r.user_id
""",
})
