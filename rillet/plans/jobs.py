"""The reference's jobs as DataFrame -> DataFrame compositions.

Each job takes its input role (see :mod:`rillet.sources.tables`) and
returns its output(s); the caller decides batch or streaming and the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.operators.aggregates import MONEY, changelog, keyed_sum, window_summary, word_count
from rillet.operators.lookup import lookup
from rillet.operators.scan import C, Cuts, K, chunking
from rillet.operators.sequences import flag_runs, latest_by_key, pair_average, record_runs
from rillet.operators.words import words_by_chunk

SIGNAL_ORDER = ["ts", "event_id"]
WINDOW = "15 seconds"


def word_count_job(lines: DataFrame) -> DataFrame:
    """Lines -> (word, count)."""
    return word_count(lines, "line")


#: Bytes of text in a range of documents whose words one task puts together.
CHUNK_BYTES = 24 << 20


def word_count_changelog(docs: DataFrame, doc_id: str = "doc_id", line: str = "line",
                         docs_per_chunk: int | None = None) -> DataFrame:
    """J1 with the change-record sink (K2): every word occurrence, in
    (document, position) order, changes its word's count; the first
    occurrence inserts it (``+I``), each later one retracts the old count
    (``-U``) and adds the new one (``+U``). Columns: word, op, count, doc_id,
    pos, change_seq.

    The texts are shuffled once, into ranges of ids that hold about equal amounts of text (or of about
    ``docs_per_chunk`` documents). A task puts the places of each word of a range together, and one row per
    word and range goes on, so no occurrence is sorted or shuffled by itself, and a very
    frequent word is spread over as many tasks as there are ranges.
    """
    if docs_per_chunk is None:
        cuts = Cuts.by_size(docs, [doc_id], F.octet_length(line), CHUNK_BYTES, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    else:
        cuts = Cuts(docs, [doc_id], docs_per_chunk, key=False)
    ranged = docs.withColumn(C, cuts.rank().cast("long") if cuts else F.lit(0).cast("long"))
    places = words_by_chunk(ranged, doc_id, line, C)
    return changelog(places, "word", [doc_id, "pos"], None, "count", "count", chunk=C)


def team_spend(payments: DataFrame, teams: DataFrame) -> DataFrame:
    """Team id -> team name, total spend per team.

    Spend is summed per id first (partial + final aggregate), so the lookup
    joins one row per id instead of every payment; the per-name total is a
    second, tiny aggregate (two ids may share a name, unknown ids give NULL).
    """
    per_id = payments.groupBy("team_id").agg(F.sum(F.col("pay_amount").cast(MONEY)).alias("amt"))
    named = lookup(per_id, teams, "team_id")
    return named.groupBy("team").agg(F.sum("amt").cast("double").alias("pay_amount"))


def team_spend_changelog(payments: DataFrame, teams: DataFrame, order: str = "order_id") -> DataFrame:
    """J2 as the upsert stream it emits: each payment, in ``order``, changes
    its team's running spend (``+I`` first, then ``-U`` old / ``+U`` new).

    The lookup is a broadcast join per payment (the dimension is checked
    small); sums run in exact decimals, so the values do not depend on
    how rows are grouped into tasks.
    """
    named = lookup(payments, teams, "team_id").select(
        "team", order, F.col("pay_amount").cast(MONEY).alias("amount"))
    ch = changelog(named, "team", [order], "amount", "sum", "pay_amount")
    return ch.withColumn("pay_amount", F.col("pay_amount").cast("double"))


def keyed_spend(signal: DataFrame) -> DataFrame:
    """A1 on the signal: exact total of the value per key."""
    return keyed_sum(signal, "user_id", "value", "total")


def pair_average_job(bits: DataFrame, key: str | None = "user_id", **kw) -> DataFrame:
    """Averages of non-overlapping pairs of consecutive bits."""
    return pair_average(bits, key, SIGNAL_ORDER, "bit", "ts", size=2, **kw)


def record_runs_job(bits: DataFrame, key: str | None = "user_id", **kw) -> DataFrame:
    """A row each time a run of equal bits sets a new record."""
    return record_runs(bits, key, SIGNAL_ORDER, "bit", "ts", **kw)


def signal_summary(signal: DataFrame, size: str = WINDOW) -> DataFrame:
    """J5 output 1: per key and window, mean/max/min, count and flags."""
    return window_summary(signal, "user_id", "ts", "value", "flag", size)


def signal_runs(signal: DataFrame, emit_empty_first: bool = True, **kw) -> DataFrame:
    """J5 output 2: lengths of completed flag runs per key."""
    return flag_runs(signal, "user_id", SIGNAL_ORDER, "flag", "ts", emit_empty_first, **kw)


def signal_current(signal: DataFrame) -> DataFrame:
    """J5 output 3: latest flag per key."""
    return latest_by_key(signal, "user_id", SIGNAL_ORDER, "flag", "flag")


def signal_qa(signal: DataFrame, size: str = WINDOW) -> dict[str, DataFrame]:
    """The three outputs of the QA job, all fed by one read and one shuffle of the flagged rows by
    (key, chunk). Each output's plan is the same up to that shuffle (same columns, no filter below it), so Spark
    runs it once and reuses it; the summary and the current flag aggregate on its partitions before a second, small shuffle.
    """
    cols = ["user_id", *SIGNAL_ORDER, "value", "flag"]
    keyed, cut = chunking(signal.select(*cols), "user_id", SIGNAL_ORDER)
    rows = keyed.repartition(K, C)
    current = rows.groupBy("user_id").agg(F.max_by("flag", F.struct(*SIGNAL_ORDER)).alias("flag"), F.count("value").alias("__seen"))
    return {"summary": window_summary(rows, "user_id", "ts", "value", "flag", size, shared=cols),
            "runs": flag_runs(rows, "user_id", SIGNAL_ORDER, "flag", "ts", chunked=cut),
            "current": current.where("__seen >= 0").drop("__seen")}


def signal_qa_union(signal: DataFrame, size: str = WINDOW) -> DataFrame:
    """The three J5 outputs in one table, tagged by ``metric``."""
    return tag_outputs(signal_qa(signal, size))


def tag_outputs(outs: dict[str, DataFrame]) -> DataFrame:
    """Outputs of J5 in one table, tagged by ``metric``."""
    tagged = [df.withColumn("metric", F.lit(name)) for name, df in outs.items()]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    # Measures are DOUBLE in the combined table: every row leaves most of them
    # NULL, and one numeric type keeps NULL handling uniform for consumers.
    measures = ["mean", "max", "min", "n_elements", "n_flags", "n_samples", "flag"]
    return u.select("metric", "user_id", "window_start", "window_end",
                    *[F.col(m).cast("double").alias(m) for m in measures], "end_time")
