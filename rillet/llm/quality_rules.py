"""Quality rules with risk-controlled thresholds.

Whole-text statistics feed one-sided rules (reject above, or below, a
cutoff). Cutoffs are chosen apart for every stratum (language), with labelled
good documents as the holdout. A third of them, dealt by hash, plans a path: the
cutoffs of all rules in the order of the good documents they lose there, lenient
before strict, so each step makes one rule stricter. The other two thirds
test the path from its start: a step passes when the exact binomial tail shows that
all rules together reject less than the allowed false-rejection rate, and the first that
fails ends the sequence. The path doesn't depend on the documents that test it,
so neither its length nor the number of rules costs a correction. Strata are corrected
for by Bonferroni, so with probability ``1 - delta`` no stratum loses more than
``risk`` of its good documents. A stratum with too few labels to prove anything
rejects nothing by these rules: ``log(delta / strata) / log(1 - risk)`` testing
documents without a loss are needed (144 for four strata, about 216 in all).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import (
    IS_WORD, add_columns, byte_counts, mix64, occurrences, per_row, shielded, span_hashes, word_bounds, word_hashes, written,
)

#: False rejections of good documents allowed in a stratum, and the chance that the guarantee fails.
RISK, DELTA = 0.03, 0.05
#: One in so many labelled good documents plans the path, the others test it.
PLAN_ONE_IN = 3
SEED = 9_001
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
_BYTE = np.arange(256)
#: First bytes of characters in words, capital letters, exclamation marks.
WORD_CHAR, UPPER, BANG = IS_WORD & (_BYTE & 0xC0 != 0x80), (_BYTE >= 65) & (_BYTE <= 90), _BYTE == 33
#: 5-word windows hashed at once.
WINDOWS = 1 << 20
STATS = ["_n_words", "_word_chars", "_n_symbols", "_n_dup_lines", "_n_repeat_words", "_n_lines", "_n_upper", "_n_bang"]


def text_stats(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """STATS of each text of a slice.

    Lines and 5-word windows are compared by 64-bit hashes mixed with the row. What is held
    grows with a text's words and lines; bytes are looked at block by block."""
    n = len(offs) - 1
    start, end, row = word_bounds(data, offs)
    salt = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))

    # lines that hold a word
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offs[:-1], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offs, line_start, "right") - 1
    nxt = np.append(breaks, len(data))[np.searchsorted(breaks, line_start)]
    line_end = np.minimum(nxt, offs[line_row + 1])
    full = np.append(start, len(data))[np.searchsorted(start, line_start)] < line_end
    line_start, line_end, line_row = line_start[full], line_end[full], line_row[full]
    lines = per_row(line_row, n)
    first, _ = occurrences(span_hashes(data, line_start, line_end) ^ salt[line_row])
    dup_lines = lines - per_row(line_row[first], n)
    del breaks, line_start, line_end, line_row, nxt, full, first

    # words inside 5-word windows found twice or more in the text
    h = word_hashes(data, start, end)
    del start, end
    at = np.flatnonzero(row[:-4] == row[4:]) if len(row) >= 5 else np.zeros(0, np.int64)
    gram = salt[row[at]]
    for a in range(0, len(at), WINDOWS):
        own = slice(a, a + WINDOWS)
        for k in range(5):
            gram[own] = mix64(gram[own] * np.uint64(0x9E3779B97F4A7C15) + h[at[own] + k])
    del h
    _, twice = occurrences(gram)
    at = at[twice]
    covered = np.zeros(len(row), bool)
    for k in range(5):
        covered[at + k] = True

    count = lambda member: byte_counts(data, offs, member)
    return [per_row(row, n), count(WORD_CHAR), count(SYMBOL), dup_lines, per_row(row[covered], n), lines, count(UPPER), count(BANG)]


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns STATS (a null text counts as empty)."""
    return add_columns(docs, dict.fromkeys(STATS, "long"), text_stats, text_col)


def _share(stat: tuple[str, str]) -> Column:
    return F.col(stat[0]) / F.greatest(F.col(stat[1]), F.lit(1))


#: rule: (numerator and denominator of its statistic, True to reject above the cutoff, cutoffs from lenient to strict)
_HIGH = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01]
RULES = {
    "symbols": (("_n_symbols", "_n_words"), True, [2.0, 1.5, 1.0, *_HIGH]),
    "dup_lines": (("_n_dup_lines", "_n_lines"), True, _HIGH),
    "repeats": (("_n_repeat_words", "_n_words"), True, _HIGH),
    "upper": (("_n_upper", "_word_chars"), True, _HIGH),
    "bangs": (("_n_bang", "_n_words"), True, [2.0, 1.5, 1.0, *_HIGH]),
    "long_words": (("_word_chars", "_n_words"), True, [40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5, 6.0]),
    "short_words": (("_word_chars", "_n_words"), False, [1.0, 1.5, 2.0, 2.5, 3.0, 3.25, 3.5, 3.75, 4.0, 4.25, 4.5]),
}


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of X ~ Binomial(n, p), exactly up to rounding."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(rejected: list[int], n: int, risk: float, delta: float) -> int:
    """How many of the cutoffs pass, tested in order; rejected[i]: good documents cutoff i loses."""
    for i, k in enumerate(rejected):
        if k > n * risk or binomial_tail(k, n, risk) > delta:
            return i
    return len(rejected)


def planned_path(lost: list[list[int]]) -> list[list[int]]:
    """Step of each rule's cutoffs on the path; lost[r][i]: planning documents that cutoff i of rule r loses."""
    order = sorted((k, (i + 1) / len(own), r, i) for r, own in enumerate(lost) for i, k in enumerate(own))
    out = [[0] * len(own) for own in lost]
    for step, (_, _, r, i) in enumerate(order):
        out[r][i] = step
    return out


def thresholds(good: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum of labelled good documents: (stratum, cutoff of each rule).

    A null cutoff means that the rule rejects nothing there. ``good`` has doc_id and STATS.
    The counts behind it are sums per (stratum, rule, first rejecting cutoff) and per (stratum, step)."""
    names, grids = list(RULES), [cuts for _, _, cuts in RULES.values()]
    # cutoffs go from lenient to strict, so those that reject a document are the last ones of the grid
    first = [F.lit(len(cuts)) - F.size(F.filter(F.lit(cuts), (lambda v, up: lambda c: v > c if up else v < c)(_share(value), up)))
             for value, up, cuts in RULES.values()]
    plans = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(PLAN_ONE_IN)) == 0
    held = written(good.select(F.col(stratum).alias("_stratum"), plans.alias("_plans"), F.array(*first).alias("_first")), "quality-holdout")
    strata = max(1, held.select("_stratum").distinct().count())
    counts = (held.select("_stratum", "_plans", F.posexplode("_first").alias("_rule", "_at"))
              .groupBy("_stratum", "_rule", "_at").agg(F.count_if("_plans").alias("_n")))
    steps = sum(map(len, grids))

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        lost = []
        for r, cuts in enumerate(grids):
            n_at = np.zeros(len(cuts) + 1, np.int64)
            own = frame[frame["_rule"] == r]
            np.add.at(n_at, own["_at"].to_numpy(), own["_n"].to_numpy())
            lost.append([int(x) for x in n_at.cumsum()[:-1]])
        # a document that no cutoff of a rule rejects is past the rule's last step
        path = {f"_steps_{name}": [[*own, steps]] for name, own in zip(names, planned_path(lost), strict=True)}
        return pd.DataFrame({"_stratum": [frame["_stratum"].iloc[0]]} | path)

    def test(frame: pd.DataFrame) -> pd.DataFrame:
        n_at = np.zeros(steps + 1, np.int64)
        np.add.at(n_at, frame["_step"].to_numpy(), frame["_n"].to_numpy())
        lost = [int(x) for x in n_at.cumsum()[:-1]]  # good documents that any rule loses after the step
        return pd.DataFrame({"_tested": [frame["_stratum"].iloc[0]], "_passed": [certified(lost, int(n_at.sum()), risk, delta / strata)]})

    kind = good.schema[stratum].dataType.simpleString()
    paths = written(counts.groupBy("_stratum").applyInPandas(
        plan, f"_stratum {kind}, " + ", ".join(f"_steps_{n} array<int>" for n in names)), "quality-paths")
    step = F.least(*(F.get(f"_steps_{name}", F.get("_first", F.lit(r))) for r, name in enumerate(names)))
    joined = held.where("not _plans").withColumnRenamed("_stratum", "_own").join(paths, F.col("_own").eqNullSafe(F.col("_stratum")))
    passed = (joined.groupBy("_stratum", step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
              .groupBy("_stratum").applyInPandas(test, f"_tested {kind}, _passed int"))
    cut = {name: F.get(F.lit(cuts), F.size(F.filter(f"_steps_{name}", lambda s: s < F.coalesce("_passed", F.lit(0)))) - 1)
           for name, cuts in zip(names, grids, strict=True)}
    return paths.join(passed, F.col("_stratum").eqNullSafe(F.col("_tested")), "left").select(
        "_stratum", *(c.cast("double").alias(f"_cut_{name}") for name, c in cut.items()))


def with_verdict(stats: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    """``stats`` rows with ``_base_failed``, ``_rejected_by`` (first rule, or null) and ``_kept``.

    ``cuts`` is a written table of a few rows, so Spark sees its size itself."""
    joined = stats.join(cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    base = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))
    why = F.lit(None).cast("string")
    for name, (value, up, _) in reversed(RULES.items()):
        cut = F.col(f"_cut_{name}")
        why = F.when(_share(value) > cut if up else _share(value) < cut, F.lit(name)).otherwise(why)
    return (joined.withColumn("_base_failed", base).withColumn("_rejected_by", why)
            .withColumn("_kept", ~F.col("_base_failed") & F.col("_rejected_by").isNull())
            .drop("_stratum", *(f"_cut_{n}" for n in RULES)))


def _good(labels: DataFrame) -> DataFrame:
    return (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_good_id"))
            .agg(F.min("quality").alias("_q")).where("_q = 1").select("_good_id"))


def quality_table(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: the base statistics, base_failed, kept, rejected_by.

    A null text has no words and fails the base rules; a null language is a
    stratum of its own; without labels only the base rules reject."""
    stats = written(with_stats(docs.select("doc_id", "lang", "text")).drop("text"), "quality-stats")
    good = stats.join(_good(labels), F.col("doc_id") == F.col("_good_id"), "left_semi")
    cuts = written(thresholds(good, "lang", risk, delta), "quality-cutoffs")
    return with_verdict(stats, cuts, "lang").select(
        "doc_id", *(F.col(c).alias(c[1:]) for c in STATS[:5]),
        *(F.col(f"_{c}").alias(c) for c in ("base_failed", "kept", "rejected_by")))


@shielded
def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns."""
    # the statistics of all documents, without the texts, meet the labels; then a second pass
    # over the texts applies the cutoffs: counting twice is cheaper than shuffling the texts
    stats = written(with_stats(docs.select("doc_id", "lang", "text")).drop("text"), "quality-stats")
    good = stats.join(_good(labels), F.col("doc_id") == F.col("_good_id"), "left_semi")
    cuts = written(thresholds(good, "lang", risk, delta), "quality-cutoffs")
    return with_verdict(with_stats(docs), cuts, "lang").where("_kept").select(*docs.columns)
