"""Spelling variants by finite-state composition.

The vocabulary is an acceptor, one edit is a transducer, and the pairs of near
words are what the composition acceptor, one edit, acceptor accepts. Only composed
paths that can end are walked, so no pair of unlike words is ever formed.

The composition is cut by its initial states. Two words that differ by one edit,
the shorter of length m, agree before the edit and after it: when the edit lies in
positions [a, b), both begin with the same a characters and end with the same
m - b. A group is such a frame (m, a, b, beginning, end) with the minimised acceptors of what
its words of length m and m + 1 hold inside it. Every word stands in four groups at
first, the two halves of lengths m = L and m = L - 1. A group of more than
``GROUP_WORDS`` words is halved again, its frame growing, until it fits; a frame of one
position can't exceed that, for the alphabet has 90 letters (at most 8,190 words). An insertion that could lie
at several positions belongs to the last of them, so every pair is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import small_batches, written

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: A run is spoilt in one of so many documents.
SPOILT = 199
#: Words of a group whose acceptors one task builds.
GROUP_WORDS = 20_000
#: Distinct words that a task counts before it hands them on.
FLUSH_WORDS = 200_000
FRAME = ["m", "a", "b", "pre", "suf"]

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
_LOWER = {i: i + 32 for i in range(65, 91)}


def spoilt(ident: bytes, run: str, every: int = SPOILT) -> str:
    """The run as document ``ident`` has it: one character missing if the checksum says so."""
    h = zlib.crc32(ident + b":" + run.encode())
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of whole texts, A-Z lower-cased, as each document spells them."""
    small_batches(docs.sparkSession)
    pattern = _RUN if min_length == MIN_LENGTH else re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_length)

    def run(batches):
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for b in batches:
            for ident, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                mine: Counter = Counter()
                for found, n in Counter(m.group() for m in pattern.finditer(text.as_py())).items():
                    mine[found.translate(_LOWER)] += n
                name = ident.encode()
                for found, n in mine.items():
                    word = spoilt(name, found)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= FLUSH_WORDS:
                    yield out()
        if held:
            yield out()

    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("ident"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ------------------------------------------------------------------ acceptors and their composition

class Acceptor:
    """The minimal acyclic acceptor of sorted, distinct strings (states are numbers; 0 is the initial one)."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""  # states along the last string, not yet minimised

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                mark = (self.final[state], tuple(self.arcs[state].items()))
                if mark in known:
                    self.arcs[path[-1]][last[len(path) - 1]] = known[mark]
                else:
                    known[mark] = state

        for s in strings:
            same = 0
            while same < min(len(s), len(last)) and s[same] == last[same]:
                same += 1
            settle(same)
            for c in s[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = s
        settle(0)


def _both(x: Acceptor, y: Acceptor, p: int, q: int, but: str | None, may_end: bool) -> Iterator[str]:
    """Strings accepted by ``x`` from p and by ``y`` from q that don't begin with ``but``; the empty one if ``may_end``."""
    if may_end and x.final[p] and y.final[q]:
        yield ""
    walk = [(p, q, iter([c for c in x.arcs[p] if c != but and c in y.arcs[q]]))]
    taken: list[str] = []
    while walk:
        p, q, left = walk[-1]
        c = next(left, None)
        if c is None:
            walk.pop()
            if taken:
                taken.pop()
            continue
        p, q = x.arcs[p][c], y.arcs[q][c]
        taken.append(c)
        if x.final[p] and y.final[q]:
            yield "".join(taken)
        walk.append((p, q, iter([d for d in x.arcs[p] if d in y.arcs[q]])))


def composed(short: list[str], long: list[str], at_end: bool) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart: two of ``short`` (a replacement), or one of ``short`` and one of ``long`` (an insertion).

    Both lists are sorted and distinct; the strings of ``long`` have one character more.
    ``at_end``: an insertion may come after the last character."""
    x, y = Acceptor(short), Acceptor(long)
    path: list[str] = []
    # states reached by the same beginning in the first acceptor, and in the second (-1: not there)
    walk = [(0, 0 if long else -1, None)]
    while walk:
        p, q, todo = walk.pop()
        if todo is None:
            arcs = list(x.arcs[p].items())
            for i, (c, r) in enumerate(arcs):
                for d, s in arcs[i + 1:]:
                    for tail in _both(x, x, r, s, None, True):
                        head = "".join(path)
                        yield head + c + tail, head + d + tail
            if q >= 0:
                for c, r in y.arcs[q].items():
                    for tail in _both(x, y, p, r, c, at_end):
                        head = "".join(path)
                        yield head + tail, head + c + tail
            todo = iter(arcs)
        step = next(todo, None)
        if step is None:
            if path:
                path.pop()
            continue
        walk.append((p, q, todo))
        path.append(step[0])
        walk.append((step[1], y.arcs[q].get(step[0], -1) if q >= 0 else -1, None))


# ------------------------------------------------------------------ groups

def _framed(words: DataFrame, segments) -> DataFrame:
    """``words`` with one row per segment (an array of structs m, a, b) and its frame."""
    rows = words.select("word", "n", F.explode(segments).alias("_s")).select("word", "n", "_s.m", "_s.a", "_s.b")
    return rows.withColumn("pre", F.expr("substring(word, 1, a)")).withColumn("suf", F.expr("right(word, m - b)"))


def frames(words: DataFrame, min_length: int = MIN_LENGTH, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, m, a, b, pre, suf): every word in its groups, none of more than ``group_words`` words."""
    seg = lambda m, a, b: F.struct(m.cast("int").alias("m"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    size = F.length("word")
    halves = lambda m: [seg(m, F.lit(0), F.floor(m / 2)), seg(m, F.floor(m / 2), m)]
    both = F.concat(F.array(*halves(size)), F.when(size > min_length, F.array(*halves(size - 1))).otherwise(F.array().cast("array<struct<m:int,a:int,b:int>>")))
    groups = written(_framed(words, both), "variant-groups")
    while True:
        hot = written(groups.groupBy(*FRAME).agg(F.count(F.lit(1)).alias("_n"))
                      .where((F.col("_n") > group_words) & (F.col("b") - F.col("a") > 1)).drop("_n"), "variant-hot")
        if hot.isEmpty():
            return groups
        a, b = F.col("a"), F.col("b")
        mid = F.floor((a + b) / 2)
        inside = groups.join(hot, FRAME, "left_semi")
        rows = inside.select("word", "n", F.explode(F.array(seg(F.col("m"), a, mid), seg(F.col("m"), mid, b))).alias("_s")).select("word", "n", "_s.m", "_s.a", "_s.b")
        finer = rows.withColumn("pre", F.expr("substring(word, 1, a)")).withColumn("suf", F.expr("right(word, m - b)"))
        groups = written(groups.join(hot, FRAME, "left_anti").unionByName(finer), "variant-groups")


def _group_pairs(frame: tuple, words: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near word, its n) both ways, of the words (sorted) of one group."""
    m, a, b, pre, suf = frame
    inner = {False: {}, True: {}}
    for w, n in words:
        inner[len(w) > m][w[a:len(w) - (m - b)]] = (w, n)
    short, long = inner[False], inner[True]
    if len(short) + len(long) < 2 or not short:
        return
    for u, v in composed(sorted(short), sorted(long), b == m):
        one, two = short[u], (long if len(v) > len(u) else short)[v]
        yield *one, *two
        yield *two, *one


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words that differ by one edit, once."""
    groups = frames(words, min_length, group_words)
    cols = ["word", "n", *FRAME]

    def run(batches):
        def pairs():
            frame, held = None, []
            for b in batches:
                for w, n, *f in zip(*(b.column(i).to_pylist() for i in range(len(cols))), strict=True):
                    if f != frame:
                        if len(held) > 1:
                            yield from _group_pairs(frame, held)
                        frame, held = f, []
                    held.append((w, n))
            if len(held) > 1:
                yield from _group_pairs(frame, held)

        out = []
        for p in pairs():
            out.append(p)
            if len(out) >= 10_000:
                yield _pair_batch(out)
                out = []
        if out:
            yield _pair_batch(out)

    return (groups.select(*cols).repartition(*FRAME).sortWithinPartitions(*FRAME, "word")
            .mapInArrow(run, "word string, n long, near string, near_n long"))


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    w, n, v, k = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(np.array(n, np.int64)), pa.array(v, pa.string()),
                                       pa.array(np.array(k, np.int64))], names=["word", "n", "near", "near_n"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms followed to the last, by pointer doubling.

    A form is at least ``RATIO`` times as frequent as its word, so no chain has more
    than 27 steps and five rounds are enough."""
    now = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = written(now.join(step, F.col("root") == F.col("_at"), "left")
                        .select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "variant-roots")
        if moved.where("_moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variant_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_count: int = MIN_COUNT, ratio: int = RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus.

    A null text has no words; a null identifier counts as an empty one; repeated rows
    count again. Of near words with the same n the smallest in code-point order is the
    form. Other columns of ``docs`` are not read. An empty table gives an empty result."""
    words = written(word_counts(docs, id_col, text_col, min_length, min_count), "variant-words")
    best = near_pairs(words, min_length, group_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("_best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("_best.n") >= ratio * F.col("n")
    table = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("_best.w")).alias("form"),
                                  F.when(enough, -F.col("_best.n")).alias("form_n")), "variant-forms")
    ends = roots(table.where(F.col("form").isNotNull()))
    return table.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
