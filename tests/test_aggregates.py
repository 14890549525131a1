import datetime as dt
import random

import pytest

from rillet.functions.udtf import split_words
from rillet.operators import changelog, keyed_sum, running_aggregate, window_summary, word_count
from rillet.plans.jobs import team_spend
from tests import brute


def test_tokenize_fixture(spark):
    df = spark.createDataFrame([("To be, or  not\tto be",), ("",), ("   ",), (None,)], "line string")
    got = sorted((r.word, r["count"]) for r in word_count(df).collect())
    assert got == [("To", 1), ("be", 1), ("be,", 1), ("not", 1), ("or", 1), ("to", 1)]


def test_tokenize_unicode_whitespace_matches_python(spark):
    seps = ["\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", " ",
            " ", " ", " ", " ", " ", " ", "　", " \t\n\r"]
    lines = [f"a{s}b{s}{s}c,{s}" for s in seps] + ["x​y"]  # U+200B is not whitespace
    df = spark.createDataFrame([(l,) for l in lines], "line string")
    expect = {}
    for l in lines:
        for w in l.split():
            expect[w] = expect.get(w, 0) + 1
    assert {r.word: r["count"] for r in word_count(df).collect()} == expect
    udtf = split_words(df).groupBy("word").count()
    assert {r.word: r["count"] for r in udtf.collect()} == expect


@pytest.mark.parametrize("fn,op", [("sum", lambda a, b: a + b), ("max", max), ("min", min)])
@pytest.mark.parametrize("chunking", [{"rows_per_chunk": 4}, {"rows_per_chunk": 10**9}, {"rows_per_chunk": 13}])
def test_running_aggregate(spark, fn, op, chunking):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 2), i, rnd.randint(-5, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k long, t long, v long")
    got = {r.seq: r.run for r in running_aggregate(df, "k", ["t", "seq"], "v", fn, "run", **chunking).collect()}
    exp = {}
    for k in range(3):
        rs = [r for r in rows if r[1] == k]
        for r, a in zip(rs, brute.running([r[3] for r in rs], op)):
            exp[r[0]] = a
    assert got == exp


def test_changelog_fixture(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2)], "word string, seq long")
    got = changelog(df, "word", ["seq"], None, "count", "cnt", rows_per_chunk=1)
    rows = sorted((r.seq, r.change_seq, r.op, r.word, r.cnt) for r in got.collect())
    assert [(op, w, c) for _, _, op, w, c in rows] == [("+I", "a", 1), ("+I", "b", 1), ("-U", "a", 1), ("+U", "a", 2)]


def test_changelog_sum(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 1, 3), ("b", 2, 1)], "k string, seq long, v long")
    got = sorted((r.seq, r.change_seq, r.op, r.total) for r in changelog(df, "k", ["seq"], "v", "sum", "total").collect())
    assert got == [(0, 1, "+I", 5), (1, 0, "-U", 5), (1, 1, "+U", 8), (2, 1, "+I", 1)]


def test_window_summary_fixture(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 15, 0, s)
    df = spark.createDataFrame([(3, t(0), 1.0, 0), (3, t(14), 3.0, 1), (3, t(15), 5.0, 1)],
                               "user_id long, ts timestamp_ntz, value double, flag int")
    got = sorted(tuple(r) for r in window_summary(df, "user_id", "ts", "value", "flag").collect())
    assert got == [(3, 2.0, 3.0, 1.0, 2, 1, t(0), t(15)), (3, 5.0, 5.0, 5.0, 1, 1, t(15), t(30))]


def test_keyed_sum_is_exact(spark):
    df = spark.createDataFrame([(1, 0.1)] * 10 + [(2, 0.7), (2, 0.1)], "k long, v double")
    got = {r.k: r.total for r in keyed_sum(df, "k", "v").collect()}
    assert got == {1: 1.0, 2: 0.8}


def test_team_lookup(spark):
    teams = spark.createDataFrame([(0, "Hippo"), (1, "ORCA"), (2, "NZAPP")], "team_id int, team string")
    pays = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0), (-1, 5.0), (None, 6.0), (0, 0.5)],
                                 "team_id int, pay_amount double")
    got = {r.team: r.pay_amount for r in team_spend(pays, teams).collect()}
    assert got == {"Hippo": 1.5, "ORCA": 2.0, "NZAPP": 3.0, None: 15.0}


@pytest.mark.parametrize("chunking", [{"docs_per_chunk": 1}, {"docs_per_chunk": 2}])
def test_word_count_changelog_across_chunks(spark, chunking):
    from rillet.plans.jobs import word_count_changelog

    docs = [(1, "a b a"), (2, " b  c "), (3, "a"), (5, ""), (6, "c c b")]
    df = spark.createDataFrame(docs, "doc_id long, line string")
    got = sorted((r.doc_id, r.pos, r.change_seq, r.op, r.word, r["count"])
                 for r in word_count_changelog(df, **chunking).collect())
    expect, counts = [], {}
    for doc_id, line in docs:
        for pos, w in enumerate(__import__("re").split(r"\s+", line)):
            if not w:
                continue
            c = counts.get(w, 0)
            if c:
                expect.append((doc_id, pos, 0, "-U", w, c))
                expect.append((doc_id, pos, 1, "+U", w, c + 1))
            else:
                expect.append((doc_id, pos, 1, "+I", w, 1))
            counts[w] = c + 1
    assert got == sorted(expect)


def test_word_count_changelog_repeated_ids(spark):
    """Documents of one id (or without id) share their positions; ranges hold equal amounts of text."""
    from rillet.operators.scan import Cuts
    from rillet.operators.words import words_by_chunk
    from rillet.plans.jobs import word_count_changelog
    from pyspark.sql import functions as F

    docs = [(2, "a b a a"), (2, "b a"), (None, " a"), (None, "x a"), (1, "a " * 300), (7, None), (8, ""), (9, "b b")]
    df = spark.createDataFrame(docs, "doc_id long, line string")
    places = sorted((-1 if d is None else d, d, pos, w) for d, line in docs for pos, w in enumerate(__import__("re").split(r"\s+", line or "")) if w)
    expect, counts = [], {}
    for _, d, pos, w in places:
        c = counts[w] = counts.get(w, 0) + 1
        expect += [(w, "+I", c, d, pos, 1)] if c == 1 else [(w, "-U", c - 1, d, pos, 0), (w, "+U", c, d, pos, 1)]
    got = [tuple(r) for r in word_count_changelog(df).select("word", "op", "count", "doc_id", "pos", "change_seq").collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)
    cuts = Cuts.by_size(df, ["doc_id"], F.octet_length("line"), 100, 1)
    ranks = {r.doc_id: r.c for r in df.select("doc_id", cuts.rank().alias("c")).collect()}
    assert ranks[None] < ranks[1] <= ranks[2] and cuts.n <= 7
    # one row per word and range goes on, not one per occurrence
    ranged = df.withColumn("c", cuts.rank().cast("long"))
    rows = words_by_chunk(ranged, "doc_id", "line", "c").select("c", "word", F.size("pos").alias("n")).collect()
    assert len({(r.c, r.word) for r in rows}) == len(rows) < sum(r.n for r in rows) == len(places)


def test_whitespace_sets_agree():
    import re

    from rillet.functions.text import WHITESPACE_CHARS, WHITESPACE_JAVA

    assert len(WHITESPACE_CHARS) == 29
    # Java's \s is exactly [\t\n\x0b\f\r ]; spell it out (Python's \s is wider).
    java_class = re.compile(WHITESPACE_JAVA.replace("\\s", "\\t\\n\\x0b\\x0c\\r "))
    assert {c for c in map(chr, range(0x10000)) if java_class.fullmatch(c)} == set(WHITESPACE_CHARS)


def test_tokenize_array(spark):
    from rillet.functions import tokenize

    df = spark.createDataFrame([(" a　b  c\x1c",), (None,)], "line string")
    assert [r.t for r in df.select(tokenize("line").alias("t")).collect()] == [["a", "b", "c"], None]
