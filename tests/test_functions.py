import datetime as dt

from pyspark.sql import functions as F

from rillet.functions import document_id, last_interval, second_bucket, status_level, truncating_mean
from rillet.operators import lookup
from rillet.operators.topk import restrict_to_top_keys, top_by_metric


def test_lookup_unknown_ids_are_null(spark):
    dim = spark.createDataFrame([(0, "Hippo"), (1, "ORCA"), (2, "NZAPP")], "id int, team string")
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (-1,), (None,)], "id int")
    got = {r.id: r.team for r in lookup(df, dim, "id").collect()}
    assert got == {0: "Hippo", 1: "ORCA", 2: "NZAPP", 3: None, -1: None, None: None}


def test_document_id(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    assert df.select(document_id("a", "b", "c").alias("id")).first().id == "a$n/a$3"


def test_status_and_truncation(spark):
    df = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (1.0,), (None,)], "x double")
    assert [r.s for r in df.select(status_level(F.col("x")).alias("s")).collect()] == ["ok", "ok", "bad", "bad", None]
    df = spark.createDataFrame([(-3,), (3,), (-1,)], "s long")
    assert [r.m for r in df.select(truncating_mean(F.col("s"), 2).alias("m")).collect()] == [-1, 1, 0]


def test_last_interval_and_seconds(spark):
    t = lambda m, s=0, us=0: dt.datetime(2024, 1, 1, 12, m, s, us)
    df = spark.createDataFrame([(t(0),), (t(10, 5, 900),), (t(30),)], "ts timestamp_ntz")
    got = last_interval(df, "ts", t(30), 25).select(second_bucket("ts").alias("s")).collect()
    assert sorted(r.s for r in got) == [t(10, 5), t(30)]


def test_top_keys_and_metrics(spark):
    df = spark.createDataFrame([(k, float(k % 3)) for k in range(10)] + [(None, 9.0)], "k int, v double")
    assert sorted(r.k for r in restrict_to_top_keys(df, "k", 5).collect()) == [5, 6, 7, 8, 9]
    top = top_by_metric(df, "k", {"m": F.max("v")}, "m", 3).collect()
    assert [r.k for r in top] == [2, 5, 8]


def test_epoch_millis(spark):
    from rillet.functions import epoch_millis

    df = spark.createDataFrame([("1970-01-01 00:00:01",), ("junk",)], "t string")
    assert [r.ms for r in df.select(epoch_millis("t").alias("ms")).collect()] == [1000, None]


def test_text_rows_sink(spark, tmp_path):
    from rillet.streaming import write_text_rows

    df = spark.createDataFrame([("be,", 2), ("to", None)], "word string, count long")
    write_text_rows(df, str(tmp_path / "out"))
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert sorted(x for f in files for x in f.read_text().splitlines()) == ["(be,,2)", "(to,null)"]
