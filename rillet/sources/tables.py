"""The driver's parquet tables and the roles they play for the reference's jobs.

``events`` plays the signal and the bit stream, ``customer`` + ``nation``
the payments and teams, ``documents.text`` the lines of text. Each role is a
projection only, so Catalyst prunes the scan to the columns a job uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, folder: str, names=TABLES) -> list[str]:
    """Register each ``<name>.parquet`` of ``folder`` as a temporary view (S7), so
    jobs can look tables up by name (``spark.table``) or in SQL. Returns the
    names registered; missing tables are skipped."""
    done = []
    for name in names:
        path = f"{folder.rstrip('/')}/{name}.parquet"
        if path_kind(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            done.append(name)
    return done


def path_kind(spark: SparkSession, path: str) -> str | None:
    """``"dir"``, ``"file"`` or None (nothing there), asked of the file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return "dir" if fs.getFileStatus(p).isDirectory() else "file"


def role_signal(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, user_id, value, flag): the QA job's flagged signal.

    The flag is deterministic (``event_type = 'error'``), so every branch of a
    fan-out sees the same flags without materialising them.
    """
    return events.select(
        "event_id", "ts", "user_id", "value",
        (F.col("event_type") == F.lit("error")).cast("int").alias("flag"),
    )


def role_bits(events: DataFrame) -> DataFrame:
    """events -> (event_id, ts, user_id, bit): a 0/1 stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", "ts", "user_id", F.pmod(k, F.lit(2)).alias("bit"))


def role_payments(customer: DataFrame) -> DataFrame:
    """customer -> (team_id, pay_amount)."""
    return customer.select(F.col("c_nationkey").alias("team_id"),
                           F.col("c_acctbal").alias("pay_amount"))


def role_teams(nation: DataFrame) -> DataFrame:
    """nation -> dimension (team_id, team)."""
    return nation.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team"))


def role_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("text").alias("line"))
