"""Exact dedup by a tree merge of digest runs (DataFrame functions only).

Every input partition makes a run: one row per distinct text, with the
largest identifier and the number of copies. Partitions then merge their runs
in rounds, ``radix`` neighbours at a time, until one run per text is left. A
text that a third of all rows share is one row per partition from the first
level on, so no round gathers its copies in one task. The result travels
back by the same runs: first to the (partition, text) rows, then to the
documents of that partition.

Texts are equal when identical after lower-casing A-Z (null counts as empty).
The key of a run is the SHA-256 of the normalised text, verified at every level
by its byte length and a second, independent 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import ascii_lower, shielded, written

KEY = ["_sha", "_len", "_check"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _row, _part, _sha, _len, _check) of each row, as a written table.

    ``_row`` tells repeated rows apart; being written, it and the partition
    number stay as they are when a later stage is recomputed."""
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    named = docs.select(F.col(id_col).alias("_id"), norm.alias("_text"))
    return written(named.select(
        "_id", F.monotonically_increasing_id().alias("_row"), F.spark_partition_id().alias("_part"),
        F.sha2(F.col("_text"), 256).alias("_sha"), F.octet_length("_text").alias("_len"),
        F.xxhash64("_text").alias("_check")), "digests")


def merge_runs(runs: DataFrame, parts: int, radix: int) -> DataFrame:
    """Merge runs of neighbouring partitions until one is left.

    A run has the columns of KEY, ``_part``, ``_keep`` (identifier, row) and
    ``_n``. Each level keeps the largest identifier and adds up the copies."""
    while parts > 1:
        parts = -(-parts // radix)
        runs = (runs.withColumn("_part", F.floor(F.col("_part") / radix).cast("int"))
                .groupBy("_part", *KEY).agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n")))
    return runs


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radix: int = 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest identifier stays (a null identifier is smaller
    than any other); of repeated rows with that identifier exactly one is
    ``kept``. An empty table gives an empty result; other columns of ``docs``
    are neither read nor returned, so their names can't clash."""
    slim = digests(docs, id_col, text_col)
    parts = (slim.agg(F.max("_part")).first()[0] or 0) + 1
    first = slim.groupBy("_part", *KEY).agg(
        F.max(F.struct("_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_n"))
    final = merge_runs(first, parts, radix).select(*KEY, "_keep", "_n")
    back = first.select("_part", *KEY).join(final, KEY)
    return slim.join(back, ["_part", *KEY]).select(
        F.col("_id").alias("doc_id"), F.col("_keep._id").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_keep._row")).alias("kept"), F.col("_sha").alias("text_sha256"))


@shielded
def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radix: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one of each group of equal texts.

    Of repeated rows (same identifier, same text) one stays. The texts are
    shuffled once: the join on (identifier, digest) leaves them where
    repeated rows meet."""
    name = lambda ident, sha: F.concat_ws(":", F.coalesce(F.col(ident).cast("string"), F.lit("null")), sha)
    kept = exact_groups(docs, id_col, text_col, radix).where("kept").select(name("doc_id", F.col("text_sha256")).alias("_row_name"))
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    found = docs.withColumn("_row_name", name(id_col, sha)).join(kept, "_row_name", "left_semi")
    return found.dropDuplicates(["_row_name"]).select(*docs.columns)
