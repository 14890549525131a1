"""Token counts from an exact length histogram.

Documents are encoded once; all that leaves a task is a count per length. Sums
over the histogram from either end then answer totals, quantiles and
truncated totals for every context limit, without another pass over the texts.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import add_columns, written

#: Rank file of the byte-level BPE; must be at this path on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that belongs to that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters encoded at once. Between a character and a single space before another one no pre-token
#: can run on, so cutting a long text there leaves its tokens as they are.
PIECE_CHARS = 1 << 16
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Runs of so many blanks are one pre-token, which needs no pattern. (The pattern's look-ahead goes one level
#: deeper for every blank, so a run of a million would overflow its stack.) The class is what the pattern's ``\\s`` means.
BLANKS = 4096
_BLANK_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % BLANKS)
#: Lengths per block of the two-level running sums.
BLOCK = 1024


@functools.cache
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("rillet", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str):
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = _CUT.search(text, at + PIECE_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def n_tokens(encoding, text: str) -> int:
    """Tokens of a text of any length. A long run of blanks is one pre-token but for its last
    blank, which the pattern hands to what follows; at the end of the text it is one as a whole."""
    count, at = 0, 0
    for run in _BLANK_RUN.finditer(text):
        a, end = run.start(), run.end() if run.end() == len(text) else run.end() - 1
        count += sum(len(encoding.encode_ordinary(p)) for p in pieces(text[at:a]))
        count += len(encoding._encode_single_piece(text[a:end]))
        at = end
    return count + sum(len(encoding.encode_ordinary(p)) for p in pieces(text[at:]))


def with_token_counts(docs: DataFrame, out: str = "_tokens", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the number of tokens of each whole text (null: 0)."""
    def lengths(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        encoding = encoder(vocabulary)
        raw = data.tobytes()
        texts = (raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True))
        return [np.array([n_tokens(encoding, t) for t in texts], np.int64)]

    return add_columns(docs, {out: "long"}, lengths, text_col)


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(length, n_docs): how many documents have each encoded length. Empty table: no rows."""
    counted = with_token_counts(docs.select(F.col(text_col).alias("_text")), text_col="_text", vocabulary=vocabulary)
    return counted.groupBy(F.col("_tokens").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def answers(histogram: DataFrame) -> DataFrame:
    """For each length of the histogram as a context limit: documents and tokens up to
    it, documents beyond it, tokens left when every document is cut to it, tokens
    lost, and the share of documents that fit whole (their rank for quantiles).

    Between two lengths of the histogram the same sums hold, so
    :func:`at_limits` and :func:`quantiles` answer any limit from these rows."""
    h = histogram.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"),
                         F.floor(F.col("length") / BLOCK).alias("_block"))
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    # one row per 1,024 lengths that occur
    down = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = blocks.select("_block", *(F.coalesce(F.sum(c).over(down), F.lit(0)).alias(f"{c}0") for c in ("_d", "_t")),
                           F.sum("_d").over(whole).alias("total_docs"), F.sum("_t").over(whole).alias("total_tokens"))
    w = Window.partitionBy("_block").orderBy("length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (h.join(before, "_block")
            .withColumn("docs_within", F.col("_d0") + F.sum("n_docs").over(w))
            .withColumn("tokens_within", F.col("_t0") + F.sum("n_tokens").over(w))
            .withColumn("docs_beyond", F.col("total_docs") - F.col("docs_within"))
            .withColumn("truncated_total", F.col("tokens_within") + F.col("length") * F.col("docs_beyond"))
            .select("length", "n_docs", "n_tokens", "docs_within", "tokens_within", "docs_beyond", "truncated_total",
                    (F.col("total_tokens") - F.col("truncated_total")).alias("tokens_lost"),
                    (F.col("docs_within") / F.col("total_docs")).alias("fit_share"), "total_docs", "total_tokens"))


def at_limits(found: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_beyond, truncated_total) for any limits, from :func:`answers`."""
    parts = []
    for x in map(int, limits):
        up_to = F.col("length") <= x
        docs, tokens = (F.coalesce(F.max(F.when(up_to, F.col(c))), F.lit(0)) for c in ("docs_within", "tokens_within"))
        beyond = F.coalesce(F.max("total_docs"), F.lit(0)) - docs
        parts.append(found.agg(beyond.alias("docs_beyond"), (tokens + x * beyond).alias("truncated_total"))
                     .select(F.lit(x).cast("long").alias("context_limit"), "docs_beyond", "truncated_total"))
    return functools.reduce(DataFrame.unionAll, parts)


def quantiles(found: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of documents doesn't exceed."""
    parts = [found.where(F.col("docs_within") >= F.ceil(F.lit(float(q)) * F.col("total_docs")))
             .agg(F.min("length").alias("length")).select(F.lit(float(q)).alias("share"), "length") for q in shares]
    return functools.reduce(DataFrame.unionAll, parts)


def token_table(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """:func:`answers` of the documents, from one encoding pass (the histogram is written)."""
    return answers(written(length_histogram(docs.select("text"), vocabulary=vocabulary), "token-lengths"))
