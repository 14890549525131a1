"""The word splitter as a Python table function (API parity with a UDTF job, U2).

The JVM tokenizer in :mod:`rillet.functions.text` is the fast path; this
form exists for jobs written against a table-function API. It is a
PyArrow-native table function: each call gets a whole Arrow batch of lines
and splits it with Arrow's vectorised regex kernel (no per-row Python). It
reads its input as a table argument, so Spark spreads the lines over all
tasks.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udtf

from rillet.functions.text import WHITESPACE_RE2


@arrow_udtf(returnType="word: string")
class SplitWords:
    """One output row per whitespace-separated token of the ``line`` column."""

    def eval(self, batch: pa.RecordBatch):
        tokens = pc.list_flatten(pc.split_pattern_regex(batch.column("line"), WHITESPACE_RE2))
        yield pa.table({"word": pc.filter(tokens, pc.not_equal(tokens, ""))})


def split_words(lines: DataFrame) -> DataFrame:
    """``lines(line)`` -> ``(word)`` through the Arrow table function."""
    return SplitWords(lines.select("line").asTable())
