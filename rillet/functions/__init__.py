"""Column-level helpers: all built from pyspark.sql.functions (JVM side)."""

from rillet.functions.text import WHITESPACE_CHARS, WHITESPACE_JAVA, WHITESPACE_RE2, split_blanks, tokenize
from rillet.functions.time import epoch_millis, last_interval, second_bucket, to_ntz
from rillet.functions.flags import document_id, status_level, truncating_mean, with_flag

__all__ = [
    "WHITESPACE_CHARS", "WHITESPACE_JAVA", "WHITESPACE_RE2", "split_blanks", "tokenize",
    "epoch_millis", "last_interval", "second_bucket", "to_ntz",
    "document_id", "status_level", "truncating_mean", "with_flag",
]
