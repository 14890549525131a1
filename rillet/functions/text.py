"""Whitespace tokenising with the semantics of Python's ``str.split()`` (F1).

Tokens are maximal runs of non-whitespace; case and punctuation are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.split() splits on, from the rule that defines them
# (str.isspace); all lie below U+3001.
WHITESPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# The same set as regular-expression classes, in code-point
# order: U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Java's \s covers U+0009-U+000D and U+0020 only; the rest are listed.
WHITESPACE_JAVA = (
    "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
)
# The same set in RE2 syntax (DuckDB, Arrow), where \s lacks U+000B.
WHITESPACE_RE2 = (
    "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
)


def spaces_to_blank(line: Column | str) -> Column:
    """Every whitespace character replaced by a plain space (a character map)."""
    c = F.col(line) if isinstance(line, str) else line
    return F.translate(c, WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))


def split_blanks(line: Column | str) -> Column:
    """Split on single whitespace characters; empty strings mark runs and edges.

    Mapping whitespace to a space and splitting on that one character takes
    the JVM's single-character split path instead of its regex engine.
    """
    return F.split(spaces_to_blank(line), " ")


def tokenize(line: Column | str) -> Column:
    """Array of the whitespace-separated tokens of ``line`` (no empties)."""
    return F.filter(split_blanks(line), lambda t: t != F.lit(""))
