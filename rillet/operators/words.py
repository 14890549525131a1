"""The words of many documents, one row per word with all its places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillet.functions.text import WHITESPACE_RE2

#: Bytes of text whose words are put together at a time.
BLOCK_BYTES = 16 << 20
#: Words in one Arrow batch of the result.
WORDS_PER_BATCH = 1 << 16


def word_places(docs: pa.Table, doc_id: str, line: str) -> pa.Table:
    """Columns ``word``, ``doc_id`` (by its own name) and ``pos``: each word of ``docs`` once, with the documents and positions where it
    stands (lists of one length, by document and position; documents without id first)."""
    docs = docs.filter(pc.is_valid(docs[line])).sort_by(doc_id) if docs.num_rows else docs
    ids = docs[doc_id].combine_chunks()
    if ids.null_count:
        at = np.concatenate([np.flatnonzero(ids.is_null()), np.flatnonzero(ids.is_valid())])
        docs, ids = docs.take(at), ids.take(pa.array(at))
    parts = pc.split_pattern_regex(docs[line].combine_chunks().cast(pa.large_string()), WHITESPACE_RE2)
    size = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    words, row = pc.list_flatten(parts), np.repeat(np.arange(len(size)), size)
    pos = (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
    keep = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not keep.all():
        words, row, pos = words.filter(pa.array(keep)), row[keep], pos[keep]
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy()
    doc = ids.dictionary_encode("encode").indices.to_numpy() if len(ids) else row  # documents of one id share their positions
    if len(doc) and doc[-1] != len(doc) - 1:
        at = np.lexsort((pos, doc[row], code))
    else:
        at = np.argsort(code.astype(np.uint16), kind="stable")  # two passes over 16 bits each, which numpy sorts by radix
        at = at[np.argsort((code >> 16).astype(np.uint16)[at], kind="stable")]
    ends = pa.array(np.append(0, np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))).astype(np.int32))
    return pa.table({"word": coded.dictionary.cast(pa.string()), doc_id: pa.ListArray.from_arrays(ends, ids.take(pa.array(row[at]))),
                     "pos": pa.ListArray.from_arrays(ends, pa.array(pos[at]))})


def _schema(docs: DataFrame, doc_id: str, *more: T.StructField) -> T.StructType:
    return T.StructType([*more, T.StructField("word", T.StringType(), False), T.StructField(doc_id, T.ArrayType(docs.schema[doc_id].dataType)),
                         T.StructField("pos", T.ArrayType(T.IntegerType()))])


def words_by_chunk(docs: DataFrame, doc_id: str, line: str, chunk: str) -> DataFrame:
    """:func:`word_places` of each chunk of documents: one row per chunk and word. A chunk is held by one task."""
    def run(key, table):
        found = word_places(table, doc_id, line)
        found = found.add_column(0, chunk, pa.repeat(pa.scalar(key[0].as_py(), pa.int64()), found.num_rows))
        return pa.Table.from_batches(found.to_batches(WORDS_PER_BATCH), found.schema)
    schema = _schema(docs, doc_id, T.StructField(chunk, T.LongType(), False))
    return docs.select(chunk, doc_id, line).groupBy(chunk).applyInArrow(run, schema)


def words_by_block(docs: DataFrame, doc_id: str, line: str) -> DataFrame:
    """:func:`word_places` of the documents as they come (also of a stream), about ``BLOCK_BYTES`` of text at a time:
    one row per block and word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= BLOCK_BYTES:
                yield from word_places(pa.Table.from_batches(held), doc_id, line).to_batches(WORDS_PER_BATCH)
                held, size = [], 0
        if held:
            yield from word_places(pa.Table.from_batches(held), doc_id, line).to_batches(WORDS_PER_BATCH)
    return docs.select(doc_id, line).mapInArrow(run, _schema(docs, doc_id))
