"""Removal of repeated byte strings of 100 bytes, by winnowed window hashing in place of suffix buckets.

Windows of 100 bytes are found by :mod:`echolattice.llm.repeats`, as those of op5 are: a window is anchored at its
25-byte seed of least fingerprint, and windows with one anchor are grouped by fingerprints.
There are no rounds of refinement: no suffixes enter buckets but at anchors, nothing is sorted on
bucket identifiers of later offsets, and none are updated.  What is left of bucket pointers is how the fingerprint of
100 bytes is made (:func:`bucket_ids`): from those of 50 bytes, and these from those of 25, within one text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from echolattice.llm.common import map_texts
from echolattice.llm.repeats import covered, earlier_windows, with_repeats
from echolattice.llm.textarrays import BYTE, Spans, mix, text_bytes

#: Bytes of a string that counts as a repeat, and of the initial buckets.
LENGTH, QGRAM = 100, 25
#: Suffixes that are refined together where a bucket has several surroundings.
BLOCKS = (8, 1)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return BYTE[data], offsets


def bucket_ids(spans: Spans, at: np.ndarray, length: int, qgram: int = QGRAM) -> np.ndarray:
    """Identifiers of the buckets of ``length`` bytes at some places: pairs of identifiers of half the length."""
    if length <= qgram:
        return mix(spans.of(at, at + length), 7)
    half = (length + 1) // 2
    return mix(bucket_ids(spans, at, half, qgram) * _ODD + bucket_ids(spans, at + length - half, half, qgram), 8)


def _names(spans: Spans, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of all between two places less than ``LENGTH`` apart: the identifiers at both."""
    at_first = bucket_ids(spans, first, LENGTH)
    return at_first if first is last else at_first * _ODD + bucket_ids(spans, last, LENGTH)


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Cut every byte covered by a 100-byte string that also starts earlier.

    ``docs``: doc_id, text.  Returns one row per input row: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and, if asked for, spans (array of start and
    end) and kept (binary; a cut may fall inside a character).

    Null texts are empty; texts under 100 bytes lose nothing.  Earlier is a smaller
    doc_id (null: before all), or a smaller start in the text.  Rows sharing a doc_id are compared
    with other documents and themselves, not with each other; rows that repeat
    doc_id and text get the same result.  Other columns are ignored, an empty table gives no rows.
    """
    repeats = earlier_windows(docs, _units, _names, LENGTH, QGRAM, BLOCKS)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, spans, kept = [], [], []
        for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("repeats").to_pylist()):
            if not found:
                rest, gone, edges = text, 0, np.zeros(0, dtype=np.int64)
            else:
                gone_at = covered(found, len(text), LENGTH)
                rest, gone = np.frombuffer(text, dtype=np.uint8)[~gone_at].tobytes(), int(gone_at.sum())
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone_at.view(np.int8), [0]])))
            rows.append((len(text), gone, len(edges) // 2, hashlib.sha256(rest).hexdigest()))
            if keep_text:
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(rest)
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
        arrays, names = [batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if keep_text:
            arrays += [pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]
            names += ["spans", "kept"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return map_texts(with_repeats(docs, repeats), finish, schema + (", spans array<struct<start:long,end:long>>, kept binary" if keep_text else ""))
