"""Removal of repeated passages of words: seed and extend.

Seeds are winnowed anchors: of the five-word sequences in every 20-word
window, one is chosen by its fingerprint.  Documents meet by joining on seeds that occur in several of
them.  Around each seed the match is extended both ways: as far as the windows
with that anchor reach in one step, where the surroundings agree, else word by
word, each step being a window with fewer words left and more words right of
the seed.  Matches that reach the threshold are united, over all seeds, to maximal
repeats.  All occurrences of a seed are extended together by grouping, so
that a passage in many documents makes no pairs; see :mod:`echolattice.llm.repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from echolattice.llm.common import map_texts
from echolattice.llm.repeats import covered, earlier_windows, with_repeats
from echolattice.llm.textarrays import Spans, mix, text_bytes, word_bounds, word_units

#: Words of a passage that counts as a repeat, and of a seed.
LENGTH, SEED = 20, 5
#: Windows around a seed that are extended together; one at a time at last.
BLOCKS = (1,)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_bounds(data, offsets)
    return word_units(data, starts, ends), firsts


def _window(spans: Spans, at: np.ndarray) -> np.ndarray:
    half = LENGTH // 2
    return mix(mix(spans.of(at, at + half), 7) * _ODD + mix(spans.of(at + half, at + LENGTH), 7), 8)


def _names(spans: Spans, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of all between two places less than ``LENGTH`` apart: the windows at both."""
    at_first = _window(spans, first)
    return at_first if first is last else at_first * _ODD + _window(spans, last)


def remove_passages(docs: DataFrame, keep_text: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Cut every word covered by 20 consecutive words that also start earlier.

    ``docs``: doc_id, text.  Returns one row per input row: doc_id, n_words, n_removed, kept_sha256 (of
    the kept words, joined by one space) and, if asked for, spans (arrays of first word and the one after
    the last) and kept (the text without the words cut; untouched if nothing was cut).  Columns of ``docs`` in
    ``carry`` come along in the struct ``carried``, with ``NO_TEXT`` of :mod:`repeats`, so that texts are shuffled with them once.

    Words are separated by spaces and the control characters 0x09 to 0x0D.  Null texts are empty;
    texts under 20 words lose nothing.  Earlier is a smaller doc_id (null: before all), or an earlier
    word of the text.  Rows sharing a doc_id are compared with other documents and themselves, not
    with each other; rows that repeat doc_id and text get the same result.  Other columns are
    ignored, an empty table gives no rows.
    """
    repeats = earlier_windows(docs, _units, _names, LENGTH, SEED, BLOCKS)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        starts, ends, firsts = word_bounds(data, offsets)
        whole = data.tobytes()
        rows, spans, kept = [], [], []
        for i, found in enumerate(batch.column("repeats").to_pylist()):
            text, n = whole[offsets[i] : offsets[i + 1]], int(firsts[i + 1] - firsts[i])
            rest, gone, edges = text, 0, np.zeros(0, dtype=np.int64)
            if found:
                gone_at = covered(found, n, LENGTH)
                gone, edges = int(gone_at.sum()), np.flatnonzero(np.diff(np.concatenate([[0], gone_at.view(np.int8), [0]])))
                # What is cut starts at a word and ends where the next kept word starts, or with the text.
                place = np.append(starts[firsts[i] : firsts[i + 1]] - offsets[i], len(text))
                bounds = [0, *place[edges], len(text)]
                rest = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
            rows.append((n, gone, hashlib.sha256(b" ".join(rest.split())).hexdigest()))
            if keep_text:
                spans.append([{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(rest.decode())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))]
        arrays, names = [batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if keep_text:
            arrays += [pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())]
            names += ["spans", "kept"]
        if carry:
            arrays.append(batch.column("carried"))
            names.append("carried")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    found = with_repeats(docs, repeats, carry)
    schema += ", spans array<struct<first:long,end:long>>, kept string" if keep_text else ""
    schema += f", carried {found.schema['carried'].dataType.simpleString()}" if carry else ""
    return map_texts(found, finish, schema)
