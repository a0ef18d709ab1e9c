"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of an item.  It is contained in a document only if all its
shingles (five words) are, so its rarest shingle, by the order of frequency over all
documents, is a sufficient prefix: documents and windows meet by joining on it.
The position of the shingle in the window gives the only place the window can
have in the document, which length and position bound; there the words are compared.

Documents never meet the benchmark as a whole.  A bitmap of fixed size, the only thing
that is broadcast, tells which shingles can be joined at all, and only those are
shuffled.  A larger benchmark makes it fuller and lets more through, it loses nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import cut, keyed, map_texts
from echolattice.llm.textarrays import SPACE, Spans, mix, signed, text_bytes, word_bounds, word_units

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Bits of the bitmap (512 KB whatever the size of the benchmark).
BITMAP = 1 << 22
#: A-Z to lower case, and the bytes between words: 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BETWEEN = np.zeros_like(SPACE)
BETWEEN[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def _words(column: pa.Array):
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, firsts = word_bounds(data, offsets, BETWEEN)
    return data, starts, ends, firsts, word_units(data, starts, ends)


def _shingles(units: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, place and text of every shingle of one size."""
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.flatnonzero(np.arange(len(units)) + size <= firsts[1:][text])
    return mix(Spans(units).of(at, at + size), size), at, text[at]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of items, with its shingles."""
    for batch in batches:
        data, starts, ends, firsts, units = _words(batch.column("text"))
        spans, rows = Spans(units), []
        for i, item in enumerate(batch.column("item").to_pylist()):
            n = int(firsts[i + 1] - firsts[i])
            for first in range(firsts[i], firsts[i] + max(min(n, 1), n - WINDOW + 1)):
                m = min(n, WINDOW)
                size = min(m, SHINGLE)
                at = np.arange(first, first + m - size + 1)
                words = b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(first, first + m))
                rows.append((item, words.decode(), m, size, mix(spans.of(at, at + size), size).view(np.int64).tolist()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())))],
                names=["item", "words", "m", "size", "shingles"],
            )


def _bitmap(shingles: DataFrame) -> np.ndarray:
    """Which of ``BITMAP`` places the shingles fall on; at most so many numbers reach the driver."""
    places = shingles.select(F.col("shingle").bitwiseAND(F.lit(BITMAP - 1)).cast("int").alias("place")).distinct()
    bits = np.zeros(BITMAP, dtype=bool)
    bits[places.toPandas()["place"].to_numpy(dtype=np.int64)] = True
    return np.packbits(bits)


def _hits(bitmap: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    place = (shingles & np.uint64(BITMAP - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def _union_length(spans: Column) -> Column:
    """Number of words in the union of spans (start, m)."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, x: Column) -> Column:
        end = x["start"] + x["m"]
        more = F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["start"]))
        return F.struct((acc["total"] + more).alias("total"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add)["total"]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    hit_spans, hit_items and th, which are for later steps.

    ``docs``: doc_id, text; ``benchmark``: item_id, text.  Texts are lower-cased (A-Z); words
    are runs of letters, digits and characters outside ASCII.  An item of fewer than ten words, but not none, is
    one window.  A word inside any occurrence of a window is hit.  Null has no words.  A null
    item_id is an item named by the empty string; item rows with one item_id are one item in several texts.
    Rows that repeat doc_id and text get the same result.  Other columns are
    ignored; an empty benchmark hits nothing, an empty table of documents gives no rows.
    """
    spark = docs.sparkSession
    texts = keyed(docs)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    found = cut(items.mapInArrow(_windows, "item string, words string, m int, size int, shingles array<long>"), "windows")
    named = found.select("words", "item").distinct()
    windows = found.select("words", "m", "size", "shingles").distinct()
    unrolled = windows.select("words", "m", "size", F.posexplode("shingles").alias("offset", "shingle"))
    own = unrolled.select("shingle", "size").distinct()
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())  # five numbers at most
    every = spark.sparkContext.broadcast(_bitmap(own))

    def count_rows(batch: pa.RecordBatch):
        _, _, _, firsts, units = _words(batch.column("text"))
        known = [s[_hits(every.value, s)] for s in (_shingles(units, firsts, size)[0] for size in sizes)]
        value, times = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *known]), return_counts=True)
        return pa.RecordBatch.from_arrays([signed(value), pa.array(times)], names=["shingle", "times"])

    counts = map_texts(texts, count_rows, "shingle long, times long").groupBy("shingle").agg(F.sum("times").alias("times"))
    rarity = own.join(counts, "shingle").select("shingle", "size", "times")
    # A window with a shingle that no document has occurs nowhere.
    prefix = (
        unrolled.join(rarity, ["shingle", "size"], "left").groupBy("words", "m", "size")
        .agg(F.min(F.struct(F.coalesce("times", F.lit(0).cast("long")).alias("times"), "offset", "shingle")).alias("rarest"))
        .where("rarest.times > 0").select("words", "m", F.col("rarest.offset").alias("offset"), F.col("rarest.shingle").alias("shingle"))
    )
    prefix = cut(prefix, "prefix")
    rarest = spark.sparkContext.broadcast(_bitmap(prefix))

    def document_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, firsts, units = _words(batch.column("text"))
        near: list[list[dict]] = [[] for _ in range(len(batch))]
        for size in sizes:
            shingles, at, text = _shingles(units, firsts, size)
            for k in np.flatnonzero(_hits(rarest.value, shingles)):
                place, i = int(at[k]), int(text[k])
                first, end = max(int(firsts[i]), place - WINDOW + size), min(int(firsts[i + 1]), place + WINDOW)
                words = b" ".join(data[starts[j] : ends[j]].tobytes() for j in range(first, end))
                near[i].append({"shingle": int(shingles[k].view(np.int64)), "at": place - int(firsts[i]), "before": place - first, "near": words.decode()})
        kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("near", pa.string())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(np.diff(firsts).astype(np.int64)), pa.array(near, kind)],
            names=["doc_id", "th", "n_words", "near"],
        )

    read = cut(
        map_texts(texts, document_rows, "doc_id long, th long, n_words long, near array<struct<shingle:long,at:long,before:int,near:string>>"), "read"
    )
    places = read.select("doc_id", "th", "n_words", F.inline("near"))
    start, before = F.col("at") - F.col("offset"), F.col("before") - F.col("offset")
    there = F.array_join(F.slice(F.split("near", " "), F.greatest(before, F.lit(0)) + 1, F.col("m")), " ")
    met = places.join(prefix, "shingle").where((start >= 0) & (start + F.col("m") <= F.col("n_words")) & (before >= 0))
    met = cut(met.where(there == F.col("words")).select("doc_id", "th", start.alias("start"), "m", "words").distinct(), "met")
    words = met.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", F.col("m").cast("long").alias("m"))).alias("spans"))
    occurring = (
        met.select("doc_id", "th", "words").distinct().join(named, "words").groupBy("doc_id", "th")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in ("doc_id", "th")]
    hit = words.join(occurring, same(words, occurring)).select(words["doc_id"], words["th"], "spans", "items")
    nothing = hashlib.sha256(b"").hexdigest()
    n_hit = F.coalesce(_union_length(F.col("spans")), F.lit(0).cast("long"))
    return read.join(hit, same(read, hit), "left").select(
        read["doc_id"], "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.sha2(F.array_join("items", ",").cast("binary"), 256), F.lit(nothing)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.col("spans").alias("hit_spans"), F.col("items").alias("hit_items"), read["th"],
    )
