"""Best-fit packing planned on a histogram of lengths.

Texts are tokenised once.  The plan needs only the number of pieces of each length, at most
``capacity`` numbers: best-fit decreasing works on whole counts, putting all pieces of a length
into the sequences of least sufficient room at once.  Pieces then take the planned
slots by their rank within their length.  The rank is the number of pieces in lower
salts plus the rank within a salt, so that a length of many documents is not ranked in one task.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolattice.llm.common import cut, keyed, map_texts, partitions

#: Tokens of a sequence, and the token that ends a document.
CAPACITY, END = 2048, 0
TOKENIZER = "byte_bpe_50k"

_encoders: dict[str, object] = {}


def _encoder(name: str):
    """The byte-level vocabulary; its ranks and the JSON form give equal ids, the ranks several times faster."""
    if name not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)}
        )
    return _encoders[name]


def token_ids(text: str, tokenizer: str = TOKENIZER) -> np.ndarray:
    """Ids of a text and the end."""
    ids = _encoder(tokenizer).encode(text, allowed_special="all")
    return np.array([*ids, END], dtype="<u4")


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """doc_id, th, piece, start, length, ids_crc32 and, if asked for, ids.  Only the first piece of a longer document may be short."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, piece, start, length, crc, ids = [], [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            tokens = token_ids(text, tokenizer)
            bounds = [0, *range((len(tokens) - 1) % capacity + 1, len(tokens) + 1, capacity)]
            for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                part = tokens[a:b]
                owner.append(i)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(part.tobytes()))
                if with_ids:
                    ids.append(part.astype(np.int32))
        pick = pa.array(owner, pa.int64())
        arrays = [batch.column("doc_id").take(pick), batch.column("th").take(pick), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
        names = ["doc_id", "th", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return map_texts(keyed(docs), rows, "doc_id long, th long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs of slots (length, first rank, number, first sequence, offset): rank r of the run is in sequence first + r.

    Best-fit decreasing over counts.  Sequences of equal room form groups; pieces of a
    length go, many at a time, to the group of least room that takes one.  A group is
    split at most once for each length, so groups and slots stay few.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, number)
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        heap = [room for room in rooms if room >= length]
        heapq.heapify(heap)
        while left and heap:
            room = heap[0]
            if not rooms.get(room):
                heapq.heappop(heap)
                rooms.pop(room, None)
                continue
            first, number = rooms[room].pop()
            taken = min(left, number)
            if taken < number:
                rooms[room].append((first + taken, number - taken))
            slots.append((length, rank, taken, first, capacity - room))
            rank, left = rank + taken, left - taken
            if room - length not in rooms:
                rooms[room - length] = []
                if room - length >= length:
                    heapq.heappush(heap, room - length)
            rooms[room - length].append((first, taken))
        # The rest opens sequences, each filled with as many of the length as fit.
        each = capacity // length
        for number, held in ((left // each, each), (1 if left % each else 0, left % each)):
            if number:
                for k in range(held):
                    slots.append((length, rank, number, sequences, k * length))
                    rank += number
                if capacity > held * length:
                    rooms.setdefault(capacity - held * length, []).append((sequences, number))
                sequences += number
    return slots


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids.

    ``docs``: doc_id, text (null: empty, so one token).  Documents of more than ``capacity`` tokens
    are cut into pieces of ``capacity``, the first may be shorter.  Offsets of a sequence are gapless from 0.
    Repeated rows are documents of their own.  Other columns are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    found = cut(pieces(docs, capacity, tokenizer, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # at most ``capacity`` numbers
    slots = pd.DataFrame(plan(counts, capacity), columns=["length", "rank", "number", "sequence", "offset"])
    by_length = spark.sparkContext.broadcast(
        {int(k): tuple(g[c].to_numpy() for c in ("rank", "sequence", "offset")) for k, g in slots.sort_values(["length", "rank"]).groupby("length")}
    )
    key = ["length", "salt"]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "th", "piece"), F.lit(4 * partitions(spark))).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy(key).count().select(*key, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy(key).orderBy("doc_id", "th", "piece")) - 1
    ranked = salted.withColumn("within", within).join(base, key).withColumn("rank", F.col("base") + F.col("within")).drop("salt", "within", "base", "th")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            for value in np.unique(length):
                rows = length == value
                firsts, sequences, offsets = by_length.value[int(value)]
                run = np.searchsorted(firsts, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = sequences[run] + rank[rows] - firsts[run], offsets[run]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
