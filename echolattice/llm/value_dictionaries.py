"""Codes for vectors by codebooks, with distances read from dictionaries of values.

A vector is cut into equal parts; each part is named by the nearest entry of the codebook of its place.
Components are integers, and a dimension repeats few of them, so vectors are kept in blocks as Parquet
keeps columns: for each dimension the distinct integers in order and, for each vector, the place of its integer among them.
Blocks are coded once, written, and read by every round.

For a round, a block tabulates for each dimension the squared differences of its distinct integers to
the components of all entries.  The distances of a part are then rows gathered from the tables of its dimensions, and added.
A round returns sums and counts of entries, by task and entry, which Spark adds up; the driver holds codebooks only
(entries times dimensions numbers, whatever the number of vectors).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import cut

#: Parts of a vector, entries of a codebook (256 at most), rounds of improvement, and steps to a unit.
PARTS, ENTRIES, ROUNDS, STEPS = 16, 64, 2, 256
#: Vectors of a block at most (places are of 16 bits), and numbers of a block.
BLOCK, BLOCK_NUMBERS = 8192, 1 << 22
#: Integers beyond are taken for these: squares and their sums over 4,096 dimensions stay exact in 64 bits.
LARGEST = 1 << 24
_BLOCKS = "dims int, n int, ids array<long>, labels array<long>, sizes binary, values binary, places binary"


@dataclass
class Block:
    """``values``: for each dimension its distinct integers; ``places``: for each dimension and vector one of them."""

    ids: pa.Array
    labels: pa.Array
    values: list[np.ndarray]
    places: np.ndarray

    def integers(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([v[p[rows]] for v, p in zip(self.values, self.places)], axis=1)


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 x), within the range that is exact."""
    return np.clip(np.floor(x.astype(np.float64) * STEPS), -LARGEST, LARGEST).astype(np.int64)


def dictionaries(rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For each column the distinct values in order, and places among them."""
    found = [np.unique(c, return_inverse=True) for c in rows.T]
    return [v for v, _ in found], np.array([p for _, p in found], dtype=np.uint16).reshape(len(found), len(rows))


def _coded(vectors: DataFrame) -> DataFrame:
    """Blocks of the vectors that are kept; those of a block have one length."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            good = pc.fill_null(pc.is_finite(flat), False).to_numpy(zero_copy_only=False)
            x = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~good)])
            fit = (lengths > 0) & (lengths % PARTS == 0) & (bad[ends] == bad[ends - lengths])
            for dims in np.unique(lengths[fit]):
                rows = np.flatnonzero(fit & (lengths == dims))
                size = min(BLOCK, max(1, BLOCK_NUMBERS // int(dims)))
                for chunk in (rows[k : k + size] for k in range(0, len(rows), size)):
                    values, places = dictionaries(integers(x[(ends - lengths)[chunk][:, None] + np.arange(dims)]))
                    ids, labels = (pa.array([batch.column(c).take(pa.array(chunk)).to_pylist()], pa.list_(pa.int64())) for c in ("vec_id", "label"))
                    sizes = np.array([len(v) for v in values], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dims], pa.int32()), pa.array([len(chunk)], pa.int32()), ids, labels, *[pa.array([a.tobytes()], pa.binary()) for a in (sizes, np.concatenate(values), places)]],
                        names=["dims", "n", "ids", "labels", "sizes", "values", "places"],
                    )

    return vectors.mapInArrow(code, _BLOCKS)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            sizes, values, places = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=t) for c, t in (("sizes", np.int32), ("values", np.int64), ("places", np.uint16)))
            ids, labels = (batch.column(c)[k].values for c in ("ids", "labels"))
            yield Block(ids, labels, np.split(values, np.cumsum(sizes)[:-1]), places.reshape(len(sizes), -1))


def nearest(block: Block, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part and vector the nearest entry (the first, if several are) and its squared distance.

    ``books``: part, entry, component.
    """
    parts, _, width = books.shape
    entry, error = (np.zeros((parts, block.places.shape[1]), dtype=np.int64) for _ in range(2))
    for part in range(parts):
        dims = range(part * width, (part + 1) * width)
        tables = [np.square(block.values[d][:, None] - books[part, :, d - part * width][None, :]) for d in dims]
        if sum(int(t.max()) for t in tables) < 2**31:  # narrower numbers, the same values
            tables = [t.astype(np.int32) for t in tables]
        distance = tables[0][block.places[dims[0]]]
        for d, table in zip(dims[1:], tables[1:]):
            distance += table[block.places[d]]
        entry[part] = distance.argmin(axis=1)
        error[part] = np.take_along_axis(distance, entry[part][:, None], axis=1)[:, 0]
    return entry, error


def _first_entries(blocks: DataFrame, dims: int, entries: int) -> np.ndarray:
    """The vectors of the smallest vec_ids, null after all others; of one vec_id the least integers first."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            ids = block.ids.to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            # All with the last vec_id taken, as their integers decide between them.
            end = min(entries, len(order))
            while end < len(order) and ids[order[end]] == ids[order[end - 1]]:
                end += 1
            rows = np.array(order[:end])
            if end > entries:
                x = block.integers(rows)
                rows = rows[sorted(range(end), key=lambda k: (ids[rows[k]] is None, ids[rows[k]] or 0, x[k].tolist()))[:entries]]
            yield pa.RecordBatch.from_arrays([block.ids.take(pa.array(rows)), pa.array(block.integers(rows).tolist(), pa.list_(pa.int64()))], names=["vec_id", "x"])

    found = blocks.mapInArrow(least, "vec_id long, x array<long>").orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    x = np.array([r[0] for r in found], dtype=np.int64)
    return x.reshape(len(x), PARTS, dims // PARTS).transpose(1, 0, 2)


def _moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of the mean of their parts; those without parts stay."""
    parts, entries, width = books.shape
    given = blocks.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for block in _blocks(batches):
            for part, found in enumerate(nearest(block, given.value)[0]):
                count[part] += np.bincount(found, minlength=entries)
                for k in range(width):
                    d = part * width + k
                    # Sums of a block are below 2^53, so exact.
                    total[part, :, k] += np.bincount(found, weights=block.values[d][block.places[d]], minlength=entries).astype(np.int64)
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    sums = blocks.mapInArrow(add, "part long, entry long, n long, total array<long>").groupBy("part", "entry")
    out = books.copy()
    for row in sums.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[k]) for k in range(width)]).alias("total")).collect():
        out[row["part"], row["entry"]] = np.array(row["total"], dtype=np.int64) // row["n"]
    return out


@dataclass
class Codes:
    """``rows``: vec_id, label, code, error; ``books``: part, entry, component (null: nothing to code)."""

    rows: DataFrame
    books: np.ndarray | None

    def digest(self) -> str:
        """SHA-256 of all components of all entries, joined by commas."""
        return hashlib.sha256(",".join(map(str, [] if self.books is None else self.books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes:
    """Codebooks and codes of all vectors; ``vectors``: vec_id, label and the vector.

    Left out are vectors that are null, empty, or hold null or non-finite components, those whose length sixteen does not
    divide, and those that have not the length most vectors have (of equally frequent ones the shortest).  Integers
    beyond ``LARGEST`` (components of 65,536) are taken for it.  Codebooks start from the smallest vec_ids (null after all
    others; of repeated ones the least vectors), with fewer entries if there are fewer vectors; equal entries
    go to the first.  Repeated rows count each for itself and get equal codes.  Null labels are kept.  Other
    columns are ignored.  No vector gives no rows.
    """
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vector).alias("vector"))
    blocks = cut(_coded(chosen.where("vector IS NOT NULL")), "blocks")
    most = blocks.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "dims").first()
    if most is None:
        return Codes(chosen.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None)
    blocks = blocks.where(F.col("dims") == most["dims"])
    books = _first_entries(blocks, most["dims"], entries)
    for _ in range(rounds):
        books = _moved(blocks, books)
    given = blocks.sparkSession.sparkContext.broadcast(books)
    hexes = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            entry, error = nearest(block, given.value)
            codes = ["".join(c) for c in hexes[entry.T].tolist()]
            yield pa.RecordBatch.from_arrays([block.ids, block.labels, pa.array(codes, pa.string()), pa.array(error.sum(axis=0))], names=["vec_id", "label", "code", "error"])

    return Codes(cut(blocks.mapInArrow(assign, "vec_id long, label long, code string, error long"), "codes"), books)


def with_label_errors(codes: Codes) -> DataFrame:
    """The rows with ``label_error``, the error of all rows of the same label (null is one); null where it exceeds 64 bits."""
    total = F.expr("try_cast(sum(cast(error AS decimal(38, 0))) AS bigint)")
    labels = codes.rows.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of_label")
    return codes.rows.join(labels, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
