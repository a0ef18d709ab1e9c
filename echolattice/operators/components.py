"""Four-connected components of boolean images, for all images in one job.

Pixels are first folded into horizontal runs on the JVM side, with whatever
per-run sums the caller wants, so only runs travel further.  An image whose
lattice bounds its number of runs is labelled within one task; a larger image is
labelled by tiles, whose labels are united at their borders.  Both give the smallest raster index of the
component as its label.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.session import cut_lineage


def image_runs(
    pixels: DataFrame, image: Sequence[str], row: str, col: str, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Maximal horizontal runs: (image, row, first, last, pixels, sums...).

    The window is one image row, bounded by the width of the lattice; the
    aggregation that follows reuses its partitioning.
    """
    line = Window.partitionBy(*image, row).orderBy(col)
    marked = pixels.withColumn("__island", F.col(col) - F.row_number().over(line))
    return (
        marked.groupBy(*image, F.col(row).alias("row"), "__island")
        .agg(
            F.min(col).alias("first"),
            F.max(col).alias("last"),
            F.count(F.lit(1)).alias("pixels"),
            *[expression.alias(name) for name, expression in (sums or {}).items()],
        )
        .drop("__island")
    )


def component_of_runs(
    start: np.ndarray, stop: np.ndarray, width: int, wrap_rows: int | None, image_rows: int | None = None
) -> np.ndarray:
    """Label runs by their sorted raster indices; the label is the least index of the component.

    Several images may follow each other, ``image_rows`` apart with an empty row between.
    """
    row = start // width

    def touching(chosen: np.ndarray, target_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = (target_row - row[chosen]) * width
        low = np.searchsorted(stop, start[chosen] + shift, "left")
        high = np.searchsorted(start, stop[chosen] + shift, "right")
        count = np.maximum(high - low, 0)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(chosen, count), np.repeat(low, count) + offset

    everyone = np.arange(len(start))
    left, right = touching(everyone, row + 1)
    if wrap_rows is not None:
        local = row if image_rows is None else row % image_rows
        last = everyone[local == wrap_rows - 1]
        more_left, more_right = touching(last, row[last] - (wrap_rows - 1))
        left, right = np.concatenate([left, more_left]), np.concatenate([right, more_right])
    label = everyone.copy()
    while True:
        a, b = label[left], label[right]
        if np.array_equal(a, b):
            return start[label]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def _label_in_tasks(
    runs: DataFrame, image: Sequence[str], rows: int, width: int, wrap_rows: int | None
) -> DataFrame:
    """Images gathered whole and in order; each Arrow batch labels all images it completes.

    A task holds one batch and at most one unfinished image, whose runs the lattice bounds.
    """
    keys = list(image)
    image_rows = rows + 1

    def label_images(held: list[pd.DataFrame]) -> pd.DataFrame:
        out = held[0].copy() if len(held) == 1 else pd.concat(held, ignore_index=True)
        row = out["row"].to_numpy(np.int64)
        if len(row) and (row.max() >= rows or row.min() < 0):
            raise ValueError(f"a row lies outside the {rows} rows of the lattice")
        fresh = np.zeros(len(out), dtype=bool)
        for key in keys:
            value = out[key].to_numpy()
            fresh[1:] |= value[1:] != value[:-1]
        offset = np.cumsum(fresh) * (image_rows * width)
        base = offset + row * width
        start, stop = base + out["first"].to_numpy(np.int64), base + out["last"].to_numpy(np.int64)
        out["label"] = component_of_runs(start, stop, width, wrap_rows, image_rows) - offset
        return out

    def label_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            same = np.ones(len(batch), dtype=bool)
            for key in keys:
                value = batch[key].to_numpy()
                same &= value == value[-1]
            cut = len(batch) - int(same.sum())
            final = tuple(batch[k].iloc[-1] for k in keys)
            if cut:
                yield label_images([*held, batch.iloc[:cut]])
                held = [batch.iloc[cut:]]
            elif held and tuple(held[-1][k].iloc[-1] for k in keys) != final:
                yield label_images(held)
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield label_images(held)

    schema = runs.withColumn("label", F.lit(0).cast("bigint")).schema
    ordered = runs.repartition(*keys).sortWithinPartitions(*keys, "row", "first")
    return ordered.mapInPandas(label_batches, schema)


def _least_reached(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, root): the least label each label reaches over ``edges`` (keys, a, b), by rounds with pointer jumping.

    The lineage is cut every round.
    """
    both = edges.union(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut_lineage(both)
    labels = both.select(*keys, F.col("a").alias("label")).distinct().withColumn("root", F.col("label"))
    while True:
        seen = both.join(labels.select(*keys, F.col("label").alias("b"), F.col("root").alias("seen")), [*keys, "b"])
        lowest = seen.groupBy(*keys, F.col("a").alias("label")).agg(F.min("seen").alias("seen"))
        met = labels.join(lowest, [*keys, "label"]).select(*keys, "label", F.col("root").alias("before"), F.least("root", "seen").alias("root"))
        jump = met.select(*keys, F.col("label").alias("root"), F.col("root").alias("further"))
        stepped = cut_lineage(met.join(jump, [*keys, "root"]).select(*keys, "label", "before", F.col("further").alias("root")))
        labels = stepped.drop("before")
        if stepped.filter(F.col("root") != F.col("before")).isEmpty():
            return labels


#: Rows and columns of a tile of an image no task can hold.
TILE = 1024


def _label_in_tiles(
    runs: DataFrame, image: Sequence[str], rows: int, width: int, wrap_rows: int | None, tile: int
) -> DataFrame:
    """Labels inside tiles, each in a task, then a union of labels that meet at tile borders.

    Runs are cut at the borders of tiles and moved to their tile once.  After that only cells on borders are
    joined, and only labels that touch a border go through rounds; what lies inside a tile is never looked at again.
    """
    keys = list(image)
    tiled = [*keys, "__tr", "__tc"]
    pieces = runs.withColumns({"__first": F.col("first"), "__last": F.col("last"), "__tr": F.expr(f"row div {tile}")})
    pieces = pieces.withColumn("__tc", F.explode(F.sequence(F.expr(f"first div {tile}"), F.expr(f"last div {tile}"))))
    pieces = pieces.withColumns({
        "first": F.greatest("first", (F.col("__tc") * tile).cast("int")), "last": F.least("last", (F.col("__tc") * tile + tile - 1).cast("int")),
    })
    labelled = cut_lineage(_label_in_tasks(pieces, tiled, rows, width, None))

    def cells(which: Column, row: Column) -> DataFrame:
        return labelled.filter(which).select(*keys, row.alias("row"), "label", F.explode(F.sequence("first", "last")).alias("col"))

    def met(one: DataFrame, other: DataFrame) -> DataFrame:
        pairs = one.join(other.withColumnRenamed("label", "__other"), [*keys, "row", "col"])
        return pairs.select(*keys, F.col("label").alias("a"), F.col("__other").alias("b")).filter("a <> b").distinct()

    row, top = F.col("row"), F.col("row") % tile == 0
    edges = met(cells(row % tile == tile - 1, row + 1), cells(top, row))
    ends = labelled.filter((F.col("last") + 1) % tile == 0).select(*keys, "row", "label", (F.col("last") + 1).alias("col"))
    begins = labelled.filter(F.col("first") % tile == 0).select(*keys, "row", "label", F.col("first").alias("col"))
    edges = edges.union(met(ends, begins))
    if wrap_rows is not None:
        edges = edges.union(met(cells(row == wrap_rows - 1, F.lit(0)), cells(row == 0, F.lit(0))))
    roots = _least_reached(edges, keys)
    whole = labelled.filter(F.expr(f"__first div {tile}") == F.col("__tc")).withColumns({"first": F.col("__first"), "last": F.col("__last")})
    joined = whole.join(roots, [*keys, "label"], "left").withColumn("label", F.coalesce("root", "label"))
    return joined.select(*runs.columns, "label")


def label_runs(
    runs: DataFrame,
    image: Sequence[str],
    rows: int,
    width: int,
    wrap: bool = False,
    rounds: bool = False,
    tile: int = TILE,
) -> DataFrame:
    """Runs with their component's label (``row * width + column`` of its first pixel).

    ``rows`` and ``width`` are the lattice of every image, and therefore a proven
    bound of the runs an image has; images are labelled in tasks, many at a time.  ``rounds``
    is for callers whose images no task can hold: these are labelled by tiles.
    """
    wrap_rows = rows if wrap else None
    if rounds:
        return _label_in_tiles(runs, image, rows, width, wrap_rows, tile)
    return _label_in_tasks(runs, image, rows, width, wrap_rows)


def label_components(
    pixels: DataFrame,
    image: Sequence[str],
    rows: int,
    width: int,
    row: str = "iy",
    col: str = "ix",
    wrap: bool = False,
    rounds: bool = False,
    tile: int = TILE,
) -> DataFrame:
    """Every pixel of the mask with its component's label."""
    labelled = label_runs(image_runs(pixels, image, row, col), image, rows, width, wrap, rounds, tile)
    return labelled.select(
        *image, F.col("row").alias(row), F.explode(F.sequence("first", "last")).alias(col), "label"
    )
