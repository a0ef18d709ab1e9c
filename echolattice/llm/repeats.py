"""Which windows of fixed length occur earlier in the corpus: the exact core of both substring operators.

A window is ``window`` consecutive units (bytes or words) of one text.  Sampled
places stand for all others: of the ``gram``-unit seeds in a window, the one of
least fingerprint is its anchor (the first, if several are least).  Equal windows have equal anchors at the same
distance, so windows need comparing only with windows of the same anchor seed.
Consecutive windows with one anchor form a run, a single row, with a fingerprint
of the anchor seed and one of all the run covers.

1. Seeds that occur in one text are done.  The count is an aggregate with partial sums.
2. Of runs whose seed has one surrounding only, all but those of the first text
   are repeats as a whole.
3. Where a seed has several surroundings, equal runs are grouped once more;
   again all but the first of a group are repeats as a whole.
4. What is left are the first runs of different surroundings of one seed.  They
   are cut into smaller blocks of windows, whose seed is the part all windows of a block
   share, and these go through the same steps; at last the blocks are single windows.

No pairs are made: a group of m copies costs m rows.  ``earlier`` means a smaller
doc_id or, in one text, a smaller start; repeats within a text are settled in
the task which reads it, so that groups need the smallest doc_id only.  Rows of one
doc_id are not compared with each other.
Fingerprints have 64 bits for seeds and 64 for runs or windows, compared jointly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import NO_ID, cut, discard, keyed, map_texts
from echolattice.llm.textarrays import Spans, mix, signed, sliding_min

#: Units of a slice: fingerprints of units, and the number of the first unit of each text.
Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
#: Two fingerprints of the windows at the starts given.
Names = Callable[[Spans, np.ndarray, np.ndarray], np.ndarray]

RUNS = "doc_id long, th long, first int, windows int, lead int, seed long, around long, again boolean"


def _first_of(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs for the first time."""
    first = np.zeros(len(keys), dtype=bool)
    first[np.unique(keys, return_index=True)[1]] = True
    return first


def _salt(text: np.ndarray) -> np.ndarray:
    return text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _unroll(first: np.ndarray, count: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every window of some runs, in order of place, and its text."""
    start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    order = np.argsort(start, kind="stable")
    return start[order], np.repeat(text, count)[order]


def _runs(units: np.ndarray, firsts: np.ndarray, window: int, gram: int, names: Names):
    lengths = np.diff(firsts)
    text = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(np.arange(len(units)) + window <= firsts[1:][text])
    if not len(at):
        return None
    spans = Spans(units)
    seeds = mix(spans.all_of(gram), 1)
    place = np.arange(len(seeds), dtype=np.uint64)
    anchor = (sliding_min((seeds & np.uint64(0xFFFFFFFF00000000)) | place, window - gram + 1)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[at][1:] != text[at][:-1])]))
    first, last, anchor = at[change], at[np.concatenate([change[1:], [len(at)]]) - 1], anchor[change]
    count = last - first + 1
    around = mix(names(spans, first, last) + (count * 4096 + (anchor - first)).astype(np.uint64), 2)
    text = text[first]
    seed = mix(spans.of(anchor, anchor + gram), 3)
    again = ~_first_of(mix(seed ^ mix(around, 4)) + _salt(text))
    # A seed with several surroundings in one text: its windows are settled here, one by one.
    _, inverse, times = np.unique(seed + _salt(text), return_inverse=True, return_counts=True)
    twice = np.flatnonzero((times[inverse] > 1) & ~again)
    start, within = _unroll(first[twice], count[twice], text[twice])
    dup = ~_first_of(mix(mix(spans.of(start, start + window), 5) ^ mix(names(spans, start, start), 6)) + _salt(within))
    start, within = start[dup], within[dup]
    none = np.zeros(len(start), dtype=np.uint64)
    lead = anchor - first
    text, first = np.concatenate([text, within]), np.concatenate([first, start])
    return (
        text, first - firsts[:-1][text], np.concatenate([count, np.ones(len(start), dtype=np.int64)]),
        np.concatenate([lead, np.zeros(len(start), dtype=np.int64)]), np.concatenate([seed, none]), np.concatenate([around, none]), np.concatenate([again, np.ones(len(start), dtype=bool)]),
    )


def _blocks(units: np.ndarray, firsts: np.ndarray, runs: pa.ListArray, size: int, window: int, names: Names):
    """Runs cut into blocks of up to ``size`` windows, by the distance of windows to the anchor."""
    spans, flat = Spans(units), runs.flatten()
    run_text = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
    first = flat.field("first").to_numpy() + firsts[:-1][run_text]
    count, lead = flat.field("windows").to_numpy().astype(np.int64), flat.field("lead").to_numpy()
    anchor = np.repeat(first + lead, count)
    start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    block = (anchor - start) // size
    run = np.repeat(np.arange(len(first)), count)
    change = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (run[1:] != run[:-1])]))
    last = start[np.concatenate([change[1:], [len(start)]]) - 1]
    first, anchor, block, text = start[change], anchor[change], block[change], run_text[run[change]]
    count, lead = last - first + 1, anchor - first
    core = spans.of(anchor - block * size, anchor - block * size - size + 1 + window)
    seed = mix(core + block.astype(np.uint64), 5)
    around = mix(names(spans, first, last) + (count * 4096 + lead).astype(np.uint64), 2)
    return text, first - firsts[:-1][text], count, lead, seed, around


def _settle(rows: DataFrame, final: bool) -> tuple[DataFrame, DataFrame | None]:
    """Of rows (doc_id, th, first, windows, lead, seed, around): those that are repeats as a whole, and
    the runs still open by text."""
    order = F.coalesce("doc_id", F.lit(NO_ID))
    seeds = cut(
        rows.groupBy("seed", *(["around"] if final else []))
        .agg(F.min(order).alias("least"), F.max(order).alias("most"), F.min("around").alias("lo"), F.max("around").alias("hi"))
        .where("least < most")
        .select("seed", *(["around"] if final else []), "least", (F.col("lo") != F.col("hi")).alias("mixed")),
        "seeds",
    )
    if final:
        return rows.join(seeds, ["seed", "around"]).where(order > F.col("least")), None
    shared = cut(rows.join(seeds, "seed"), "shared")
    discard(seeds)
    mixed = shared.where("mixed").drop("least", "mixed")
    groups = cut(mixed.groupBy("seed", "around").agg(F.min(order).alias("least")), "groups")
    grouped = cut(mixed.join(groups, ["seed", "around"]), "grouped")
    discard(groups)
    whole = shared.where("not mixed").unionByName(grouped, allowMissingColumns=True).where(order > F.col("least"))
    still = grouped.where(order <= F.col("least")).groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "windows", "lead")).alias("runs"))
    return whole, still


#: Name, among carried columns, of whether the text was null.
NO_TEXT = "__no_text"


def earlier_windows(docs: DataFrame, units: Units, names: Names, window: int, gram: int, blocks: tuple[int, ...]) -> DataFrame:
    """The repeats by text, as ``keyed`` tells them apart: doc_id, th, repeats (array of first window and number).

    ``blocks``: windows of a block in each later step, the last being 1.
    """
    texts = keyed(docs)
    fields = ("first", "windows", "lead")

    def table(batch: pa.RecordBatch, text, first, count, lead, seed, around, *more) -> pa.RecordBatch:
        pick = pa.array(text)
        numbers = [pa.array(x.astype(np.int32)) for x in (first, count, lead)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pick), batch.column("th").take(pick), *numbers, signed(seed), signed(around), *[pa.array(x) for x in more]],
            names=["doc_id", "th", *fields, "seed", "around", *["again"] * len(more)],
        )

    def run_rows(batch: pa.RecordBatch):
        found = _runs(*units(batch.column("text")), window, gram, names)
        return None if found is None else table(batch, *found)

    place = F.struct("first", "windows").alias("at")
    runs = cut(map_texts(texts, run_rows, RUNS), "runs")
    repeats = cut(runs.where("again").select("doc_id", "th", place), "own")
    whole, still = _settle(runs.where(~F.col("again")).drop("again"), final=False)
    discard(runs)
    repeats = repeats.unionByName(whole.select("doc_id", "th", place))
    for size in blocks:
        still = cut(still, "open")
        same = [texts[c].eqNullSafe(still[c]) for c in ("doc_id", "th")]
        wanted = texts.join(still, same).select(texts["doc_id"], texts["th"], texts["text"], "runs")

        def block_rows(batch: pa.RecordBatch, size=size):
            return table(batch, *_blocks(*units(batch.column("text")), batch.column("runs"), size, window, names))

        rows = cut(map_texts(wanted, block_rows, RUNS.removesuffix(", again boolean")), "blocks")
        discard(still)
        whole, still = _settle(rows, final=size == 1)
        repeats = repeats.unionByName(whole.select("doc_id", "th", place))
    return repeats.groupBy("doc_id", "th").agg(F.collect_set("at").alias("repeats"))


def covered(repeats: list | None, n: int, window: int) -> np.ndarray:
    """Which of ``n`` units lie in one of the repeats."""
    steps = np.zeros(n + 1, dtype=np.int32)
    if repeats:
        first = np.array([r["first"] for r in repeats])
        np.add.at(steps, first, 1)
        np.add.at(steps, np.minimum(first + np.array([r["windows"] for r in repeats]) - 1 + window, n), -1)
    return np.cumsum(steps[:n]) > 0


def with_repeats(docs: DataFrame, repeats: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every row with its repeats (null: none); the columns in ``carry`` come along as one, with ``no_text``."""
    more = [F.struct(*carry, F.col("text").isNull().alias(NO_TEXT)).alias("carried")] if carry else []
    texts = keyed(docs, *more)
    same = [texts[c].eqNullSafe(repeats[c]) for c in ("doc_id", "th")]
    return texts.join(repeats, same, "left").select(texts["doc_id"], texts["text"], "repeats", *["carried" for _ in more])
