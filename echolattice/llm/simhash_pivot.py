"""Near-duplicates by SimHash, found with tables of distances to reference fingerprints (pivots).

For every distinct fingerprint the Hamming distances to many references are known.
Distances of two fingerprints that differ in k bits differ by k at most in every
column of the table, which is used twice:

* The distances to zero and to the 64 single-bit references tell a fingerprint's
  cells.  Of five blocks of columns, two at least are equal in a pair of distance three,
  so pairs meet by an equi-join on the columns of two blocks, ten ways.  A bucket
  of more than ``BUCKET`` fingerprints is split by further columns, again such that every
  pair still meets, until all are small: no bucket of any size is dropped or paired as a whole.
* In a bucket, sorted by the distance to the first of the other references, neighbours
  are compared outwards until that column differs too much; pairs whose largest difference over
  the columns exceeds three are discarded, and what survives is verified bit by bit.

Only a spanning forest of each bucket leaves it, so m copies give less than m links.

Three bits are too few for texts of which a fifth differs.  :func:`similar` links texts by the similarity of their
five-word shingles: texts meet where the least hashes of their shingles agree in a group of six of 84,
pairs are discarded by the same pivot columns at a wider distance, and what survives is verified on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import NO_ID, cut, discard, keyed, map_texts, partitions
from echolattice.llm.graph import components
from echolattice.llm.textarrays import Spans, mix, signed, text_bytes, word_bounds, word_units

#: Words of a shingle, seed of its hash, and bits in which linked fingerprints may differ.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints of a bucket that are compared in one go; larger buckets are split.
BUCKET = 2048
#: References other than zero and the single bits.
REFERENCES = np.random.default_rng(64).integers(0, 2**64, 12, dtype=np.uint64)
#: Links held by a task before they are contracted to a forest.
LINKS = 1 << 20


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """64 bits for each text; zero where there is no word."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    ends = [0]
    for text in texts:
        words = text.lower().split()
        if len(words) >= SHINGLE:
            hashes += [digest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])]
        elif words:
            hashes.append(digest(b" ".join(words), SEED))
        ends.append(len(hashes))
    return majority(np.array(hashes, dtype=np.uint64), ends)


def majority(hashes: np.ndarray, ends: Sequence[int]) -> np.ndarray:
    """For the hashes between each two ends 64 bits, set where over half of the hashes have them set; zero for none."""
    out = np.zeros(len(ends) - 1, dtype=np.uint64)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            # Counts of up to 255 rows fit in bytes, so eight are added at once.
            parts = np.add.reduceat(bits[a:b], np.arange(0, b - a, 255), axis=0)
            counts = parts.view(np.uint8).reshape(len(parts), 64).sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(counts * 2 > b - a).view(">u8")[0]
    return out


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances of all fingerprints to the references, one column each."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def _masks() -> list[int]:
    """Bits of two of five blocks."""
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip((0, 13, 26, 39, 52), (13, 26, 39, 52, 64))]
    return [a | b for a, b in combinations(blocks, 2)]


def _finer(mask: int) -> list[int]:
    """The mask and a fourth of the other bits: a pair equal under the mask is equal under one of these."""
    rest = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in rest[k :: DISTANCE + 1]) for k in range(DISTANCE + 1) if rest[k :: DISTANCE + 1]]


def _long(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def close_pairs(prints: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in one group, not too far apart.  Sorted by group, in it by the first column."""
    table = pivot_table(prints)
    left, step = np.arange(len(prints)), 1
    while len(left):
        left = left[left + step < len(prints)]
        right = left + step
        near = (group[left] == group[right]) & (table[right, 0] - table[left, 0] <= DISTANCE)
        left, right = left[near], right[near]
        kept, other = left, right
        for column in range(1, table.shape[1]):
            near = np.abs(table[kept, column] - table[other, column]) <= DISTANCE
            kept, other = kept[near], other[near]
        near = np.bitwise_count(prints[kept] ^ prints[other]) <= DISTANCE
        if near.any():
            yield kept[near], other[near]
        step += 1


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n places the least place it is linked with over any chain."""
    label = np.arange(n)

    def contract(a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for pair in pairs:
        held.append(pair)
        if sum(len(a) for a, _ in held) > LINKS:
            contract(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
            held = []
    if held:
        contract(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
    return label


def _bucket_links(rows: DataFrame) -> DataFrame:
    """Links within buckets of bounded size; ``rows``: print, mask, cell."""

    def solve(prints: np.ndarray, group: np.ndarray) -> pa.RecordBatch | None:
        first = pivot_table(prints)[:, 0]
        order = np.lexsort((first, group))
        prints, group = prints[order], group[order]
        label = forest(len(prints), close_pairs(prints, group))
        linked = np.flatnonzero(label != np.arange(len(prints)))
        if not len(linked):
            return None
        return pa.RecordBatch.from_arrays([pa.array(prints[linked].view(np.int64)), pa.array(prints[label[linked]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("print", "mask", "cell")])
            waiting.append(part)
            whole = np.concatenate(waiting, axis=1)
            if whole.shape[1] < 4 * BUCKET:
                waiting = [whole]
                continue
            change = np.flatnonzero((whole[1:, 1:] != whole[1:, :-1]).any(axis=0))
            end = change[-1] + 1 if len(change) else 0
            waiting = [whole[:, end:]]
            if end:
                found = solve(whole[0, :end].view(np.uint64), _groups(whole[:, :end]))
                if found is not None:
                    yield found
        if waiting:
            whole = np.concatenate(waiting, axis=1)
            found = solve(whole[0].view(np.uint64), _groups(whole))
            if found is not None:
                yield found

    def _groups(whole: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum((whole[1:, 1:] != whole[1:, :-1]).any(axis=0))])

    n = partitions(rows.sparkSession)
    return rows.repartition(n, "mask", "cell").sortWithinPartitions("mask", "cell").mapInArrow(run, "a long, b long")


def links(prints: DataFrame) -> DataFrame:
    """a, b: enough links between distinct fingerprints to connect all within ``DISTANCE`` bits of each other."""

    first = F.array(*[F.lit(_long(m)) for m in _masks()])
    buckets = prints.select("print", F.explode(first).alias("mask")).withColumn("cell", F.col("print").bitwiseAND(F.col("mask")))
    found = None
    while True:
        buckets = cut(buckets, "buckets")
        sizes = buckets.groupBy("mask", "cell").count().where("count > 1")
        sizes = cut(sizes.select("mask", "cell", (F.col("count") > BUCKET).alias("large")), "sizes")
        sized = buckets.join(sizes, ["mask", "cell"])
        small = cut(_bucket_links(sized.where("not large").select("print", "mask", "cell")), "bucketlinks")
        found = small if found is None else found.unionByName(small)
        if sizes.where("large").isEmpty():
            return found
        buckets = sized.where("large").select("print", "mask").mapInArrow(_split, "print long, mask long, cell long")


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of large buckets, under all finer masks."""
    known: dict[int, list[int]] = {}
    for batch in batches:
        prints, masks = (batch.column(c).to_numpy().view(np.uint64) for c in ("print", "mask"))
        for mask in np.unique(masks):
            own = prints[masks == mask]
            for finer in known.setdefault(int(mask), _finer(int(mask))):
                new = np.full(len(own), finer, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (own, new, own & new)], names=["print", "mask", "cell"])


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, th, print, root (a fingerprint that names the component) and component_id, one row per input row."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = fingerprints(batch.column("text").cast(pa.binary()).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(found.view(np.int64))], names=["doc_id", "th", "print"])

    printed = cut(map_texts(keyed(docs), rows, "doc_id long, th long, print long"), "prints")
    distinct = cut(printed.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    joined = components(links(distinct.select("print")))
    root = distinct.join(joined, distinct["print"] == joined["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    root = cut(root, "roots")
    least = root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(root.join(least, "root").select("print", "root", "component_id"), "components")
    return printed.join(named, "print").select("doc_id", "th", "print", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per input row.

    Texts are lower-cased (A-Z), words separated by spaces and the control characters 0x09 to 0x0D;
    shingles are of three words with repeats, a shorter text is one shingle, a text without
    words (null, empty) has fingerprint zero, linked like any other.  Fingerprints
    link at three or fewer differing bits; component_id is the smallest doc_id reached over links.
    Null doc_ids take part but are nobody's smallest; component_id is null only if all
    of a component are null.  Repeated rows are copies.  Other columns are ignored, an
    empty table gives no rows.
    """
    return linked(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of a shingle and least similarity (shared of all distinct shingles) of texts that :func:`similar` links.
WORDS, SIMILARITY = 5, 0.8
#: Groups of least hashes, and hashes of a group.  At a similarity of 0.8 a pair agrees in none with a chance of 0.014.
GROUPS, ROWS = 14, 6
#: Bits in which fingerprints of similar texts may differ: 9.7 are expected at 0.8, with a deviation of three.
WIDE = 24
_MULTIPLIER = np.random.default_rng(584).integers(0, 2**31, (GROUPS * ROWS, 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, lower-cased (A-Z), and where each text's begin, with the end of the last.

    A text of fewer words, or none, has one shingle.
    """
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    starts, ends, firsts = word_bounds(data, offsets)
    spans, words = Spans(word_units(data, starts, ends)), np.diff(firsts)
    count = np.maximum(words - WORDS + 1, 1)
    edges = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(edges[-1]) - np.repeat(edges[:-1] - firsts[:-1], count)
    last = np.minimum(first + WORDS, np.repeat(firsts[1:], count))
    return mix(spans.of(first, last) + (last - first).astype(np.uint64), 21), edges


def least_hashes(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A number for each group and text: texts whose least hashes agree in all of a group share it."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((GROUPS, len(edges) - 1), dtype=np.uint64)
    for k, (a, b) in enumerate(_MULTIPLIER):
        out[k // ROWS] = mix(out[k // ROWS] * _ODD + np.minimum.reduceat(low * a + b, edges[:-1]), k)
    return out


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashes, edges = shingles(batch.column("text"))
    groups = [signed(g) for g in least_hashes(hashes, edges)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), signed(majority(hashes, edges)), *groups], names=["doc_id", "th", "print", *[f"g{k}" for k in range(GROUPS)]])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    hashes, edges = shingles(batch.column("text"))
    found = [np.unique(hashes[a:b]).tobytes() for a, b in zip(edges, edges[1:])]
    return pa.RecordBatch.from_arrays([batch.column("th"), pa.array(found, pa.binary())], names=["th", "shingles"])


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose pivot columns and bits don't differ by more than ``WIDE``."""
    for batch in batches:
        a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("print", "lead_print"))
        near = (np.abs(pivot_table(a) - pivot_table(b)) <= WIDE).all(axis=1)
        near &= np.bitwise_count(a ^ b) <= WIDE
        yield batch.filter(pa.array(near)).select(["th", "lead"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with whether their shingles are similar."""
    for batch in batches:
        good = []
        for k in range(batch.num_rows):
            a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=np.uint64) for c in ("own", "other"))
            shared = len(a) + len(b) - len(np.union1d(a, b))
            good.append(shared >= SIMILARITY * (len(a) + len(b) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("th"), batch.column("lead"), pa.array(good, pa.bool_())], names=["th", "lead", "good"])


#: Texts and bytes of shingles of a block of a bucket; a task compares two blocks.
BLOCK, BLOCK_BYTES = 4096, 16 << 20


def _block_links(table: pa.Table) -> pa.Table:
    """Links between texts of two blocks of one bucket (or within one) that join different roots, as a forest.

    All pairs are compared but those of one root, those known to be joined by links found before, those whose numbers of shingles
    differ too much, and those that an earlier group of least hashes brings together as well.
    """
    table = table.combine_chunks()
    th, block, k = (table.column(c).to_numpy() for c in ("th", "block", "k"))
    values = np.array(table.column("values").to_pylist(), dtype=np.int64)[:, : k[0]]
    own = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
    size = np.array([len(x) for x in own])
    ends = np.concatenate([[0], np.cumsum(size)])
    number = np.unique(np.concatenate(own), return_inverse=True)[1]
    label = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
    marked = np.zeros(number.max() + 1, dtype=np.int64)
    places, others = np.arange(len(th)), np.flatnonzero(block == block.max())
    one = block.min() == block.max()
    links: list[tuple[int, int]] = []
    for a in places[block == block.min()]:
        met = others[others > a] if one else others
        met = met[label[met] != label[a]]
        met = met[np.minimum(size[met], size[a]) >= SIMILARITY * np.maximum(size[met], size[a])]
        met = met[~(values[met] == values[a]).any(axis=1)]
        if not len(met):
            continue
        mine = number[ends[a] : ends[a + 1]]
        marked[mine] = 1
        starts = np.concatenate([[0], np.cumsum(size[met])[:-1]])
        shared = np.add.reduceat(marked[np.concatenate([number[ends[b] : ends[b + 1]] for b in met])], starts)
        marked[mine] = 0
        for b in met[shared >= SIMILARITY * (size[met] + size[a] - shared)]:
            if label[b] != label[a]:
                links.append((th[a], th[b]))
                label[label == label[b]] = label[a]
    return pa.table({"th": pa.array([a for a, _ in links], pa.int64()), "lead": pa.array([b for _, b in links], pa.int64())})


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, th, root (names the component) and component_id (its smallest doc_id), one row per input row.

    Texts are linked if, lower-cased (A-Z), at least ``SIMILARITY`` of their distinct five-word shingles are shared; a text of
    fewer words is one shingle, and texts without words (null, empty) are copies of each other.  In a group
    of least hashes all texts are compared with the one that most others meet over all groups, so that m copies make m pairs.  Where
    this leaves a group in several components, all its pairs of different components are compared, block by
    block: no pair that agrees in a group is left out unless it is joined already.  Equal texts, told by 64 bits, are compared once.  Null doc_ids take part
    and are nobody's smallest.  Other columns are ignored, an empty table gives no rows.
    """
    texts = keyed(docs)
    schema = "doc_id long, th long, print long, " + ", ".join(f"g{k} long" for k in range(GROUPS))
    described = cut(map_texts(texts, _described, schema), "described")
    names = [f"g{k}" for k in range(GROUPS)]
    order = F.coalesce("doc_id", F.lit(NO_ID))
    nodes = cut(described.groupBy("th").agg(F.min(order).alias("own_id"), F.min("doc_id").alias("least"), F.min("print").alias("print"), *[F.min(g).alias(g) for g in names]), "texts")
    values = F.array(*names)
    known = nodes.select("th", "print", values.alias("values"))
    rows = known.select("th", "print", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("k"), "values")
    rows = cut(rows.select("th", "print", "k", F.element_at("values", F.col("k") + 1).alias("value")), "groups")
    sizes = rows.groupBy("k", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(rows.join(sizes, ["k", "value"]), "shared")
    discard(rows)
    # An original meets more of its edited copies than these meet each other.
    central = shared.groupBy("th").agg(F.sum("n").alias("meets"))
    leads = shared.join(central, "th").groupBy("k", "value").agg(F.max_by(F.struct("th", "print"), F.struct("meets", "th")).alias("of"))
    leads = leads.select("k", "value", F.col("of.th").alias("lead"), F.col("of.print").alias("lead_print"))
    pairs = shared.join(leads, ["k", "value"]).where("th <> lead").select("th", "lead", "print", "lead_print").distinct()
    pairs = cut(pairs.mapInArrow(_near_enough, "th long, lead long"), "pairs")

    def sets_of(wanted: DataFrame) -> DataFrame:
        # The text of the smallest doc_id stands for its copies, which stay where they are.
        wanted = nodes.select("th", "own_id").join(wanted, F.col("th") == F.col("wanted"), "left_semi").withColumnsRenamed({"th": "own_th"})
        own = texts.join(wanted, (texts["th"] == wanted["own_th"]) & (F.coalesce(texts["doc_id"], F.lit(NO_ID)) == wanted["own_id"]), "left_semi")
        return cut(map_texts(own, _sets, "th long, shingles binary").dropDuplicates(["th"]), "sets")

    sets = sets_of(pairs.select(F.explode(F.array("th", "lead")).alias("wanted")).distinct())
    both = pairs.join(sets.withColumnRenamed("shingles", "own"), "th").join(sets.select(F.col("th").alias("lead"), F.col("shingles").alias("other")), "lead")
    links = cut(both.select("th", "lead", "own", "other").mapInArrow(_compared, "th long, lead long, good boolean").where("good").select(F.col("th").alias("a"), F.col("lead").alias("b")), "compared")
    rooted = shared.join(components(links), F.col("th") == F.col("node"), "left").select("th", "k", "value", F.coalesce("root", "th").alias("root"))
    parted = rooted.groupBy("k", "value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("k", "value")
    parted = cut(rooted.join(parted, ["k", "value"]), "parted")
    if not parted.isEmpty():
        wanted = parted.select(F.col("th").alias("wanted")).distinct().join(sets.select(F.col("th").alias("wanted")), "wanted", "left_anti")
        sets = sets.unionByName(sets_of(wanted))
        bulk = parted.join(sets.select("th", F.length("shingles").alias("bytes")), "th").groupBy("k", "value").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
        dealt = parted.join(bulk.select("k", "value", blocks.alias("blocks")), ["k", "value"]).withColumn("block", F.pmod(F.xxhash64("th"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("th", "k", "value", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        filled = dealt.join(known.select("th", "values"), "th").join(sets, "th")
        found = filled.groupBy("k", "value", "i", "j").applyInArrow(_block_links, "th long, lead long")
        links = links.unionByName(cut(found.select(F.col("th").alias("a"), F.col("lead").alias("b")), "blocklinks"))
    joined = components(links)
    root = cut(nodes.select("th", "least").join(joined, F.col("th") == F.col("node"), "left").select("th", "least", F.coalesce("root", "th").alias("root")), "roots")
    named = root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(root.join(named, "root").select("th", "root", "component_id"), "components")
    return described.select("doc_id", "th").join(named, "th").select("doc_id", "th", "root", "component_id")
