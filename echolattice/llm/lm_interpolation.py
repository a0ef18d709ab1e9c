"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of words after words with those of classes after classes,

    p(w | v) = m * f(w | v) + (1 - m) * q(w | v),
    q(w | v) = l2 * f(class w | class v) * f(w | class w) + l1 * f(w) + l0 / (V + 1),

with weights that depend on the bucket (octave) of the frequency of the context v.  They are learned by
expectation-maximisation on counts of a part of the training texts held out from the frequencies
(``HELD_OUT``); the final frequencies use all training texts.  Probabilities over all known words and one for any
unknown word add up to 1.

Every word and every pair of neighbours is counted, in tables that grow with the corpus.  Only the classes, to which the
pairs fall back, are bounded: the ``WORDS`` most frequent words are classes of their own; others share a class with words of
the same octave of frequency, and those beyond the ``DICTIONARY`` most frequent share one class.  Tasks hold the
dictionary and the ``PAIRS`` most frequent pairs, as these would meet in single tasks; the other pairs of the
texts, and words beyond the dictionary, meet their counts where both are dealt to.

Texts are split into words for the words' counts, and once more to be kept as numbers (:func:`coded`).  What is exchanged after that are
blocks: one row for a task and a partition, which holds the sorted numbers of many pairs, packed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import BATCH_ROWS, cut, discard, keyed, partitions, slices
from echolattice.llm.textarrays import mix

#: Words that are classes of their own; words tasks hold; kinds of words a task counts before it passes them on.
WORDS, DICTIONARY, HELD_WORDS = 1000, 1 << 18, 1 << 19
#: Folds of a text by the CRC-32 of its doc_id: ``TESTED`` is never learned from, ``HELD_OUT`` gives the weights.
FOLDS, TESTED, HELD_OUT = 7, 2, 3
#: The end of a text, which is no word.
END = "\n"
ROUNDS = 40
#: Pairs that tasks hold; neighbours of a partition; neighbours a task counts before it passes them on; bins of an octave in which EM sees a ratio.
PAIRS, PART_PAIRS, HELD_PAIRS, BINS = 1 << 19, 1 << 21, 1 << 20, 32
#: Bits of each of the three counts that a task sends as one number; it counts fewer neighbours at a time.
COUNT = 21
#: Places of words of the dictionary in a pair's key, and the one that stands for the start of a text.
PLACE, START = 20, (1 << 20) - 1
#: Bits of a text's number in its slice; pairs of a block of the table.
TEXTS, BLOCK = 10, 1 << 17
#: Pairs of texts a task holds before it passes them on.
HELD_ASKED = 1 << 19
#: What a block holds: words beyond the dictionary, pairs, pairs that lack the counts of their context, pairs of texts, texts.
WORD, PAIR, OPEN, ASKED, TEXT = range(5)
BLOCKS = "part int, kind int, block binary"
_CODEC = pa.Codec("zstd", compression_level=1)


def _words(batch: pa.RecordBatch) -> list[list[bytes]]:
    return [t.lower().split() for t in batch.column("text").cast(pa.binary()).to_pylist()]


def word_counts(texts: DataFrame) -> DataFrame:
    """word, a and b: its counts in the training texts, and in the part held out for the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {False: Counter(), True: Counter()}

        def flush() -> pa.RecordBatch:
            words = [*held[False], *held[True]]
            a, b = [*held[False].values(), *[0] * len(held[True])], [*[0] * len(held[False]), *held[True].values()]
            for c in held.values():
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["word", "a", "b"])

        for batch in batches:
            for part in slices(batch, "text"):
                for words, fold in zip(_words(part), part.column("fold").to_pylist()):
                    held[fold == HELD_OUT].update(words)
                    held[fold == HELD_OUT][END.encode()] += 1
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield flush()
        yield flush()

    return texts.where(F.col("fold") != TESTED).mapInArrow(run, "word string, a long, b long").groupBy("word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _least_count(counts: DataFrame, words: int) -> float:
    """A frequency that at most ``words`` words reach, from a histogram of a few thousand buckets."""
    bucket = F.floor(F.log2(F.col("a") + F.col("b")) * 256)
    return _least_of(counts.groupBy(bucket.alias("bucket")).count(), words)


def _least_of(histogram: DataFrame, words: int) -> float:
    total, least = 0, np.inf
    for r in histogram.orderBy(F.desc("bucket")).collect():
        total += r["count"]
        if total > words:
            break
        least = 2 ** (r["bucket"] / 256)
    return least


class Model:
    """What tasks need: the dictionary, and weights and frequencies by class."""

    def __init__(self, counts: DataFrame):
        c = F.col("a") + F.col("b")
        sums = counts.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
        self.n, self.types = (sums[0] or 0) + (sums[1] or 0), sums[2]
        least_word, least_known = _least_count(counts, WORDS), _least_count(counts, DICTIONARY)
        table = counts.where(c >= least_known - 1e-9 * least_known).orderBy(F.desc(c), "word").toPandas()
        own = ((table["a"] + table["b"]) >= least_word * (1 - 1e-9)).to_numpy()
        self.own = int(own.sum())
        self.count = (table["a"] + table["b"]).to_numpy(dtype=np.int64)
        octave = np.floor(np.log2(np.maximum(self.count, 1))).astype(np.int64)
        self.rare, self.start, self.classes = self.own + 62, self.own + 63, self.own + 64
        self.word_class = np.where(own, np.arange(len(table)), self.own + np.minimum(octave, 61)).astype(np.int32)
        self.index = {w.encode(): i for i, w in enumerate(table["word"])}
        a, b = table["a"].to_numpy(dtype=np.int64), table["b"].to_numpy(dtype=np.int64)
        rare = counts.where(c < least_known - 1e-9 * least_known).agg(
            F.sum("a"), F.sum("b"), F.sum((F.col("a") > 0).cast("long")), F.sum(F.when(F.col("a") == 0, F.col("b")))
        ).first()
        sum_by = lambda x: np.bincount(self.word_class, weights=x, minlength=self.classes).astype(float)
        self.class_a, self.class_b, self.seen, self.unseen_b = sum_by(a), sum_by(b), sum_by(a > 0), sum_by(np.where(a == 0, b, 0))
        for x, extra in zip((self.class_a, self.class_b, self.seen, self.unseen_b), rare):
            x[self.rare] += extra or 0

        ends = counts.where(F.col("word") == END).agg(F.sum("a"), F.sum("b")).first()
        self.a, self.b = np.append(a, ends[0] or 0), np.append(b, ends[1] or 0)

    def codes(self, words: list[list[bytes]]) -> np.ndarray:
        """Place of each word and end in the dictionary (-1: none)."""
        get, end = self.index.get, self.index.get(END.encode(), -1)
        flat: list[int] = []
        for w in words:
            flat += [get(x, -1) for x in w]
            flat.append(end)
        return np.array(flat, dtype=np.int64)

    def learned(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class and counts of words; a and b: counts of those beyond the dictionary."""
        at = np.where(ids == START, len(self.count), np.where(ids < 0, 0, ids))
        cls = np.concatenate([self.word_class, [self.start]])[at]
        known = ids >= 0
        return np.where(known, cls, self.rare), np.where(known, self.a[at], a), np.where(known, self.b[at], b)

    def ratio(self, v, w, pair_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the context, and how much likelier the pair than the classes make it, without the part held out."""
        (v_class, v_a, _), (w_class, w_a, _) = v, w
        q = w_a * self.slope_a[v_class, w_class] + self.floor_a[v_class]
        return octave(v_a), pair_a / np.maximum(v_a, 1) / q

    def log_p(self, v, w, pair: np.ndarray) -> np.ndarray:
        """log10 p of words after contexts; pair: how often they are neighbours."""
        (v_class, v_a, v_b), (w_class, w_a, w_b) = v, w
        q = (w_a + w_b) * self.slope[v_class, w_class] + self.floor[v_class]
        m = np.where(v_a + v_b > 0, self.mixed[np.minimum(octave(v_a), len(self.mixed) - 1)], 0.0)
        return np.log10(m * pair / np.maximum(v_a + v_b, 1) + (1 - m) * q)

    def pair_p(self, key: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """log10 p of pairs of words of the dictionary."""
        nil = np.zeros(len(key), dtype=np.int64)
        return self.log_p(self.learned(key >> PLACE, nil, nil), self.learned(key & START, nil, nil), pair)

    def mix_in(self, rows) -> None:
        """Weight of the word pairs by octave of the context; rows: bucket, bin (null: never together), n."""
        weight = np.full(65, 0.5)
        bucket, n = rows["bucket"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=float)
        r = np.where(rows["bin"].isna(), 0.0, 2.0 ** (rows["bin"].fillna(0).to_numpy(dtype=float) / BINS))
        total = np.bincount(bucket, weights=n, minlength=65) + 2
        for _ in range(ROUNDS):
            m = weight[bucket]
            weight = (np.bincount(bucket, weights=n * m * r / (m * r + 1 - m), minlength=65) + 1) / total
        self.mixed = weight

    def fit(self, a: np.ndarray, b: np.ndarray) -> None:
        """Weights from the bigram counts of both folds, then frequencies from both together."""
        context_a = a.sum(axis=1)
        bucket = np.floor(np.log2(np.maximum(context_a, 1))).astype(np.int64) + (context_a > 0)
        v, w = np.nonzero(b)
        n, unseen = b[v, w].astype(float), np.divide(self.unseen_b, self.class_b, out=np.zeros(self.classes), where=self.class_b > 0)[w]
        within = 1 / np.maximum(self.seen[w], 1)
        p2 = np.divide(a[v, w], context_a[v], out=np.zeros(len(v)), where=context_a[v] > 0) * within
        p1 = self.class_a[w] / max(self.class_a.sum(), 1) * within
        p0 = 1 / (self.types + 1)
        weights = np.full((bucket.max() + 1, 3), 1 / 3)
        own = bucket[v]
        for _ in range(ROUNDS):
            share = weights[own] * np.stack([p2, p1, np.full(len(v), p0)], axis=1)
            share *= (n * (1 - unseen) / share.sum(axis=1))[:, None]
            share[:, 2] += n * unseen
            # One token for each order keeps all weights over zero.
            weights = np.stack([np.bincount(own, weights=share[:, k], minlength=len(weights)) for k in range(3)], axis=1) + 1.0
            weights /= weights.sum(axis=1, keepdims=True)
        self.weights = weights
        both, context = a + b, (a + b).sum(axis=1)
        l2, l1, l0 = weights[np.floor(np.log2(np.maximum(context_a, 1))).astype(np.int64) + (context_a > 0)].T
        l1, l2 = np.where(context > 0, l1, l1 + l2), np.where(context > 0, l2, 0.0)
        l0, l1 = (l0, l1) if self.n else (l0 + l1, l1 * 0)
        classes = self.class_a + self.class_b
        pairs = both / np.maximum(context, 1)[:, None] / np.maximum(classes, 1)[None, :]
        # For a word of count c after v: c * slope[v, class] + floor[v].
        self.slope = l2[:, None] * pairs + (l1 / max(self.n, 1))[:, None]
        self.floor = l0 / (self.types + 1)
        # The same without the part held out, for the weight of word pairs.
        l2, l1, l0 = weights[bucket].T
        pairs = a / np.maximum(context_a, 1)[:, None] / np.maximum(self.class_a, 1)[None, :]
        self.slope_a = l2[:, None] * pairs + (l1 / max(self.class_a.sum(), 1))[:, None]
        self.floor_a = l0 / (self.types + 1)


def octave(count: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + (count > 0)


def fingerprints(words: list[bytes]) -> np.ndarray:
    """A negative number for each word."""
    return np.array([xxhash.xxh64_intdigest(w, 1) for w in words], dtype=np.uint64).view(np.int64) | np.int64(-(2**63))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers as one value: like bytes of a column side by side, compressed."""
    head = np.array([len(columns), *map(len, columns)], dtype=np.int64)
    planes = [np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T) for c in columns]
    return head.tobytes() + _CODEC.compress(b"".join(p.tobytes() for p in planes), asbytes=True)


def unpack(block: bytes) -> list[np.ndarray]:
    """The columns of :func:`pack`, as integers."""
    n = int(np.frombuffer(block, dtype=np.int64, count=1)[0])
    sizes = np.frombuffer(block, dtype=np.int64, count=n, offset=8)
    raw = np.frombuffer(_CODEC.decompress(memoryview(block)[8 * n + 8 :], int(sizes.sum()) * 8, asbytes=True), dtype=np.uint8)
    ends = np.cumsum(sizes) * 8
    return [np.ascontiguousarray(raw[e - 8 * k : e].reshape(8, k).T).view(np.int64).reshape(-1) for e, k in zip(ends, sizes)]


def rows_of(blocks: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, block = zip(*blocks) if blocks else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.binary())], names=["part", "kind", "block"])


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        for part, kind, block in zip(*(batch.column(c) for c in ("part", "kind", "block"))):
            yield part.as_py(), kind.as_py(), block.as_py()


def dealt(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns cut by partition, in their order otherwise."""
    order = np.argsort(part.astype(np.int32), kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), dtype=bool), part[1:] != part[:-1]]))
    for lo, hi in zip(starts, np.append(starts[1:], len(part))):
        yield int(part[lo]), [c[lo:hi] for c in columns]


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Key of a word after another: their places in the dictionary, or a negative fingerprint."""
    hashed = mix(v.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64), 11).view(np.int64) | np.int64(-(2**63))
    return np.where((v >= 0) & (w >= 0), v << PLACE | w, hashed)


def home(parts: int, key: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Partition of pairs: that of a word beyond the dictionary, where its counts are; the second of two, else that of the key."""
    return (mix(np.where(key >= 0, key, np.where(w < 0, w, v)).view(np.uint64), 17) % np.uint64(parts)).astype(np.int64)


class Slice:
    """Some texts as numbers: places of words in the dictionary (-1: none), fingerprints of the others, tokens, fold and doc_id of each text."""

    def __init__(self, number: int, block: bytes):
        self.index, self.beyond, self.size, self.fold, self.doc, self.has_doc = unpack(block)
        self.row = np.int64(number << TEXTS) + np.arange(len(self.size))
        self.text = np.repeat(np.arange(len(self.size)), self.size)

    @classmethod
    def all_of(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
        for batch in batches:
            for number, block in zip(batch.column("slice"), batch.column("block")):
                yield cls(number.as_py(), block.as_py())

    def after(self, tokens: np.ndarray, start: int) -> np.ndarray:
        """What is before each token in its text."""
        out = np.empty_like(tokens)
        out[1:] = tokens[:-1]
        out[np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64)] = start
        return out

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key of each word and the one before it, and both: places in the dictionary, or negative fingerprints."""
        w = self.index.copy()
        w[w < 0] = self.beyond
        v = self.after(w, START)
        return pair_key(v, w), v, w


def coded(texts: DataFrame, model: Model) -> DataFrame:
    """slice and block: texts as :class:`Slice` reads them; given such rows, the same."""
    if "block" in texts.columns:
        return texts
    given = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for whole in slices(batch, "text"):
                for at in range(0, whole.num_rows, 1 << TEXTS):
                    part = whole.slice(at, 1 << TEXTS)
                    words = _words(part)
                    index = given.value.codes(words)
                    beyond = np.zeros(0, dtype=np.int64)
                    if (index < 0).any():
                        flat = [x for own in words for x in (*own, END.encode())]
                        beyond = fingerprints([flat[k] for k in np.flatnonzero(index < 0)])
                    doc = part.column("doc_id")
                    size, fold = np.array([len(w) + 1 for w in words], dtype=np.int64), part.column("fold").to_numpy().astype(np.int64)
                    block = pack(index, beyond, size, fold, doc.fill_null(0).to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False).astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([block], pa.binary())], names=["slice", "block"])
                    number += 1

    return texts.mapInArrow(run, "slice long, block binary")


def bigram_counts(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Counts of class pairs in both folds; the table has a fixed bound, so it fits the driver."""
    given, m = texts.sparkSession.sparkContext.broadcast(model), model.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, m * m), dtype=np.int64)
        for own in Slice.all_of(batches):
            learned = own.fold != TESTED
            cls = np.append(given.value.word_class, np.int32(given.value.rare))[own.index]
            pair = ((own.fold == HELD_OUT)[own.text] * m + own.after(cls, given.value.start)) * m + cls
            pair, times = np.unique(pair[learned[own.text]] if not learned.all() else pair, return_counts=True)
            counts.reshape(-1)[pair] += times
        used = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(used), 1 << 16):
            own = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *[pa.array(c[own].astype(np.int32)) for c in counts]], names=["pair", "a", "b"])

    rows = coded(texts, model).mapInArrow(run, "pair int, a int, b int")
    found = rows.groupBy("pair").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toPandas()
    out = np.zeros((2, m * m), dtype=np.int64)
    out[0, found["pair"]], out[1, found["pair"]] = found["a"], found["b"]
    return out[0].reshape(m, m), out[1].reshape(m, m)


def summed(parts: list[np.ndarray]) -> np.ndarray:
    """Tables of key, v, w and counts (a column for each row) as one, by key; the parts are freed as they are read.

    Rows are gathered one after the other, so that little more than the result is held beside the parts.
    """
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1]]))
    out = np.empty((parts[0].shape[0], len(first)), dtype=np.int64)
    out[0] = keys[first]
    for k in range(1, len(out)):
        row = np.concatenate([p[k] for p in parts])[order]
        out[k] = row[first] if k < 3 or not len(first) else np.add.reduceat(row, first)
    parts.clear()
    return out


def parts_for(texts: DataFrame, model: Model) -> int:
    return max(partitions(texts.sparkSession), model.n // PART_PAIRS)


def _table(columns: list[np.ndarray]) -> Iterator[bytes]:
    """Blocks of a table of pairs: key, a, b, t, and, for those with a word beyond the dictionary, which come first, v, w, va, vb, wa, wb."""
    own, rare = columns[:4], columns[4:]
    for at in range(0, len(own[0]), BLOCK):
        key, *counts = (c[at : at + BLOCK] for c in own)
        yield pack(np.diff(key, prepend=0), *counts, *[c[at : at + BLOCK] for c in rare])


def _read_table(block: bytes) -> list[np.ndarray]:
    delta, *rest = unpack(block)
    return [np.cumsum(delta), *rest]


def _looked_up(words: list[list[np.ndarray]], sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of words by fingerprint; zero for those never learned from."""
    if not words:
        return np.zeros_like(sought), np.zeros_like(sought)
    ids, a, b = (np.concatenate(c) for c in zip(*words))
    order = np.argsort(ids)
    ids, a, b = ids[order], a[order], b[order]
    found, at = _held(ids, sought)
    return np.where(found, a[at], 0), np.where(found, b[at], 0)


def pair_counts(texts: DataFrame, model: Model, ids: DataFrame | None = None) -> DataFrame:
    """Blocks of a, b, t: counts of every pair of neighbours in both training folds and in the texts never learned from.

    Pairs of words of the dictionary that occur once, and not in the part held out, are left out: who meets one knows its count.
    ``ids``: :func:`word_ids`, whose counts pairs with such words get; pairs of two of them lack those of the first (``OPEN``).
    """
    parts = parts_for(texts, model)

    def packed(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        big = (table[3:] >> COUNT).any(axis=0)
        if big.any():
            # A text longer than a task's share: its counts go in several rows.
            rest = table[:, big].copy()
            rest[3:] -= np.minimum(rest[3:], (1 << COUNT) - 1)
            yield from packed(rest)
        a, b, t = np.minimum(table[3:], (1 << COUNT) - 1)
        out = []
        for part, (key, v, w, n) in dealt(home(parts, *table[:3]), *table[:3], a | b << COUNT | t << 2 * COUNT):
            rare = np.searchsorted(key, 0)
            out.append((part, PAIR, pack(np.diff(key[rare:], prepend=0), n, v[:rare], w[:rare])))
        yield rows_of(out)

    def unpacked(block: bytes) -> np.ndarray:
        delta, n, v, w = unpack(block)
        nil = np.zeros(len(delta), dtype=np.int64)
        key = np.concatenate([pair_key(v, w), np.cumsum(delta)])
        return np.stack([key, np.concatenate([v, nil]), np.concatenate([w, nil]), *[n >> k * COUNT & (1 << COUNT) - 1 for k in range(3)]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for own in Slice.all_of(batches):
            key, v, w = own.keys()
            fold, rare = own.fold[own.text], key < 0
            kinds = [(fold != TESTED) & (fold != HELD_OUT), fold == HELD_OUT, fold == TESTED]
            held.append(summed([np.stack([key, np.where(rare, v, 0), np.where(rare, w, 0), *[k.astype(np.int64) for k in kinds]])]))
            if sum(x.shape[1] for x in held) > HELD_PAIRS:
                held = [summed(held)]
                # What hardly shrinks is passed on.
                if held[0].shape[1] > HELD_PAIRS // 2:
                    yield from packed(held.pop())
        if held:
            yield from packed(summed(held))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, words, own = [], [], 0
        for own, kind, block in blocks_of(batches):  # noqa: B007
            (words if kind == WORD else tables).append(unpack(block) if kind == WORD else unpacked(block))
        if not tables:
            return
        whole = summed(tables)
        whole = whole[:, (whole[0] < 0) | (whole[3:].sum(axis=0) > 1) | (whole[4] > 0)]
        rare = int(np.searchsorted(whole[0], 0))
        v, w = whole[1:3, :rare]
        second, both = w < 0, (w < 0) & (v < 0)
        a, b = _looked_up(words, np.where(second, w, v))
        va, vb, wa, wb = np.where(second, 0, a), np.where(second, 0, b), np.where(second, a, 0), np.where(second, b, 0)
        # Fingerprints have served, but for those of pairs of two such words.
        sides = [np.where(both, v, np.maximum(v, -1)), np.where(both, w, np.maximum(w, -1)), va, vb, wa, wb]
        done = np.concatenate([~both, np.ones(whole.shape[1] - rare, dtype=bool)])
        for block in _table([*[x[done] for x in (whole[0], *whole[3:])], *[x[~both] for x in sides]]):
            yield rows_of([(own, PAIR, block)])
        lacking = [x[:rare][both] for x in (whole[0], *whole[3:])] + [x[both] for x in sides]
        blocks = dealt(home(parts, lacking[0], lacking[4], np.zeros_like(lacking[0])), *lacking)
        yield rows_of([(part, OPEN, block) for part, columns in blocks for block in _table(columns)])

    sent = coded(texts, model).mapInArrow(count, BLOCKS)
    return (sent if ids is None else sent.unionByName(ids)).repartitionById(parts, F.col("part")).mapInArrow(add, BLOCKS)


def word_ids(counts: DataFrame, model: Model) -> DataFrame:
    """Blocks of id, a, b: fingerprints of words beyond the dictionary and their counts."""
    parts, given = parts_for(counts, model), counts.sparkSession.sparkContext.broadcast(model.index)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            beyond = np.array([k for k, w in enumerate(words) if w not in given.value], dtype=np.int64)
            held.append([fingerprints([words[k] for k in beyond]), *[batch.column(c).to_numpy()[beyond] for c in "ab"]])
            if sum(len(x[0]) for x in held) > HELD_WORDS:
                yield flush()
        if held:
            yield flush()

    held: list[list[np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        ids, a, b = (np.concatenate(c) for c in zip(*held))
        held.clear()
        return rows_of([(part, WORD, pack(*x)) for part, x in dealt(home(parts, ids, ids, ids), ids, a, b)])

    return counts.mapInArrow(hashed, BLOCKS)


def with_contexts(lacking: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """Pairs of two words beyond the dictionary, with the counts of the first, dealt by the second again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, words = [], []
        for _, kind, block in blocks_of(batches):
            (words if kind == WORD else tables).append(unpack(block) if kind == WORD else _read_table(block))
        if tables:
            columns = [np.concatenate(c) for c in zip(*tables)]
            key, v, w = columns[0], columns[4], columns[5]
            columns[6], columns[7] = _looked_up(words, v)
            to, columns[4], columns[5] = home(parts, key, v, w), np.full_like(v, -1), np.full_like(w, -1)
            yield rows_of([(part, PAIR, block) for part, x in dealt(to, *columns) for block in _table(x)])

    return lacking.unionByName(ids).repartitionById(parts, F.col("part")).mapInArrow(run, BLOCKS)


def _sides(model: Model, key: np.ndarray, rare: list[np.ndarray]):
    """Contexts and words of pairs, as :meth:`Model.learned` gives them; rare: v, w, va, vb, wa, wb of the first pairs."""
    n, nil = len(rare[0]), np.zeros(len(key) - len(rare[0]), dtype=np.int64)
    va, vb, wa, wb = (np.concatenate([c, nil]) for c in rare[2:])
    v, w = np.concatenate([rare[0], key[n:] >> PLACE]), np.concatenate([rare[1], key[n:] & START])
    return model.learned(v, va, vb), model.learned(w, wa, wb)


def weigh(pairs: DataFrame, model: Model) -> None:
    """Weights of word pairs, from a histogram of at most 65 buckets by a few thousand bins."""
    given = pairs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in blocks_of(batches):
            key, a, b, _, *rare = _read_table(block)
            own = b > 0
            sides = _sides(given.value, key[own], [c[own[: len(c)]] for c in rare])
            bucket, r = given.value.ratio(*sides, a[own])
            never = -(1 << 20)
            bins = np.where(r > 0, np.round(np.log2(np.where(r > 0, r, 1)) * BINS), never).astype(np.int64)
            cell, at = np.unique(bucket << 32 | bins + (1 << 31), return_inverse=True)
            n, bins = np.bincount(at.reshape(-1), weights=b[own], minlength=len(cell)).astype(np.int64), (cell & (1 << 32) - 1) - (1 << 31)
            yield pa.RecordBatch.from_arrays([pa.array(cell >> 32), pa.array(bins, mask=bins == never), pa.array(n)], names=["bucket", "bin", "n"])

    model.mix_in(pairs.mapInArrow(run, "bucket long, bin long, n long").groupBy("bucket", "bin").agg(F.sum("n").alias("n")).toPandas())


def frequent(pairs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log10 p of at most ``PAIRS`` pairs of words of the dictionary, all as frequent as the least of them."""

    def seen(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, a, b, t, v, *_ = _read_table(block)
        return key[len(v) :], (a + b)[len(v) :], (a + b + t)[len(v) :]

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(64 * 256, dtype=np.int64)
        for _, _, block in blocks_of(batches):
            total += np.bincount(np.floor(np.log2(seen(block)[2]) * 256).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "count"])

    histogram = pairs.mapInArrow(buckets, "bucket long, count long").groupBy("bucket").agg(F.sum("count").alias("count"))
    least = _least_of(histogram, PAIRS) * (1 - 1e-9)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, block in blocks_of(batches):
            key, n, times = seen(block)
            yield pa.RecordBatch.from_arrays([pa.array(key[times >= least]), pa.array(n[times >= least])], names=["key", "n"])

    table = pairs.mapInArrow(rows, "key long, n long").toPandas().sort_values("key")
    key = table["key"].to_numpy(dtype=np.int64)
    return key, model.pair_p(key, table["n"].to_numpy(dtype=np.int64))


def _held(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys tasks hold, and where."""
    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    return (keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)), at


def score(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``docs``: doc_id, text (null: empty, so the end alone).  Tokens are lower-cased (A-Z) words and one end.
    ``held_out``: the CRC-32 of the doc_id as text (null: empty) leaves ``TESTED`` when divided by
    ``FOLDS``; such texts are scored, not learned from.  ``base_score`` adds up log10((c + 1) / (N + V + 1)), ``score`` is
    the log10 probability of the text under the model.  Repeated rows count each time.  Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")
    texts = keyed(docs, fold.alias("fold"))
    counts = cut(word_counts(texts), "words")
    model = Model(counts)
    ids = cut(word_ids(counts, model), "ids")
    discard(counts)
    own = cut(coded(texts, model), "codes")
    model.fit(*bigram_counts(own, model))
    parts = parts_for(docs, model)
    counted = cut(pair_counts(own, model, ids), "pairs")
    pairs = counted.where(F.col("kind") == PAIR).unionByName(cut(with_contexts(counted.where(F.col("kind") == OPEN), ids, parts), "rarepairs"))
    discard(ids)
    weigh(pairs, model)
    given = spark.sparkContext.broadcast((model, *frequent(pairs, model)))
    unknown = float(-np.log10(model.n + model.types + 1))
    place = lambda row: (mix((row >> TEXTS).view(np.uint64), 19) % np.uint64(parts)).astype(np.int64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What tasks know of texts, and the pairs they don't hold, once for each text; the last bit of times: nothing is learned from the text."""
        m, keys, p = given.value
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, to, row, times = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.argsort(key)
            blocks = dealt(to[order], key[order], row[order], times[order])
            return rows_of([(part, ASKED, pack(np.diff(key, prepend=0), row, times)) for part, (key, row, times) in blocks])

        for s in Slice.all_of(batches):
            n, text, known = len(s.size), s.text, s.index >= 0
            base = np.log10((np.append(m.count, 0)[s.index] + 1) / (m.n + m.types + 1), out=np.zeros(len(text)), where=known)
            key, v, w = s.keys()
            here, at = _held(keys, key)
            total = lambda x, of: np.bincount(text[of], weights=x[of], minlength=n).astype(float)  # noqa: B023, E731
            score = total(np.append(p, 0.0)[at], here)
            block = pack(s.row, s.doc, s.has_doc, s.fold, s.size, np.bincount(text[known], minlength=n), total(base, known), score)
            yield rows_of([(int(place(s.row[:1])[0]), TEXT, block)])
            cold = np.flatnonzero(~here)
            cold = cold[np.argsort(key[cold], kind="stable")]
            own, of = key[cold], text[cold]
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(own)), dtype=bool), (own[1:] != own[:-1]) | (of[1:] != of[:-1])]))
            times, cold, of = np.diff(np.append(first, len(own))), cold[first], of[first]
            held.append([key[cold], home(parts, key[cold], v[cold], w[cold]), s.row[of], times << 1 | (s.fold[of] == TESTED)])
            if sum(len(x[0]) for x in held) > HELD_ASKED:
                yield flush()
        if held:
            yield flush()

    def met(m: Model, key: np.ndarray, p: np.ndarray, count: np.ndarray, ours: np.ndarray, _, times: np.ndarray):
        """Known words, their base scores and prices of the pairs of a block, in a partition's table of pairs."""
        learned, times = times & 1 == 0, times >> 1
        there, at = _held(key, ours)
        price, base, known = np.zeros(len(ours)), np.zeros(len(ours)), np.zeros(len(ours))
        c = np.full(len(ours), -1)
        price[there], c[there] = p[at[there]], count[at[there]]
        # A pair of the dictionary that is in no table occurs here only.
        plain = ours >= 0
        price[plain] = m.pair_p(ours[plain], np.where(there, c, learned)[plain])
        beyond = ~plain & (c >= 0)
        base[beyond] = times[beyond] * (np.log10(c[beyond] + 1) + unknown)
        known[beyond] = times[beyond] * (c[beyond] > 0)
        return known, base, times * price

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums by text of a partition's pairs of texts, from its counts and prices of pairs."""
        m = given.value[0]
        table, asked = [], []
        for part, kind, block in blocks_of(batches):
            if kind == TEXT:
                yield rows_of([(part, kind, block)])
            elif kind == ASKED:
                asked.append(_read_table(block))
            else:
                key, a, b, _, *rare = _read_table(block)
                # Of pairs with a word beyond the dictionary the price, and the count of such a word (else -1); of others their count.
                n, price, count = len(rare[0]), np.zeros(len(key)), a + b
                price[:n] = m.log_p(*_sides(m, key[:n], rare), count[:n])
                count[:n] = np.where(rare[1] < 0, rare[4] + rare[5], -1)
                table.append((key, price, count))
        if not asked:
            return
        key, p, count = (np.concatenate(c) for c in zip(*table)) if table else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        table.clear()
        order = np.argsort(key)
        key, p, count = key[order], p[order], count[order]
        row = np.concatenate([x[1] for x in asked])
        sums = []
        while asked:
            sums.append(met(m, key, p, count, *asked.pop(0)))
        known, base, price = (np.concatenate(x) for x in zip(*sums))
        rows, at = np.unique(row, return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(rows)) for x in (known, base, price)]
        yield rows_of([(part, ASKED, pack(np.diff(x, prepend=0), *more)) for part, (x, *more) in dealt(place(rows), rows, *sums)])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of the result: what tasks knew of a text, and the sums of its other pairs."""
        texts, sums = [], []
        for _, kind, block in blocks_of(batches):
            (texts if kind == TEXT else sums).append(unpack(block) if kind == TEXT else _read_table(block))
        if not texts:
            return
        row, doc, has_doc, fold, size, known, base, score = (np.concatenate(c) for c in zip(*texts))
        more = [known.astype(float), base.view(np.float64).copy(), score.view(np.float64).copy()]
        order = np.argsort(row)
        for own, *x in sums:
            at = order[np.searchsorted(row[order], own)]
            for total, value in zip(more, x):
                total[at] += value.view(np.float64)
        out = [pa.array(doc, mask=has_doc == 0), pa.array(fold == TESTED), pa.array(size), pa.array(np.round(more[0]).astype(np.int64)),
               pa.array(np.full(len(row), m_n)), *[pa.array(x) for x in more[1:]]]
        for at in range(0, len(row), 1 << 16):
            yield pa.RecordBatch.from_arrays([x.slice(at, 1 << 16) for x in out], names=names)

    m_n = np.int64(model.n)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    sent = own.mapInArrow(ask, BLOCKS).unionByName(pairs).repartitionById(parts, F.col("part")).mapInArrow(add, BLOCKS)
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sent.repartitionById(parts, F.col("part")).mapInArrow(whole, kind)
