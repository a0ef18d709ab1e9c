"""Quality rules whose cutoffs keep the share of good documents they reject under a limit.

A rule rejects a document whose score for one kind of fault is at or over a cutoff.  For every
stratum (language) and rule, the good documents of the labelled holdout that a
candidate cutoff would reject are counted, and the exact (Clopper-Pearson) upper bound of
the true share follows.  Of the cutoffs whose bound is under the limit, all of them safe, the one is taken that
rejects most bad documents of the holdout, a good one counting against it ``PRICE`` times; a
rule that has none, or none that pays, stays off.  All candidates of all rules and strata
are fixed beforehand and tested at once, so the error probability is divided by their number (Bonferroni): with
probability ``1 - ERROR`` no rule in any stratum rejects more than ``RISK / rules`` of the
good documents, nor all rules together more than ``RISK``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolattice.llm.common import cut, keyed, map_texts

#: Share of good documents that may be rejected in a stratum, and probability that more are.
RISK, ERROR = 0.06, 0.05
#: Bad documents that one good document is worth in the choice among safe cutoffs.
PRICE = 4
#: Scores, each a share of 0 to 1, and candidate cutoffs for all of them.
SCORES = ("symbol_words", "loud_words", "upper_letters", "repeated_words", "repeated_lines", "short_words")
CUTOFFS = tuple(round(0.05 * i, 2) for i in range(1, 20))
SYMBOLS = b"#*$%&|<>"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_NOT_SYMBOL = bytes(sorted(set(range(256)) - set(SYMBOLS)))
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def _measure(text: bytes) -> tuple:
    """The counts of a text, then its scores."""
    words = text.split()
    n = len(words)
    joined = b" ".join(words)
    # Code points are the bytes that don't continue a character.
    chars = len(joined.decode()) - max(n - 1, 0)
    symbols = len(text.translate(None, _NOT_SYMBOL))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            dup += line in seen
            seen.add(line)
    first: dict[tuple, int] = {}
    repeated = bytearray(n)
    for i, three in enumerate(zip(words, words[1:], words[2:])):
        j = first.setdefault(three, i)
        if j != i:
            repeated[j : j + 3] = repeated[i : i + 3] = b"\1\1\1"
    again = sum(repeated)
    letters = len(text) - len(text.translate(None, _LETTERS))
    upper = len(text) - len(text.translate(None, _UPPER))
    marked = [w.translate(None, _NOT_SYMBOL) for w in words] if symbols else []
    loud = text.count(b"!! ") + text.count(b"!!\n") + text.endswith(b"!!")
    same = sum(a == b for a, b in zip(words, words[1:]))
    each = max(n, 1)
    scores = (
        sum(map(bool, marked)) / each, min(1.0, loud / each), upper / max(letters, 1), max(again, same) / each, dup / max(lines, 1), max(0.0, 1 - chars / (4 * each)) if n else 1.0,
    )
    return (n, chars, symbols, dup, again, *scores)


def upper_bound(rejected: np.ndarray, good: np.ndarray, error: float) -> np.ndarray:
    """Exact upper confidence bound of a share: the p at which so few or fewer are seen with probability ``error``."""
    low, high = rejected / np.maximum(good, 1), np.ones(len(good))
    for _ in range(50):
        p = (low + high) / 2
        under = np.array([_binomial_cdf(int(k), int(n), q) for k, n, q in zip(rejected, good, p)]) > error
        low, high = np.where(under, p, low), np.where(under, high, p)
    return np.where(rejected >= good, 1.0, high)


def _binomial_cdf(k: int, n: int, p: float) -> float:
    """Probability of k or fewer of n, by the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    if p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    return _incomplete_beta(n - k, k + 1, 1 - p)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c = 1e-300, 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    fraction = d
    for m in range(1, 10_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            fraction *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * fraction


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, th, stratum, the base counts and the scores of every row."""
    kinds = [pa.int64()] * len(_COUNTS) + [pa.float64()] * len(SCORES)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*[_measure(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "th", "stratum")], *[pa.array(c, k) for c, k in zip(found, kinds)]],
            names=["doc_id", "th", "stratum", *_COUNTS, *SCORES],
        )

    schema = "doc_id long, th long, stratum string, " + ", ".join([f"{c} long" for c in _COUNTS] + [f"{s} double" for s in SCORES])
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum")
    return map_texts(keyed(docs, stratum), rows, schema)


def cutoffs(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """stratum and the certified cutoff of each score (null: the rule is off), for every stratum of the documents.

    Good documents are those labelled quality 1; a document with several labels is good if one
    says so, labels without doc_id or quality count for nothing.
    """
    labelled = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    holdout = measured.where("not base_failed").join(labelled.agg((F.max("quality") == 1).alias("good")), "doc_id")
    # One aggregate serves all cutoffs, for the good and for the bad.
    reached = [
        F.sum(((F.col(s) >= c - 1e-12) & (F.col("good") == good)).cast("long")).alias(f"{s}_{i}_{kind}")
        for s in SCORES for i, c in enumerate(CUTOFFS) for kind, good in (("good", True), ("bad", False))
    ]
    n_good = F.sum(F.col("good").cast("long")).alias("good")
    counts = measured.select("stratum").distinct().join(holdout.groupBy("stratum").agg(n_good, *reached), "stratum", "left")
    counts = cut(counts.fillna(0), "counts")
    tests = max(counts.count(), 1) * len(SCORES) * len(CUTOFFS)
    limit, error = RISK / len(SCORES), ERROR / tests

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"stratum": frame["stratum"]}
            good = frame["good"].to_numpy()
            for s in SCORES:
                best, worth = np.full(len(frame), np.nan), np.zeros(len(frame))
                for i in reversed(range(len(CUTOFFS))):
                    rejected, bad = frame[f"{s}_{i}_good"].to_numpy(), frame[f"{s}_{i}_bad"].to_numpy()
                    pays = bad - PRICE * rejected > worth
                    pays &= upper_bound(rejected, good, error) <= limit
                    best, worth = np.where(pays, CUTOFFS[i], best), np.where(pays, bad - PRICE * rejected, worth)
                out[f"cut_{s}"] = best
            yield pd.DataFrame(out)

    return counts.mapInPandas(choose, "stratum string, " + ", ".join(f"cut_{s} double" for s in SCORES))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per input row: doc_id, the base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words),
    base_failed, kept, and the scores with the cutoff of each.

    ``docs``: doc_id, text, lang (null: a stratum of its own); ``labels``: doc_id, quality.
    Base rules fail texts under 50 words, or with over half of the words repeated in
    3-word windows; null texts are empty and fail.  Others are kept unless a
    certified rule rejects them; a stratum with too few labels keeps all.  Each of several rows with one
    doc_id is judged by its own text.  Other columns are ignored; an empty table
    gives no rows, without labels all rules are off.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = cut(measures(docs).withColumn("base_failed", failed), "measures")
    chosen = cut(cutoffs(measured, labels), "cutoffs")
    rejected = F.lit(False)
    for s in SCORES:
        rejected |= F.coalesce((F.col(s) >= F.col(f"cut_{s}") - 1e-12) & ~F.isnan(f"cut_{s}"), F.lit(False))
    judged = measured.join(chosen, "stratum").withColumn("kept", ~F.col("base_failed") & ~rejected)
    return judged.select("doc_id", "th", *_COUNTS, "base_failed", "kept", *SCORES, *[f"cut_{s}" for s in SCORES])
