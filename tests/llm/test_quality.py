from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from echolattice.llm import quality_risk
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    threes = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {k for i, t in enumerate(threes) if threes.count(t) > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def good_text(r):
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(3, 9))) for _ in range(r.randint(60, 90)))


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(3)
    docs = [(i, good_text(r) if i % 4 else " ".join(x + "###" for x in good_text(r).split())) for i in range(1200)]
    docs += [(2000, None), (2001, ""), (2002, "a\n\na\n \n \nb b b b\tc\x0bé  ü #|"), (2003, "x y z " * 50), (2004, "É" * 5000 + " a" * 60)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(1200)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    frame = documents(spark, docs)
    return docs, quality_risk.judge(frame, labels).collect(), quality_risk.judge(frame, labels.limit(0)).collect()


def test_base_counts(judged):
    docs, rows, _ = judged
    found = {x.doc_id: (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) for x in rows}
    assert found == {i: brute(t) for i, t in docs}


def test_verdicts(judged):
    _, rows, unlabelled = judged
    plain = {x.doc_id: x.kept for x in rows if x.doc_id < 1200}
    assert not any(kept for i, kept in plain.items() if i % 4 == 0)
    good = [kept for i, kept in plain.items() if i % 4]
    assert sum(good) >= (1 - quality_risk.RISK) * len(good)
    assert all(x.kept != x.base_failed for x in unlabelled)


def test_upper_bound_is_exact():
    for k, n, error in ((0, 300, 1e-4), (3, 500, 1e-3), (40, 90, 0.01)):
        p = quality_risk.upper_bound(np.array([k]), np.array([n]), error)[0]
        assert math.isclose(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), error, rel_tol=1e-6)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, "a b", None, 1), (1, "c", "en", 2), (1, "c", "en", 3)], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [x.kept for x in quality_risk.judge(frame, labels).collect()] == [False] * 3
    assert quality_risk.judge(frame.limit(0), labels).collect() == []
