from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from echolattice.llm import seed_extend, suffix_buckets
from echolattice.llm.textarrays import word_bounds, word_units
from tests.llm.helpers import documents


def brute(docs, window, units, join):
    """Each unit covered by a window that also starts earlier goes."""
    seen, gone = {}, {}
    for doc_id, text in sorted(docs):
        u = units(text or "")
        mask = [False] * len(u)
        for i in range(len(u) - window + 1):
            key = tuple(u[i : i + window])
            if key in seen:
                mask[i : i + window] = [True] * window
            else:
                seen[key] = (doc_id, i)
        gone[doc_id] = (u, mask)
    out = {}
    for doc_id, (u, mask) in gone.items():
        kept = join([x for x, m in zip(u, mask) if not m])
        spans = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        out[doc_id] = (len(u), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return out


def made_up(seed: int, n: int = 60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdeéß", k=r.randint(1, 7))) for _ in range(60)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(15, 90))] for _ in range(6)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(r.randint(0, 4)):
            part = list(r.choice(passages)) if r.random() < 0.5 else [r.choice(vocabulary) for _ in range(r.randint(1, 60))]
            if r.random() < 0.3:
                part[r.randrange(len(part))] = "edit"
            words += part
        docs.append((i, r.choice([" ", " ", "\n"]).join(words)))
    docs.append((n, docs[3][1]))
    docs.append((n + 1, "x " * 300))
    docs.append((n + 2, "a" * 1000))
    docs.append((n + 3, " ".join(docs[5][1].split() + ["y"] + docs[5][1].split())))
    docs += [(n + 4, ""), (n + 5, None), (n + 6, " \t\n")]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_bytes_equal_brute_force(spark, seed):
    docs = made_up(seed)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_buckets.remove_repeats(documents(spark, docs)).collect()}
    assert found == brute(docs, 100, lambda t: t.encode(), bytes)


@pytest.mark.parametrize("seed", range(3))
def test_words_equal_brute_force(spark, seed):
    docs = made_up(seed)
    rows = seed_extend.remove_passages(documents(spark, docs)).collect()
    expected = {k: (v[0], v[1], v[3]) for k, v in brute(docs, 20, lambda t: t.encode().split(), b" ".join).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected
    texts = dict(docs)
    for r in rows:
        assert hashlib.sha256(b" ".join(r.kept.encode().split())).hexdigest() == r.kept_sha256
        assert r.n_removed or r.kept == (texts[r.doc_id] or "")
        assert sum(s["end"] - s["first"] for s in r.spans) == r.n_removed


@pytest.mark.parametrize("operator", [suffix_buckets.remove_repeats, seed_extend.remove_passages])
def test_odd_rows(spark, operator):
    long = " ".join(f"word{i}" for i in range(40))
    frame = spark.createDataFrame(
        [(1, long, 5), (1, long, None), (None, long, 1), (2, long + " z", 2), (1, "short", 3)], "doc_id long, text string, th int"
    ).withColumnsRenamed({}).selectExpr("*", "1 AS first", "2 AS repeats", "3 AS windows", "4 AS seed")
    rows = operator(frame).collect()
    assert len(rows) == 5
    removed = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed > 0) for r in rows)
    # The row without an id comes first; both copies of row 1 lose all, the short row nothing.
    assert removed == [(False, 0, False), (True, 1, False), (True, 1, True), (True, 1, True), (True, 2, True)]
    assert operator(frame.limit(0)).collect() == []


def test_words_alike_under_polynomials_are_told_apart(spark):
    """A word of the Thue-Morse sequence and its complement are equal for every odd base modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    words = [f"w{i}" for i in range(19)]
    docs = [(1, " ".join([*words, one])), (2, " ".join([*words, other]))]
    assert {r.doc_id: r.n_removed for r in seed_extend.remove_passages(documents(spark, docs), keep_text=False).collect()} == {1: 0, 2: 0}


def test_word_units_differ_as_words_do():
    data = b"".join([b"a" * k + b" " + b"b" * k + b" " + b"a" * (k - 1) + b"b " for k in range(1, 130)]) + b"a\x00 "
    column = np.frombuffer(data, dtype=np.uint8)
    starts, ends, _ = word_bounds(column, np.array([0, len(column)]))
    units = word_units(column, starts, ends)
    words = data.split(b" ")[:-1]
    assert len(set(units.tolist())) == len(set(words)) and len(words) == len(units)
    assert units[0] == units[[k for k, w in enumerate(words) if w == b"a"][-1]]


@pytest.mark.parametrize("operator", [seed_extend.remove_passages, suffix_buckets.remove_repeats])
def test_a_very_long_text(spark, operator):
    """20 MB in one row beside short texts that repeat a part of it."""
    r = random.Random(3)
    words = [f"{r.getrandbits(40):x}" for _ in range(1_900_000)]
    long = " ".join(words)
    docs = [(1, long), (2, "start " + " ".join(words[500_000:500_040]) + " end")]
    found = {x.doc_id: x.n_removed for x in operator(documents(spark, docs), keep_text=False).collect()}
    assert len(long) > 18_000_000 and found[1] == 0
    assert found[2] == (40 if operator is seed_extend.remove_passages else len(" ".join(words[500_000:500_040])) + 2)
