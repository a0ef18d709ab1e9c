from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from echolattice.llm import value_dictionaries as vd
from echolattice.llm.queries import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Loops over vectors, parts and entries, without dictionaries."""
    kept = []
    for vec_id, x, label in rows:
        if x and len(x) % 16 == 0 and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in x], label))
    lengths = [len(x) for _, x, _ in kept]
    dims = min(set(lengths), key=lambda d: (-lengths.count(d), d))
    kept = [k for k in kept if len(k[1]) == dims]
    width = dims // 16
    first = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[1]))[:64]
    books = [[k[1][p * width : (p + 1) * width] for k in first] for p in range(16)]

    def assign():
        out = []
        for _, x, _ in kept:
            found = []
            for p in range(16):
                own = x[p * width : (p + 1) * width]
                distance = [sum((a - b) ** 2 for a, b in zip(own, e)) for e in books[p]]
                found.append((distance.index(min(distance)), min(distance)))
            out.append(found)
        return out

    for _ in range(2):
        found = assign()
        for p in range(16):
            for e in range(len(books[p])):
                own = [k[1][p * width : (p + 1) * width] for k, f in zip(kept, found) if f[p][0] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    error = [sum(d for _, d in f) for f in found]
    total = {}
    for k, e in zip(kept, error):
        total[k[2]] = total.get(k[2], 0) + e
    name = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(k[0], "".join(f"{e:02x}" for e, _ in f), err, total[k[2]], name) for k, f, err in zip(kept, found, error)]


def check(spark, rows):
    got = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain(rows), key=key)


@pytest.mark.parametrize("n, dims", [(300, 64), (90, 16), (20, 48)])
def test_codes_against_brute_force(spark, n, dims):
    r = random.Random(n)
    rows = [(i * 3, [r.gauss(0, 0.3) for _ in range(dims)], r.choice([0, 1, None])) for i in range(n)]
    rows += [(10_000 + i, rows[0][1], 1) for i in range(n // 2)]  # one very common vector
    r.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    r = random.Random(5)
    good = [(i, [r.choice([-0.5, 0.0, 0.25, 0.001]) for _ in range(32)], i % 3) for i in range(100)]
    odd = [(200, None, 1), (201, [], 1), (202, [0.1] * 31 + [None], 1), (203, [float("nan")] * 32, 1), (204, [float("inf")] * 32, 2), (205, [0.5] * 16, 1), (206, [0.5] * 33, 1)]
    more = [(None, [0.5] * 32, None), (None, [-0.5] * 32, None), (3, [-60_000.0] * 32, 7), (3, good[3][1], 0), (3, good[3][1], 0)]
    check(spark, good + odd + more)
    check(spark, [(1, [1.0] * 16, None)] * 5)


def test_huge_components_are_cut_to_the_exact_range(spark):
    rows = spark.createDataFrame([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1)], SCHEMA)
    assert {(r.vec_id, r.error) for r in vector_codes(rows).collect()} == {(1, 0), (2, 0)}
    assert vd.integers(np.array([3e38])).tolist() == [vd.LARGEST]


def test_empty_table_and_other_columns(spark):
    rows = spark.createDataFrame([(1, [1.0] * 16, 1, "x", 2.0)], SCHEMA + ", code string, error double")
    assert vector_codes(rows).count() == 1
    assert vector_codes(rows.limit(0)).collect() == []


def test_dictionaries_give_back_the_integers():
    x = np.random.default_rng(1).integers(-50, 50, (200, 32))
    values, places = vd.dictionaries(x)
    assert (vd.Block(None, None, values, places).integers(np.arange(200)) == x).all()
