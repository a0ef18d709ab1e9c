from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from echolattice.llm import lm_interpolation
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    follow = {i: r.sample(range(300), 3) for i in range(300)}
    docs = []
    for i in range(400):
        w, word = [], r.randrange(300)
        for _ in range(r.randint(0, 60)):
            w.append(f"{'W' if r.random() < 0.2 else 'w'}{word}" if r.random() < 0.95 else f"rare{r.randrange(10**6)}")
            word = r.choice(follow[word]) if r.random() < 0.8 else int(300 * r.random() ** 3)
        docs.append((i, " ".join(w)))
    return [*docs, (1000, None), (1001, ""), (1002, "É éa\x0bÉ")]


def small(monkeypatch):
    """Few words known to tasks, so that most take the join."""
    monkeypatch.setattr(lm_interpolation, "WORDS", 40)
    monkeypatch.setattr(lm_interpolation, "DICTIONARY", 120)


@pytest.mark.parametrize("tight", [False, True])
def test_base_and_held_out_gain(spark, corpus, monkeypatch, tight):
    if tight:
        small(monkeypatch)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in corpus}
    count = Counter(t for i, text in corpus if not held[i] for t in tokens(text))
    n, v = sum(count.values()), len(count)
    rows = {x.doc_id: x for x in lm_interpolation.score(documents(spark, corpus)).collect()}
    assert set(rows) == set(held)
    for i, text in corpus:
        x, own = rows[i], tokens(text)
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[i], len(own), sum(count[t] > 0 for t in own), n)
        assert math.isclose(x.base_score, sum(math.log10((count[t] + 1) / (n + v + 1)) for t in own), rel_tol=1e-9)
        assert x.score < 0
    gain = sum(x.score - x.base_score for x in rows.values() if x.held_out)
    assert gain > (0.02 if tight else 0.2) * -sum(x.base_score for x in rows.values() if x.held_out)


def test_probabilities_add_up_to_one(spark, corpus, monkeypatch):
    small(monkeypatch)
    frame = documents(spark, corpus)
    texts = lm_interpolation.keyed(frame, lm_interpolation.F.pmod("doc_id", lm_interpolation.F.lit(7)).cast("int").alias("fold"))
    counts = lm_interpolation.cut(lm_interpolation.word_counts(texts), "words")
    model = lm_interpolation.Model(counts)
    model.fit(*lm_interpolation.bigram_counts(texts, model))
    c = {r.word: r.a + r.b for r in counts.collect()}
    mass = np.zeros(model.classes)
    for word, times in c.items():
        i = model.index.get(word.encode(), -1)
        mass[model.word_class[i] if i >= 0 else model.rare] += times
    total = model.slope @ mass + model.floor * (len(c) + 1)
    assert np.allclose(total, 1)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, "a b", 1), (1, "c", 2), (1, "c", 3), (2, "zz", 5)], "doc_id long, text string, rare int")
    rows = lm_interpolation.score(frame).collect()
    assert len(rows) == 4 and all(math.isfinite(x.score) for x in rows)
    assert lm_interpolation.score(frame.limit(0)).collect() == []


@pytest.mark.parametrize("tight", [False, True])
def test_scores_use_every_word_pair(spark, corpus, monkeypatch, tight):
    """Scores against plain counts of word pairs, with words and pairs that tasks hold and with others."""
    if tight:
        small(monkeypatch)
        monkeypatch.setattr(lm_interpolation, "PAIRS", 30)
    models = []
    weigh = lm_interpolation.weigh
    monkeypatch.setattr(lm_interpolation, "weigh", lambda pairs, model: (weigh(pairs, model), models.append(model)))
    frame = documents(spark, [*corpus, corpus[5], corpus[7]])
    rows = lm_interpolation.score(frame).collect()
    m, fold = models[0], {i: zlib.crc32(str(i).encode()) % 7 for i, _ in corpus}
    a, b, pairs = Counter(), Counter(), Counter()
    for i, text in [*corpus, corpus[5], corpus[7]]:
        if fold[i] != lm_interpolation.TESTED:
            own = tokens(text)
            (b if fold[i] == lm_interpolation.HELD_OUT else a).update(["", *own])
            pairs.update(zip(["", *own], own))
    assert 0.05 < m.mixed[4] < 1
    texts = dict(corpus)
    for x in rows:
        own, total = tokens(texts[x.doc_id]), 0.0
        for v, w in zip(["", *own], own):
            cls = lambda t: m.start if t == "" else m.word_class[m.index[t.encode()]] if t.encode() in m.index else m.rare
            q = (a[w] + b[w]) * m.slope[cls(v), cls(w)] + m.floor[cls(v)]
            part = m.mixed[a[v].bit_length()] if a[v] + b[v] else 0
            total += math.log10(part * pairs[v, w] / max(a[v] + b[v], 1) + (1 - part) * q)
        assert math.isclose(x.score, total, rel_tol=1e-9)


def test_counts_of_pairs_are_joined_in_little_memory():
    """Beside the parts, tasks hold the joined table and a few of its rows, not copies of all."""
    r = np.random.default_rng(1)
    parts = [np.concatenate([r.integers(0, 10**12, (1, 50_000)), np.ones((5, 50_000), dtype=np.int64)]) for _ in range(4)]
    parts.append(parts[0].copy())
    size, total = sum(p.nbytes for p in parts), sum(int(p[3:].sum()) for p in parts)
    tracemalloc.start()
    out = lm_interpolation.summed(parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[3:].sum() == total and (np.diff(out[0]) > 0).all() and parts == []
    assert peak < 2.2 * size
    assert lm_interpolation.summed([np.empty((6, 0), dtype=np.int64)]).shape == (6, 0)


def test_pairs_passed_on_early_count_the_same(spark, corpus, monkeypatch):
    frame = documents(spark, corpus)
    texts = lm_interpolation.keyed(frame, lm_interpolation.F.pmod("doc_id", lm_interpolation.F.lit(7)).cast("int").alias("fold"))
    model = lm_interpolation.Model(lm_interpolation.cut(lm_interpolation.word_counts(texts), "words"))
    whole = sorted(lm_interpolation.pair_counts(texts, model).collect())
    monkeypatch.setattr(lm_interpolation, "HELD_PAIRS", 40)
    monkeypatch.setattr(lm_interpolation, "COUNT", 3)
    assert sorted(lm_interpolation.pair_counts(texts, model).collect()) == whole


def test_pairs_travel_in_blocks(spark, corpus):
    """A row for a task and a partition, not one for each pair; nothing is lost in them."""
    frame = documents(spark, corpus)
    texts = lm_interpolation.keyed(frame, lm_interpolation.F.pmod("doc_id", lm_interpolation.F.lit(7)).cast("int").alias("fold"))
    model = lm_interpolation.Model(lm_interpolation.cut(lm_interpolation.word_counts(texts), "words"))
    parts = lm_interpolation.parts_for(texts, model)
    blocks = lm_interpolation.pair_counts(texts, model).collect()
    # Pairs of two words beyond the dictionary go on to the partition of the first.
    assert len(blocks) <= parts + parts**2
    found = {}
    for r in blocks:
        key, *counts = lm_interpolation._read_table(bytes(r.block))[:4]
        found |= {int(k): tuple(map(int, n)) for k, *n in zip(key, *counts)}
    place, sums = {w.decode(): i for w, i in model.index.items()} | {"": lm_interpolation.START}, {}
    for i, text in corpus:
        own = tokens(text)
        kind = {lm_interpolation.TESTED: 2, lm_interpolation.HELD_OUT: 1}.get(i % 7, 0)
        for v, w in zip(["", *own], own):
            if v in place and w in place:
                sums.setdefault(place[v] << lm_interpolation.PLACE | place[w], [0, 0, 0])[kind] += 1
    expected = {k: tuple(n) for k, n in sums.items() if sum(n) > 1 or n[1]}
    assert len(expected) > 500 and {k: n for k, n in found.items() if k >= 0} == expected


def test_blocks_give_back_their_columns():
    columns = [np.array([-(2**63), 5, 2**63 - 1]), np.zeros(0, dtype=np.int64), np.array([1.5, -0.0, np.inf]).view(np.int64)]
    assert all((a == b).all() for a, b in zip(lm_interpolation.unpack(lm_interpolation.pack(*columns)), columns, strict=True))
    assert (lm_interpolation._read_table(lm_interpolation.pack(np.diff(columns[0], prepend=0)))[0] == columns[0]).all()
