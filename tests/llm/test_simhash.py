from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from echolattice.llm import graph, simhash_pivot
from tests.llm import test_pipeline
from tests.llm.helpers import documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    label = {i: i for i in prints}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in prints.items():
        for j, b in prints.items():
            if j < i and (a ^ b).bit_count() <= 3:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_brute_force(spark, seed):
    r = random.Random(seed)
    docs = []
    for i in range(150):
        if docs and r.random() < 0.5:
            words = r.choice(docs)[1].split(" ")
            words[r.randrange(len(words))] = "edit" + str(r.random())
        else:
            words = [f"W{r.randrange(400)}" for _ in range(r.choice([1, 2, 3, 40, 300]))]
        docs.append((i, " ".join(words)))
    docs += [(200, ""), (201, None), (202, " \n"), (203, docs[0][1]), (204, docs[0][1].upper())]
    prints = {i: plain_fingerprint(t) for i, t in docs}
    rows = simhash_pivot.near_duplicates(documents(spark, docs)).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_components(prints)


def test_dense_buckets_are_split(spark, monkeypatch):
    """Many fingerprints around few centres: buckets far above the limit, chains longer than three bits."""
    monkeypatch.setattr(simhash_pivot, "BUCKET", 40)
    r = np.random.default_rng(1)
    centres = r.integers(0, 2**64, 3, dtype=np.uint64)
    prints = set()
    for c in centres:
        for _ in range(150):
            flips = r.integers(0, 64, r.integers(0, 6))
            prints.add(int(c) ^ int(np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64), initial=np.uint64(0))))
    prints = sorted(prints)
    as_long = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = graph.components(simhash_pivot.links(spark.createDataFrame([(p,) for p in as_long], "print long"))).collect()
    root = {p: p for p in as_long} | {x.node: x.root for x in found}
    expected = plain_components(dict(enumerate(prints)))
    assert len({root[p] for p in as_long}) == len(set(expected.values()))
    for i in range(len(prints)):
        assert root[as_long[i]] == root[as_long[expected[i]]]


def test_chain_of_nodes(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a long, b long")
    found = {x.node: x.root for x in graph.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "a b c", 1), (1, "a b c", 2), (None, "a b c", 3), (None, "x y z", 4), (5, None, 5)], "doc_id long, text string, print int")
    rows = simhash_pivot.near_duplicates(frame).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [("1", "1"), ("1", "1"), ("5", "5"), ("None", "1"), ("None", "None")]
    assert simhash_pivot.near_duplicates(frame.limit(0)).collect() == []


def edited(r, words, share):
    """The words with about so many of the shingles changed, by single replacements."""
    out = list(words)
    for at in r.sample(range(len(out)), max(1, int(len(out) * share / 10))):
        out[at] = f"new{r.random()}"
    return out


def test_similar_texts_against_brute_force(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    docs, near = [], 0
    for k in range(60):
        base = [word() for _ in range(r.randint(60, 300))]
        docs.append((k * 10, " ".join(base)))
        for c in range(r.randint(0, 4)):
            docs.append((k * 10 + c + 1, " ".join(edited(r, base, r.choice([0.02, 0.1, 0.2, 0.35])))))
    docs += [(5000 + k, docs[0][1].upper()) for k in range(30)] + [(6000, ""), (6001, None), (6002, " \n"), (6003, "two words"), (6004, "Two  WORDS"), (None, docs[0][1]), (None, "an own text")]
    sets = {i: test_pipeline.words_of(t) for i, t in docs if i is not None}
    roots = test_pipeline.alike({i: t for i, t in docs if i is not None})
    found = {x.doc_id: x.component_id for x in simhash_pivot.similar(documents(spark, docs)).collect() if x.doc_id is not None}
    lost = [i for i in roots if roots[i] != i and found[i] == i]
    linked = [i for i in roots if roots[i] != i]
    assert len(linked) > 60 and len(lost) <= 0.03 * len(linked)
    # Nothing is linked that brute force does not link.
    assert all(roots[found[i]] == roots[i] for i in found)
    assert found[6001] == 6000 == found[6002] and found[6004] == 6003 and {found[5000 + k] for k in range(30)} == {0}
    assert any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in zip(linked, map(roots.get, linked)))
    assert simhash_pivot.similar(documents(spark, docs).limit(0)).collect() == []


def test_many_near_copies_of_one_text_and_a_boilerplate(spark):
    """A large group links whole; texts that share a long passage but differ otherwise are told apart in later rounds."""
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    base, plate = [word() for _ in range(200)], [word() for _ in range(150)]
    docs = [(i, " ".join(edited(r, base, 0.1))) for i in range(150)] + [(1000 + i, " ".join(plate + [word() for _ in range(90)])) for i in range(40)]
    found = {x.doc_id: x.component_id for x in simhash_pivot.similar(documents(spark, docs)).collect()}
    assert sum(found[i] == 0 for i in range(150)) >= 148
    assert all(found[1000 + i] == 1000 + i for i in range(40))


def test_pairs_that_meet_in_one_group_only(spark, monkeypatch):
    """Three texts share a group's value; two unlike the first are alike and agree in no other group.  Blocks of any size find them."""
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefgh", k=5))
    bases = [[word() for _ in range(120)] for _ in range(12)]
    docs = [(i * 10 + c, " ".join(b[: 118 - 4 * c])) for i, b in enumerate(bases) for c in range(2)]

    def crafted(batch):
        out = described(batch)
        th = batch.column("th").to_numpy()
        groups = [pa.array(np.zeros(len(th), dtype=np.int64))] + [pa.array(th + k) for k in range(1, simhash_pivot.GROUPS)]
        return pa.RecordBatch.from_arrays([*out.columns[:3], *groups], names=out.schema.names)

    described = simhash_pivot._described
    monkeypatch.setattr(simhash_pivot, "_described", crafted)
    for block in (4096, 5):
        monkeypatch.setattr(simhash_pivot, "BLOCK", block)
        found = {x.doc_id: x.component_id for x in simhash_pivot.similar(documents(spark, docs)).collect()}
        assert found == {i: i // 10 * 10 for i, _ in docs}
