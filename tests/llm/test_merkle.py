from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from echolattice.llm import merkle_manifest as mm
from echolattice.llm.queries import merkle_proofs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def runs(nodes):
    """Levels from the nodes given up to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    """(left, right) from below."""
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        out.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return out


def plain(rows):
    def first_null(x):
        return (x is not None, x if x is not None else 0)

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (first_null(r[0]), leaf(*r)))
        trees[lang] = own, runs([leaf(*r) for r in own])
    top = runs([trees[lang][1][-1][0] for lang in langs])
    out = []
    for g, lang in enumerate(langs):
        own, levels = trees[lang]
        for at, r in enumerate(own):
            steps = path(levels, at) + path(top, g)
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r[0], text, *r[2:])
            for left, right in steps:
                folded = h(left, folded, right)
            proof = h(*[x for s in steps for x in s])
            out.append((r[0], leaf(*r), levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = merkle_proofs(frame)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=key)
    assert got == sorted(plain(rows), key=key)
    return got


@pytest.mark.parametrize("n, langs", [(1, 1), (9, 2), (64, 1), (65, 1), (700, 20)])
def test_proofs_against_brute_force(spark, n, langs):
    r = random.Random(n)
    # The first group holds most rows; others hold few, so heights differ.
    rows = [(i * 7, r.choice(["ABC é", "lower", "Ünï", ""]) + str(i), f"l{max(0, r.randrange(-langs, langs))}", "s", i) for i in range(n)]
    got = check(spark, rows)
    if n > 60:
        assert {x[-1] for x in got} == {True, False}


def test_odd_rows(spark):
    rows = [(1, "T", None, None, None), (None, "T", "en", "s", 1), (None, None, "en", "s", None), (2, "", "en", "", 0), (3, None, "z", "s", 1)]
    rows += [(5, "Same text", "en", "s", 9)] * 30 + [(None, "copy", None, None, 4)] * 20 + [(6, "LONG " * 200_000, "Ä", "s", 10**6), (7, "x", "z\U0001f600", "s", 1), (8, "x", "zﬁ", "s", 1)]
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([(4, "A", "en", "s", 1, "g", 5, "x"), (5, "B", "en", "s", 1, "g", 5, "x")], SCHEMA + ", group string, i int, leaf string")
    got = merkle_proofs(frame).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain([(4, "A", "en", "s", 1), (5, "B", "en", "s", 1)]))
    assert merkle_proofs(frame.limit(0)).collect() == []


def test_requests_descend_alone(spark):
    rows = [(i, f"Text {i}", f"l{i % 3}", "s", i) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    manifest = mm.build(mm.document_leaves(frame))
    asked = spark.createDataFrame([(0, 0), (1, 70), (2, 99)], '"group" long, i long'.replace('"', "`"))
    found = mm.prove(manifest, asked).select("doc_id", "leaf", mm.fold(mm.F.col("leaf"), mm.F.col("steps")).alias("folded")).collect()
    assert sorted(r.doc_id for r in found) == [0, 211, 299]
    assert {r.folded for r in found} == {manifest.root}
