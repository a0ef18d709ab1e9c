"""The pipeline's stages against plain versions of them, on a small set of documents."""

from __future__ import annotations

import random
import tempfile

import corpus_pipeline
from echolattice.llm import quality_risk
from tests.llm import test_decontam, test_packing, test_quality
from tests.llm.helpers import documents


def cut_passages(docs):
    """Texts without words covered by 20 words that start earlier, other white space as it was."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        parts = test_quality.re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
        words = [p.split()[0] for p in parts]
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            key = tuple(words[i : i + 20])
            if key in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(key)
        lead = text[: len(text) - sum(map(len, parts))]
        out[doc_id] = lead + "".join(p for p, g in zip(parts, gone) if not g) if any(gone) else text
    return out


def words_of(text):
    words = [w for w in test_quality.re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def alike(docs):
    """The least doc_id reached over links of texts with 0.8 of their five-word shingles in common."""
    sets = {i: words_of(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in docs}


def made_up():
    r = random.Random(12)
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(r.choices(vocabulary, k=n))
    items = [(i, text(15)) for i in range(5)]
    passage = text(40)
    docs = []
    for i in range(120):
        kind, body = i % 8, text(r.randint(55, 220))
        if kind == 1:
            body = docs[r.randrange(len(docs))][1]
        elif kind == 2:
            body = body[: len(body) // 2] + "\n" + passage + "\n " + body[len(body) // 2 :]
        elif kind == 3:
            body += " " + items[r.randrange(5)][1].upper() + " " + text(5)
        elif kind == 4:
            body = text(20)
        elif kind == 5 and i % 3 == 0:
            body = "x y z " * 40
        elif kind == 6 and docs:
            words = docs[r.randrange(len(docs))][1].split(" ")
            words[-1] = "edited"
            body = " ".join(words)
        docs.append((i, body))
    return docs + [(900, None), (901, "")], items


def test_every_stage_on_its_own_input(spark):
    given, items = made_up()
    docs = dict(given)
    kept = {i: t for i, t in docs.items() if not test_quality.brute(t)[-1]}
    roots = alike(kept)
    single = {i: kept[i] for i in kept if roots[i] == i}
    cut = cut_passages(list(single.items()))
    hit = test_decontam.brute(list(cut.items()), items)
    clean = {i: t for i, t in cut.items() if not hit[i][-1]}
    assert len(docs) > len(kept) > len(single) > len(clean) and cut != single

    sf = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    documents(spark, given).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    table, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    for (name, stage), expected in zip(corpus_pipeline.STAGES, (kept, single, cut, clean)):
        columns = columns or table.columns
        table = corpus_pipeline.cut(stage(spark, table, sf), "stage")
        rows = table.collect()
        assert table.columns == columns, name
        assert {r.doc_id: r.text for r in rows} == expected, name
        assert len(rows) == len(expected)
        assert all(r.n_chars == len(r.text) for r in rows)
    packed = corpus_pipeline.run(spark, sf).collect()
    test_packing.check(packed, list(clean.items()), 2048)
    assert corpus_pipeline.ORACLE_SQL is None and quality_risk.RISK < 1


def test_odd_rows(spark):
    """Repeated rows and rows without ids, with columns named like those in use."""
    sf = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    long = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"other{i}" for i in range(80))
    rows = [(1, long), (1, long), (None, other), (2, long + " end"), (3, None), (4, "")]
    frame = documents(spark, rows).selectExpr("*", "1 AS kept", "2 AS th", "3 AS own_id", "4 AS component_id", "5 AS n_words")
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        table = corpus_pipeline.cut(stage(spark, table, sf), "stage")
        left.append(table.count())
    # Both copies and the near copy become one; the row without an id is a document of its own.
    assert left[0] == 4 and left[1:4] == [2, 2, 2] and left[4] >= 2


def test_near_duplicates_keep_one_row_of_every_group(spark):
    """Rows without an id, and texts that share one, are groups of their own unless their texts are alike."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(80))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d")), (8, text("d")), (None, text("c")), (9, text("e")), (3, text("e"))]
    frame = documents(spark, rows).selectExpr("*", "1 AS own_th", "2 AS root")
    left = corpus_pipeline.near_duplicates(spark, frame, "")
    assert left.columns == frame.columns
    assert sorted((str(r.doc_id), r.text[0]) for r in left.collect()) == [("3", "e"), ("7", "c"), ("7", "d"), ("None", "a"), ("None", "b")]


def test_leaks_go_where_others_have_the_same_id(spark):
    sf = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    item = " ".join(f"leak{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = [(None, "clean one"), (None, f"x {item}"), (4, "clean two"), (4, f"{item} y"), (5, item), (6, None)]
    left = corpus_pipeline.benchmark_leaks(spark, documents(spark, rows), sf)
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == [("4", "clean two"), ("6", "None"), ("None", "clean one")]
