from __future__ import annotations

import hashlib
import random
import re

from echolattice.llm import prefix_decontam
from tests.llm.helpers import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(min(len(w), 1), len(w) - 9)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for win, names in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= names
        out[doc_id] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_equals_brute_force(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["Éa", "über", "x1"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 2, 4, 7, 9, 10, 12, 30])))) for i in range(30)]
    items += [(30, items[9][1]), (31, None), (32, "..."), (None, " ".join(r.choices(vocabulary, k=15))), (33, "a " * 14)]
    docs = []
    for i in range(80):
        w = r.choices(vocabulary, k=r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            part = words(r.choice(items)[1])
            a = r.randint(0, max(0, len(part) - 10))
            at = r.randint(0, len(w))
            w[at:at] = part[a : a + r.randint(8, 14)]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(x.upper() if r.random() < 0.2 and x.isascii() else x for x in w)))
    docs += [(100, None), (101, ""), (102, "a " * 40), (103, "a")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    rows = prefix_decontam.contamination(documents(spark, docs), frame).collect()
    assert {x.doc_id: (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in rows} == brute(docs, items)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(12))
    frame = spark.createDataFrame([(1, text, "a"), (1, text, None), (None, text, "b"), (1, "none", "c")], "doc_id long, text string, words string")
    bench = spark.createDataFrame([(1, text, 1)], "item_id long, text string, th int")
    rows = prefix_decontam.contamination(frame, bench).collect()
    assert sorted((str(x.doc_id), x.n_hit) for x in rows) == [("1", 0), ("1", 12), ("1", 12), ("None", 12)]
    assert [x.n_hit for x in prefix_decontam.contamination(frame, bench.limit(0)).collect()] == [0, 0, 0, 0]
    assert prefix_decontam.contamination(frame.limit(0), bench).collect() == []
