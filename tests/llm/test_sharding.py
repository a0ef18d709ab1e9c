from __future__ import annotations

import random
from collections import defaultdict

from echolattice.llm import histogram_sort
from tests.llm.helpers import documents


def sizes_and_slots(rows, shards):
    size, slots = [0] * shards, defaultdict(list)
    for r in rows:
        assert r.shard_size == len((r.text or "").encode()) + 1
        size[r.shard] += r.shard_size
        slots[r.shard].append(r.shard_slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    return size


def test_bytes_are_shared_out(spark):
    r = random.Random(1)
    docs = [(i, "é" * r.randint(0, 400)) for i in range(1000)] + [(5000 + i, "one large group of copies " * 8) for i in range(600)] + [(9000, None)]
    r.shuffle(docs)
    rows = histogram_sort.shard(documents(spark, docs)).collect()
    assert sorted((x.doc_id, x.text) for x in rows) == sorted(docs, key=lambda d: d[0])
    size = sizes_and_slots(rows, 16)
    mean = sum(size) / 16
    assert all(abs(s - mean) <= 1e-3 * mean + 2 * 801 for s in size)
    # The order is one of hash and doc_id: copies follow each other by doc_id.
    copies = [x.doc_id for x in sorted(rows, key=lambda x: (x.shard, x.shard_slot)) if x.doc_id >= 5000 and x.text]
    assert copies == sorted(copies)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "a", 7), (1, "a", 8), (None, None, 9), (None, "b", 1)], "doc_id long, text string, shard int")
    rows = histogram_sort.shard(frame).collect()
    assert len(rows) == 4 and sum(sizes_and_slots(rows, 16)) == 7
    assert histogram_sort.shard(frame.limit(0)).collect() == []
    same = spark.createDataFrame([(1, "copy")] * 50, "doc_id long, text string")
    rows = histogram_sort.shard(same).collect()
    assert len(rows) == 50 and sum(sizes_and_slots(rows, 16)) == 250


def test_rows_without_ids_and_of_one_text_are_divided(spark):
    docs = [(None, "same text")] * 1000 + [(i, "x" * (i % 9)) for i in range(200)] + [(3, "again")] * 300
    rows = histogram_sort.shard(documents(spark, docs)).collect()
    size = sizes_and_slots(rows, 16)
    assert len(rows) == 1500 and max(size) - min(size) <= 2e-3 * sum(size) / 16 + 2 * 10
