from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from echolattice.llm import chat_trees


def test_round_trip_of_any_text(spark):
    r = random.Random(1)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "&", "&0;", "&1;", "&2;", "&3;", "<", "[", "/s>", "\n", "é🙂", " ", "", "0;", "x"]
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 9)):
            rows.append((c, t, r.choice(["user", "assistant", "system", "a\n<s>b"]), "".join(r.choices(bits, k=r.randint(0, 8)))))
    rows += [(100, 0, None, None), (None, 3, "assistant", "x"), (None, 5, "user", "y")]
    shuffled = r.sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string").repartition(3)
    done = chat_trees.formatted(chat_trees.chains(frame))
    back = {x.conv_id: x for x in chat_trees.read_back(done).collect()}
    expected = {}
    for c, _, role, text in rows:
        expected.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in x.turns] for c, x in back.items()} == expected
    for c, x in back.items():
        assert x.under_loss == "".join(t for role, t in expected[c] if role == "assistant")
        assert x.formatted.count("<s>") == x.formatted.count("</s>") == len(expected[c])


def test_branches_are_ranked(spark):
    # 1 -> (2 -> 4, 3 -> (5, 6)); a second root 9 and a lost parent 70.
    nodes = [(1, 1, None, 0.0), (1, 2, 1, 5.0), (1, 4, 2, 1.0), (1, 3, 1, 1.0), (1, 5, 3, 9.0), (1, 6, 3, 5.0), (1, 9, None, 3.0), (1, 71, 70, 4.0), (2, 5, 5, None)]
    frame = spark.createDataFrame([(*n, "user", f"t{n[1]}") for n in nodes], "conv_id long, node_id long, parent_id long, score double, role string, text string")
    found = {}
    for x in chat_trees.paths(frame, best=3).collect():
        found.setdefault((x.conv_id, x.path), {})[x.depth] = x.node_id
    assert {k: [v[d] for d in sorted(v)] for k, v in found.items()} == {(1, 1): [1, 3, 5], (1, 2): [1, 2, 4], (1, 3): [1, 3, 6], (2, 1): [5]}


def test_deep_tree_and_odd_rows(spark):
    frame = spark.range(300).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("t").alias("text"), F.lit(0).alias("depth"))
    done = chat_trees.read_back(chat_trees.formatted(chat_trees.chains(frame))).collect()
    assert len(done) == 1 and len(done[0].turns) == 300
    assert chat_trees.formatted(chat_trees.chains(frame.limit(0))).collect() == []
    twice = frame.limit(2).unionAll(frame.limit(2)).withColumn("turn", F.lit(None).cast("long"))
    assert len(chat_trees.read_back(chat_trees.formatted(chat_trees.chains(twice))).collect()[0].turns) == 4
    assert hashlib.sha256(done[0].formatted.encode()).digest()
