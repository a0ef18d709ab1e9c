from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from echolattice.llm import histogram_packing
from tests.llm.helpers import documents


def test_ids_are_those_of_the_named_tokenizer():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(1)
    odd = ["", " ", "\n\n  \t x", "a<|endoftext|>b <|endoftext|>", "don't I'll WE'RE 12345 é日本語🙂‍  　", "x" * 3000, "\r\n\x00\x7f", "!?" * 50]
    odd += ["".join(r.choices("abé ñ\n\t'sd19.,<|>日🙂́", k=80)) for _ in range(200)]
    for text in odd:
        assert histogram_packing.token_ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids + [0]


def check(rows, docs, capacity):
    ids = {i: histogram_packing.token_ids(t or "") for i, t in docs}
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert set(parts) == set(ids)
    for i, own in parts.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own[:-1]]]).tolist()
        assert sum(r.length for r in own) == len(ids[i])
        assert len(own) == -(-len(ids[i]) // capacity) and all(r.length == capacity for r in own[1:])
    for slots in sequences.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_every_piece_has_its_slot(spark):
    r = random.Random(2)
    docs = [(i, " ".join(r.choices(["the", "cat", "sat", "é", "antidisestablishment"], k=r.choice([0, 1, 5, 30, 200, 500])))) for i in range(300)]
    docs += [(1000 + i, "same length") for i in range(200)] + [(2000, None), (2001, "")]
    rows = histogram_packing.pack(documents(spark, docs), capacity=256).collect()
    used = check(rows, docs, 256)
    assert used <= 1.05 * -(-sum(r.length for r in rows) // 256) + 1


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_as_good_as_best_fit_decreasing(seed):
    r = random.Random(seed)
    counts = Counter(min(64, int(r.expovariate(0.06)) + 1) for _ in range(3000))
    slots = histogram_packing.plan(dict(counts), 64)
    assert Counter({n: sum(s[2] for s in slots if s[0] == n) for n in counts}) == counts
    rooms: list[int] = []
    for length in sorted(counts.elements(), reverse=True):
        fit = min((x for x in rooms if x >= length), default=None)
        if fit is None:
            rooms.append(64 - length)
        else:
            rooms[rooms.index(fit)] -= length
    assert len({s[3] + k for s in slots for k in range(s[2])}) <= len(rooms)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, "a b", 7), (1, "a b", 8), (None, None, 9)], "doc_id long, text string, length int")
    rows = histogram_packing.pack(frame, with_ids=True).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1
    assert sorted(r.offset for r in rows) == [0, *np.cumsum([r.length for r in sorted(rows, key=lambda r: r.offset)][:-1]).tolist()]
    assert all(len(r.ids) == r.length for r in rows)
    assert histogram_packing.pack(frame.limit(0)).collect() == []
