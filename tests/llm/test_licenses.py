from __future__ import annotations

import random

import pytest

from echolattice.llm import license_paragraphs
from tests.llm.helpers import documents

PROSE = ["lorem", "dolor", "the", "river", "was", "license", "permission", "copy", "of", "a", "house", "software", "and", "free"]


@pytest.fixture(scope="module")
def scanned(spark):
    r = random.Random(2)
    docs, truth = [], {}
    for i in range(400):
        lines = [" ".join(r.choices(PROSE, k=r.randint(3, 90))) for _ in range(r.randint(1, 5))]
        if i % 3 == 0:
            family = r.choice(license_paragraphs.FAMILIES)
            notice = r.choice(license_paragraphs.TEMPLATES[family])
            notice = r.choice([notice, notice.upper(), "  " + notice.replace(" ", "  "), " ".join(r.choices(PROSE, k=6)) + " " + notice])
            lines.insert(r.randint(0, len(lines)), notice)
            truth[i] = family
        docs.append((i, "\n".join(lines)))
    docs += [(1000, None), (1001, ""), (1002, "\n\n")]
    return docs, truth, {x.doc_id: x for x in license_paragraphs.scan(documents(spark, docs)).collect()}


def test_held_out_accuracy(scanned):
    docs, truth, found = scanned
    assert set(found) == {i for i, _ in docs}
    caught = sum(truth[i] in found[i].families for i in truth)
    wrong = sum(bool(set(x.families) - {truth.get(i)}) for i, x in found.items())
    assert caught >= 0.95 * len(truth) and wrong <= 0.02 * len(found)
    plain = [x for i, x in found.items() if i not in truth]
    assert sum(x.n_unknown > 0 for x in plain) <= 0.1 * len(plain)


def test_paragraphs_and_odd_rows(spark, scanned):
    docs, _, found = scanned
    for i, text in docs:
        assert found[i].n_paragraphs == sum(bool(x.strip()) for x in (text or "").split("\n"))
    assert found[1000].licence_probability is None
    frame = spark.createDataFrame([(None, "x", 1), (1, "Released under the MIT License.", 2), (1, "Released under the MIT License.", 2)], "doc_id long, text string, families int")
    rows = license_paragraphs.scan(frame).collect()
    assert sorted(str(x.families) for x in rows) == ["['mit']", "['mit']", "[]"]
    assert license_paragraphs.scan(frame.limit(0)).collect() == []


#: Notices of licences the classifier has never seen, in words of their own.
UNSEEN = (
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Licensed under the Microsoft Public License.",
)


def test_whole_and_short_forms_of_other_families(spark):
    """Headers as files carry them: over several lines, behind comment signs, with names and years."""
    docs = [
        (1, "/*\n * This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. */"),
        (2, "# This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
        (3, "// SPDX-License-Identifier: MIT"), (4, "# SPDX-License-Identifier: GPL-2.0-or-later"), (5, "SPDX-License-Identifier: BSD-2-Clause  see the file"),
        (6, "Copyright 2020 A Person\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
        (7, "Distributed under the Boost Software License, Version 1.0."), (8, "-- SPDX-License-Identifier: AGPL-3.0-only"), (9, "We met on the free river and had permission to copy a house."),
    ]
    docs += [(100 + k, t) for k, t in enumerate(UNSEEN)]
    filler = [(1000 + k, " ".join(random.Random(k).choices(PROSE, k=30))) for k in range(200)]
    found = {x.doc_id: x.families for x in license_paragraphs.scan(documents(spark, docs + filler)).collect()}
    expected = {1: "lgpl-2.1", 2: "gpl-2.0", 3: "mit", 4: "gpl-2.0", 5: "bsd-2-clause", 6: "isc", 7: "bsl-1.0", 8: "agpl-3.0"}
    assert {k: found[k] for k in expected} == {k: [v] for k, v in expected.items()}
    assert found[9] == [] and all(found[100 + k] == [] for k in range(len(UNSEEN))), "families it has not seen are never named as others"
