from __future__ import annotations

import gzip
import hashlib
import os
import random
import re
import tempfile
import zlib

import pytest

from echolattice.llm import warc_shards as ws

SCHEMA = "page_id long, url string, html string"


def folder() -> str:
    return f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/archive"


def plain(rows):
    """Records by a loop over payloads."""
    out, groups = [], {}
    for page_id, url, html in rows:
        payload = (html or "").encode()
        groups.setdefault(payload, []).append((page_id, url))
    for payload, pages in groups.items():
        digest = hashlib.sha1(payload).hexdigest()
        pages.sort(key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
        for k, (page_id, _) in enumerate(pages):
            revisit = len(payload) >= 1000 and k < len(pages) - 1
            out.append((page_id, len(payload), digest, "revisit" if revisit else "response", pages[-1][0] if revisit else None))
    return sorted(out, key=_key)


def _key(row):
    return tuple((x is not None, x) for x in row)


def digests(found):
    return sorted((tuple(r) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=_key)


def some_pages(n, seed=1):
    r = random.Random(seed)
    rows = [(i * 3, f"http://h{i % 3}/é {i}", "<p>" + "".join(r.choice("abc é") for _ in range(r.choice([0, 10, 900, 5000])))) for i in range(n)]
    return rows + [(10_000 + i, "http://copies", "same " * 300) for i in range(n // 2)]


def test_round_trip_and_records(spark):
    rows = some_pages(200)
    path = folder()
    ws.write(spark.createDataFrame(rows, SCHEMA).repartition(4), path)
    found = ws.read_back(spark, path)
    assert digests(found) == plain(rows)
    texts = {r[0]: r[2] for r in rows}
    stored = found.where("record_type = 'response'").collect()
    assert all(r.html == texts[r.page_id] for r in stored)
    assert not os.path.exists(f"{path}/_temporary")


def test_same_bytes_whatever_the_partitions_and_files_roll(spark):
    rows = some_pages(150) + [(7_777_777, "u", "an odd page")] * 40
    hashes = []
    for k in (1, 5):
        path = folder()
        shuffled = rows[:]
        random.Random(k).shuffle(shuffled)
        spark.conf.set("spark.sql.shuffle.partitions", str(k + 1))
        files = ws.write(spark.createDataFrame(shuffled, SCHEMA).repartition(k), path, roll_bytes=8192, range_bytes=60_000).collect()
        hashes.append(sorted((f.name, f.sha256) for f in files))
        assert len({f.part for f in files}) > 3 and len(files) > len({f.part for f in files})
        for f in files:
            data = open(f"{path}/{f.name}", "rb").read()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (f.bytes, f.sha256)
            assert f.bytes <= 8192 or f.records == 1
            ids = re.findall(rb"WARC-Record-ID: (\S+)", gzip.decompress(data))
            assert len(ids) == len(set(ids)) == f.records + 1
        # The files in order hold the pages in order.
        order = [int(x) for f in sorted(files, key=lambda f: f.name) for x in re.findall(rb"X-Page-Id: (\d+)", gzip.decompress(open(f"{path}/{f.name}", "rb").read()))]
        assert order == sorted(order) and len(order) == len(rows)
        assert digests(ws.read_back(spark, path)) == plain(rows)
    assert hashes[0] == hashes[1]


def test_odd_rows(spark):
    long = "long é " * 400_000
    rows = [(1, None, None), (None, "u\r\nX-Evil: 1", ""), (None, None, "y" * 1500), (None, "b", "y" * 1500), (2, "u", long), (3, "u", long), (3, "v", long), (4, "x y", "x" * 999), (5, "", "x" * 999)]
    rows += [(6, "same", "z" * 2000)] * 3000 + [(7, "same", "short")] * 1500 + [(-5, "neg", "z" * 2000), (8, "\r\n\r\n", "\r\n\r\nWARC/1.1\r\n\r\n" * 100)]
    path = folder()
    ws.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    assert digests(ws.read_back(spark, path)) == plain(rows)


def test_hot_copies_are_dealt_out(spark):
    path = folder()
    files = ws.write(spark.createDataFrame([(1, "u", "z" * 2000)] * 9000, SCHEMA), path, range_bytes=1 << 20)
    records = {r.part: r.records for r in files.collect()}
    assert sum(records.values()) == 9000 and len(records) > 4 and max(records.values()) <= 2048


def test_empty_table_and_other_columns(spark):
    rows = spark.createDataFrame([(1, "u", "a", 5, "k")], SCHEMA + ", part int, sha string")
    path = folder()
    ws.write(rows, path)
    assert digests(ws.read_back(spark, path)) == plain([(1, "u", "a")])
    path = folder()
    assert ws.write(rows.limit(0), path).collect() == []
    assert ws.read_back(spark, path).collect() == []


def test_only_the_manifest_counts_and_renames_may_repeat(spark):
    path = folder()
    ws.write(spark.createDataFrame(some_pages(20), SCHEMA), path)
    # A lost attempt's file is no part of the archive.
    open(f"{path}/pages-000999-00000.warc.gz", "wb").write(b"half")
    assert digests(ws.read_back(spark, path)) == plain(some_pages(20))
    rows = ws.manifest(spark, path).withColumn("temporary", ws.F.lit("_temporary/gone/x"))
    batches = rows.select("part", "seq", "temporary", "name", "bytes", "records", "sha256").toArrow().to_batches()
    assert sum(b.num_rows for b in ws._commit(iter(batches), path)) == rows.count()
    os.remove(f"{path}/{rows.first().name}")
    with pytest.raises(FileNotFoundError):
        list(ws._commit(iter(batches), path))


def test_damage_is_found():
    member = ws.page_record(1, "http://u", 0, b"payload", 0, "", None)
    fields, block = ws.parsed(zlib.decompress(member, 31))
    assert block.endswith(b"payload") and fields["WARC-Target-URI"] == "http://u"
    with pytest.raises(ValueError, match="damaged"):
        ws.parsed(zlib.decompress(member, 31).replace(b"payload", b"paxload"))
