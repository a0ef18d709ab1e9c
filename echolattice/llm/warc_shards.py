"""Web archives written in shards, always the same for the same pages, and read back.

1. Pages that are equal as a whole are counted; of equal payloads the page of the largest id is stored, the others refer to it.
2. Records lie in the order of page_id.  The order is cut into ranges of equal bytes by exact counts
   (:func:`histogram_sort.splitters`), not by a sample, so the cuts do not depend on how the table is dealt out.
3. Records and payloads move to their ranges once and are sorted there: a payload arrives behind the record that stores it.
   Copies' payloads do not leave their task more than once, and records that refer have none.
4. A task writes the files of its ranges, each record compressed for itself, and begins
   another file when one has the bytes it may have.  Lengths and digests in headers come from what is written.
5. Files get temporary names of the attempt that writes them.  The table of files, written when all tasks are done, fixes which
   attempt counts; only then files are renamed, which may be repeated, and the manifest is written, which alone makes the archive.

Executors reach the folder by Arrow's file systems (local and shared folders, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolattice.llm.common import NO_ID, cut, discard, map_texts, partitions
from echolattice.llm.histogram_sort import rank_among, splitters

#: Payloads from this size on are stored once.
LEAST = 1000
#: Compressed bytes after which a file is full; bytes of a range, which one task writes.
ROLL_BYTES, RANGE_BYTES = 128 << 20, 512 << 20
#: Small archives are cut into so many ranges, though not below so many bytes.
RANGES, SMALL_RANGE = 64, 256 << 10
#: Bytes of a record besides its payload, for the ranges' sizes; copies of a page that are dealt out together.
HEADERS, TOGETHER = 700, 1024
#: The time in all headers: that of the write would differ each time.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
_ROWS = "part int, h long, i long, page_id long, url string, sha binary, kind int, copies long, first long, size long, sha1 string, stores boolean, refers boolean, refers_to long, html string"
_FILES = "part int, seq int, temporary string, name string, bytes long, records long, sha256 string"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a folder, and the folder there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None, url: str | None) -> str:
    """The address, with what has no place in a header line as percent codes."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{'' if page_id is None else page_id}"


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=4)}>"


def _member(kind: str, record: str, block: bytes, content: str, fields: list[tuple[str, object]]) -> bytes:
    """A record, compressed for itself."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record), ("WARC-Date", DATE), *fields, ("WARC-Block-Digest", _sha1(block)), ("Content-Type", content), ("Content-Length", len(block))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, ordinal: int, payload: bytes | None, size: int, sha1: str, refers_to: int | None) -> bytes:
    """A response with its payload, or (``payload`` None) a revisit of page ``refers_to``."""
    own = "" if page_id is None else page_id
    fields: list[tuple[str, object]] = [("WARC-Target-URI", _uri(page_id, url)), ("X-Page-Id", own)]
    if payload is None:
        digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", "" if refers_to is None else refers_to)]
    else:
        digest, size = _sha1(payload), len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    fields.append(("WARC-Payload-Digest", digest))
    kind = "response" if payload is not None else "revisit"
    return _member(kind, _record_id(page_id, url, digest, ordinal), block, "application/http; msgtype=response", fields)


class _Files:
    """Files of one attempt, under temporary names."""

    def __init__(self, path: str, roll: int):
        self.system, self.folder = file_system(path)
        self.roll, self.attempt = roll, uuid.uuid4().hex
        self.part, self.out = None, None

    def _open(self) -> None:
        self.name = f"pages-{self.part:06d}-{self.seq:05d}.warc.gz"
        self.temporary = f"_temporary/{self.attempt}/{self.name}"
        where = posixpath.join(self.folder, self.temporary)
        self.system.create_dir(posixpath.dirname(where), recursive=True)
        self.out = self.system.open_output_stream(where, compression=None)
        self.bytes, self.records, self.sha = 0, -1, hashlib.sha256()
        self._put(_member("warcinfo", _record_id("warcinfo", self.name), b"format: WARC File Format 1.1\r\n", "application/warc-fields", [("WARC-Filename", self.name)]))

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.bytes, self.records = self.bytes + len(member), self.records + 1

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            yield self.part, self.seq, self.temporary, self.name, self.bytes, self.records, self.sha.hexdigest()

    def add(self, part: int, member: bytes) -> Iterator[tuple]:
        if self.out is not None and (part != self.part or self.bytes + len(member) > self.roll):
            yield from self.close()
            self.seq = self.seq + 1 if part == self.part else 0
        if self.part is None:
            self.seq = 0
        self.part = part
        if self.out is None:
            self._open()
        self._put(member)


def _pages(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))


def _records(pages: DataFrame) -> DataFrame:
    """A row for each distinct page and up to ``TOGETHER`` copies of it: what is stored, what it refers to; h and i order them."""
    size = F.octet_length("html").cast("long")
    small = F.when(size < LEAST, F.col("html"))
    hashed = pages.select("page_id", "url", F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("sha"), F.sha1(F.col("html").cast("binary")).alias("sha1"), size.alias("size"), small.alias("html"))
    counted = cut(hashed.groupBy("page_id", "url", "sha", "sha1", "size", "html").agg(F.count("*").alias("n")), "pages")
    stored = counted.where(F.col("size") >= LEAST).groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("kept"), F.sum("n").alias("all")).where(F.col("all") > 1)
    judged = counted.join(stored.select("sha", "kept"), "sha", "left")
    large = F.col("size") >= LEAST
    stores = large & (F.col("kept").isNull() | (F.col("kept")["page_id"].eqNullSafe(F.col("page_id")) & F.col("kept")["url"].eqNullSafe(F.col("url"))))
    judged = judged.withColumn("stores", stores).withColumn("refers", large).withColumn("refers_to", F.col("kept")["page_id"]).drop("kept")
    # Many copies of a page become many rows in two steps, neither of which unrolls more than a thousand times the square.
    coarse = TOGETHER * TOGETHER
    blocks = judged.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / coarse))))
    left = F.least(F.col("n") - F.col("block") * coarse, F.lit(coarse))
    blocks = blocks.withColumn("inner", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((left - 1) / TOGETHER))))
    first = F.col("block") * coarse + F.col("inner") * TOGETHER
    chunk = F.least(F.floor(first / TOGETHER), F.lit((1 << 20) - 1))
    order = F.shiftleft(F.shiftright(F.xxhash64("url", "sha"), 20), 20)
    return blocks.select(
        F.coalesce("page_id", F.lit(NO_ID)).alias("h"), order.bitwiseOR(chunk).alias("i"), "page_id", "url", "sha", "sha1", "size", "html", "stores", "refers", "refers_to",
        F.least(F.col("n") - first, F.lit(TOGETHER)).alias("copies"), first.alias("first"),
    )


def _bodies(pages: DataFrame) -> DataFrame:
    """Payloads large enough to be stored once, each once a batch, with the key of their page."""

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        seen, pick, shas = set(), [], []
        texts = batch.column("html").cast(pa.binary())
        for k, (page_id, url) in enumerate(zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())):
            sha = hashlib.sha256(texts[k].as_buffer()).digest()
            if (page_id, url, sha) not in seen:
                seen.add((page_id, url, sha))
                pick.append(k)
                shas.append(sha)
        rows = batch.take(pa.array(pick, pa.int64()))
        return pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(shas, pa.binary()), rows.column("html")], names=["page_id", "url", "sha", "html"])

    found = map_texts(pages.where(F.octet_length("html") >= LEAST), keys, "page_id long, url string, sha binary, html string", column="html")
    order = F.shiftleft(F.shiftright(F.xxhash64("url", "sha"), 20), 20)
    return found.select(F.coalesce("page_id", F.lit(NO_ID)).alias("h"), order.alias("i"), "page_id", "url", "sha", "html", F.lit(1).alias("kind"))


def _written(batches: Iterator[pa.RecordBatch], path: str, roll: int) -> Iterator[pa.RecordBatch]:
    """Write sorted records and payloads to files; a row for each file."""
    files, done, waiting = _Files(path, roll), [], None

    def copies(row: dict, start: int) -> None:
        for ordinal in range(start, row["copies"]):
            payload = None if row["refers"] else row["html"].encode()
            done.extend(files.add(row["part"], page_record(row["page_id"], row["url"], row["first"] + ordinal, payload, row["size"], row["sha1"], row["refers_to"])))

    for batch in batches:
        for k in range(batch.num_rows):  # row by row, as payloads can be long
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            if row["kind"] == 0:
                if waiting is not None:
                    raise ValueError(f"no payload came for page {waiting['page_id']}")
                if row["stores"] and row["first"] == 0:
                    waiting = row
                else:
                    copies(row, 0)
            elif waiting is not None and all(waiting[c] == row[c] for c in ("page_id", "url", "sha")):
                own, waiting = waiting, None
                done.extend(files.add(own["part"], page_record(own["page_id"], own["url"], 0, row["html"].encode(), 0, "", None)))
                copies(own, 1)
    if waiting is not None:
        raise ValueError(f"no payload came for page {waiting['page_id']}")
    done.extend(files.close())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], schema=_arrow(_FILES))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _commit(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rename files; what an earlier try has renamed stays."""
    system, folder = file_system(path)
    for batch in batches:
        for row in batch.to_pylist():
            source, target = posixpath.join(folder, row["temporary"]), posixpath.join(folder, row["name"])
            if system.get_file_info(source).type == fs.FileType.File:
                system.move(source, target)
            elif system.get_file_info(target).size != row["bytes"]:
                raise FileNotFoundError(f"{row['name']} is neither at its temporary nor at its final place")
        yield batch


def write(pages: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive in the folder ``path``, which must not hold one; returns its manifest.

    Payloads are the UTF-8 bytes of html (null: empty).  Of equal payloads of 1,000 bytes or more, that of
    the largest page_id (null: least; of equal ids the largest url, null the least) is a response, the others are revisits of that
    page; all smaller ones are responses.  Pages equal in all three are records of their own: one is
    the response, the others revisit it under the same page_id.  Null addresses become ``urn:page:`` and the id; characters that no header
    line can hold become percent codes.  Other columns are ignored.  The same rows give the same bytes,
    in whatever order and partitions they come.  An empty table gives an archive without files.
    A file holds more than ``roll_bytes`` only if a single record does.
    """
    spark = pages.sparkSession
    given = _pages(pages)
    records = cut(_records(given), "records")
    size = F.col("copies") * HEADERS + F.when(F.col("stores") & (F.col("first") == 0), F.col("size")).when(~F.col("refers"), F.col("size") * F.col("copies")).otherwise(0)
    keys = records.select("h", "i", size.alias("size"))
    total = keys.agg(F.sum("size")).first()[0] or 0
    n = int(max(-(-total // range_bytes), min(RANGES, total // SMALL_RANGE), 1))
    borders = [b[0] for b in sorted(splitters(keys, [total * k // n for k in range(1, n)], [0.1 * total / n] * (n - 1)))]
    shared = spark.sparkContext.broadcast(borders)

    @F.pandas_udf("int")
    def part_of(h: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series(rank_among(shared.value, h.to_numpy(), i.to_numpy()).astype(np.int32))

    rows = records.withColumn("kind", F.lit(0)).unionByName(_bodies(given), allowMissingColumns=True).withColumn("part", part_of("h", "i"))
    dealt = rows.repartition(min(n, 4 * partitions(spark)), "part").sortWithinPartitions("part", "h", "i", "page_id", "url", "sha", "kind", "first")
    names = [x.split()[0] for x in _ROWS.split(", ")]
    files = cut(dealt.select(*names).mapInArrow(lambda b: _written(b, path, roll_bytes), _FILES), "files")
    files.repartition(partitions(spark), "name").mapInArrow(lambda b: _commit(b, path), _FILES).drop("temporary").write.parquet(f"{path}/_manifest")
    discard(records)
    system, folder = file_system(path)
    if system.get_file_info(f"{folder}/_temporary").type == fs.FileType.Directory:
        system.delete_dir(f"{folder}/_temporary")
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """part, seq, name, bytes, records and sha256 of the files of an archive."""
    return spark.read.schema(_FILES.replace("temporary string, ", "")).parquet(f"{path}/_manifest")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one in memory at a time."""
    unpack, out, data = zlib.decompressobj(31), [], stream.read(size)
    while data:
        out.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(out)
            data, unpack, out = unpack.unused_data, zlib.decompressobj(31), []
            if data:
                continue
        data = stream.read(size)
    if out and any(out):
        raise ValueError("a file ends within a record")


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block, whose length and digest must be those of the header."""
    head, block = record.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block, end = block[: int(fields["Content-Length"])], block[int(fields["Content-Length"]) :]
    if end != b"\r\n\r\n" or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, block


def read_back(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of an archive: page_id, url (as in the header), record_type, payload_bytes, payload_digest (hex), refers_to and, if
    asked for, html (null for revisits).

    Only files of the manifest count; a damaged record or a payload that has not the digest of its header ends the job.
    """
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", *(["html"] if payloads else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), *([pa.string()] if payloads else [])]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(path)
        rows, held = [], 0
        for name in (x for batch in batches for x in batch.column("name").to_pylist()):
            with system.open_input_stream(posixpath.join(folder, name), compression=None) as stream:
                for record in members(stream):
                    fields, block = parsed(record)
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, payload = block.split(b"\r\n\r\n", 1)
                    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    stored = fields["WARC-Type"] == "response"
                    if stored and (len(payload) != size or _sha1(payload) != fields["WARC-Payload-Digest"]):
                        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
                    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                    own, other = fields["X-Page-Id"], fields.get("X-Refers-To-Page-Id")
                    row = (int(own) if own else None, fields["WARC-Target-URI"], fields["WARC-Type"], size, digest, int(other) if other else None)
                    rows.append((*row, payload.decode() if stored else None) if payloads else row)
                    held += len(payload) if payloads else 100
                    if held > 4 << 20:
                        yield table(rows)
                        rows, held = [], 0
        if rows:
            yield table(rows)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + (", html string" if payloads else "")
    return manifest(spark, path).select("name").repartition(partitions(spark), "name").mapInArrow(run, schema)
