"""WARC archives: a writer with revisit records, and a splittable reader.

Each record is a gzip member of its own. The reader cuts archives into byte ranges that tasks scan at
the same time: a task looks for the gzip magic from the start of its range, tries each candidate by
decoding it, takes it if a WARC header comes out, and owns every record that starts inside its range
(a record may end beyond it). Between records it goes on where the last one ended.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more the one with the largest page id is a
response, the others are revisits that refer to it and have no payload of their own; the reader takes
their payload facts from the response they refer to. A task writes one archive under a name of its
partition and moves it into place when it is whole, so a repeated task replaces its own file.

Defined cases: a null html is an empty payload; a null url gets a name made from the page id; a null
page id is least (if all ids of a payload are null, all its records are responses); rows that repeat the
largest id are responses too; other columns are ignored; without rows there is an archive folder
without records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalgrid.llm.common import map_arrow, stage
from shoalgrid.operators.skew import lookup

MIN_REVISIT = 1000
SPLIT = 8 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLOCK = 1 << 18
RECORD = "record_id string, record_type string, refers_to_id string, uri string, page_id long, payload binary, digest string, path string, offset long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; with ``refers_to`` a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~') if url else f'urn:page:{page_id}'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _writer(path: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(path)
        files.create_dir(root)
        task = TaskContext.get()
        name, trial = f"{root}/part-{task.partitionId():05d}.warc.gz", f"{root}/.trial-{task.taskAttemptId()}"
        rows = 0
        with files.open_output_stream(trial, compression=None) as out:
            for batch in batches:
                for x in batch.to_pylist():
                    out.write(record(x["page_id"], x["url"], x["payload"], x["digest"], x["refers_to"]))
                    rows += 1
        files.move(trial, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows])], names=["path", "records"])

    return step


def with_revisits(pages: DataFrame, min_bytes: int, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every page."""
    payload = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    kept = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = lookup(rows, kept, ["digest"])
    return found.select("page_id", "url", "payload", "digest", F.when(F.coalesce(F.col("page_id") != F.col("keeper"), F.col("keeper").isNotNull()), F.col("keeper")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write archives below ``path`` (a folder all tasks reach); gives (path, records) of what was written."""
    return stage(map_arrow(with_revisits(pages, min_bytes, id_column, url_column, html_column), _writer(path), "path string, records long"), "archives")


class _Window:
    """Bytes of a file from a moving start, read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def at(self, offset: int, count: int) -> bytes:
        """Bytes from ``offset``: ``count`` of them, fewer only at the end of the file."""
        count = min(count, self.size - offset)
        if not self.start <= offset <= offset + count <= self.start + len(self.data):
            self.file.seek(offset)
            self.start, self.data = offset, self.file.read(max(count, min(_BLOCK, self.size - offset)))
        return self.data[offset - self.start: offset - self.start + count]


def _member(window: _Window, offset: int) -> tuple[bytes, int] | None:
    """Text and end of the gzip member at ``offset`` if it is a whole WARC record."""
    opener, parts, at, head = zlib.decompressobj(31), [], offset, b""
    try:
        while not opener.eof:
            block = window.at(at, _BLOCK)
            if not block:
                return None
            parts.append(opener.decompress(block))
            at += len(block)
            if len(head) < 5:
                head += parts[-1][:5]
                if not b"WARC/".startswith(head[:5]):
                    return None
    except zlib.error:
        return None
    return (b"".join(parts), at - len(opener.unused_data)) if head[:5] == b"WARC/" else None


def parse(text: bytes) -> dict | None:
    """Header fields and payload of a record; None if its length does not fit."""
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    block = rest[: int(length)]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    return {"fields": fields, "payload": payload}


def records_in(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of the records that start in ``start .. end - 1``."""
    window, at = _Window(file, size), start
    while at < end:
        # a magic that starts inside the range may end beyond it
        block = window.at(at, min(_BLOCK, end - at + len(MAGIC) - 1))
        place = block.find(MAGIC)
        if place < 0:
            at += max(len(block) - len(MAGIC) + 1, 1)
            continue
        at += place
        found = _member(window, at)
        parsed = parse(found[0]) if found else None
        if parsed is None:
            at += 1
            continue
        yield at, parsed
        at = found[1]


def _digest_hex(field: str) -> str | None:
    kind, _, value = field.partition(":")
    return base64.b32decode(value).hex() if kind.lower() == "sha1" and len(value) == 32 else None


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64()]

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for x in batch.to_pylist():
            files, root = pa.fs.FileSystem.from_uri(x["path"])
            rows, held = [], 0
            with files.open_input_file(root) as file:
                for offset, found in records_in(file, x["length"], x["start"], min(x["start"] + x["split"], x["length"])):
                    f = found["fields"]
                    page = f.get("x-page-id", "")
                    rows.append((f.get("warc-record-id"), f.get("warc-type"), f.get("warc-refers-to"), f.get("warc-target-uri"), int(page) if page.lstrip("-").isdigit() else None,
                                 found["payload"], _digest_hex(f.get("warc-payload-digest", "")), x["path"], offset))
                    held += len(found["payload"])
                    if held > _BLOCK * 8:
                        yield out(rows)
                        rows, held = [], 0
            if rows:
                yield out(rows)


def read_warc(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Every record of the ``*.warc.gz`` archives below ``path``, read in byte ranges of ``split``."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select("path", "length").where("length > 0")
    ranges = archives.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start"), F.lit(split).cast("long").alias("split"))
    tasks = max(ranges.count(), 1)  # one range each; a fixed number, so that adaptive execution does not put them together
    return map_arrow(ranges.repartition(tasks), _reader, RECORD)


def page_facts(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits take them from their response."""
    light = stage(records.select(
        "record_id", "record_type", "refers_to_id", "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")), "records")
    own = light.where("record_type = 'response'")
    answers = own.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    again = lookup(light.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to_id"), answers, ["refers_to_id"])
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return own.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(again.select(*columns, "refers_to"))


#: The same rows over ``pages``, in DuckDB's SQL.
SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT *, CASE WHEN n >= {MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY digest) END AS keeper FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to FROM k"""
