"""WARC archives as a Spark data source: one gzip member for each record.

Writing: every task appends records to its own archives and starts a new one
at ``maxFileBytes``. Only archives named by the tasks whose results were
committed are listed in ``_archives.json``; what a lost executor or a repeated
attempt left beside them is never read.

Reading: a task reads one archive from front to back. Each member is
decompressed in small steps by its own zlib object, the record's block is
framed by Content-Length, and block and payload digests are verified while
the bytes pass, so memory does not depend on the record's length unless the
payload itself is asked for (``payload=true``).

Defined results: a NULL payload is written as an empty one. A NULL record id,
URI or date is written as an empty field and read back as NULL. Repeated rows
give repeated records. A record that breaks its framing or a digest is
returned with the reason in ``error``; after a damaged member, reading goes on
at the next member that holds a record. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)

from citymarts.session import new_scratch

MANIFEST = "_archives.json"
STEP = 1 << 16  # bytes read and decompressed at a time
#: A revisit points to a response only for payloads of at least this many bytes.
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITE_SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload binary, "
                "payload_bytes long, payload_digest string, refers_to string")
READ_SCHEMA = ("file string, offset long, record_id string, record_type string, target_uri string, date string, "
               "refers_to string, payload_bytes long, payload_digest string, payload binary, error string")
ARROW_SCHEMA = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()),
                          ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                          ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                          ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def _label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _hex(label: str | None) -> str | None:
    """Hexadecimal form of a ``sha1:`` label in base 32 or base 16."""
    kind, _, value = (label or "").partition(":")
    if kind.lower() != "sha1" or not value:
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


# -- writing -----------------------------------------------------------------

def record_bytes(row: dict) -> bytes:
    """One WARC record, not compressed."""
    payload = row["payload"] or b""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id'] or ''}>"),
              ("WARC-Target-URI", row["target_uri"] or ""), ("WARC-Date", row["date"] or ""),
              ("WARC-Payload-Digest", _label(row["payload_digest"])),
              ("WARC-Block-Digest", _label(hashlib.sha1(block).hexdigest()))]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("maxFileBytes", 256 << 20))
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = pafs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    names.append(f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                data = _member(record_bytes(row), self.level)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        store, root = pafs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names = sorted(n for m in messages if m is not None for n in m.names)
        with store.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())


# -- reading -----------------------------------------------------------------

class _Record:
    """Takes a record's bytes piece by piece; ``row`` gives what they held."""

    def __init__(self, keep: bool):
        self.keep, self.head, self.fields = keep, bytearray(), None
        self.left = 0                       # bytes of the block still to come
        self.tail = bytearray()             # what follows the block
        self.http: bytearray | None = None  # the HTTP head, until it is complete
        self.http_fields: dict[str, str] = {}
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.length, self.kept = 0, bytearray()

    @staticmethod
    def _parse(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k.strip()}

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                return
            data, self.fields = bytes(self.head[end + 4:]), self._parse(self.head[:end])
            self.left = int(self.fields["content-length"])
            if self.fields.get("content-type", "").startswith("application/http"):
                self.http = bytearray()
        block, rest = data[:self.left], data[self.left:]
        self.tail += rest[:5 - len(self.tail)] if len(self.tail) < 5 else b""
        self.left -= len(block)
        self.block.update(block)
        if self.http is not None:
            self.http += block
            end = self.http.find(b"\r\n\r\n")
            if end < 0:
                return
            self.http_fields, block, self.http = self._parse(self.http[:end]), bytes(self.http[end + 4:]), None
        self.payload.update(block)
        self.length += len(block)
        if self.keep:
            self.kept += block

    def row(self) -> dict:
        f = self.fields
        if f is None:
            return {"error": "no record head"}
        kind, error = f.get("warc-type"), None
        declared, found = _hex(f.get("warc-payload-digest")), self.payload.hexdigest()
        if self.left or bytes(self.tail) != b"\r\n\r\n":
            error = "content length does not frame the block"
        elif _hex(f.get("warc-block-digest")) not in (None, self.block.hexdigest()):
            error = "block digest differs"
        elif kind != "revisit" and declared not in (None, found):
            error = "payload digest differs"
        bare = lambda k: (f.get(k) or "").strip("<>") or None
        revisit = kind == "revisit"
        return {"record_id": bare("warc-record-id"), "record_type": kind, "target_uri": bare("warc-target-uri"),
                "date": bare("warc-date"), "refers_to": bare("warc-refers-to"), "error": error,
                "payload_bytes": int(self.http_fields.get("content-length", 0)) if revisit else self.length,
                "payload_digest": declared if revisit else found,
                "payload": bytes(self.kept) if self.keep and not revisit else None}


def read_archive(handle, keep: bool = False) -> Iterator[dict]:
    """The records of one archive in order; ``handle`` is a seekable binary file."""
    offset, lost, buffer = 0, False, b""
    while True:
        buffer = buffer or handle.read(STEP)
        if not buffer:
            return
        record, z, read, begun = _Record(keep), zlib.decompressobj(31), 0, False
        try:
            while not z.eof:
                buffer = buffer or handle.read(STEP)
                if not buffer:
                    raise EOFError("the archive ends inside a member")
                while buffer and not z.eof:
                    before = len(buffer)
                    piece = z.decompress(buffer, STEP)
                    buffer = z.unused_data if z.eof else z.unconsumed_tail
                    read += before - len(buffer)
                    if lost and not begun and piece and not piece.startswith(b"WARC/"):
                        raise zlib.error("not a record")
                    begun = begun or bool(piece)
                    record.feed(piece)
            yield {"offset": offset} | record.row()
            offset, lost = offset + read, False
        except (zlib.error, EOFError, KeyError, ValueError) as e:
            if not lost:
                yield {"offset": offset, "error": f"damaged member: {e}"}
            offset, buffer, lost = _next_member(handle, offset + 1), b"", True
            if offset < 0:
                return
            handle.seek(offset)


def _next_member(handle, start: int) -> int:
    """Where the next gzip head begins at or after ``start``, or -1."""
    handle.seek(start)
    last = b""
    while data := handle.read(STEP):
        at = (last + data).find(b"\x1f\x8b\x08")
        if at >= 0:
            return start + at - len(last)
        start += len(data)
        last = (last + data)[-2:]
    return -1


@dataclass
class _Archive(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.keep = options.get("payload", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        store, root = pafs.FileSystem.from_uri(self.path)
        if store.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as f:
                names = json.loads(f.read())
        else:
            found = store.get_file_info(pafs.FileSelector(root))
            names = sorted(i.base_name for i in found if i.base_name.endswith((".warc.gz", ".warc")))
        return [_Archive(f"{root}/{n}") for n in names] or [_Archive("")]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = pafs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        with store.open_input_file(partition.path) as handle:
            for row in read_archive(handle, self.keep):
                rows.append({"file": partition.path} | row)
                size += 300 + len(row.get("payload") or b"")
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW_SCHEMA)


class WarcSource(DataSource):
    """``format("warc")``; options: path, payload (read), maxFileBytes and level (write)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


# -- the operator ------------------------------------------------------------

def with_revisits(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", text_col: str = "html",
                  date: str = "2024-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Records for ``pages``; equal payloads of ``revisit_bytes`` or more become revisits.

    The record with the largest id of each such payload stays a response. Only
    digests and ids are aggregated; a payload that many pages share is split by
    the adaptive skew join. Rows that repeat the largest id are all responses.
    """
    p = (pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("target_uri"),
                      F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("payload"))
         .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
         .withColumn("same", F.when(F.col("payload_bytes") >= revisit_bytes, F.sha2("payload", 256))))
    first = (p.where("same is not null").groupBy("same").agg(F.max("id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("same", "first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    # payloads that are too short for revisits are not shuffled
    told = p.where("same is not null").join(first, "same", "left").unionByName(
        p.where("same is null").withColumn("first", F.lit(None).cast(p.schema["id"].dataType)))
    return told.select(
        urn("id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(date).alias("date"), F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes", F.sha1("payload").alias("payload_digest"), F.when(revisit, urn("first")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, max_file_bytes: int = 256 << 20) -> str:
    """Write ``records`` (``WRITE_SCHEMA``) below ``path``, a folder that all executors share."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").option("maxFileBytes", max_file_bytes).option("path", path).save()
    return path


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back."""
    spark = pages.sparkSession
    path = write_archives(with_revisits(pages), new_scratch(spark, "warc"))
    return read_archives(spark, path, payload=False)


def page_records(records: DataFrame) -> DataFrame:
    """Per page: what its record says. ``verified``: framing and digests held."""
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^urn:page:(-?[0-9]+)$', 1) as long)")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"), F.col("error").isNull().alias("verified"))
