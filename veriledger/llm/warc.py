"""Deterministic sharded WARC archives, and their reader.

Records are range-sorted by page, each task rolls files by compressed size, and a manifest
names the files that count.  The same rows give the same bytes on every run and retry.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.llm.common import bounded_batches
from veriledger.session import shared_folder

MANIFEST = "_manifest"
_MANIFEST_ROW = "file string, bytes bigint, sha256 string, records bigint"
_MANIFEST_ARROW = pa.schema(
    [("file", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("records", pa.int64())]
)
_RECORD_ROW = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
# Names and forms of the WARC 1.1 format.
_VERSION = b"WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, without a time stamp."""
    lines = [_VERSION] + [f"{k}: {v}".encode() for k, v in headers]
    lines.append(b"Content-Length: %d" % len(block))
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"\r\n".join(lines) + _END + block + _END) + packer.flush()


def _sha1(data: bytes) -> bytes:
    return hashlib.sha1(data, usedforsecurity=False).digest()


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _line(text: str | None) -> str:
    """A header value on one line."""
    return "%0A".join((text or "").splitlines())


def _page_record(page, url, payload: bytes, refers, date: str, copy: int) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers is None else b"")
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page}" + (f":{copy}>" if copy else ">")),
        ("WARC-Date", date),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", _base32(_sha1(payload))),
        ("WARC-Block-Digest", _base32(_sha1(block))),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers is not None:
        headers += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", _REVISIT)]
    return _record(headers, block)


class _Shard:
    """The file a task is writing: a temporary name until it is whole."""

    def __init__(self, store: fs.FileSystem, folder: str, part: int, number: int, attempt: int, date: str):
        self.store, self.folder = store, folder
        self.name = f"part-{part:05d}-{number:05d}.warc.gz"
        self.temporary = f"{folder}/.{self.name}.{attempt}"
        self.out = store.open_output_stream(self.temporary, compression=None)
        self.digest, self.bytes, self.records = hashlib.sha256(), 0, 0
        self.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", date)], b""))

    def write(self, data: bytes, records: int = 0) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.bytes += len(data)
        self.records += records

    def commit(self) -> pa.RecordBatch:
        self.out.close()
        whole = f"{self.folder}/{self.name}"
        # An earlier attempt of the task may have left the same bytes, onto which not every store moves.
        if self.store.get_file_info(whole).type != fs.FileType.NotFound:
            self.store.delete_file(whole)
        self.store.move(self.temporary, whole)
        row = [[self.name], [self.bytes], [self.digest.hexdigest()], [self.records]]
        return pa.record_batch([pa.array(v, f.type) for v, f in zip(row, _MANIFEST_ARROW, strict=True)], schema=_MANIFEST_ARROW)


def _writer(folder: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, path = fs.FileSystem.from_uri(folder)
        shard, number = None, 0
        page = winner_of = winner = None  # the page in hand, and the group row that came before it
        copies = answered = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    winner_of, winner, answered = (row["page_id"], row["content"]), row["winner"], 0
                    continue
                copies = copies + 1 if row["page_id"] == page else 0
                page, refers = row["page_id"], None
                if winner_of == (page, row["content"]):
                    refers = winner if page != winner or answered else None
                    answered += page == winner
                if shard is None:
                    shard = _Shard(store, path, task.partitionId(), number, task.taskAttemptId(), date)
                payload = (row["payload"] or "").encode()
                shard.write(_page_record(page, row["url"], payload, refers, date, copies), 1)
                if shard.bytes >= roll_bytes:
                    yield shard.commit()
                    shard, number = None, number + 1
        if shard is not None:
            yield shard.commit()

    return write


def write_archives(
    pages: DataFrame, folder: str, roll_bytes: int = 256 << 20, least_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; the manifest of the files comes back.

    Of equal payloads of at least ``least_bytes`` bytes, the record with the largest page id
    is the response and the others are revisits of it; shorter payloads are all responses.
    A file is closed once ``roll_bytes`` compressed bytes are reached.

    The html crosses the network once: the groups of equal payloads are found on digests,
    and each of their rows sorts right before its page.  A task writes to a temporary name
    and renames the whole file; names and bytes depend on the rows alone, so a repeated
    attempt replaces a file by the same bytes.  Files count only once the manifest does,
    which Spark commits after all tasks.

    Null html is an empty payload.  Rows with a null page id are records too, never the
    response of a group that has another id; of rows that repeat the largest id, the first
    answers and the others revisit it.  An empty table gives an empty manifest.  A payload
    is held whole by the task that writes it, whatever its size.  Other columns have no
    part, whatever their names.  Names and bounds of the files follow the number of
    shuffle partitions: the same bytes come from the same settings.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.sha2(payload, 256).alias("content"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("bigint").alias("winner"),
        "url",
        payload.alias("payload"),
    )
    long = rows.filter(F.octet_length("payload") >= least_bytes).select("page_id", "content")
    groups = (
        long.groupBy("content").agg(F.count("*").alias("n"), F.max("page_id").alias("winner"))
        .filter("n > 1 and winner is not null").drop("n")
    )
    marks = long.join(groups, "content").select(
        "page_id", "content", F.lit(0).alias("kind"), "winner",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"),
    )
    ordered = rows.unionByName(marks).repartitionByRange("page_id", "content").sortWithinPartitions(
        "page_id", "content", "kind", "url"
    )
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    manifest = ordered.mapInArrow(_writer(folder, roll_bytes, date), _MANIFEST_ROW)
    manifest.write.json(f"{folder}/{MANIFEST}")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_ROW).json(f"{folder}/{MANIFEST}")


class _Checked:
    """A file being read, with the digest of what has been read so far."""

    def __init__(self, stream):
        self.stream, self.digest = stream, hashlib.sha256()

    def chunk(self, size: int = 1 << 20) -> bytes:
        data = self.stream.read(size)
        self.digest.update(data)
        return data


def _members(source: _Checked) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one by one."""
    rest = source.chunk()
    while rest:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not rest and not (rest := source.chunk()):
                raise ValueError("the file ends within a record")
            parts.append(member.decompress(rest))
            rest = member.unused_data if member.eof else b""
        yield b"".join(parts)
        rest = rest or source.chunk()


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(_END)
    version, *lines = head.split(b"\r\n")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if version != _VERSION or rest[size:] != _END:
        raise ValueError("not a whole record")
    return headers, rest[:size]


def _page_of(urn: str) -> int | None:
    number = urn.strip("<>").split(":")[2]
    return None if number == "None" else int(number)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    if headers["WARC-Block-Digest"] != _base32(_sha1(block)):
        raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
    payload = block.partition(_END)[2]
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
    kind, refers, size = headers["WARC-Type"], None, int(headers["X-Payload-Length"])
    if kind == "revisit":
        refers, payload = _page_of(headers["WARC-Refers-To"]), None
    else:
        digest, size = _sha1(payload), len(payload)
        if _base32(digest) != headers["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
    return _page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind, refers, size, digest.hex(), payload


def _reader(folder: str, batch_bytes: int = 8 << 20):
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD_ARROW, strict=True)], schema=_RECORD_ARROW)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for entry in batch.to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{path}/{entry['file']}", compression=None) as stream:
                    source = _Checked(stream)
                    for record in _members(source):
                        headers, block = _parsed(record)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_row(headers, block))
                        held += len(block)
                        if held > batch_bytes:
                            yield flush(rows)
                            rows, held = [], 0
                if rows:
                    yield flush(rows)
                if source.digest.hexdigest() != entry["sha256"]:
                    raise ValueError(f"{entry['file']} is not the file of the manifest")

    return read


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files named by the manifest, digests checked, a file to a task.

    Responses carry their payload; revisits carry the page that has it.
    """
    manifest = read_manifest(spark, folder)
    files = max(1, manifest.count())
    return manifest.repartitionByRange(files, "file").mapInArrow(_reader(folder), _RECORD_ROW)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to a new shared folder and read the records back."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    write_archives(pages, folder, **options)
    return read_archives(spark, folder)
