"""Web archives as a chunked record table.

Payloads travel as (record, chunk number) rows of at most ``CHUNK`` bytes with the digest carried along from chunk to chunk: beyond the
page's own row, neither writer nor reader holds a whole record. Archives are gzip members per record, written and read with pyarrow's file systems
in the cluster's shared folder. The list of archives a run wrote is a table of its own; files of lost or repeated tasks are not on it.
"""

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions.once import with_columns_once
from quipu.llm.common import bound, small_side, stored, whole_text, with_package
from quipu.scratch import run_folder

CHUNK = 1 << 20
ROLL = 1 << 28
BLOCK = 1 << 18
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the payload's SHA-1: 8 groups of 20 bits."""
    group = lambda hexa, i: F.conv(F.substring(hexa, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
    letter = lambda v, shift: F.substring(F.lit(_ALPHABET), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    letters = lambda v: F.concat(*[letter(v, s) for s in (15, 10, 5, 0)])
    whole = lambda hexa: F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: bound(group(hexa, i), letters)))
    return bound(F.sha1(payload), whole)


def record_kinds(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, payload_digest, payload_bytes, ...) with record_type and refers_to.

    The smallest page_id of equal payloads of at least min_bytes is the response, the others revisit it. Repeated rows of one page
    with one payload get the same type. A null page_id never is the response of others; alone it is one.
    """
    firsts = pages.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
    firsts = firsts.agg(F.min("page_id").alias("__first"), F.count("*").alias("__rows")).filter("__rows > 1").drop("__rows")
    firsts = stored(firsts, "warc-repeats")
    rows = pages.join(small_side(firsts), "payload_digest", "left")
    again = F.coalesce((F.col("payload_bytes") >= min_bytes) & F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first")), F.lit(False))
    rows = rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
    return rows.withColumn("refers_to", F.when(again, F.col("__first"))).drop("__first")


def chunk_rows(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """record columns, chunk_no from 0, last, and data; a revisit has one empty chunk. Rows of a record stay together, in order; each is
    cut from the payload by itself."""
    size = F.when(F.col("record_type") == "revisit", 0).otherwise(F.octet_length("__payload"))
    last = F.floor(F.greatest(size - 1, F.lit(0)) / chunk).cast("int")
    names = ["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to"]
    rows = records.select(*names, "__payload", size.alias("__size"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    end = (F.col("chunk_no").cast("long") + 1) * chunk
    data = F.when(F.col("__size") == 0, F.lit(b"")).otherwise(F.substring("__payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return rows.select(*names, "chunk_no", (end >= F.col("__size")).alias("last"), data.alias("data"))


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def _clean(value: str) -> str:
    return "".join(c for c in value if c >= " " and c != "\x7f")


def _head(row: dict, day: str) -> bytes:
    """WARC and HTTP headers up to the payload. Identifiers go through JSON, so that null and any text come back."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    body = 0 if row["record_type"] == "revisit" else row["payload_bytes"]
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {day}",
        f"WARC-Target-URI: {_clean(row['url'] or '')}", f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Page-ID: {json.dumps(row['page_id'])}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + body}",
    ]
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page: {json.dumps(row['refers_to'])}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Member:
    """One gzip member written as a stream."""

    def __init__(self, out, level: int):
        self.out, self.z, self.bytes = out, zlib.compressobj(level, zlib.DEFLATED, 31), 0

    def add(self, data: bytes) -> None:
        self._put(self.z.compress(data))

    def end(self) -> None:
        self._put(self.z.flush())

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.out.write(data)


def write_archives(chunks: DataFrame, folder: str, day: str = "2000-01-01T00:00:00Z", roll: int = ROLL, level: int = 1) -> DataFrame:
    """Writes the chunk rows, record by record, to .warc.gz files in folder; returns path, records, bytes of every file.

    A payload whose running digest differs from the announced one fails the task. The returned table is stored: only files on it
    count, so repeated and speculative tasks do no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _file_system(folder)
        files.create_dir(base, recursive=True)
        out = member = digest = path = None
        done, records, size = [], 0, 0

        def close() -> None:
            if out is not None:
                out.close()
                done.append((path, records, size))

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if out is None or size >= roll:
                        close()
                        path, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = files.open_output_stream(path, compression=None)
                    member, digest = _Member(out, level), hashlib.sha1()
                    member.add(_head(row, day))
                digest.update(row["data"])
                member.add(row["data"])
                if row["last"]:
                    if row["record_type"] != "revisit" and base64.b32encode(digest.digest()).decode() != row["payload_digest"]:
                        raise ValueError(f"payload of {row['page_id']} does not match its digest")
                    member.add(b"\r\n\r\n")
                    member.end()
                    records, size = records + 1, size + member.bytes
        close()
        names = ["path", "records", "bytes"]
        yield pa.RecordBatch.from_pydict({n: [d[i] for d in done] for i, n in enumerate(names)}, schema=_FILES)

    return stored(with_package(chunks).mapInArrow(write, "path string, records long, bytes long"), "warc-files")


_FILES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORD_TABLE = (
    "archive string, record_no long, chunk_no int, last boolean, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, bytes_so_far long, digest_so_far string, payload_digest string, data binary"
)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _inflated(stream, block: int) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether a gzip member ends there) of a file of members. A file that ends inside one is refused."""
    z, rest, inside = zlib.decompressobj(31), b"", False
    while True:
        raw = rest or stream.read(block)
        if not raw:
            if inside:
                raise ValueError("truncated archive")
            return
        inside = True
        out = z.decompress(raw, block)
        if z.eof:
            rest, z, inside = z.unused_data, zlib.decompressobj(31), False
            yield out, True
        else:
            rest = z.unconsumed_tail
            if out:
                yield out, False


def _records(stream, chunk: int) -> Iterator[tuple[dict, int, bool, bytes]]:
    """(headers, chunk number, whether it is the last, data) in file order; holds one chunk and one header at most."""
    held, meta, left, number = b"", None, 0, 0
    for data, ended in _inflated(stream, BLOCK):
        held += data
        if meta is None and (cut := held.find(b"\r\n\r\n")) >= 0 and (stop := held.find(b"\r\n\r\n", cut + 4)) >= 0:
            meta = _headers(held[:cut])
            http = held[cut + 4 : stop + 4]
            meta["http"] = _headers(http)
            left, number, held = int(meta["content-length"]) - len(http), 0, held[stop + 4 :]
            if left == 0:
                yield meta, 0, True, b""
        while meta is not None and left and len(held) >= min(chunk, left):
            part, held = held[: min(chunk, left)], held[min(chunk, left) :]
            left -= len(part)
            yield meta, number, left == 0, part
            number += 1
        if ended:
            if meta is None or left or held != b"\r\n\r\n":
                raise ValueError("broken record")
            held, meta = b"", None


def read_chunks(files: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table (RECORD_TABLE) of the archives in files: every chunk with the bytes and the digest so far.

    payload_bytes and payload_digest are set on last chunks: counted for responses, as announced for revisits, whose payload is
    elsewhere. with_data=False leaves out the data. Checks every announced digest and length, and that each file has as many records
    as the table says: a file that was cut, wherever, fails the task.
    """
    names = [f.strip().split()[0] for f in RECORD_TABLE.split(",")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        for path, told_records in (p for b in batches for p in zip(*[b.column(c).to_pylist() for c in ("path", "records")], strict=True)):
            rows, held, record, total, digest = [], 0, -1, 0, None
            with system.open_input_stream(path, compression=None) as stream:
                for meta, number, last, data in _records(stream, chunk):
                    if number == 0:
                        record, total, digest = record + 1, 0, hashlib.sha1()
                    digest.update(data)
                    total += len(data)
                    so_far = base64.b32encode(digest.digest()).decode()
                    again, told = meta["warc-type"] == "revisit", meta["warc-payload-digest"].removeprefix("sha1:")
                    size = int(meta["http"]["content-length"])
                    if last and not again and (so_far, total) != (told, size):
                        raise ValueError(f"record {record} of {path} is damaged")
                    rows.append(
                        (
                            path, record, number, last, json.loads(meta["x-page-id"]), meta["warc-target-uri"], meta["warc-type"],
                            json.loads(meta["x-refers-to-page"]) if again else None, size if last else None, total, so_far,
                            told if last else None, data if with_data else None,
                        )
                    )
                    held += len(data) if with_data else 0
                    if held >= 8 * chunk or len(rows) >= 5000:
                        yield _batch(names, rows)
                        rows, held = [], 0
            if record + 1 != told_records:
                raise ValueError(f"{path} has {record + 1} records of {told_records}")
            if rows:
                yield _batch(names, rows)

    tasks = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return with_package(files).select("path", "records").repartition(tasks, "path").mapInArrow(read, RECORD_TABLE)


_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in RECORD_TABLE.split(", ")])


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), schema=_SCHEMA)


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes one record per row of pages (page_id, url, html; a null html is empty) and returns the table of files and their folder."""
    folder = folder or run_folder(pages.sparkSession, "warc")
    records = with_columns_once(pages.select("page_id", "url", "html"), {"__payload": F.encode(whole_text("html"), "UTF-8")}).drop("html")
    records = with_columns_once(
        records, {"payload_digest": base32_sha1(F.col("__payload")), "payload_bytes": F.octet_length("__payload").cast("long")}
    )
    return write_archives(chunk_rows(record_kinds(records, min_bytes)), folder), folder
