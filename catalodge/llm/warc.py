"""Web archives: writing, normalising and reading WARC files.

Archives are written as one gzip stream each. The normaliser inflates such a stream once,
record by record, writes every record again as a gzip member of its own, and puts a
sidecar index of offsets beside the file, so that any record can be read alone.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, utf8
from catalodge.session import materialize

# Bytes of records in one archive, read at once from a stream, and of archives read back by one task.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
TASK_BYTES = 64 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
END = b"\r\n\r\n"
INDEX = "file string, offset long, length long, record_id string"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(identifier: str | None) -> int | None:
    number = (identifier or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "null") else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record in full. A revisit has the headers of the answer and names the record that holds the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # A line end inside an address would end the header.
    target = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    head += [f"WARC-Date: {DATE}"] + ([f"WARC-Target-URI: {target}"] if target else [])
    head += [f"WARC-Payload-Digest: sha1:{digest32(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def header(text: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = (line.partition(":") for line in text.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file, whether it is one member or many, in bounded parts."""
    engine, data = zlib.decompressobj(31), b""
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            if not engine.eof:
                raise ValueError("the gzip stream ends early")
            return
        if engine.eof:
            engine = zlib.decompressobj(31)
        part = engine.decompress(data, CHUNK)
        data = engine.unused_data if engine.eof else engine.unconsumed_tail
        if part:
            yield part


def records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, whole record) of a WARC stream; memory is bounded by the largest record."""
    held = bytearray()
    ended = False
    while True:
        at = held.find(END)
        need = None
        if at >= 0:
            fields = header(bytes(held[:at]))
            need = at + len(END) + int(fields["content-length"]) + len(END)
        if need is not None and len(held) >= need:
            yield fields, bytes(held[:need])
            del held[:need]
            continue
        if ended:
            if held:
                raise ValueError("the last record is cut off")
            return
        # Gather what is missing before looking again, so that a large record is scanned once.
        missing = max(1, (need or 0) - len(held))
        while missing > 0:
            part = next(parts, None)
            if part is None:
                ended = True
                break
            held += part
            missing -= len(part)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record for each row of `pages` (page_id, url, html); returns the archives: file, bytes.

    Of rows with equal payloads of `min_bytes` or more the smallest id is a response and
    the others revisit it; shorter payloads are all responses. The manifest names the
    files of tasks that ended well; what a lost executor has left is not in it.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", utf8("html").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    shared = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    shared = materialize(shared, "shared-payloads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, engine, held, done = None, None, 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.write(engine.flush())
                done.append((name, out.tell()))
                out.close()
                out = None

        for batch in batches:
            columns = (column(batch, c) for c in ("page_id", "url", "payload", "first", "small"))
            for page_id, url, payload, first, small in zip(*columns, strict=True):
                if out is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done)}.warc.gz"
                    out, engine, held = system.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, wbits=31), 0
                revisit = first is not None and first != page_id and not small
                whole = record(page_id, url, payload, first, revisit)
                out.write(engine.compress(whole))
                held += len(whole)
                if held >= ARCHIVE_BYTES:
                    close()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n, _ in done]), pa.array([b for _, b in done])], ["file", "bytes"])

    # Payloads that occur twice are few or many; Spark broadcasts them only where they are small.
    joined = rows.join(shared, "digest", "left").withColumn("small", F.octet_length("payload") < min_bytes)
    return materialize(joined.select("page_id", "url", "payload", "first", "small").mapInArrow(run, "file string, bytes long"), "archives")


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite archives with a gzip member for each record and a sidecar index; returns the index (INDEX).

    For a.warc.gz the results are a-<attempt>.members.warc.gz and, beside it, the same name
    with .idx: lines of offset, length and record id. Each archive is inflated once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name in column(batch, "file"):
                system, path = fs.FileSystem.from_uri(name)
                target = f"{name.removesuffix('.warc.gz')}-{attempt}.members.warc.gz"
                _, to = fs.FileSystem.from_uri(target)
                rows, offset = [], 0
                with system.open_input_stream(path, compression=None) as source, system.open_output_stream(to, compression=None) as out:
                    for fields, whole in records(inflated(source)):
                        member = gzip.compress(whole, LEVEL, mtime=0)
                        out.write(member)
                        rows.append((target, offset, len(member), fields["warc-record-id"]))
                        offset += len(member)
                with system.open_output_stream(f"{to}.idx", compression=None) as out:
                    out.write("".join(f"{o}\t{n}\t{r}\n" for _, o, n, r in rows).encode())
                if rows:
                    kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
                    arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in INDEX.split(", ")])

    files = archives.count()
    return materialize(archives.repartition(max(1, min(files, 10_000)), "file").mapInArrow(run, INDEX), "archive-index")


def read_archives(index: DataFrame) -> DataFrame:
    """One row for each record, read by its offset: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The payload of a response is held against the length and digest in its header; a
    revisit's are those of the payload it refers to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            rows = []
            for name, offset, length in zip(*(column(batch, c) for c in ("file", "offset", "length")), strict=True):
                if name != opened:
                    if source is not None:
                        source.close()
                    system, path = fs.FileSystem.from_uri(name)
                    opened, source = name, system.open_input_file(path)
                source.seek(offset)
                whole = gzip.decompress(source.read(length))
                head, _, block = whole.partition(END)
                fields = header(head)
                block = block[: int(fields["content-length"])]
                digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                if fields["warc-type"] == "response":
                    payload = block.partition(END)[2]
                    if len(payload) != size or digest32(payload) != digest:
                        raise ValueError(f"{fields['warc-record-id']} in {name} is damaged")
                rows.append((page_of(fields["warc-record-id"]), size, digest, fields["warc-type"], page_of(fields.get("warc-refers-to"))))
            if rows:
                kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()
                arrays = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if source is not None:
            source.close()

    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(2 * index.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES + 1)
    placed = index.select("file", "offset", "length").repartition(tasks, "file", (F.col("offset") / (TASK_BYTES // 16)).cast("long"))
    return placed.sortWithinPartitions("file", "offset").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archive_round_trip(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write `pages` to archives in `folder`, normalise them, and read every record back.

    Null html counts as an empty payload; empty payloads are equal like any others. Rows
    that repeat id and payload are records with the same id, all responses or all
    revisits. A null id ranks above all others. An empty table writes nothing.
    """
    return read_archives(normalise(write_archives(pages, folder, min_bytes)))
