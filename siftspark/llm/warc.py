"""WARC records in ZIP packages: written by tasks, found by index, read back by range.

A package holds `archive/data.warc.gz`, a stored member with one gzip member per record,
and `indexes/index.cdxj`, a stored member with a line per record. Tasks write a package through
pyarrow's file systems below a folder all executors share, under a name no other attempt uses; only the
packages a finished task reports are read, so lost executors leave at most files nobody lists.
Readers parse the central directory, locate every stored member `archive/*.warc.gz` or `archive/*.warc`
and the indexes `indexes/*.cdxj` or `indexes/*.cdx.gz`, and spread the records' ranges over tasks. An index line
names its archive by `filename`; one without a name stands for the package's only archive, and archives that no
index names are walked. A package is closed at a size limit, which bounds its index; nothing is extracted.
Packages may lie wherever the tasks' file systems reach (`s3a`, `hdfs`, `abfss`, `gs`, plain paths).

Of records with equal payloads of at least `min_bytes`, the one with the smallest page_id is the
response and the others revisit it. Defined results: a NULL payload is empty; smaller payloads are
all responses; rows that share the smallest id are all responses; a NULL id sorts after any
other and revisits the smallest; an empty table gives no packages and no rows; a package without an archive,
a compressed archive and an index that names an archive which is not there are errors. Records of
other types and writers come out as they are: without an id, payloads of HTTP records below their
HTTP head, digests computed if their own is no SHA-256.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm import zipfiles
from siftspark.llm.common import open_store, staged
from siftspark.operators.scope import broadcast_if_small
from siftspark.session import work_path

DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVES, INDEXES = re.compile(r"archive/.+\.warc(\.gz)?"), re.compile(r"indexes/.+\.cdxj?(\.gz)?")
GZIP = b"\x1f\x8b"
HEAD_BYTES = 1 << 16  # read at first of a record that is not compressed
# Fixed value: the profile of a revisit by equal payload, as WARC 1.1 names it.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_ROWS = 2000


def with_record_types(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to.

    Only digests found more than once take part in the join, so the other side of it is the
    list of copied payloads, not of pages. Each digest is counted map-side first.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    copied = (
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
        .drop("_n")
    )
    copied = broadcast_if_small(staged(copied, "copied"))
    later = F.col("_first").isNotNull() & ~F.coalesce(
        F.col("page_id") <= F.col("_first"), F.lit(False)
    )
    return (
        rows.join(copied, F.col("payload_digest") == F.col("_digest"), "left")
        .withColumn("record_type", F.when(later, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(later, F.col("_first")))
        .drop("_digest", "_first")
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def render_record(row: dict, date: str) -> bytes:
    """One WARC record; header values can't break out of their line."""
    payload = (row["html"] or "").encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_record_id(row['page_id'])}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    if row["record_type"] == "revisit":
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(row['refers_to'])}",
            f"X-Refers-To-Page: {row['refers_to']}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_packages(
    records: DataFrame,
    folder: str,
    max_bytes: int = 256 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """path, records, bytes of the packages the tasks wrote, one after another per partition."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        done, package = [], None

        def close() -> None:
            name, stream, out, index = package
            out.end()
            out.begin(INDEX_MEMBER)
            out.write("".join(index).encode())
            out.end()
            out.close()
            stream.close()
            done.append({"path": f"{folder}/{name}", "records": len(index), "bytes": out.at})

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.zip"
                    stream = store.open_output_stream(f"{root}/{name}")
                    package = (name, stream, zipfiles.Writer(stream), [])
                    package[2].begin(DATA_MEMBER)
                _, _, out, index = package
                data = _gzip(render_record(row, date))
                place = {"offset": out.write(data), "length": len(data), "type": row["record_type"]}
                index.append(f"{row['page_id']} {json.dumps(place)}\n")
                if out.at >= max_bytes:
                    close()
                    package = None
        if package is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done)

    return records.mapInArrow(write, "path string, records long, bytes long")


def _open(path: str):
    store, name = open_store(path)
    file = store.open_input_file(name)
    return file, file.size()


def _packed(file, start: int, length: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member of an archive."""
    at = 0
    while at < length:
        unpacker, read = zlib.decompressobj(31), 0
        while not unpacker.eof:
            step = min(1 << 20, length - at - read)
            if not step:
                raise ValueError("the archive member ends inside a record")
            unpacker.decompress(zipfiles.read_range(file, start + at + read, step))
            read += step
        size = read - len(unpacker.unused_data)
        yield at, size
        at += size


def _plain(file, start: int, length: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each record of an archive that is not compressed, by its heads."""
    at = 0
    while at < length:
        head, step = b"", HEAD_BYTES
        while b"\r\n\r\n" not in head:
            if len(head) == length - at:
                raise ValueError("the archive member ends inside a record")
            head = zipfiles.read_range(file, start + at, min(step, length - at))
            step *= 2
        head = head.partition(b"\r\n\r\n")[0]
        block = re.search(rb"(?i)\r\nContent-Length:\s*(\d+)", head)
        if block is None:
            raise ValueError(f"the record at {at} does not say how long it is")
        size = len(head) + 4 + int(block[1]) + 4  # a blank line above the block, and two line ends below
        if at + size > length:
            raise ValueError("the archive member ends inside a record")
        yield at, size
        at += size


def _index_lines(file, member: zipfiles.Member) -> list[dict]:
    data = zipfiles.read_range(file, zipfiles.data_offset(file, member), member.size)
    if data.startswith(GZIP):
        data = gzip.decompress(data)
    lines = (line for line in data.decode().splitlines() if "{" in line)
    return [json.loads(line[line.index("{") :]) for line in lines if not line.startswith("!")]


def package_ranges(file, size: int) -> Iterator[tuple[int, int]]:
    """Offset in the package and length of each record of all its archives."""
    found = list(zipfiles.members(file, size))
    archives = {m.name: m for m in found if ARCHIVES.fullmatch(m.name)}
    if not archives:
        raise ValueError("the package has no archive")
    starts = {name: zipfiles.data_offset(file, m) for name, m in archives.items()}
    named = set()
    for member in found:
        if not INDEXES.fullmatch(member.name):
            continue
        for line in _index_lines(file, member):
            if "filename" in line:
                name = "archive/" + line["filename"].removeprefix("archive/")
            elif len(archives) == 1:
                name = next(iter(archives))
            else:
                raise ValueError(f"{member.name} does not say which of {len(archives)} archives it is of")
            if name not in archives:
                raise ValueError(f"{member.name} names {name}, which is not in the package")
            named.add(name)
            yield starts[name] + int(line["offset"]), int(line["length"])
    for name in sorted(archives.keys() - named):
        walk = _packed if name.endswith(".gz") else _plain
        for at, length in walk(file, starts[name], archives[name].size):
            yield starts[name] + at, length


def record_ranges(packages: DataFrame) -> DataFrame:
    """path, offset, length of every record: from the packages' indexes, else by a walk."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                file, size = _open(path)
                with file:
                    try:
                        spots = list(package_ranges(file, size))
                    except ValueError as error:
                        raise ValueError(f"{path}: {error}") from error
                for i in range(0, len(spots), BATCH_ROWS):
                    part = spots[i : i + BATCH_ROWS]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": [path] * len(part),
                            "offset": [offset for offset, _ in part],
                            "length": [length for _, length in part],
                        }
                    )

    return packages.select("path").mapInArrow(ranges, "path string, offset long, length long")


def parse_record(data: bytes) -> dict:
    """Header fields, payload and stated payload length of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a WARC record is expected")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    payload = rest[: int(fields["content-length"])]
    length = None
    if "application/http" in fields.get("content-type", ""):
        http, _, payload = payload.partition(b"\r\n\r\n")
        # A revisit's HTTP head speaks of the payload that stands elsewhere.
        stated = re.search(rb"(?i)\r\nContent-Length:\s*(\d+)", http)
        if stated and fields.get("warc-type") == "revisit":
            length = int(stated[1])
    return {"fields": fields, "payload": payload, "payload_bytes": len(payload) if length is None else length}


RECORD_SCHEMA = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read_records(ranges: DataFrame, tasks: int, payloads: bool = True) -> DataFrame:
    """The records at the given ranges; revisits have no payload of their own.

    A response's digest is computed from what was read and must equal its header's. The number of
    tasks is stated: a range is a few bytes to Spark, whatever the record it stands for.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("payload", pa.binary()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
            ]
        )
        held, file = None, None
        for batch in batches:
            rows, size = [], 0
            for place in batch.to_pylist():
                if place["path"] != held:
                    if file is not None:
                        file.close()
                    file, _ = _open(place["path"])
                    held = place["path"]
                raw = zipfiles.read_range(file, place["offset"], place["length"])
                record = parse_record(zlib.decompress(raw, 31) if raw.startswith(GZIP) else raw)
                fields, payload = record["fields"], record["payload"]
                kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
                stated = digest.removeprefix("sha256:") if digest.startswith("sha256:") else None
                digest = stated
                if kind != "revisit":
                    digest = hashlib.sha256(payload).hexdigest()
                    if kind == "response" and stated not in (None, digest):
                        raise ValueError(f"payload of {fields.get('warc-record-id')} is damaged")
                page, other = fields.get("x-page-id"), fields.get("x-refers-to-page")
                rows.append(
                    {
                        "page_id": None if page is None else int(page),
                        "url": fields.get("warc-target-uri"),
                        "payload": payload if payloads else None,
                        "payload_bytes": record["payload_bytes"],
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": None if other is None else int(other),
                    }
                )
                size += len(payload) if payloads else 0
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)
        if file is not None:
            file.close()

    spread = ranges.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset")
    return spread.mapInArrow(read, RECORD_SCHEMA)


def archive(
    pages: DataFrame, min_bytes: int = 100, payloads: bool = True, task_bytes: int = 4 << 20
) -> DataFrame:
    """Write every page as a record of a package, and read all records back.

    A reading task gets about `task_bytes` of packed records.
    """
    spark = pages.sparkSession
    folder = work_path(spark, "packages")
    packages = staged(write_packages(with_record_types(pages, min_bytes), folder), "written")
    packed = packages.agg(F.sum("bytes")).first()[0] or 0
    return read_records(record_ranges(packages), packed // task_bytes + 1, payloads)
