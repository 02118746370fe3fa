"""WARC archives of web pages, compressed with a dictionary of their own.

Every archive is a ``.warc.zst`` file: a skippable frame that holds a
Zstandard dictionary trained on a sample of the archive's own records, then
one Zstandard frame for each record. A page is a ``response`` record; of pages
with equal payloads of at least ``REVISIT_BYTES`` the one with the smallest
id is, and the others are ``revisit`` records without a payload that refer to
it. An archive ends at about ``ROLL_BYTES`` of records, so a task holds no
more than that.

Tasks write archives into the shared folder under names of their own and
return them; the list of archives is committed by Spark, so what a lost task
left behind is never read. Reading goes by that list, several archives a task.
Folders are opened through ``pyarrow.fs`` (local and mounted paths, S3, GCS,
HDFS with libhdfs).

Defined cases: null html is an empty payload; a null url is replaced by the
record's own id; control characters and spaces in a url are percent-encoded;
rows that repeat the smallest id of their group are responses too; a null
page_id never is a group's smallest, unless all are null, and then all are
responses; a sample too small to train on gives an archive without a
dictionary; an empty table gives no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, shuffle_width, skew_lookup
from tessera.session import scratch_path

REVISIT_BYTES = 100
ROLL_BYTES = 32 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:x-page:"


def _urn(page_id: str | None) -> str:
    return f"<{URN}{quote(page_id, safe='') if page_id is not None else ''}>"


def _page_id(urn: str | None) -> str | None:
    return unquote(urn[len(URN) + 1 : -1]) or None if urn else None


def make_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP headers only."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else _urn(page_id)[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES):
    """A dictionary from records spread evenly over the archive, or None."""
    import zstandard

    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        return zstandard.train_dictionary(size, [r[: 128 << 10] for r in records[::step]])
    except zstandard.ZstdError:  # too little to learn from
        return None


def write_archive(out: io.RawIOBase, records: list[bytes]) -> None:
    import zstandard

    dictionary = train_dictionary(records)
    if dictionary is not None:
        data = dictionary.as_bytes()
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    else:
        pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    for r in records:
        out.write(pack.compress(r))


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC header fields, block) of every record, one at a time."""
    import zstandard

    head = source.read(8)
    if len(head) < 8:
        return
    magic, size = struct.unpack("<II", head)
    if magic == DICTIONARY_MAGIC:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(size)))
    else:
        unpack = zstandard.ZstdDecompressor()
        source.seek(0)
    with unpack.stream_reader(source, read_across_frames=True) as stream:
        lines = io.BufferedReader(stream, 1 << 18)
        while version := lines.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            fields = {}
            while (line := lines.readline().rstrip(b"\r\n")) != b"":
                k, _, v = line.partition(b": ")
                fields[k.decode().lower()] = v.decode()
            block = lines.read(int(fields["content-length"]))
            if lines.read(4) != b"\r\n\r\n":
                raise ValueError("a WARC record does not end where it should")
            yield fields, block


def _open(uri: str):
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to and revisit of every page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long = F.octet_length("payload") >= revisit_bytes
    equal = rows.filter(long).groupBy("digest")
    equal = equal.agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1 and first is not null")
    found = skew_lookup(rows.filter(long), materialize(equal, "equal-payloads"), ["digest"], "n", ["first"])
    # Short payloads repeat without end and look nothing up: they stay where they are.
    rows = found.unionByName(rows.filter(~long), allowMissingColumns=True)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write planned records as archives into ``folder``; returns the
    committed list (file, records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                write_archive(out, held)
            return pa.RecordBatch.from_pydict({"file": [name], "records": [len(held)], "bytes": [size]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(make_record(*row))
                size += len(held[-1])
                if size >= roll_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    text = lambda c: F.col(c).cast("string").alias(c)
    planned = records.select(text("page_id"), "url", "payload", "digest", text("refers_to"), "revisit")
    return materialize(planned.mapInArrow(run, "file string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the listed archives: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, with ``with_payload``, the payload
    (null for revisits). A payload that does not have its digest is an error."""
    schema = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    schema += ", payload binary" if with_payload else ""

    def rows(stream) -> Iterator[tuple]:
        for fields, block in read_archive(stream):
            http, _, payload = block.partition(b"\r\n\r\n")
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            size = int(re.search(rb"(?mi)^Content-Length: (\d+)", http)[1])
            kind = fields["warc-type"]
            if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"damaged payload of {fields['warc-record-id']}")
            yield (
                _page_id(fields["warc-record-id"]), fields["warc-target-uri"], kind, _page_id(fields.get("warc-refers-to")),
                size, digest, payload if kind == "response" else None,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        names = schema.replace(",", "").split()[::2]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{name}") as source:
                    held = list(rows(source))
                for at in range(0, len(held), 1000):
                    columns = list(zip(*held[at : at + 1000], strict=True))[: len(names)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    tasks = max(1, min(archives.count(), 4 * shuffle_width(archives.sparkSession)))
    return archives.select("file").repartition(tasks).mapInArrow(run, schema)


def archive_pages(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    back = read_archives(write_archives(plan_records(pages), folder), folder, with_payload)
    kind = pages.schema["page_id"].dataType
    typed: list[Column] = [F.col(c).cast(kind).alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in back.columns]
    return back.select(*typed)
