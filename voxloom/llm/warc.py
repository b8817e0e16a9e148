"""WARC archives with records compressed one by one against a shared Zstandard dictionary.

An archive is a valid .warc.zst file: a skippable frame (magic 0x184D2A5D) with the dictionary,
then one Zstandard frame for each record. The dictionary is trained on a bounded sample of the
records. Of records with equal payloads one is a response, the others are revisits of it.

Each task writes archives of its own under new names, and returns an index row for each
record; the index table is the commit. Files of an attempt that failed are in no index.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import one_task_each, open_input, open_output, settle, shared_dir, slices

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
RESPONSE_TYPE, REVISIT_TYPE, INFO_TYPE = "response", "revisit", "warcinfo"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "1970-01-01T00:00:00Z"  # of records whose caller names none
MIN_REVISIT_BYTES = 1000
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 2000, 8 << 10  # of the dictionary's sample; 32 MB at most
ARCHIVE_BYTES = 256 << 20  # a task begins a new archive above this
READ_BYTES = 1 << 20
LEVEL = 3

INDEX = "page_id bigint, file string, offset bigint, length bigint"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def train_dictionary(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> bytes:
    """A dictionary from about SAMPLE_RECORDS records, picked by a hash, SAMPLE_BYTES of each.

    The hash picks a share of the rows, so only the sample travels. Too few or too small
    records give their bytes as a raw dictionary."""
    share = min(1.0, SAMPLE_RECORDS / max(1, pages.count()))
    picked = F.pmod(F.xxhash64(F.col(page_id), F.crc32(html)), F.lit(1 << 40)) < int(share * (1 << 40))
    head = F.substring(F.encode(F.coalesce(html, F.lit("")), "UTF-8"), 1, SAMPLE_BYTES)
    sample = [
        bytes(r["head"])
        for r in pages.filter(picked).select(head.alias("head")).limit(2 * SAMPLE_RECORDS).collect()
    ]
    sample = [s for s in sample if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode()


def make_info(date: str) -> bytes:
    """The record that an archive begins with."""
    body = b"format: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", INFO_TYPE),
        ("WARC-Record-ID", f"<{uuid4().urn}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(body)),
    ]
    return _header(fields) + body + b"\r\n\r\n"


def make_record(page_id, url, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; a revisit has no body."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", REVISIT_TYPE if revisit else RESPONSE_TYPE),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", len(payload)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", len(body)),
    ]
    return _header(fields) + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """page_id, url, type, refers_to, payload bytes, digest, payload (null for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    number = lambda v: None if v in (None, "<urn:page:none>") else int(v[10:-1])
    revisit = fields["WARC-Type"] == REVISIT_TYPE
    body = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    return (
        number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
        number(fields.get("WARC-Refers-To")), int(fields["WARC-Payload-Length"]), digest,
        None if revisit else body,
    )


def revisits(pages: DataFrame, page_id: str, html: str, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """_page, _digest, _refers_to of the rows that revisit another: small rows only.

    Groups of one are dropped after an aggregate that is combined before the shuffle; the
    written rest meets the pages in a join that can be split where a payload is very frequent.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    small = pages.select(
        F.col(page_id).cast("bigint").alias("_page"), F.sha1(body).alias("_digest"), F.octet_length(body).alias("_n")
    ).filter(F.col("_n") >= least)
    groups = small.groupBy("_digest").agg(F.max("_page").alias("_refers_to"), F.min("_page").alias("_low"))
    groups = settle(groups.filter(F.col("_low") < F.col("_refers_to")).drop("_low"))
    joined = small.join(groups, "_digest").filter(F.col("_page") < F.col("_refers_to"))
    return settle(joined.select("_page", "_digest", "_refers_to").distinct())


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE
) -> DataFrame:
    """Write a record for each row of pages; returns the written index (INDEX), a row each.

    date (UTC, as 2024-01-31T00:00:00Z) is that of all records, since pages have none of their
    own; a fixed one, so that records do not differ between runs.

    Null html is an empty payload, null urls have no target. Of rows with equal payloads of
    at least 1000 bytes, those with the largest id are responses and the others revisits; rows
    with a null id are responses. An empty table writes no archive. Other columns are left out.
    """
    dictionary = train_dictionary(pages, page_id, html)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        body.alias("html"), F.sha1(body).alias("digest"),
    )
    known = revisits(pages, page_id, html)
    rows = rows.join(
        known, (rows["page_id"] == known["_page"]) & (rows["digest"] == known["_digest"]), "left"
    ).select("page_id", "url", "html", "digest", F.col("_refers_to").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for part in slices(batch, 4 << 20):
                made = []
                for row in part.to_pylist():
                    if archive is None or archive.at >= ARCHIVE_BYTES:
                        if archive:
                            archive.close()
                        archive = _Archive(f"{folder}/pages-{uuid4()}.warc.zst", dictionary, date)
                    record = make_record(
                        row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"], date
                    )
                    made.append((row["page_id"], archive.uri, *archive.add(record)))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("page_id", "file", "offset", "length"), m, strict=True)) for m in made],
                    schema=pa.schema(
                        [("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
                    ),
                )
        if archive:
            archive.close()

    return settle(rows.mapInArrow(run, INDEX))


class _Archive:
    def __init__(self, uri: str, dictionary: bytes, date: str):
        self.uri, self.at, self.out = uri, 0, open_output(uri)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        self.add(make_info(date))

    def _put(self, data: bytes) -> tuple[int, int]:
        start = self.at
        self.out.write(data)
        self.at += len(data)
        return start, len(data)

    def add(self, record: bytes) -> tuple[int, int]:
        return self._put(self.compressor.compress(record))

    def close(self):
        self.out.close()


def read_frames(uri: str) -> Iterator[bytes]:
    """The records of an archive, one after the other; one record is held at a time."""
    with open_input(uri) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError(f"{uri} does not begin with a dictionary frame")
        known = _dictionary(file.read(size))
        decompressor = zstandard.ZstdDecompressor(dict_data=known)
        data = b""
        frame, parts = decompressor.decompressobj(), []
        while data or (data := file.read(READ_BYTES)):
            parts.append(frame.decompress(data))
            data = b""
            if frame.eof:
                yield b"".join(parts)
                data = frame.unused_data
                frame, parts = decompressor.decompressobj(), []
        if any(parts):
            raise ValueError(f"{uri} ends inside a record")


def read_record(uri: str, offset: int, length: int) -> tuple:
    """One record by its index row; reads the dictionary and that record only."""
    with open_input(uri) as file:
        _, size = struct.unpack("<II", file.read(8))
        known = _dictionary(file.read(size))
        file.seek(offset)
        return parse_record(zstandard.ZstdDecompressor(dict_data=known).decompress(file.read(length)))


def read_archives(files: DataFrame, file: str = "file") -> DataFrame:
    """All records (RECORD) of the archives that the frame names, each archive once."""
    named = one_task_each(files.select(file).distinct(), file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for data in read_frames(uri):
                    if f"\r\nWARC-Type: {INFO_TYPE}\r\n".encode() in data[:64]:
                        continue
                    held.append(parse_record(data))
                    size += len(data)
                    if size >= 4 << 20:
                        yield _batch(held, schema)
                        held, size = [], 0
                if held:
                    yield _batch(held, schema)

    return named.mapInArrow(run, RECORD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def archive_folder(spark) -> str:
    return f"{shared_dir(spark)}/warc-{uuid4()}"
