"""Token-id files in patched frame-of-reference blocks.

Ids are cut into blocks of 128. A block keeps its minimum; the differences are packed with the
width that PERCENTILE of them need, and the rest are exceptions: their place and the bits above
the width. A file is

    magic | blocks ... | block index | documents | footer

The block index has the byte offset of every block, so a reader can begin anywhere. Documents
are the ids and token counts of the file's documents. The footer has the counts and offsets.
A block is: minimum u32, values u8, width u8, exceptions u8, packed bits of 128 values (the last
block is filled up), exception places u8, exception bits u32.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import frugal, open_input, open_output, one_task_each, settle, shared_dir, slices
from voxloom.llm.tokens import tokenizer_text, worker_encoder

BLOCK = 128
PERCENTILE = 0.9
MAGIC = b"TOKPFOR1"
HEAD = struct.Struct("<IBBB")  # minimum, values, width, exceptions
FOOTER = struct.Struct("<QQQQQ8s")  # values, blocks, index offset, documents, documents offset
END_ID = 2
GROUP = 2048  # blocks that are coded together
NULL_ID = -(1 << 63)  # stands for a null document id

INDEX = "doc_id bigint, file string, file_no int, nth bigint, first bigint, n_tokens bigint"
READ = "doc_id bigint, file_no int, nth bigint, first bigint, n_tokens bigint, ids_crc32 bigint"


def encode_blocks(values: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids; only the last may be short."""
    n = len(values)
    count = -(-n // BLOCK)
    if not count:
        return []
    padded = np.empty(count * BLOCK, np.uint32)
    padded[:n] = values
    padded[n:] = values[-1]
    rows = padded.reshape(count, BLOCK)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = int(PERCENTILE * BLOCK) - 1
    widths = _bits(np.partition(rest, at, axis=1)[:, at])
    made: list[bytes] = [b""] * count
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        part = rest[own]
        high = part >> np.uint32(width) if width < 32 else np.zeros_like(part)
        packed = _pack(part, int(width))
        odd_row, odd_at = np.nonzero(high)
        bounds = np.searchsorted(odd_row, np.arange(len(own) + 1))
        places, bits = odd_at.astype(np.uint8), high[odd_row, odd_at].astype("<u4")
        for k, block in enumerate(own.tolist()):
            a, b = bounds[k], bounds[k + 1]
            size = BLOCK if block < count - 1 or n % BLOCK == 0 else n % BLOCK
            made[block] = (
                HEAD.pack(int(least[block]), size, int(width), int(b - a))
                + packed[k].tobytes() + places[a:b].tobytes() + bits[a:b].tobytes()
            )
    return made


def _bits(values: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _bytes_for(width: int) -> int:
    """Bytes of the smallest unsigned type that holds so many bits."""
    return 1 if width <= 8 else 2 if width <= 16 else 4


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """The lowest bits of each value, packed; BLOCK * width / 8 bytes for each row."""
    if width == 0:
        return np.zeros((len(rows), 0), np.uint8)
    size = _bytes_for(width)
    low = rows.astype(f"<u{size}").view(np.uint8).reshape(len(rows), BLOCK, size)
    bits = np.unpackbits(low, axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    rows = len(packed)
    if width == 0:
        return np.zeros((rows, BLOCK), np.uint32)
    size = _bytes_for(width)
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(rows, BLOCK, width)
    if width < 8 * size:
        full = np.zeros((rows, BLOCK, 8 * size), np.uint8)
        full[:, :, :width] = bits
        bits = full
    return np.packbits(bits, axis=2, bitorder="little").view(f"<u{size}").reshape(rows, BLOCK)


def _gathered(body: np.ndarray, places: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian values that begin at these places."""
    size = np.dtype(kind).itemsize
    return body[places[:, None] + np.arange(size)].view(kind).reshape(-1)


def decode_blocks(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks that begin at these places of data."""
    body = np.frombuffer(data, np.uint8)
    least = _gathered(body, offsets, "<u4")
    sizes, widths, odds = (body[offsets + 4 + i].astype(np.int64) for i in range(3))
    rows = np.empty((len(offsets), BLOCK), np.uint32)
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        size = BLOCK * int(width) // 8
        begin = offsets[own] + HEAD.size
        packed = body[begin[:, None] + np.arange(size)] if size else np.zeros((len(own), 0), np.uint8)
        rows[own] = _unpack(packed, int(width))
    # The exceptions of all blocks at once: which block, and which one in it.
    block = np.repeat(np.arange(len(offsets)), odds)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(odds) - odds, odds)
        begin = (offsets + HEAD.size + BLOCK * widths // 8)[block]
        bits = _gathered(body, begin + odds[block] + 4 * nth, "<u4")
        rows[block, body[begin + nth]] |= bits << widths[block].astype(np.uint32)
    rows += least[:, None]
    flat = rows.reshape(-1)
    return flat if sizes[-1] == BLOCK else flat[: len(flat) - BLOCK + int(sizes[-1])]


class Writer:
    """Writes one file; memory is bounded by a group of blocks and 16 bytes a document."""

    def __init__(self, uri: str):
        self.uri, self.out = uri, open_output(uri)
        self.at, self.values = 0, 0
        self.offsets, self.docs, self.held, self.held_bytes = [], [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes):
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> tuple[int, int]:
        """Append a document's ids; gives the place of its first id and their number."""
        first, n = self.values, len(ids) // 4
        self.docs.append((NULL_ID if doc_id is None else doc_id, n))
        self.values += n
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= 4 * BLOCK * GROUP:
            self._flush(final=False)
        return first, n

    def _flush(self, final: bool):
        data = b"".join(self.held)
        whole = len(data) if final else len(data) // (4 * BLOCK) * (4 * BLOCK)
        values = np.frombuffer(data, "<u4", whole // 4)
        for s in range(0, len(values), BLOCK * GROUP):
            for block in encode_blocks(values[s : s + BLOCK * GROUP]):
                self.offsets.append(self.at)
                self._put(block)
        self.held, self.held_bytes = [data[whole:]], len(data) - whole

    def close(self):
        self._flush(final=True)
        index_at = self.at
        self._put(np.array(self.offsets, "<u8").tobytes())
        docs_at = self.at
        self._put(np.array(self.docs, "<i8").tobytes())
        self._put(FOOTER.pack(self.values, len(self.offsets), index_at, len(self.docs), docs_at, MAGIC))
        self.out.close()


class Reader:
    """Reads one file; the index and the documents' table are in memory, ids are streamed."""

    def __init__(self, uri: str):
        self.file = open_input(uri)
        size = self.file.size()
        self.file.seek(size - FOOTER.size)
        self.values, blocks, self.index_at, docs, docs_at, magic = FOOTER.unpack(self.file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.file.seek(self.index_at)
        self.offsets = np.frombuffer(self.file.read(8 * blocks), "<u8").astype(np.int64)
        self.file.seek(docs_at)
        self.docs = np.frombuffer(self.file.read(16 * docs), "<i8").reshape(-1, 2)

    def ids(self, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
        """The ids from one place up to another, in pieces; begins at the block that holds it."""
        last = self.values if last is None else last
        for b in range(first // BLOCK, -(-last // BLOCK), GROUP):
            e = min(b + GROUP, -(-last // BLOCK))
            start = int(self.offsets[b])
            end = int(self.offsets[e]) if e < len(self.offsets) else self.index_at
            self.file.seek(start)
            values = decode_blocks(self.file.read(end - start), self.offsets[b:e] - start)
            low = b * BLOCK
            yield values[max(0, first - low) : last - low]

    def documents(self) -> Iterator[tuple]:
        """nth, document id, first, tokens, crc32 of the ids as little-endian unsigned 32 bits."""
        pieces, held = self.ids(), np.zeros(0, np.uint32)
        first = 0
        for nth, (doc_id, n) in enumerate(self.docs.tolist()):
            left, crc = n, 0
            while left:
                if not len(held):
                    held = next(pieces)
                take = held[:left]
                crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                left -= len(take)
                held = held[len(take) :]
            yield nth, None if doc_id == NULL_ID else doc_id, first, n, crc
            first += n


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Encode every whole text, append end_id and write token files; returns the index (INDEX).

    Files are in ascending order of the key (file_no), and so are documents in a file (nth);
    first is the place of a document's first id in its file. Null keys come first; rows that
    repeat a key are separate documents, in the order of their text's hash. Null texts are
    empty: they have the end id only. An empty table writes no file. Other columns are left out.

    One range exchange by key; each task encodes and writes its rows as they stream by. Names
    are new for each attempt, and only the files in the written index count.
    """
    data = tokenizer_text(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, nth = None, None, 0
        number = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, 4 << 20):
                if writer is None:
                    encoder = worker_encoder(data)
                    writer = Writer(f"{folder}/tokens-{number:06d}-{uuid4()}.pfor")
                ids = part.column(0).to_pylist()
                coded = encoder.encode_all(part.column(1).to_pylist())
                places = [writer.add(i, c + end) for i, c in zip(ids, coded, strict=True)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array([writer.uri] * n), pa.array([number] * n, pa.int32()),
                        pa.array(range(nth, nth + n), pa.int64()), pa.array([p[0] for p in places], pa.int64()),
                        pa.array([p[1] for p in places], pa.int64()),
                    ],
                    [c.split()[0] for c in INDEX.split(", ")],
                )
                nth += n
        if writer:
            writer.close()

    return settle(ordered.mapInArrow(frugal(run), INDEX))


def read_token_files(index: DataFrame) -> DataFrame:
    """The documents of the files that the index names, from the files alone: READ and start.

    start is the number of ids of all documents before it. One row for each file goes through
    the window that sums up the files.
    """
    files = one_task_each(index.select("file", "file_no").distinct(), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in READ.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for uri, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(d, number, nth, first, n, crc) for nth, d, first, n, crc in Reader(uri).documents()]
                for s in range(0, len(rows), 10_000):
                    columns = zip(*rows[s : s + 10_000], strict=True)
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    read = settle(files.mapInArrow(frugal(run), READ))
    totals = read.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    begin = totals.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return read.join(begin, "file_no").withColumn("start", F.col("begin") + F.col("first")).drop("begin")


def token_folder(spark) -> str:
    return f"{shared_dir(spark)}/tokens-{uuid4()}"
