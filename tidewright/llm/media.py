"""Content-addressed media in tar shards, with metadata from range reads of headers.

``store_media`` writes each task's payloads as 8-bit grey PNG files into tar shards of at most ``SHARD_BYTES``, in the
shared folder. A row carries the digest of its file, the shard, and the offset and length of the file in it. Within a shard
equal payloads are stored once. ``read_headers`` reads only the first 33 bytes of each file for the metadata columns;
``read_features`` reads the files themselves. A shard's name is new for each attempt of a task and its rows are written
as a table afterwards, so a lost executor leaves at most shards that no row names.

Null text counts as empty and has a payload of one line of padding. Ids pass through. Repeated rows share a file. A very long text is one payload in
memory. An empty table gives an empty one. Only the id and text columns are read, so extra columns may have any name; an id column called like a
column of the index or of what is read raises an error.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.arrow_batches import split_batch
from tidewright.llm.workspace import Workspace

WIDTH = 576
SHARD_BYTES = 1 << 30
#: Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33
FEATURE_CELLS = 24


def pad(data: bytes, width: int = WIDTH) -> bytes:
    """Bytes 255 up to a positive multiple of ``width``."""
    return data + b"\xff" * (max(1, -(-len(data) // width)) * width - len(data))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, width: int = WIDTH) -> bytes:
    """One byte of the payload is one grey sample; lines are stored unfiltered."""
    lines = np.frombuffer(payload, np.uint8).reshape(-1, width)
    raw = np.concatenate([np.zeros((len(lines), 1), np.uint8), lines], axis=1).tobytes()
    header = struct.pack(">IIBBBBB", width, len(lines), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bits per sample and colour type from the first ``HEADER_BYTES``."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG file")
    return struct.unpack(">IIBB", data[16:26])


def from_png(data: bytes) -> bytes:
    width, height, bits, colour = png_header(data)
    if (bits, colour) != (8, 0):
        raise ValueError("not 8-bit grey")
    at, packed = 8, []
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:].tobytes()


def feature(payload: bytes, cells: int = FEATURE_CELLS) -> str:
    """Mean grey of ``cells`` equal stretches of the payload, in hexadecimal."""
    samples = np.frombuffer(payload, np.uint8)
    means = np.add.reduceat(samples.astype(np.uint32), np.arange(cells) * (len(samples) // cells)) // np.diff([*(np.arange(cells) * (len(samples) // cells)), len(samples)])
    return means.astype(np.uint8).tobytes().hex()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Appends files to a tar shard and knows where each begins."""

    def __init__(self, folder: str):
        self.folder, self.stream = folder, None

    def add(self, digest: str, data: bytes) -> tuple[str, int, int]:
        if self.stream is None:
            self.uri, self.size, self.places = f"{self.folder}/{uuid.uuid4().hex}.tar", 0, {}
            system, path = _open(self.uri)
            self.stream = system.open_output_stream(path)
        if digest not in self.places:
            entry = tarfile.TarInfo(f"{digest}.png")
            entry.size = len(data)
            head = entry.tobuf(tarfile.USTAR_FORMAT)
            self.stream.write(head + data + bytes(-len(data) % tarfile.BLOCKSIZE))
            self.places[digest] = (self.uri, self.size + len(head), len(data))
            self.size += len(head) + len(data) + -len(data) % tarfile.BLOCKSIZE
        return self.places[digest]

    def full(self) -> bool:
        return self.stream is not None and self.size >= SHARD_BYTES

    def close(self) -> None:
        if self.stream is not None:
            self.stream.write(bytes(2 * tarfile.BLOCKSIZE))
            self.stream.close()
            self.stream = None


INDEX = "digest string, shard string, offset long, length long, n_bytes long"
RESERVED = {c.split()[0] for c in INDEX.split(", ")} | {"width", "height", "bits", "colour_type", "payload_bytes", "payload_sha256", "tail_crc32", "media_sha256", "feature"}


def store_media(docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """Writes the shards, and returns the written index: ``id``, ``digest``, ``shard``, ``offset``, ``length`` of the file,
    and ``n_bytes`` of the text."""
    if id_column in RESERVED:
        raise ValueError(f"an id column cannot be called {id_column}, as a column of the index is")
    id_type = docs.schema[id_column].dataType.simpleString()
    folder = f"{work.path}/shards"
    anchor = work.spark._jvm.org.apache.hadoop.fs.Path(folder)
    anchor.getFileSystem(work.spark._jsc.hadoopConfiguration()).mkdirs(anchor)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardWriter(folder)
        for whole in batches:
            for batch in split_batch(whole):
                rows = []
                for data in batch.column(1).to_pylist():
                    png = to_png(pad(data, width), width)
                    digest = hashlib.sha256(png).hexdigest()
                    rows.append((digest, *shard.add(digest, png), len(data)))
                    if shard.full():
                        shard.close()
                made = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, k) for v, k in zip(made, kinds, strict=True)]], [id_column, "digest", "shard", "offset", "length", "n_bytes"])
        shard.close()

    payloads = docs.select(F.col(id_column), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    return work.save(payloads.mapInArrow(write, f"{id_column} {id_type}, {INDEX}"), "index")


def _read_ranges(index: DataFrame, span, make, columns: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """index with what ``make`` finds in a range of each row's file. span: length -> bytes to read."""
    schema, names = index.schema, index.columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stream = None, None
        for batch in batches:
            found: dict[tuple, tuple] = {}
            places = list(zip(*[batch.column(c).to_pylist() for c in ("shard", "offset", "length")], strict=True))
            for place in sorted(set(places)):
                if place[0] != at:
                    at = place[0]
                    system, path = _open(at)
                    stream = system.open_input_file(path)
                found[place] = make(stream.read_at(span(place[2]), place[1]))
            made = list(zip(*[found[p] for p in places], strict=True)) or [()] * len(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v, t) for v, (_, _, t) in zip(made, columns, strict=True)]], [*names, *[c[0] for c in columns]])

    more = ", ".join(f"{c} {t}" for c, t, _ in columns)
    return index.mapInArrow(read, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], more]))


def read_headers(index: DataFrame) -> DataFrame:
    """index with ``width``, ``height``, ``bits`` and ``colour_type``, from header-only reads."""
    columns = [("width", "int", pa.int32()), ("height", "int", pa.int32()), ("bits", "int", pa.int32()), ("colour_type", "int", pa.int32())]
    return _read_ranges(index, lambda n: HEADER_BYTES, png_header, columns)


def read_features(index: DataFrame, tail: int = WIDTH) -> DataFrame:
    """index with figures of the stored payload: ``payload_bytes``, ``payload_sha256``, ``tail_crc32`` of the last
    ``tail`` bytes, ``media_sha256`` of the file as read, and ``feature``."""

    def make(data: bytes):
        payload = from_png(data)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-tail:]), hashlib.sha256(data).hexdigest(), feature(payload)

    columns = [("payload_bytes", "long", pa.int64()), ("payload_sha256", "string", pa.string()), ("tail_crc32", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string())]
    return _read_ranges(index, lambda n: n, make, columns)
