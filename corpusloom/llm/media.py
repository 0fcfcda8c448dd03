"""Media columns: content-addressed payloads in tar shards.

A text's UTF-8 bytes, padded with spaces to a positive multiple of 192, are the
rows of a grey 8-bit PNG of width 192. Every task appends the payloads that it
has not yet written to its own tar shards in the shared folder; a row carries
digest, shard, offset and length. One copy of each digest is canonical. Header
range reads (the first 33 bytes of a member) fill the metadata columns without
touching pixels; features read the stored bytes back and verify them.

Shards carry the task attempt in their names: an attempt that is lost leaves an
orphan, never a shard that two attempts wrote to. The manifest is written to
the shared folder before anything reads a shard.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import shared_dir, stored

WIDTH = 192
SHARD_BYTES = 256 << 20
#: Stored bytes that a task reads back, about, and the most tasks that do it.
READ_BYTES, MOST_TASKS = 8 << 20, 100_000
PNG = b"\x89PNG\r\n\x1a\n"
#: Signature, then the IHDR chunk: length, name, 13 bytes, checksum.
HEADER = 33


def payload(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // WIDTH)) * WIDTH, b" ")


def _chunk(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def png_encode(data: bytes) -> bytes:
    """A grey 8-bit PNG of width 192 whose samples are ``data``; equal data, equal bytes."""
    rows = np.zeros((len(data) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """(width, height, bits) from the first 33 bytes of a PNG."""
    if head[:8] != PNG or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != struct.unpack(">I", head[29:33])[0]:
        raise ValueError("not a PNG header")
    width, height, bits = struct.unpack(">IIB", head[16:25])
    return width, height, bits


def png_decode(data: bytes) -> np.ndarray:
    """The samples of a PNG that ``png_encode`` made, checksums verified."""
    width, height, _ = png_header(data[:HEADER])
    at, idat = 8, []
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        name, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if zlib.crc32(name + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged chunk")
        if name == b"IDAT":
            idat.append(body)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("unknown row filter")
    return rows[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and an eight-bin histogram of the samples."""
    counts = np.bincount(samples.ravel(), minlength=256)
    n, values = counts.sum(), np.arange(256)
    mean = float((counts * values).sum() / n)
    sd = float(np.sqrt((counts * (values - mean) ** 2).sum() / n))
    return f"mean={mean:.6f};sd={sd:.6f};hist=" + ",".join(map(str, counts.reshape(8, 32).sum(axis=1).tolist()))


class _Shards:
    """The tar shards of one task attempt."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.limit, self.n, self.out, self.at, self.name = limit, 0, None, 0, ""
        task = TaskContext.get()
        self.task = f"{task.partitionId():06d}-{task.taskAttemptId()}"

    def add(self, name: str, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at > self.limit:
            self.close()
            self.name = f"{self.task}-{self.n:04d}.tar"
            self.out, self.at, self.n = self.fs.open_output_stream(f"{self.folder}/{self.name}"), 0, self.n + 1
        info = tarfile.TarInfo(name)
        info.size = len(data)
        self.out.write(info.tobuf(tarfile.USTAR_FORMAT) + data + b"\0" * (-len(data) % 512))
        start, self.at = self.at + 512, self.at + 512 + len(data) + -len(data) % 512
        return self.name, start, len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.write(b"\0" * 1024)
            self.out.close()
            self.out = None


def new_folder(docs: DataFrame) -> str:
    """A new folder for shards under the shared one, as a URI."""
    base = shared_dir(docs.sparkSession)
    base = base if "://" in base or base.startswith("file:") else f"file://{base}"
    folder = f"{base.rstrip('/')}/media-{uuid.uuid4().hex}"
    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return folder


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """The manifest: (__id, n_bytes, digest, shard, offset, length) of every row.

    ``digest`` is the SHA-256 of the padded payload. Null text counts as
    empty; null ids stay null; equal texts share a payload inside a task; a
    text of any length is one member, written whole. Repeated rows come back
    repeated; other columns don't matter. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"))
    names = ["__id", "n_bytes", "digest", "shard", "offset", "length"]

    def run(batches):
        shards, known = _Shards(folder, limit), {}
        for b in batches:
            out = []
            for text in b.column(1):
                data = payload(text.as_py())
                digest = hashlib.sha256(data).digest()
                if digest not in known:
                    known[digest] = shards.add(f"{digest.hex()}.png", png_encode(data))
                out.append((len(text.as_buffer()), digest, *known[digest]))
            n, d, s, o, m = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(d, pa.binary()), pa.array(s, pa.string()), pa.array(o, pa.int64()), pa.array(m, pa.int64())], names=names)
        shards.close()

    kind = dict(docs.dtypes)[id_col]
    return stored(rows.mapInArrow(run, f"__id {kind}, n_bytes bigint, digest binary, shard string, offset bigint, length bigint"))


def canonical(manifest: DataFrame) -> DataFrame:
    """(digest, shard, offset, length): one stored copy of each payload, the smallest by name and offset."""
    one = manifest.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at"))
    return one.select("digest", "at.shard", "at.offset", "at.length")


def _ranged(catalog: DataFrame, folder: str, read, schema: str, total: int | None = None) -> DataFrame:
    """``read(file, offset, length)`` for each member, in order of shard and offset; ``total``: their bytes, about, if known."""
    kinds = {"binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    shape = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches):
        system, path = pafs.FileSystem.from_uri(folder)
        name, file = None, None
        for b in batches:
            rows = []
            for digest, shard, offset, length in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if shard != name:
                    if file is not None:
                        file.close()
                    name, file = shard, system.open_input_file(f"{path}/{shard}")
                rows.append((digest, *read(file, offset, length)))
            cols = zip(*rows, strict=True) if rows else [()] * len(shape)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape, strict=True)], schema=shape)
        if file is not None:
            file.close()

    members = catalog.select("digest", "shard", "offset", "length")
    if total is None:
        total = members.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // max(READ_BYTES, total // MOST_TASKS)))  # by what they read, not by the catalog's own size
    near = members.repartitionByRange(tasks, "shard", "offset").sortWithinPartitions("shard", "offset")
    return near.mapInArrow(run, schema)


def metadata(catalog: DataFrame, folder: str) -> DataFrame:
    """(digest, width, height, bits) by header-only range reads of 33 bytes a member."""

    def read(file, offset, length):
        return png_header(file.read_at(HEADER, offset))

    return _ranged(catalog, folder, read, "digest binary, width int, height int, bits int")


def features(catalog: DataFrame, folder: str, total: int | None = None) -> DataFrame:
    """What the stored bytes say, read back: see the schema below. The metadata come from a range read of the header alone."""

    def read(file, offset, length):
        width, height, bits = png_header(file.read_at(HEADER, offset))
        media = file.read_at(length, offset)
        samples = png_decode(media)
        data = samples.tobytes()
        return width, height, bits, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)

    return _ranged(catalog, folder, read, "digest binary, width int, height int, bits int, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string", total)


def query(docs: DataFrame) -> DataFrame:
    folder = new_folder(docs)
    manifest = write_shards(docs, folder)
    total = manifest.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    back = stored(features(canonical(manifest), folder, total))
    rows = manifest.select(F.col("__id").alias("doc_id"), "n_bytes", "digest").join(back, "digest")
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bits")
