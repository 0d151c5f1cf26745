"""Token ids in bit-plane files.

A shard file holds the ids of consecutive documents. Ids are cut into blocks of fixed size; a block is transposed into
bit planes (or byte planes), so that the rarely set high bits stand together, and every plane is compressed with
zstandard. Planes without a set bit take no room. After the blocks come the chunk index, the document lengths and a
fixed-size tail:

    "TWPLANE1" | planes of block 0 | planes of block 1 | ... | index | lengths | tail
    index    per block: offset u64, ids u32, width u32 (planes), then the compressed length u32 of each plane
    lengths  zstd of one u64 per document
    tail     block size u32, planes in bits (1) or bytes (8) u32, blocks u64, documents u64, index offset u64,
             lengths offset u64, "TWPLANE1"

All numbers are little-endian. A reader takes the tail, then the index, then only the planes it needs.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidewick.llm import files, tokens
from tidewick.llm.common import bytes_at_most, texts
from tidewick.session import fresh_path, written

MAGIC = b"TWPLANE1"
BLOCK = 1 << 16
SHARD_IDS = 4 << 20  # a shard is closed at the first document end after so many ids
_TAIL = struct.Struct("<IIQQQQ8s")


# ---- one block
def to_planes(ids: np.ndarray, bits: bool = True) -> list[bytes]:
    """Planes from the lowest to the highest that has a set bit."""
    ids = np.ascontiguousarray(ids, "<u4")
    bytes_ = ids.view(np.uint8).reshape(-1, 4)
    if not bits:
        top = int(ids.max(initial=0))
        return [bytes_[:, k].tobytes() for k in range((top.bit_length() + 7) // 8)]
    top = int(ids.max(initial=0))
    planes = []
    for k in range(-(-top.bit_length() // 8)):  # a byte of every id is turned eight ways
        own = np.ascontiguousarray(bytes_[:, k])
        planes += [np.packbits(own & (1 << j), bitorder="little").tobytes() for j in range(min(8, top.bit_length() - 8 * k))]
    return planes


def from_planes(planes: list[bytes], count: int, bits: bool = True) -> np.ndarray:
    if not bits:
        out = np.zeros((count, 4), np.uint8)
        for k, p in enumerate(planes):
            out[:, k] = np.frombuffer(p, np.uint8)
        return out.reshape(-1).view("<u4")
    out = np.zeros((count, 4), np.uint8)
    for k in range(0, len(planes), 8):
        own = np.zeros(count, np.uint8)
        for j, p in enumerate(planes[k : k + 8]):
            own |= np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") << j
        out[:, k // 8] = own
    return out.reshape(-1).view("<u4")


# ---- one file
class ShardWriter:
    """Writes to a binary stream; holds one block at most besides the index."""

    def __init__(self, stream, block: int = BLOCK, bits: bool = True, level: int = 3):
        self.stream, self.block, self.bits, self.at = stream, block, bits, len(MAGIC)
        self.press, self.index, self.lengths, self.rest, self.ids = zstandard.ZstdCompressor(level=level), [], [], b"", 0
        stream.write(MAGIC)

    def add(self, ids: bytes) -> None:
        """Ids of one document, 4 little-endian bytes each."""
        self.lengths.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.rest += ids
        size = 4 * self.block
        whole = len(self.rest) // size * size
        for at in range(0, whole, size):
            self._put(self.rest[at : at + size])
        self.rest = self.rest[whole:]

    def _put(self, chunk: bytes) -> None:
        pressed = [self.press.compress(p) for p in to_planes(np.frombuffer(chunk, "<u4"), self.bits)]
        self.index.append(struct.pack(f"<QII{len(pressed)}I", self.at, len(chunk) // 4, len(pressed), *map(len, pressed)))
        for p in pressed:
            self.stream.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.rest:
            self._put(self.rest)
        index, lengths = b"".join(self.index), self.press.compress(np.array(self.lengths, "<u8").tobytes())
        tail = _TAIL.pack(self.block, 1 if self.bits else 8, len(self.index), len(self.lengths), self.at, self.at + len(index), MAGIC)
        self.stream.write(index + lengths + tail)


class ShardReader:
    """Random access to a shard through ``read(offset, length)``."""

    def __init__(self, read, size: int):
        self.read = read
        block, planes, blocks, documents, index_at, lengths_at, magic = _TAIL.unpack(read(size - _TAIL.size, _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a plane file")
        self.block, self.bits = block, planes == 1
        raw, at, self.index = read(index_at, lengths_at - index_at), 0, []
        for _ in range(blocks):
            offset, count, width = struct.unpack_from("<QII", raw, at)
            sizes = struct.unpack_from(f"<{width}I", raw, at + 16)
            at += 16 + 4 * width
            self.index.append((offset, count, sizes))
        pressed = read(lengths_at, size - _TAIL.size - lengths_at)
        self.lengths = np.frombuffer(zstandard.ZstdDecompressor().decompress(pressed, max_output_size=8 * documents + 64), "<u8").astype(np.int64) if documents else np.empty(0, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def block_ids(self, k: int) -> np.ndarray:
        offset, count, sizes = self.index[k]
        raw, open_, at, planes = self.read(offset, sum(sizes)), zstandard.ZstdDecompressor(), 0, []
        for s in sizes:
            planes.append(open_.decompress(raw[at : at + s], max_output_size=4 * count + 64))
            at += s
        return from_planes(planes, count, self.bits)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from place start up to end; only the blocks between are read."""
        if end <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        return np.concatenate([self.block_ids(k) for k in range(first, last + 1)])[start - first * self.block : end - first * self.block]

    def documents(self):
        """(place, ids) of every document in order; one block is decoded at a time."""
        have, at, nxt = [], 0, 0
        for d, n in enumerate(self.lengths):
            while at < n:
                have.append(self.block_ids(nxt))
                at, nxt = at + len(have[-1]), nxt + 1
            joined = have[0] if len(have) == 1 else np.concatenate(have) if have else np.empty(0, np.uint32)
            yield int(self.starts[d]), joined[:n]
            have, at = [joined[n:]], at - n


# ---- data sets
def write_planes(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, block: int = BLOCK, bits: bool = True,
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every whole text and write shards in ascending doc_id order; returns the stored list of shards.

    Columns: path, part, seq (their order is the data set's), doc_ids (of the shard, in order), n_tokens, base (ids in
    all shards before). Every file gets a name of its own and counts only through this list, so repeated or lost tasks
    leave no trace. Null texts are empty (one end id); null doc_ids come first; rows of one doc_id are ordered by a
    hash of their text. An empty table gives no shards.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "planes")
    path = vocabulary or tokens.vocabulary()

    def run(frames):
        part, seq, out, named = TaskContext.get().partitionId(), 0, None, []

        def closed():
            out.close()
            out.stream.close()
            return pd.DataFrame({"path": [where], "part": [part], "seq": [seq], "doc_ids": [named], "n_tokens": [out.ids]})

        for frame in bytes_at_most(frames, "text", 2 << 20):
            for doc_id, ids in zip(frame["doc_id"], tokens.document_ids(frame["text"].tolist(), path)):
                if out is None:
                    where = f"{folder}/{uuid.uuid4().hex}.planes"
                    out, named = ShardWriter(files.create(where), block, bits), []
                named.append(None if pd.isna(doc_id) else int(doc_id))
                out.add(ids)
                if out.ids >= shard_ids:
                    yield closed()
                    out, seq = None, seq + 1
        if out is not None:
            yield closed()

    ordered = texts(docs).withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    shards = written(ordered.mapInPandas(run, "path string, part int, seq int, doc_ids array<long>, n_tokens long"), "plane-shards")
    # Totals per part first: one row each, so the running total over shards never orders all shards in one task.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    local = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return shards.withColumn("local", local).join(before, "part").select("path", "part", "seq", "doc_ids", "n_tokens", (F.col("before") + F.col("local")).alias("base"))


def read_planes(shards: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start, n_tokens, ids (array of long)."""
    return _spread(shards).mapInPandas(lambda frames: _read(frames, lambda ids: ids.astype(np.int64), "ids"), "doc_id long, start long, n_tokens long, ids array<long>")


def checksums(shards: DataFrame) -> DataFrame:
    """Every document of the shards, read back: doc_id, start, n_tokens, ids_crc32."""
    return _spread(shards).mapInPandas(lambda frames: _read(frames, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32"),
                              "doc_id long, start long, n_tokens long, ids_crc32 long")


def _spread(shards: DataFrame) -> DataFrame:
    """The list is small beside the files it names: one task for each shard or few."""
    return shards.repartition(max(1, min(shards.count(), int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def _read(frames, digest, name):
    for frame in frames:
        for path, doc_ids, base in zip(frame["path"], frame["doc_ids"], frame["base"]):
            with files.opened(path) as (read, size):
                rows, held = [], 0
                for doc_id, (start, ids) in zip(doc_ids, ShardReader(read, size).documents()):
                    rows.append((None if pd.isna(doc_id) else int(doc_id), base + start, len(ids), digest(ids)))
                    held += len(ids) if name == "ids" else 1
                    if held >= 1 << 20:
                        yield _frame(rows, name)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, name)


def _frame(rows, name):
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", name])
    return out.astype({"doc_id": "Int64"})
