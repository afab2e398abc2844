"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the documents of one range of doc_ids, in ascending order:

    magic "PFB1"
    blocks, each of 1,024 ids (the last may be shorter, and is padded):
        packed words: id - least in ``width`` bits, 64 rows of 16 lanes
        exceptions: positions (16 bit), then ids - least (32 bit)
    block index: start, least id, width, exceptions and ids of every block
    document index: doc_id, whether there is one, number of ids
    trailer: offset of the block index, blocks, documents, magic

Any id can be read from the start of its block alone.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensormart.llm.common import open_store, slices, text_or_empty, tokenizer_path
from sensormart.llm.word_table import give_back, split_ids, with_end, worker_table
from sensormart.session import materialise, scratch_path

BLOCK = 1024
#: Blocks encoded and written, or read and decoded, at a time.
GROUP = 512
#: Ids and documents of a file, about.
FILE_IDS, FILE_DOCS = 1 << 25, 1 << 20
MAGIC = b"PFB1"
_LANES = 16
_TRAILER = struct.Struct("<QQQ4s")
_BLOCKS = np.dtype([("start", "<u8"), ("least", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("ids", "<u2")])
_DOCS = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("ids", "<u8")])


# -- blocks ------------------------------------------------------------------
def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) numbers below 2 ** width as (n, width, lanes) 64-bit words."""
    rows = values.astype(np.uint64).reshape(-1, BLOCK // _LANES, _LANES)
    words = np.zeros((len(rows), width, _LANES), "<u8")
    for k in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(k * width, 64)
        words[:, word] |= rows[:, k] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, k] >> np.uint64(64 - shift)
    return words


def unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    rows = np.zeros((len(words), BLOCK // _LANES, _LANES), np.uint64)
    for k in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(k * width, 64)
        rows[:, k] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            rows[:, k] |= words[:, word + 1] << np.uint64(64 - shift)
    return (rows & np.uint64((1 << width) - 1)).reshape(-1, BLOCK)


def block_widths(above: np.ndarray, percentile: float) -> np.ndarray:
    """The smallest widths that hold at least ``percentile`` of each block's numbers."""
    most = BLOCK - int(np.ceil(percentile * BLOCK))
    top = int(above.max()).bit_length()
    widths = np.full(len(above), top, np.uint8)
    for width in range(top - 1, -1, -1):
        fits = np.count_nonzero(above >> np.uint32(width), axis=1) <= most
        if not fits.any():
            break
        widths[fits] = width
    return widths


def encode_blocks(ids: np.ndarray, percentile: float) -> tuple[list[bytes], np.ndarray]:
    """Payloads and index rows (without starts) of consecutive blocks."""
    n = -(-len(ids) // BLOCK)
    index = np.zeros(n, _BLOCKS)
    index["ids"] = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(n))
    padded = np.concatenate([ids, np.repeat(ids[-1:], n * BLOCK - len(ids))]).astype(np.uint32)
    blocks = padded.reshape(n, BLOCK)
    index["least"] = blocks.min(axis=1)
    above = blocks - index["least"][:, None]
    index["width"] = block_widths(above, percentile)
    odd = above > ((np.uint64(1) << index["width"].astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    index["exceptions"] = np.count_nonzero(odd, axis=1)
    payloads: list[bytes] = [b""] * n
    for width in np.unique(index["width"]):
        chosen = np.flatnonzero(index["width"] == width)
        words = pack_bits(np.where(odd[chosen], 0, above[chosen]), int(width))
        for row, block in zip(words, chosen, strict=True):
            at = np.flatnonzero(odd[block])
            payloads[block] = row.tobytes() + at.astype("<u2").tobytes() + above[block, at].astype("<u4").tobytes()
    return payloads, index


def decode_blocks(data: bytes, index: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks whose bytes are ``data``."""
    starts = (index["start"] - index["start"][0]).astype(np.int64)
    above = np.zeros((len(index), BLOCK), np.uint64)
    for width in np.unique(index["width"]):
        chosen = np.flatnonzero(index["width"] == width)
        size = int(width) * _LANES * 8
        words = np.frombuffer(b"".join(data[s : s + size] for s in starts[chosen]), "<u8")
        above[chosen] = unpack_bits(words.reshape(len(chosen), int(width), _LANES), int(width))
    for block in np.flatnonzero(index["exceptions"]):
        n = int(index["exceptions"][block])
        at = int(starts[block]) + int(index["width"][block]) * _LANES * 8
        places = np.frombuffer(data, "<u2", n, at)
        above[block, places] = np.frombuffer(data, "<u4", n, at + 2 * n)
    ids = (above + index["least"][:, None].astype(np.uint64)).astype("<u4")
    return ids.reshape(-1)[: int(index["ids"].sum())] if len(index) else ids.reshape(-1)


# -- files -------------------------------------------------------------------
class FileWriter:
    def __init__(self, stream, percentile: float) -> None:
        self.stream, self.percentile = stream, percentile
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.blocks: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.at = stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= BLOCK * GROUP:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, most: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for start in range(0, most, BLOCK * GROUP):
            payloads, index = encode_blocks(ids[start : min(most, start + BLOCK * GROUP)], self.percentile)
            sizes = np.array([len(p) for p in payloads], np.uint64)
            index["start"] = self.at + np.cumsum(sizes) - sizes
            self.at += self.stream.write(b"".join(payloads))
            self.blocks.append(index)
        self.waiting, self.held = [ids[most:]], len(ids) - most

    def close(self) -> None:
        self._flush(self.held)
        blocks = np.concatenate([*self.blocks, np.zeros(0, _BLOCKS)])
        self.stream.write(blocks.tobytes() + np.array(self.docs, _DOCS).tobytes())
        self.stream.write(_TRAILER.pack(self.at, len(blocks), len(self.docs), MAGIC))
        self.stream.close()


def read_file(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of a file in order, group of blocks by group."""
    size = stream.size()
    at, n_blocks, n_docs, magic = _TRAILER.unpack(stream.read_at(_TRAILER.size, size - _TRAILER.size))
    if magic != MAGIC or stream.read_at(4, 0) != MAGIC:
        raise ValueError("not a file of token blocks")
    blocks = np.frombuffer(stream.read_at(n_blocks * _BLOCKS.itemsize, at), _BLOCKS)
    docs = np.frombuffer(stream.read_at(n_docs * _DOCS.itemsize, at + blocks.nbytes), _DOCS)

    def groups() -> Iterator[np.ndarray]:
        for first in range(0, n_blocks, GROUP):
            part = blocks[first : first + GROUP]
            start = int(part["start"][0])
            end = int(blocks["start"][first + GROUP]) if first + GROUP < n_blocks else at
            yield decode_blocks(bytes(stream.read_at(end - start, start)), part)

    source, ids, used = groups(), np.zeros(0, "<u4"), 0
    for doc in docs:
        parts, missing = [], int(doc["ids"])
        while missing:
            if used == len(ids):
                ids, used = next(source), 0
            part = ids[used : used + missing]
            parts.append(part)
            used, missing = used + len(part), missing - len(part)
        whole = parts[0] if len(parts) == 1 else np.concatenate([*parts, np.zeros(0, "<u4")])
        yield (int(doc["doc_id"]) if doc["known"] else None), whole


def write_token_files(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    percentile: float = 0.98,
    folder: str | None = None,
) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order.

    Documents are range-partitioned by doc_id and a hash of the text, which splits
    an id (or the null id) that many rows share, and sorted inside partitions, so
    the files, taken by ``shard``, hold all documents in order; null ids come
    first, equal ids in the order of the hash. A file ends at ``FILE_IDS`` ids or
    ``FILE_DOCS`` documents. A block's width fits its ids up to ``percentile``, the
    rest become exceptions. Returns the written manifest: shard, path, n_docs,
    n_tokens. A file whose task failed is in no manifest. A
    null text is empty and gets the end id alone. An empty table gives no file.
    The folder is new under the shared scratch folder unless given.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    narrow = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(tokenizer_path(tokenizer))
        # Shards count on inside a partition.
        shard, writer = TaskContext.get().partitionId() << 20, None
        store, root = open_store(folder)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = split_ids(*with_end(*table.encode(part.column("text")), end_id))
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    if writer is None:
                        store.create_dir(root, recursive=True)
                        name = f"shard-{shard:012d}-{uuid.uuid4().hex}.pfb"
                        writer = FileWriter(store.open_output_stream(f"{root}/{name}", compression=None), percentile)
                    writer.add(doc_id, ids)
                    if writer.ids >= FILE_IDS or len(writer.docs) >= FILE_DOCS:
                        yield closed(writer, shard, name)
                        shard, writer = shard + 1, None
        if writer is not None:
            yield closed(writer, shard, name)
        give_back()

    def closed(writer: FileWriter, shard: int, name: str) -> pa.RecordBatch:
        writer.close()
        return pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": f"{folder}/{name}", "n_docs": len(writer.docs), "n_tokens": writer.ids}]
        )

    keys = ["doc_id", "_hash"]
    ordered = narrow.withColumn("_hash", F.xxhash64("text")).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_hash")
    manifest = ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long")
    return materialise(manifest, "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents from the files of a manifest, one task a file.

    Returns doc_id, start (ids in all documents before it), n_tokens, ids (binary,
    unsigned 32-bit little-endian).
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")
    files = manifest.select("path", before.alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                store, path = open_store(file["path"])
                rows, size, start = [], 0, file["before"]
                with store.open_input_file(path) as stream:
                    for doc_id, ids in read_file(stream):
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        size += 4 * len(ids)
                        if size > 4 << 20:
                            yield _documents(rows)
                            rows, size = [], 0
                yield _documents(rows)

    # One row stands for a whole file: dealt out by number, so that they are not put together again.
    return files.repartition(max(1, manifest.count())).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids binary"
    )


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds)
    )

