"""Packing by power-of-two decomposition: no sequence crosses documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sensormart.llm.common import slices, text_or_empty, tokenizer_path
from sensormart.llm.word_table import give_back, with_end, worker_table

#: Bits of a sequence id: bucket, partition, number within both.
_PARTITION_BITS, _SLOT_BITS = 22, 36


def binary_lengths(n: int, most: int) -> list[int]:
    """``n`` as a sum of ``most`` as often as it fits and of falling powers of two."""
    lengths = [most] * (n // most)
    rest = n % most
    return lengths + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pack_documents(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    max_tokens: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """Cut every document into pieces of power-of-two length, each its own sequence.

    Returns one row per piece: doc_id, start (the document's ids before it),
    length, ids (binary, unsigned 32-bit little-endian), doc_tokens (with the end
    id), bucket (length = 2 ** bucket), sequence_id, offset (always 0). Sequences
    of one bucket have equal lengths, so batches of one bucket need no padding.
    ``max_tokens`` must be a power of two; longer documents give several pieces of
    that length. Ids of a sequence order them by bucket and are unique, but not
    contiguous: the bucket, the input partition and a counter, so that no shuffle
    and no second pass is needed. A null text is empty: one piece with the end id.
    Null and repeated doc_ids are documents like others; other columns are not
    read; an empty table gives no rows.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    doc_id = narrow.schema["doc_id"].dataType.simpleString()
    names = ["start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(tokenizer_path(tokenizer))
        partition = TaskContext.get().partitionId()
        if partition >> _PARTITION_BITS:
            raise ValueError("too many partitions for sequence ids; repartition the documents")
        used = [0] * max_tokens.bit_length()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                row, columns = [], [[] for _ in names]
                ids, totals = with_end(*table.encode(part.column("text")), end_id)
                data, at = ids.tobytes(), 0
                for n, total in enumerate(totals.tolist()):
                    start = 0
                    for length in binary_lengths(total, max_tokens):
                        bucket = length.bit_length() - 1
                        sequence = (bucket << _PARTITION_BITS | partition) << _SLOT_BITS | used[bucket]
                        used[bucket] += 1
                        piece = data[at : at + 4 * length]
                        for column, value in zip(
                            columns, (start, length, piece, total, bucket, sequence, 0), strict=True
                        ):
                            column.append(value)
                        row.append(n)
                        start, at = start + length, at + 4 * length
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64()))]
                    + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", *names],
                )
        give_back()

    return narrow.mapInArrow(
        pack,
        f"doc_id {doc_id}, start long, length long, ids binary, doc_tokens long, bucket int, "
        "sequence_id long, offset long",
    )

