"""Token counts by a two-tier lookup on the map side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.llm.common import slices, text_or_empty, tokenizer_path
from sensormart.llm.pieces import CountEncoder, keys_of, load_tokenizer, worker_encoder

#: Entries of the table of frequent pieces.
TABLE = 32_768
#: Counters that a task keeps at most while it looks for frequent pieces.
COUNTERS = 8 * TABLE


def frequent_pieces(docs: DataFrame, most: int = TABLE) -> list[str]:
    """The most frequent words of all texts, by partial counts of the map tasks.

    A task counts in a bounded table: when it is full, the rarer half is dropped.
    It passes on its ``most`` most frequent words, and only these are added up, so
    no piece of a text is shuffled. Which words come out affects the work that is
    saved and never a token count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    if "\0" not in text and "<|" not in text:
                        # The first piece has no space in front of it.
                        seen.update(keys_of(text)[1:])
                if len(seen) > COUNTERS:
                    seen = Counter(dict(seen.most_common(COUNTERS // 2)))
        kept = [(piece, n) for piece, n in seen.most_common(2 * most) if piece.isalpha()][:most]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["piece", "n"]
        )

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(count, "piece string, n long")
    top = counted.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(most)
    return [row.piece for row in top.collect()]


def frequent_lengths(docs: DataFrame, tokenizer: str) -> tuple[str, bytes]:
    """The frequent pieces and their token counts, packed: at most ``TABLE`` words of one byte each beside the text."""
    pieces = frequent_pieces(docs)
    library = load_tokenizer(tokenizer_path(tokenizer))
    encoded = library.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)
    kept = [(p, len(e.ids)) for p, e in zip(pieces, encoded, strict=True) if len(e.ids) < 256]
    return "\0".join(p for p, _ in kept), bytes(n for _, n in kept)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """Token counts of every whole text, without any shuffle.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).
    The first tier is a broadcast table of the pieces that are frequent in all
    texts, bounded by ``TABLE``;
    what it lacks is encoded by the tokenizers library and kept in a bounded
    cache of the worker. A null text counts as empty: 0 bytes, 0 tokens. Null
    and repeated doc_ids keep a row each; other columns are not read. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    tier = spark.sparkContext.broadcast(frequent_lengths(narrow, tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, lengths = tier.value
        known = dict(zip(pieces.split("\0"), lengths, strict=True)) if lengths else {}
        encoder = worker_encoder(CountEncoder, tokenizer_path(tokenizer))
        encoder.known = known
        for batch in batches:
            for part in slices(batch, "text"):
                counts = encoder.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.compute.binary_length(part.column("text")).cast(pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    doc_id = narrow.schema["doc_id"].dataType.simpleString()
    counted = narrow.mapInArrow(count, f"doc_id {doc_id}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
