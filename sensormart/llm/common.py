"""Text rules, tables and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILAR = 0.75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on the machine that asks."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes in ``column``."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, size = 0, 0
    for row, length in enumerate(lengths):
        if size and size + (length or 0) > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def open_store(uri: str):
    """The file system and path behind a folder of the shared scratch space."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


