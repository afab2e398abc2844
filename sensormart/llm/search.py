"""Ranked lexical search: blocks of queries against all documents, as exact matrix products.

An item asks with its terms. Items are dealt into blocks of bounded text; the
terms of a block are its vocabulary, and only they are kept of the documents.
Inside a task, a tile of items times a tile of documents is one product in
double precision: the items' side holds how often a term is asked, times its
weight, over the terms of that tile alone; the documents' side holds the term's
impact. All are whole numbers, and rows are cut so that no sum reaches 2**53, so
the products are exact and the order of their additions does not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensormart.llm.common import slices
from sensormart.session import materialise

#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
_FOLD = bytes(
    b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256)
)
#: Text of the items in one block, about: it bounds vocabulary, weights and what is broadcast.
BLOCK_BYTES = 1 << 20
#: Items and documents of a tile.
TILE_ITEMS, TILE_DOCS = 64, 512
#: Bytes of a text split into terms at a time.
PIECE = 4 << 20
#: An impact lies below it, and whole numbers below 2**53 are exact in a double.
IMPACT, EXACT = 10**6, 1 << 53


def terms_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a few million bytes at a time; no term is cut."""
    folded, start = data.translate(_FOLD), 0
    while len(folded) - start > PIECE:
        end = folded.find(b" ", start + PIECE)
        if end < 0:
            break
        yield folded[start:end].split()
        start = end
    yield folded[start:].split()


# -- documents ---------------------------------------------------------------
def term_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), and the vocabulary's terms in it with their counts.

    ``vocabulary`` is a broadcast dictionary from term to number. Texts without a
    term, null ones included, give no row.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, outside = vocabulary.value, len(vocabulary.value)
        for batch in batches:
            for part in slices(batch, "text"):
                rows, sizes, codes, owners = [], [], [], []
                for row, data in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    n = 0
                    for words in _pieces(data):
                        n += len(words)
                        codes.append(np.fromiter(map(number.get, words, repeat(outside)), np.int64, len(words)))
                        owners.append(np.full(len(words), len(rows)))
                    if n:
                        rows.append(row)
                        sizes.append(n)
                    else:
                        codes.pop()
                        owners.pop()
                if not rows:
                    continue
                code, owner = np.concatenate(codes), np.concatenate(owners)
                known = code < outside
                pairs, counts = np.unique(owner[known] * outside + code[known], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(rows) + 1) * outside).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows)),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array((pairs % max(1, outside)).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64))),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    doc_id = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(count, f"doc_id {doc_id}, n long, terms array<int>, counts array<long>")


def term_weights(n_docs: int, held: list[int]) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) for the number of documents that hold each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held], np.int64)


def impacts(sizes: np.ndarray, owner: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m) of each entry, m from the size of its document."""
    if len(sizes) and 75 * int(sizes.max()) * n_docs < 1 << 63:
        lengths = 25 + 75 * sizes * n_docs // n_terms
    else:  # beyond 64 bits on the way
        lengths = np.array([25 + 75 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
    return 10**9 * counts // (1000 * counts + 8 * lengths[owner])


# -- items -------------------------------------------------------------------
class ItemTiles:
    """The items of a block as matrices over the terms of each tile."""

    def __init__(self, asked: list[Counter], weights: np.ndarray) -> None:
        self.items, self.tiles = len(asked), []
        for first in range(0, len(asked), TILE_ITEMS):
            part = asked[first : first + TILE_ITEMS]
            terms = np.array(sorted(set().union(*part)), np.int64)
            terms = terms[weights[terms] > 0] if len(terms) else terms
            column = np.full(len(weights) + 1, -1, np.int32)
            column[terms] = np.arange(len(terms))
            whole = np.zeros((len(part), len(terms)), object)
            for row, counter in enumerate(part):
                for term, q in counter.items():
                    if column[term] >= 0:
                        whole[row, column[term]] = q * int(weights[term])
            self.tiles.append((first, column, len(terms), exact_parts(whole)))

    def scores(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """items x docs, in 64-bit integers."""
        found = np.zeros((self.items, docs), np.int64)
        for first, column, width, parts in self.tiles:
            place = column[term]
            here = place >= 0
            tile = np.zeros((docs, width))
            tile[owner[here], place[here]] = impact[here]
            for part in parts:
                found[first : first + len(part)] += (part @ tile.T).astype(np.int64)
        return found


def exact_parts(whole: np.ndarray) -> list[np.ndarray]:
    """Matrices that sum up to ``whole``, of which no row times impacts can reach 2**53."""
    limit = (EXACT - 1) // IMPACT
    upto = np.cumsum(whole, axis=1)
    most = int(upto.max(initial=0))
    if most * IMPACT >= 1 << 63:
        raise ValueError("an item's score may not fit into 64 bits")
    parts = []
    for low in range(0, most, limit):
        part = np.clip(upto, low, low + limit) - np.clip(upto - whole, low, low + limit)
        parts.append(part.astype(np.float64))
    return parts


def best_rows(found: pa.Table, k: int) -> pa.Table:
    """The first ``k`` rows of each item: highest score, then smallest doc_id, null ids last."""
    order = pc.sort_indices(
        found, [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end"
    )
    found = found.take(order)
    item = found.column("item").to_numpy()
    first = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else np.zeros(0, int)
    place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
    return found.take(pa.array(np.flatnonzero(place < k)))


def _ranked(counted: DataFrame, tiles, names: list[int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best documents of every item of the block: at most ``k`` rows an item and task."""
    names = counted.sparkSession.sparkContext.broadcast(np.array(names))
    kind = counted.schema["doc_id"].dataType.simpleString()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = tiles.value
        # A score below an item's bar cannot be among its best; one at the bar can, by its id.
        bar, best, pending, waiting = np.ones(block.items, np.int64), None, [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(start, TILE_DOCS)
                docs = part.num_rows
                term = part.column("terms").flatten().to_numpy()
                counts = part.column("counts").flatten().to_numpy()
                owner = np.repeat(np.arange(docs), pc.list_value_length(part.column("terms")).to_numpy())
                impact = impacts(part.column("n").to_numpy(), owner, counts, n_docs, n_terms)
                scores = block.scores(owner, term, impact, docs)
                if docs > k:
                    bar = np.maximum(bar, np.partition(scores, docs - k, axis=1)[:, docs - k])
                item, place = np.nonzero(scores >= bar[:, None])
                pending.append(
                    pa.table(
                        {
                            "item": pa.array(item.astype(np.int32)),
                            "doc_id": part.column("doc_id").take(pa.array(place)),
                            "score": pa.array(scores[item, place]),
                        }
                    )
                )
                waiting += len(item)
                if waiting > 20 * k * block.items:
                    best, bar = _merged(best, pending, bar, k)
                    pending, waiting = [], 0
        if pending:
            best, _ = _merged(best, pending, bar, k)
        if best is not None:
            named = pa.array(names.value[best.column("item").to_numpy()])
            yield from best.set_column(0, "item", named).to_batches()

    return counted.mapInArrow(rank, f"item long, doc_id {kind}, score long")


def _merged(best: pa.Table | None, pending: list[pa.Table], bar: np.ndarray, k: int) -> tuple[pa.Table, np.ndarray]:
    best = best_rows(pa.concat_tables(([best] if best is not None else []) + pending), k).combine_chunks()
    item, score = best.column("item").to_numpy(), best.column("score").to_numpy()
    full = np.bincount(item, minlength=len(bar)) >= k
    lowest = np.full(len(bar), np.iinfo(np.int64).max)
    np.minimum.at(lowest, item, score)
    return best, np.where(full, np.maximum(bar, lowest), bar)


# -- operator ----------------------------------------------------------------
def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """The best documents of a block's items (rows of item and text)."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    asked = []
    for row in block:
        terms = Counter(terms_of((row.text or "").encode("utf-8", "surrogatepass")))
        asked.append(Counter({numbers.setdefault(t, len(numbers)): q for t, q in terms.items()}))
    counted = materialise(term_counts(docs, spark.sparkContext.broadcast(numbers)), "term-counts")
    totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    held = [0] * len(numbers)
    # One row for each term of the block's vocabulary.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[row.term] = row["count"]
    tiles = spark.sparkContext.broadcast(ItemTiles(asked, term_weights(totals.docs, held)))
    return _ranked(counted, tiles, [row.item for row in block], totals.docs, totals.terms or 1, k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest-scoring documents of each item, scores above 0 only.

    Terms, weights and scores are as the registered query states them. Returns
    item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id, null
    ids last. Each row of ``items`` is an item of its own and each row of ``docs``
    a document, repeated and null ids included. Null texts, and texts without a
    term, have no score; without items or documents there are no rows. Other
    columns are not read. A very long text costs time and room in proportion; it
    is split into terms piece by piece and never cut short.

    Items are dealt into blocks of about ``BLOCK_BYTES`` of text (an item alone
    may be longer), and only a block's items, vocabulary and weights are held by
    the driver and broadcast, however many items there are. A block reads the
    documents once and writes the counts of its own terms; statistics and scores
    come from that copy.
    """
    listed = items.select("item_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    listed = materialise(listed.withColumn("item", F.monotonically_increasing_id()), "items")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = listed.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = []
    for number in range(blocks):
        block = dealt.filter(F.col("block") == number).orderBy("item").collect()
        if not block:
            continue
        ids = dealt.filter(F.col("block") == number).select("item", "item_id")
        best = _first_of_each(_search_block(docs, block, k), k)
        found.append(best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        item_id, doc_id = (t.select(c).schema[0].dataType for t, c in ((items, "item_id"), (docs, "doc_id")))
        kinds = {"item_id": item_id, "rank": "int", "doc_id": doc_id, "score": "long"}
        nothing = docs.sparkSession.range(0)
        return nothing.select(*[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()])
    return reduce(DataFrame.unionByName, found)


def _first_of_each(ranked: DataFrame, k: int) -> DataFrame:
    place: Column = F.row_number().over(
        Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    )
    return ranked.withColumn("rank", place).filter(F.col("rank") <= k)
