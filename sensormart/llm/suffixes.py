"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A suffix matters only up to the threshold, so it is its first ``threshold`` bytes,
its window. The sort goes from the most significant digit down, and after each
digit drops the suffixes that stand alone; suffixes still together after the last
digit start with the same window. The digits are chosen so that one row stands
for many neighbouring suffixes as long as they share their fate:

1. The anchor: of all strings of ``ANCHOR`` bytes inside a window, the one with the
   smallest hash. Equal windows have equal anchors at equal distances. Neighbouring
   suffixes mostly share their anchor; such a run is one row.
2. The run: all bytes that the windows of a run cover. Runs equal in them are
   repeated as a whole and go no further.
3. Blocks of ``BLOCK`` distances to the anchor. What all windows of a block share
   must be found twice, or the block is dropped; if all they cover is found twice,
   the block is repeated as a whole.
4. The single suffixes of the blocks still open.

Digits are compared as hashes: an anchor's 64 bits together with 64 bits over
another base, so that at any later digit 128 bits agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensormart.llm.common import slices, text_or_empty
from sensormart.session import materialise, scratch

THRESHOLD = 400
#: Bytes of a passage of some 50 words: with the shortest words that occur in prose, five
#: characters with the space, a passage of 50 words has this many.
PASSAGE = 250
ANCHOR = 120
BLOCK = 16
#: Suffixes hashed at a time; longer texts are cut into such segments.
SEGMENT = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_RANDOM = np.random.default_rng(20240301)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_ROOM = SEGMENT + 4 * THRESHOLD
_POWERS = [np.multiply.accumulate(np.full(_ROOM, base, np.uint64)) for base in _BASES]
_INVERSES = [np.multiply.accumulate(np.full(_ROOM, pow(base, -1, 1 << 64), np.uint64)) for base in _BASES]


# -- hashes of byte windows --------------------------------------------------
def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Windows:
    """Hashes of any short windows of a text, from sums over its segments."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self.sums: dict[tuple[int, int], np.ndarray] = {}

    def _sums(self, segment: int, base: int) -> np.ndarray:
        if (segment, base) not in self.sums:
            if len(self.sums) > 3:
                self.sums.clear()
            part = self.data[segment * SEGMENT : segment * SEGMENT + _ROOM]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * _POWERS[base][: len(part)], out=sums[1:])
            self.sums[segment, base] = sums
        return self.sums[segment, base]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        segments = starts // SEGMENT
        for segment in np.unique(segments):
            chosen = slice(None) if segments[0] == segments[-1] else segments == segment
            sums, at = self._sums(int(segment), base), int(segment) * SEGMENT
            local = starts[chosen] - at
            out[chosen] = mix((sums[ends[chosen] - at] - sums[local]) * _INVERSES[base][local])
        return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x)
    blocks = np.append(x, np.full(-n % width, np.iinfo(np.uint64).max)).reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], onward[width - 1 : n])


def find_runs(data: np.ndarray, threshold: int = THRESHOLD, anchor: int = ANCHOR) -> list[np.ndarray]:
    """Runs of suffixes with one anchor: first, number, distance to the anchor, anchor and run hashes."""
    n = len(data) - threshold + 1
    parts = []
    windows = Windows(data)
    for start in range(0, n, SEGMENT):
        count = min(SEGMENT, n - start)
        places = np.arange(start, start + count + threshold - anchor)
        hashes = windows.hashes(places, places + anchor, 0)
        order = (hashes & ~_PLACE) | (places - start).astype(np.uint64)
        own = (sliding_least(order, threshold - anchor + 1) & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1])
        number = np.diff(np.append(first, count))
        whole = windows.hashes(first + start, first + start + number - 1 + threshold, 1)
        parts.append((first + start, number, own[first] - first, hashes[own[first]].view(np.int64), whole.view(np.int64)))
    return [np.concatenate(column) for column in zip(*parts, strict=True)]


def block_hashes(
    windows: Windows, n: int, first: np.ndarray, number: np.ndarray, distance: np.ndarray, threshold: int
) -> tuple[np.ndarray, ...]:
    """Blocks of runs: run, index, first and last suffix, hash of what all share, of what all cover, whether that fits."""
    near = distance - number + 1
    least = near // BLOCK
    counts = distance // BLOCK + 1 - least
    run = np.repeat(np.arange(len(first)), counts)
    index = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts) + least[run]
    at = (first + distance)[run]
    low, high = np.maximum(near[run], BLOCK * index), np.minimum(distance[run], BLOCK * index + BLOCK - 1)
    last_start, first_start = at - BLOCK * index, at - BLOCK * index - BLOCK + 1
    fits = (first_start >= 0) & (last_start + threshold <= n)
    inner = windows.hashes(last_start, first_start + threshold, 1)
    outer = windows.hashes(np.maximum(first_start, 0), np.minimum(last_start + threshold, n), 1)
    return run, index, at - high, at - low, inner.view(np.int64), outer.view(np.int64), fits


# -- passes ------------------------------------------------------------------
def text_key(text: Column) -> Column:
    """With the length in bytes, what tells texts apart."""
    return F.xxhash64(text)


def _runs(texts: DataFrame, threshold: int) -> DataFrame:
    """The runs of texts given by ``key`` and either ``text`` or ``packed``."""
    source = "packed" if "packed" in texts.columns else "text"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_bytes", "first", "number", "distance", "anchor", "whole"]
        for batch in batches:
            for part in slices(batch, source, 1 << 20):
                columns = [[] for _ in names]
                for text, key in zip(part.column(source).to_pylist(), part.column("key").to_pylist(), strict=True):
                    if source == "packed":
                        data = _unpacked(text)
                    else:
                        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                    if len(data) >= threshold:
                        found = find_runs(data, threshold)
                        n = len(found[0])
                        for column, values in zip(columns, (np.full(n, key), np.full(n, len(data)), *found), strict=True):
                            column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([*c, np.zeros(0, np.int64)]), pa.int64()) for c in columns], names
                )

    return texts.select("key", source).mapInArrow(find, "key long, n_bytes long, first long, number long, distance long, anchor long, whole long")


def _twice(rows: DataFrame, keys: list[str], spot: Column) -> DataFrame:
    """The keys found at two different spots; the counting is done before the shuffle where it can be."""
    seen = rows.groupBy(*keys).agg(F.min(spot).alias("_low"), F.max(spot).alias("_high"))
    return seen.filter("_low < _high").select(*keys)


def _judged(rows: DataFrame, key: list[str], part: list[str], spot: Column, name: str) -> DataFrame:
    """Mark rows whose whole ``key`` is found twice, and those that the next digit has to compare.

    Compared are rows found once, and one row of each key found twice, where both
    share ``part``: the first of a key stands for its equals, however many.
    """
    seen = rows.groupBy(*key).agg(F.min(spot).alias("_low"), F.max(spot).alias("_high"))
    seen = materialise(seen, name)
    alone = materialise(seen.filter("_low = _high").select(*part).distinct().withColumn("_open", F.lit(True)), f"{name}-open")
    marked = rows.withColumn("_spot", spot).join(seen, key).join(alone, part, "left")
    repeated = F.col("_low") < F.col("_high")
    first = ~repeated | (F.col("_spot") == F.col("_low"))
    return marked.select(
        *rows.columns, repeated.alias("repeated"), (F.col("_open").isNotNull() & first).alias("compared")
    )


def _lists(batch: pa.RecordBatch, column: str) -> list[dict[str, np.ndarray]]:
    """For each row, the fields of a list of structs as arrays; a null list is empty."""
    lists = batch.column(column)
    ends = np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy())
    flat = lists.flatten()
    fields = {f.name: v.to_numpy(zero_copy_only=False) for f, v in zip(flat.type, flat.flatten(), strict=True)}
    starts = ends - np.diff(ends, prepend=0)
    return [{name: v[s:e] for name, v in fields.items()} for s, e in zip(starts, ends, strict=True)]


def _texts_of(batch: pa.RecordBatch, most: int = 64) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, most):
        yield batch.slice(start, most)


def _blocks(texts: DataFrame, threshold: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_bytes", "anchor", "at", "index", "low", "high", "inner", "outer"]
        for batch in batches:
            for part in _texts_of(batch):
                columns, known = [[] for _ in names], []
                keys, sizes = part.column("key").to_pylist(), part.column("n_bytes").to_pylist()
                for key, n_bytes, packed, runs in zip(keys, sizes, part.column("packed").to_pylist(), _lists(part, "runs"), strict=True):
                    runs = {name: values[runs["compared"]] for name, values in runs.items()}
                    run, index, low, high, inner, outer, fits = block_hashes(
                        Windows(_unpacked(packed)), n_bytes, runs["first"], runs["number"], runs["distance"], threshold
                    )
                    n, at = len(run), (runs["first"] + runs["distance"])[run]
                    values = (np.full(n, key), np.full(n, n_bytes), runs["anchor"][run], at, index, low, high, inner, outer)
                    for column, more in zip(columns, values, strict=True):
                        column.append(more)
                    known.append(fits)
                arrays = [pa.array(np.concatenate([*c, np.zeros(0, np.int64)]), pa.int64()) for c in columns]
                if known:
                    arrays[-1] = pa.array(np.concatenate(columns[-1]), pa.int64(), mask=~np.concatenate(known))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return texts.select("key", "n_bytes", "packed", "runs").mapInArrow(
        cut, "key long, n_bytes long, anchor long, at long, index long, low long, high long, inner long, outer long"
    )


def _suffixes(texts: DataFrame, threshold: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_bytes", "anchor", "distance", "start", "hash_a", "hash_b"]
        for batch in batches:
            for part in _texts_of(batch):
                keys, sizes = part.column("key").to_pylist(), part.column("n_bytes").to_pylist()
                for key, n_bytes, packed, spans in zip(keys, sizes, part.column("packed").to_pylist(), _lists(part, "blocks"), strict=True):
                    windows, low = Windows(_unpacked(packed)), spans["low"]
                    counts = spans["high"] - low + 1
                    block = np.repeat(np.arange(len(low)), counts)
                    starts = np.arange(len(block)) - np.repeat(np.cumsum(counts) - counts, counts) + low[block]
                    order = np.argsort(starts, kind="stable")
                    block, starts = block[order], starts[order]
                    hashes = [windows.hashes(starts, starts + threshold, base).view(np.int64) for base in (0, 1)]
                    n, anchors = len(starts), spans["anchor"][block]
                    columns = [np.full(n, key), np.full(n, n_bytes), anchors, spans["at"][block] - starts, starts, *hashes]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return texts.select("key", "n_bytes", "packed", "blocks").mapInArrow(
        cut, "key long, n_bytes long, anchor long, distance long, start long, hash_a long, hash_b long"
    )


def _packed(docs: DataFrame, asked: DataFrame, threshold: int) -> DataFrame:
    """The texts of the asked (key, n_bytes, least_id), compressed, with the other columns of ``asked``."""
    named = docs.select("doc_id", text_or_empty().alias("text")).withColumns(
        {"key": text_key(F.col("text")), "n_bytes": F.octet_length("text").cast("long")}
    )
    doc_id = named.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in slices(batch, "text"):
                packed = [squeeze.compress(t.encode("utf-8", "surrogatepass")) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), part.column("n_bytes"), pa.array(packed, pa.binary())],
                    ["doc_id", "key", "n_bytes", "packed"],
                )

    # Packed before the shuffle. The id is part of the join, so that many copies of a text are no hot key.
    long = named.filter(F.col("n_bytes") >= threshold)
    small = long.mapInArrow(pack, f"doc_id {doc_id}, key long, n_bytes long, packed binary")
    wanted = asked.select(F.col("key").alias("_key"), F.col("n_bytes").alias("_n"), *[c for c in asked.columns if c not in ("key", "n_bytes")])
    same = (F.col("key") == F.col("_key")) & (F.col("n_bytes") == F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("least_id"))
    return small.join(wanted, same).drop("_key", "_n", "doc_id", "least_id")


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.uint8)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the intervals."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[fresh], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)]


def _cut_texts(texts: DataFrame, threshold: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _texts_of(batch):
                out = []
                keys, sizes, packed = (part.column(c).to_pylist() for c in ("key", "n_bytes", "packed"))
                for key, n_bytes, data, runs, found in zip(
                    keys, sizes, packed, _lists(part, "runs"), _lists(part, "found"), strict=True
                ):
                    whole = runs["repeated"]
                    low = np.concatenate([runs["first"][whole], found["low"]])
                    if not len(low):
                        continue
                    high = np.concatenate([(runs["first"] + runs["number"] - 1)[whole], found["high"]])
                    starts, ends = merged(low, high + threshold)
                    text, kept, place = zstandard.decompress(data), hashlib.sha256(), 0
                    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                        kept.update(text[place:start])
                        place = end
                    kept.update(text[place:])
                    spans = [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    out.append({"key": key, "n_bytes": n_bytes, "spans": spans, "kept_sha256": kept.hexdigest()})
                yield pa.RecordBatch.from_pylist(out, _CUT)

    chosen = texts.select("key", "n_bytes", "packed", "runs", "found")
    return chosen.mapInArrow(cut, "key long, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string")


_CUT = pa.schema(
    [
        ("key", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept_sha256", pa.string()),
    ]
)


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The bytes of each distinct text that lie in strings of ``threshold`` bytes found elsewhere.

    Returns key, n_bytes, spans (start, end in bytes; maximal), kept_sha256, for
    texts that lose something. A text held by several documents is found elsewhere
    as a whole.
    """
    return _first_sort(docs, threshold)[0]


def repeated_spans_at(docs: DataFrame, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """``repeated_spans`` at two depths for little more than the cost of the lower one.

    A string of ``high`` bytes that is found twice lies, both times, inside a run of
    bytes found at ``low``. So the sort goes on to the greater depth only in texts
    with such a run of ``high`` bytes or more, which are at hand, compressed.
    """
    spans, texts, touched = _first_sort(docs, low)
    deep = texts.filter(F.col("n_bytes") >= high)
    if touched is None:
        return spans, spans.filter(F.col("n_bytes") >= high)
    long = spans.filter(F.exists("spans", lambda s: s["end"] - s["start"] >= high)).select("key", "n_bytes")
    near = materialise(touched.drop("runs").join(long, ["key", "n_bytes"], "left_semi"), "texts-going-on")
    runs = _runs(near, high)
    return spans, _sort(deep, runs, lambda asked: near.join(asked.drop("least_id"), ["key", "n_bytes"]), high)[0]


def _first_sort(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The spans, the distinct texts, and the compressed texts that were looked into (None: not one)."""
    if threshold < ANCHOR + 2 * BLOCK:
        raise ValueError(f"a repeated string must have {ANCHOR + 2 * BLOCK} bytes at least")
    named = docs.select("doc_id", text_or_empty().alias("text")).withColumn("key", text_key(F.col("text")))
    texts = named.groupBy("key", F.octet_length("text").cast("long").alias("n_bytes")).agg(
        F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    texts = materialise(texts.filter(F.col("n_bytes") >= threshold), "texts")
    runs = _runs(named.filter(F.octet_length("text") >= threshold), threshold)
    spans, touched = _sort(texts, runs, lambda asked: _packed(docs, asked, threshold), threshold, True)
    return spans, texts, touched


def _sort(
    texts: DataFrame,
    runs: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    threshold: int,
    repeated_texts: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """The spans of ``texts`` by all digits; ``fetch`` brings the compressed texts of those asked for.

    ``repeated_texts``: the runs of a text are listed once for each of its copies.
    Each digit's rows are removed once those still together are written: the runs of
    all texts, most of which stand alone, are the largest table.
    """
    copied = texts.filter("copies > 1").select(
        "key",
        "n_bytes",
        F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"),
        F.sha2(F.lit(b""), 256).alias("kept_sha256"),
    )
    spot = F.xxhash64("key", "n_bytes", F.col("first") + F.col("distance"))
    with scratch():
        # First digit.
        with scratch():
            runs = materialise(runs, "runs")
            anchors = materialise(_twice(runs, ["anchor"], spot), "anchors")
            if anchors.isEmpty():
                together = None
            else:
                # Copies of a text are dropped after the join and by themselves: a join that deals rows
                # for the step after it cannot be split where one anchor is in very many texts.
                together = materialise(runs.join(anchors, "anchor"), "runs-together", keep=True)
        if together is not None:
            if repeated_texts:
                together = materialise(together.distinct(), "distinct-runs")
            # Second digit.
            run_key = ["anchor", "distance", "number", "whole"]
            judged = _judged(together, run_key, ["anchor"], spot, "whole-runs")
            lists = judged.groupBy("key", "n_bytes").agg(
                F.collect_list(F.struct("first", "number", "distance", "anchor", "repeated", "compared")).alias("runs")
            )
            asked = materialise(lists.join(texts.select("key", "n_bytes", "least_id"), ["key", "n_bytes"]), "run-lists")
            touched = materialise(fetch(asked), "touched-texts", keep=True)
    if together is None:
        return materialise(copied, "spans"), None
    with scratch():
        # Third digit.
        blocks = materialise(_blocks(touched.filter(F.exists("runs", lambda r: r["compared"])), threshold), "blocks")
        spot = F.xxhash64("key", "n_bytes", "at")
        inner = materialise(_twice(blocks, ["anchor", "index", "inner"], spot), "inner-blocks")
        shared = materialise(blocks.join(inner, ["anchor", "index", "inner"]), "blocks-together")
        # A block that would reach over its text's end has no equal outer bytes: it gets a place of its own.
        shared = shared.withColumn("outer", F.coalesce("outer", F.xxhash64("key", "n_bytes", "at", "index")))
        judged = _judged(shared, ["anchor", "index", "inner", "outer"], ["anchor", "index", "inner"], spot, "outer-blocks")
        judged = materialise(judged, "judged-blocks", keep=True)
    with scratch():
        # Last digit.
        left = judged.filter("compared").groupBy("key", "n_bytes").agg(
            F.collect_set(F.struct("anchor", "at", "low", "high")).alias("blocks")
        )
        open_texts = touched.drop("runs").join(left, ["key", "n_bytes"])
        suffixes = materialise(_suffixes(open_texts, threshold), "suffixes")
        suffix_key = ["anchor", "distance", "hash_a", "hash_b"]
        again = materialise(_twice(suffixes, suffix_key, F.xxhash64("key", "n_bytes", "start")), "equal-suffixes")
        single = suffixes.join(again, suffix_key).select("key", "n_bytes", F.col("start").alias("low"), F.col("start").alias("high"))
        single = materialise(single, "repeated-suffixes", keep=True)
    found = judged.filter("repeated").select("key", "n_bytes", "low", "high").unionByName(single)
    found = found.groupBy("key", "n_bytes").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    cut = _cut_texts(touched.join(found, ["key", "n_bytes"], "left"), threshold)
    alone = cut.join(texts.filter("copies = 1").select("key", "n_bytes"), ["key", "n_bytes"], "left_semi")
    return materialise(alone.unionByName(copied).dropDuplicates(["key", "n_bytes"]), "spans"), touched


def find_repeats(docs: DataFrame, threshold: int = THRESHOLD, passage: int | None = None) -> DataFrame:
    """What every document loses: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Removed are the bytes covered by a string of ``threshold`` bytes that also
    starts anywhere else, in another document or the same, overlaps included;
    strings are judged on the input. With ``passage``, a smaller number of bytes,
    n_passage_bytes and passages (their spans) tell the same at that depth. A null
    text is empty: 0 bytes, nothing removed. Texts shorter than the threshold lose
    nothing. Repeated rows count as documents of their own and so lose their whole
    text; null doc_ids keep a row each. An empty table gives no rows. A long text
    is hashed in segments; it is never cut short.
    """
    if passage is None:
        spans = repeated_spans(docs, threshold)
    else:
        shorter, spans = repeated_spans_at(docs, passage, threshold)
        shorter = shorter.select("key", "n_bytes", F.col("spans").alias("passages"))
        spans = materialise(shorter.join(spans, ["key", "n_bytes"], "left"), "spans-at-depths")
    text = text_or_empty()
    known = docs.select(
        "doc_id", text_key(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(F.encode(text, "UTF-8"), 256).alias("sha256")
    )
    joined = known.join(spans, ["key", "n_bytes"], "left")

    def covered(column: str) -> Column:
        return F.coalesce(F.aggregate(column, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]), F.lit(0).cast("long"))

    more = [] if passage is None else [covered("passages").alias("n_passage_bytes"), "passages"]
    return joined.select(
        "doc_id",
        "n_bytes",
        covered("spans").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        "spans",
        *more,
    )


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts, every row kept.

    A character goes if all its bytes are removed. Untouched texts, null ones
    included, stay as they are; an n_chars column follows the text. Null and
    repeated doc_ids are rows like others, and rows with one text lose all of it.
    An empty table gives no rows.
    """
    spans = repeated_spans(docs, threshold).select("key", "n_bytes", "spans")
    text = text_or_empty()
    rows = docs.select(
        F.struct("*").alias("row"), text_key(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    joined = rows.join(spans, ["key", "n_bytes"], "left").select("row", F.col("row.text").alias("text"), "spans")
    kind = joined.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut_text(t, s) if s else t
                for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    done = joined.mapInArrow(cut, f"row {kind}, text string")
    changed = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {})
    return done.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def cut_text(text: str, spans: list[dict]) -> str:
    data, kept, place = text.encode("utf-8", "surrogatepass"), [], 0
    for span in spans:
        start, end = span["start"], span["end"]
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end < len(data) and end > start and data[end] & 0xC0 == 0x80:
            end -= 1
        kept.append(data[place:start])
        place = end
    return b"".join([*kept, data[place:]]).decode("utf-8", "surrogatepass")
