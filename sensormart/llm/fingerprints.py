"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. On each level equal neighbours become one run;
deterministic coin tossing then turns every symbol, by the lowest bit in which it
differs from its left neighbour, into one of a few labels, and a phrase begins
where a label is greater than both beside it. A phrase's name, a hash of its
symbols, is a symbol of the next level. Where a phrase begins depends on a few
symbols on each side only, so equal substrings share all phrases but those near
their ends, at any offset.

A fingerprint keeps ``KEEP`` of the names of all levels, those with the smallest
hash divided by the phrase's length: long phrases are likelier to be kept, and
each level has about the same share. Names kept of two texts together are a
sample of both, so the part that both hold tells how much text they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensormart.llm.common import slices, text_or_empty
from sensormart.session import materialise

#: Names in a fingerprint.
KEEP = 32
#: Texts up to so many characters keep all names until the last choice.
SHORT = 2000
#: Characters parsed together, and symbols looked at in one step.
BATCH, STEP = 1 << 20, 1 << 16
#: An odd number whose powers tell the places inside a phrase apart, and its inverses.
_BASE = 0x9E3779B97F4A7C15
_ROOM = 2 * STEP
_POWERS = np.multiply.accumulate(np.full(_ROOM, _BASE, np.uint64))
_INVERSES = np.multiply.accumulate(np.full(_ROOM, pow(_BASE, -1, 1 << 64), np.uint64))


def _hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tossed(own: int, left: int) -> int:
    """Twice the place of the lowest bit that differs, plus that bit of ``own``."""
    differ = own ^ left
    place = (differ & -differ).bit_length() - 1 if differ else 0
    return 2 * place + (own >> place & 1)


#: The same for labels, which fit a byte.
_TOSSED = np.array([_tossed(own, left) for own in range(256) for left in range(256)], np.uint8)


# -- parsing -----------------------------------------------------------------
def _labels(names: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Labels 0 to 5; neighbours inside a text differ. A symbol depends on four to its left."""
    n = len(names)
    labels = np.empty(n, np.uint8)
    at = np.searchsorted(begins, np.arange(0, n + STEP, STEP))
    for number, start in enumerate(range(0, n, STEP)):
        # Four symbols further left, whose own labels are not used.
        low, end = max(0, start - 4), min(n, start + STEP)
        part = names[low:end]
        left = np.empty_like(part)
        left[1:], left[0] = part[:-1], 0
        first = begins[at[number] : at[number + 1]] - low
        early = begins[np.searchsorted(begins, low) : at[number]] - low
        first = np.concatenate([early, first])
        left[first] = 0
        differ = part ^ left
        place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
        label = 2 * place + ((part >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
        for _ in range(3):
            pair = label.astype(np.uint16) << 8
            pair[1:] |= label[:-1]
            pair[0] |= label[0] ^ 1
            pair[first] = (label[first].astype(np.uint16) << 8) | (label[first] ^ 1)
            label = _TOSSED[pair]
        labels[start:end] = label[start - low :]
    return labels


def parse_level(
    names: np.ndarray, lengths: np.ndarray, begins: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The phrases of texts laid end to end: names, lengths in characters, where each text begins.

    ``begins`` holds the first symbol of each text; no text is empty.
    """
    # Runs of one symbol.
    fresh = np.append(True, names[1:] != names[:-1])
    fresh[begins] = True
    heads = np.flatnonzero(fresh)
    if len(heads) < len(names):
        runs = np.diff(np.append(heads, len(names)))
        lengths = np.add.reduceat(lengths, heads)
        names = names[heads]
        long = runs > 1
        names[long] = _hash(names[long] ^ _hash(runs[long].astype(np.uint64)))
        begins = np.searchsorted(heads, begins)
    # Phrases: at least two symbols each, but for a text of one.
    n = len(names)
    labels = _labels(names, begins)
    cut = np.zeros(n, bool)
    cut[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    ends = np.append(begins[1:], n)
    cut[np.minimum(begins + 1, n - 1)] = False
    cut[ends - 1] = False
    cut[begins] = True
    starts = np.flatnonzero(cut)
    begins = np.searchsorted(starts, begins)
    return _phrase_names(names, starts), np.add.reduceat(lengths, starts), begins


def _phrase_names(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    found = np.empty(len(starts), np.uint64)
    steps = np.append(np.searchsorted(starts, np.arange(0, len(names), STEP)), len(starts))
    for first, last in zip(steps[:-1], steps[1:], strict=True):
        if first == last:
            continue
        low, end = starts[first], starts[last] if last < len(starts) else len(names)
        here = starts[first:last] - low
        sums = np.add.reduceat(names[low:end] * _POWERS[: end - low], here)
        found[first:last] = _hash(sums * _INVERSES[here])
    return found


def phrases(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level: text number, name and length of every phrase; texts may be empty.

    A text goes on until it is one phrase.
    """
    counts = np.array([len(t) for t in texts])
    numbers = np.flatnonzero(counts)
    if not len(numbers):
        return
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    names = _hash(codes + np.uint64(1 << 32))
    lengths = np.ones(len(names), np.int64)
    begins = np.cumsum(counts[numbers]) - counts[numbers]
    while len(numbers):
        names, lengths, begins = parse_level(names, lengths, begins)
        sizes = np.diff(np.append(begins, len(names)))
        yield np.repeat(numbers, sizes), names, lengths
        going = sizes > 1
        if not going.all():
            kept = np.repeat(going, sizes)
            names, lengths, numbers, sizes = names[kept], lengths[kept], numbers[going], sizes[going]
            begins = np.cumsum(sizes) - sizes


# -- fingerprints ------------------------------------------------------------
def _keys(names: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (a uniform number over the length) and sortable keys: the rank, then 32 bits of the name."""
    rank = ((names >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53 / lengths
    bits = rank.astype(np.float32).view(np.uint32).astype(np.uint64)
    return rank, (bits << np.uint64(32)) | (names & np.uint64(0xFFFFFFFF))


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The ``KEEP`` smallest keys of each text, ascending; fewer where there are fewer names."""
    found: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= BATCH):
            size += len(texts[end])
            end += 1
        found[start:end] = _fingerprints(texts[start:end])
        start = end
    return found


def _fingerprints(texts: list[str]) -> list[np.ndarray]:
    counts = np.array([len(t) for t in texts], np.float64)
    # Of n characters, each level has phrases of n characters together: a bar lets about
    # four times the wanted names through, and where too few came, it is raised.
    bars = np.where(counts <= SHORT, np.inf, 4 * KEEP / np.maximum(counts, 1) / np.maximum(np.log(np.maximum(counts, 3)), 1))
    found = _below(texts, bars)
    few = [i for i, keys in enumerate(found) if len(keys) < KEEP and np.isfinite(bars[i])]
    if few:
        for i, keys in zip(few, _below([texts[i] for i in few], np.full(len(few), np.inf)), strict=True):
            found[i] = keys
    return found


def _below(texts: list[str], bars: np.ndarray) -> list[np.ndarray]:
    numbers, keys = [], []
    for number, names, lengths in phrases(texts):
        rank, key = _keys(names, lengths)
        kept = rank <= bars[number]
        numbers.append(number[kept])
        keys.append(key[kept])
    if not keys:
        return [np.zeros(0, np.uint64)] * len(texts)
    number, key = np.concatenate(numbers), np.concatenate(keys)
    order = np.lexsort((key, number))
    number, key = number[order], key[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (number[1:] != number[:-1]))[: len(key)]
    number, key = number[fresh], key[fresh]
    begins = np.searchsorted(number, np.arange(len(texts)))
    ends = np.searchsorted(number, np.arange(len(texts)), "right")
    return [key[b : min(e, b + KEEP)] for b, e in zip(begins, ends, strict=True)]


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of the smallest keys of both together that lies in both; 1 for two empty texts."""
    both = np.union1d(one, other)[:KEEP]
    if not len(both):
        return 1.0
    shared = np.isin(both, one, assume_unique=True) & np.isin(both, other, assume_unique=True)
    return float(shared.mean())


def _bytes(keys: np.ndarray) -> bytes:
    return keys.astype(">u8").tobytes()


def _from_bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u8").astype(np.uint64)


# -- operators ---------------------------------------------------------------
def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (lowercase hex) of every whole text, without a shuffle.

    Equal texts have equal fingerprints. A null text is empty and has the empty
    fingerprint. Null and repeated ids keep a row each; other columns are not
    read; an empty table gives no rows. A text needs about 40 bytes of memory a
    character while it is parsed.
    """
    narrow = docs.select("doc_id", text_or_empty().alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = fingerprints(part.column("text").to_pylist())
                prints = pa.array([_bytes(keys).hex() for keys in found], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), prints], ["doc_id", "fingerprint"])

    doc_id = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(parse, f"doc_id {doc_id}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the start of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_RESULT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [column.split()[0] for column in _RESULT.split(", ")]


def _compared(texts: list[str], following: list[str], own: list[np.ndarray], others: list[np.ndarray]) -> list[pa.Array]:
    """The result columns of texts and of the ones that follow them, given both fingerprints."""
    edited = [edited_text(text, after) for text, after in zip(texts, following, strict=True)]
    changed = fingerprints(edited)
    columns = [
        [len(t) for t in texts],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        [_bytes(keys) for keys in own],
        [_bytes(keys) for keys in changed],
        [likeness(a, b) for a, b in zip(own, changed, strict=True)],
        [likeness(a, b) for a, b in zip(own, others, strict=True)],
    ]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]


def _in_order(ordered: DataFrame) -> DataFrame:
    """Compare each text with the next one of its partition.

    The first and the last row of a partition carry their text in ``edge_text``;
    the last one's comparison is left open (null ``n_chars``).
    """
    doc_id = ordered.schema["doc_id"].dataType.simpleString()

    def row(place, ids, columns, first, last, texts) -> pa.RecordBatch:
        edges = [pa.array(v, k) for v, k in ((first, pa.bool_()), (last, pa.bool_()), (texts, pa.string()))]
        part = pa.array([place] * len(first), pa.int32())
        return pa.RecordBatch.from_arrays(
            [part, ids, *columns, *edges], ["part", "doc_id", *_NAMES, "first", "last", "edge_text"]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held = None  # id, text and fingerprint of the row before
        begun = False
        for batch in batches:
            for part in slices(batch, "text"):
                texts, ids = part.column("text").to_pylist(), part.column("doc_id")
                own = fingerprints(texts)
                if held is not None:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, own = [held[1], *texts], [held[2], *own]
                held = (ids.slice(len(ids) - 1), texts[-1], own[-1])
                n = len(texts) - 1
                if n:
                    columns = _compared(texts[:-1], texts[1:], own[:-1], own[1:])
                    first = [not begun] + [False] * (n - 1)
                    edge = [None if begun else texts[0]] + [None] * (n - 1)
                    begun = True
                    yield row(place, ids.slice(0, n), columns, first, [False] * n, edge)
        if held is not None:
            none = [pa.nulls(1, k) for k in (pa.int64(), pa.string())]
            rest = [pa.array([_bytes(held[2])], pa.binary()), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.float64())] * 2]
            yield row(place, held[0], [*none, *rest], [not begun], [True], [held[1]])

    return ordered.mapInArrow(
        compare, f"part int, doc_id {doc_id}, {_RESULT}, first boolean, last boolean, edge_text string"
    )


def _at_seams(compared: DataFrame) -> DataFrame:
    """The last row of each partition, compared with the first row of the next one (and the very last
    with the very first). Two texts a partition are joined, and one number each is put in order."""
    firsts = compared.filter("first").select(
        F.col("part").alias("next_part"), F.col("edge_text").alias("following"), F.col("fingerprint").alias("other")
    )
    numbers = compared.filter("first").select("part")
    least = numbers.agg(F.min("part")).scalar()
    order = numbers.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), least).alias("next_part"))
    lasts = compared.filter("last").select("part", "doc_id", "edge_text", "fingerprint")
    pairs = lasts.join(order, "part").join(firsts, "next_part")
    doc_id = compared.schema["doc_id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "edge_text"):
                texts, following, own, other = (
                    part.column(c).to_pylist() for c in ("edge_text", "following", "fingerprint", "other")
                )
                columns = _compared(texts, following, [_from_bytes(b) for b in own], [_from_bytes(b) for b in other])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *_NAMES])

    chosen = pairs.select("doc_id", "edge_text", "fingerprint", "following", "other")
    return chosen.mapInArrow(compare, f"doc_id {doc_id}, {_RESULT}")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts, of edited ones, and how alike they and the next texts are.

    The next document is the one with the next larger doc_id, after the last the
    first; null ids come first, and equal ids in the order of their texts' hashes,
    so that reruns agree. The edited text is the text with its last
    floor(n_chars / 4) characters replaced by as many from the start of the next
    one (or all, if it is shorter). Returns doc_id, n_chars, edited_sha256 (of the
    UTF-8 bytes), fingerprint, edited_fingerprint (lowercase hex), near_edited,
    near_next (see ``likeness``). A null text is empty; a single document follows
    itself; other columns are not read; an empty table gives no rows.

    Texts are shuffled once, by ranges of id, hash and input place: many rows of
    one id, null included, are split, and rows with all three but the place alike
    give the same results in any order.
    """
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    keyed = narrow.withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    keys = ["doc_id", "_hash", "_place"]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    compared = materialise(_in_order(ordered), "fingerprints")
    whole = compared.filter("NOT last").select("doc_id", *_NAMES).unionByName(_at_seams(compared))
    prints = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return whole.withColumns(prints)
