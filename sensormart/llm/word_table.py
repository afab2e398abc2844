"""Token ids of many texts at once, their words looked up in arrays.

Words are what lies between single spaces and line feeds, as in ``pieces``. A
word is known by a 64-bit hash of its bytes and of what stands in front of it; a
table of hashes, open addressed, gives its ids in a pool. Words not met before
are encoded by the tokenizers library, all of a batch together. Texts with other
white space, special strings or very long words are left to ``pieces``.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

from sensormart.llm.pieces import _AS_IS, IdEncoder, _Generation

#: Bytes of a word that is kept, in eights.
LONGEST = 40
#: Words in the table; beyond it, the table starts anew. Its arrays then hold some 60 MB, and they
#: stay in the worker while it runs other tasks; so do so many bytes of pieces of odd texts.
MOST_WORDS, ROOM = 1 << 20, 32 << 20
#: What stands in front of a word: the text's start, a space, a line feed.
_START, _SPACE, _LINE = 0, 1, 2
_FRONT = (_AS_IS, "", "\n")
#: Numbers of values: no ids; a word that was cut wrongly.
_NOTHING, _ROUGH = 0, 1
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def _fold(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    return (h ^ (h >> np.uint64(29))) * _ODD[1]


class WordTable:
    """Ids of texts by a table of words that lives as long as the worker."""

    def __init__(self, path: str) -> None:
        self.words, self.texts = IdEncoder(path), IdEncoder(path, room=ROOM)
        self._clear(16)

    def _clear(self, bits: int) -> None:
        self.hashes, self.numbers = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.pool, self.used = np.zeros(1 << 18, np.uint16), 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.count = _ROUGH + 1

    # -- table ---------------------------------------------------------------
    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the values, -1 where a word is not known."""
        mask = np.uint64(len(self.hashes) - 1)
        found = np.full(len(hashes), -1, np.int32)
        open_, place = np.arange(len(hashes)), hashes & mask
        while len(open_):
            seen = self.hashes[place]
            hit = seen == hashes[open_]
            found[open_[hit]] = self.numbers[place[hit]]
            further = ~hit & (seen != 0)
            open_, place = open_[further], (place[further] + np.uint64(1)) & mask
        return found

    def _put(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Insert distinct hashes that are not in the table."""
        mask = np.uint64(len(self.hashes) - 1)
        place = hashes & mask
        while len(hashes):
            free = self.hashes[place] == 0
            self.hashes[place[free]] = hashes[free]
            # Of several that wanted one place, one got it.
            done = self.hashes[place] == hashes
            self.numbers[place[done]] = numbers[done]
            hashes, numbers, place = hashes[~done], numbers[~done], (place[~done] + np.uint64(1)) & mask

    def _grow(self, more: int) -> None:
        size = len(self.hashes)
        while self.count + more > size // 2:
            size *= 2
        if size > len(self.hashes):
            kept = self.hashes != 0
            hashes, numbers = self.hashes[kept], self.numbers[kept]
            self.hashes, self.numbers = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._put(hashes, numbers)

    def _learn(self, keys: list[str]) -> np.ndarray:
        """Numbers of the values of new words, which are added to the pool."""
        # Only the table remembers: nothing else is kept of the words.
        self.words.new, self.words.old, self.words.size = _Generation(), {}, 0
        rough = self.words._learn([keys])
        values = [self.words.new.get(key, b"") for key in keys]
        self.words.new, self.words.passing = _Generation(), []
        sizes = np.array([len(v) for v in values], np.int64) // 2
        ids = np.frombuffer(b"".join(values), "<u2")
        numbers = np.arange(self.count, self.count + len(keys), dtype=np.int32)
        for name, used, more in (("pool", self.used, len(ids)), ("starts", self.count, len(keys)), ("lengths", self.count, len(keys))):
            old = getattr(self, name)
            if used + more > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old), more), old.dtype)]))
        self.pool[self.used : self.used + len(ids)] = ids
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.lengths[numbers] = sizes
        self.used, self.count = self.used + len(ids), self.count + len(keys)
        if rough:
            numbers[[key in rough for key in keys]] = _ROUGH
        return numbers

    # -- texts ---------------------------------------------------------------
    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end (16 bits), and how many each text has."""
        if self.count > MOST_WORDS:
            self._clear(16)
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        whole = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        # Room behind the last word, to read it in eights.
        data = np.concatenate([whole[offsets[0] : offsets[-1]], np.zeros(LONGEST + 8, np.uint8)])
        offsets = offsets - offsets[0]
        size, many = int(offsets[-1]), len(texts)
        if not many:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        text, n = data[:size], size
        line = text == 10
        cuts = np.flatnonzero(line | (text == 32))
        before = np.searchsorted(cuts, offsets)
        owner = np.repeat(np.arange(many), np.diff(before))
        # Every text has one word more than cuts.
        first = np.arange(many) + before[:-1]
        behind = np.arange(len(cuts)) + owner + 1
        start, front = np.zeros(many + len(cuts), np.int64), np.zeros(many + len(cuts), np.uint8)
        start[first], start[behind] = offsets[:-1], cuts + 1
        front[behind] = np.where(line[cuts], _LINE, _SPACE)
        end = np.append(start[1:] - 1, 0)
        end[np.append(first[1:], len(start)) - 1] = offsets[1:]
        length = end - start
        slow = np.zeros(many, bool)
        special = np.flatnonzero((text == 0) | ((text == 60) & (data[1 : n + 1] == 124)))
        slow[np.searchsorted(offsets, special, "right") - 1] = True
        odd = ((length == 0) & (front != _START)) | (length > LONGEST)
        number = np.full(len(start), _NOTHING, np.int32)
        chosen = np.flatnonzero((length > 0) & (length <= LONGEST))
        number[chosen] = self._numbers(data, start[chosen], length[chosen], front[chosen])
        odd |= number == _ROUGH
        slow |= np.logical_or.reduceat(odd, first)
        sizes = self.lengths[number].astype(np.int64)
        if slow.any():
            sizes[np.repeat(slow, np.diff(np.append(first, len(start))))] = 0
        counts = np.add.reduceat(sizes, first)
        total = int(sizes.sum())
        shift = np.repeat(self.starts[number] - (np.cumsum(sizes) - sizes), sizes)
        ids = self.pool[shift + np.arange(total)]
        if slow.any():
            return self._with_slow(texts, slow, ids, counts)
        return ids, counts

    def _numbers(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, front: np.ndarray) -> np.ndarray:
        eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        hashes = _fold((length.astype(np.uint64) << np.uint64(2)) | front)
        rest = np.arange(len(start))
        for at in range(0, LONGEST, 8):
            rest = rest[length[rest] > at] if at else rest
            if not len(rest):
                break
            part = eights[start[rest] + at] & _MASKS[np.minimum(length[rest] - at, 8)]
            hashes[rest] = _fold(hashes[rest] ^ part)
        hashes[hashes == 0] = 1
        number = self._find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, example, which = np.unique(hashes[new], return_index=True, return_inverse=True)
            example = new[example]
            raw = data.tobytes()
            spans = zip(start[example].tolist(), (start + length)[example].tolist(), front[example].tolist(), strict=True)
            numbers = self._learn([_FRONT[f] + raw[s:e].decode("utf-8", "surrogatepass") for s, e, f in spans])
            self._grow(0)
            self._put(distinct, numbers)
            number[new] = numbers[which]
        return number

    def _with_slow(self, texts: pa.Array, slow: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen = np.flatnonzero(slow)
        found = self.texts.encode([t.decode("utf-8", "surrogatepass") for t in texts.take(pa.array(chosen)).to_pylist()])
        counts = counts.copy()
        counts[chosen] = [len(value) // 2 for value in found]
        every = np.empty(int(counts.sum()), np.uint16)
        every[np.repeat(~slow, counts)] = ids
        ends = np.cumsum(counts)
        for n, value in zip(chosen, found, strict=True):
            every[ends[n] - counts[n] : ends[n]] = np.frombuffer(value, "<u2")
        return every, counts


@functools.cache
def worker_table(path: str) -> WordTable:
    """The table of this worker process: it outlives a task, not the process."""
    return WordTable(path)


def give_back() -> None:
    """Return freed memory to the system at a task's end: the worker stays beside other work.

    Where the C library cannot trim its heap, nothing happens.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def split_ids(ids: np.ndarray, counts: Sequence[int]) -> list[np.ndarray]:
    """The ids of each text."""
    ends = np.cumsum(counts).tolist()
    return [ids[end - n : end] for end, n in zip(ends, np.asarray(counts).tolist(), strict=True)]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids as unsigned 32-bit numbers, ``end_id`` behind each text, and the new counts."""
    counts = counts + 1
    every = np.empty(int(counts.sum()), "<u4")
    last = np.zeros(len(every), bool)
    last[np.cumsum(counts) - 1] = True
    every[last], every[~last] = end_id, ids
    return every, counts
