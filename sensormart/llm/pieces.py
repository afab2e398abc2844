"""Token ids of whole texts by the tokenizers library, with repeated pieces encoded once.

Both tokenizers used here split a text at white space before they apply their
merges, so the ids of a text are the ids of its pieces one after the other. A
piece is a run of other characters with the white space character in front of
it, or a run of white space up to its last character. Each piece is encoded by
the library itself; a worker keeps the answers in a bounded cache. Texts with
special tokens or NUL characters are handed to the library whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import sys
from collections import deque
from collections.abc import Iterable

import numpy as np

#: The characters with Unicode's White_Space property.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECES = re.compile(f"[{SPACES}]?[^{SPACES}]+|[{SPACES}]+(?=[{SPACES}][^{SPACES}])|[{SPACES}]+")
#: In front of a key: encode the piece as it stands, without a space before it.
_AS_IS = "\0"
#: Bytes of a worker's cache, about, in two generations; longer pieces are not kept.
ROOM = 192 << 20
KEPT = 40
#: What an entry takes beside its piece and its value.
_ENTRY = 120
_CUT = frozenset(".,;:!?")
#: Letters below it are Latin.
_LATIN = "ɐ"


@functools.cache
def word_ends(path: str) -> tuple[np.ndarray, np.ndarray]:
    """For each id, whether it begins with a space, and whether it ends a word.

    Byte-level vocabularies mark the first, those with word ends the second.
    """
    vocabulary = load_tokenizer(path).get_vocab()
    first, last = (np.zeros(max(vocabulary.values()) + 1, bool) for _ in range(2))
    for token, number in vocabulary.items():
        first[number], last[number] = token.startswith("\u0120"), token.endswith("</w>")
    if last.any():
        first[:] = False
    return first, last


@functools.cache
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def keys_of(text: str) -> list[str]:
    """The cache keys of a text's pieces, in order.

    A key is a piece without its leading space; other pieces keep their line
    feed, or are marked.
    """
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = _AS_IS + keys[0]
    return keys


def careful_keys(text: str) -> list[str]:
    """As ``keys_of``, for texts with runs of white space or rare white space."""
    keys = []
    for piece in _PIECES.findall(text):
        if piece[0] == " " and len(piece) > 1 and not piece[1].isspace():
            keys.append(piece[1:])
        elif piece[0] == "\n" and len(piece) > 1 and not piece[1].isspace():
            keys.append(piece)
        else:
            keys.append(_AS_IS + piece)
    return keys


def is_plain(key: str) -> bool:
    """Whether a key of ``keys_of`` was cut where the tokenizers cut."""
    body = key[1:] if key[:1] in ("\n", _AS_IS) else key
    return bool(body) and not body[0].isspace() and not body[-1].isspace()


class _Generation(dict):
    """Values by piece. A piece looked up in vain is noted once and holds None until it is learnt."""

    def __init__(self) -> None:
        super().__init__()
        self.missed: list[str] = []

    def __missing__(self, key: str) -> None:
        self.missed.append(key)
        self[key] = None


class PieceEncoder:
    """Values made of the ids of whole texts; subclasses say which.

    ``known`` holds values by piece that all workers share. ``room`` bounds the
    bytes of the cache, whatever the pieces look like.
    """

    def __init__(self, path: str, known: dict | None = None, room: int = ROOM) -> None:
        self.tokenizer = load_tokenizer(path)
        self.first, self.last = word_ends(path)
        self.known, self.room = known or {}, room
        self.new, self.size = _Generation(), 0
        self.old: dict = {}
        self.passing: list[str] = []
        self.marks = {mark: self.one(self._library([mark])[0]) for mark in _CUT}
        self.nothing = self.join([])

    def cut(self, ids: np.ndarray, starts: list[int] | np.ndarray) -> list:
        """The values of the runs of ``ids`` that begin at ``starts``."""
        raise NotImplementedError

    def one(self, ids: np.ndarray):
        """The value of one piece."""
        raise NotImplementedError

    def join(self, values: Iterable):
        """The value of a text from the values of its pieces."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list:
        if self.size > self.room // 2:
            self.old, self.new, self.size = self.new, _Generation(), 0
        new = self.new
        try:
            keys = [self._keys(text) for text in texts]
            rough = self._learn(keys)
            if rough:
                for n, own in enumerate(keys):
                    if own is not None and not rough.isdisjoint(own):
                        keys[n] = careful_keys(texts[n])
                self._learn(keys, exact=True)
            look = new.__getitem__
            return [
                self.one(self._library([text])[0]) if own is None else self.join(map(look, own))
                for text, own in zip(texts, keys, strict=True)
            ]
        except BaseException:
            # Nothing half learnt stays behind.
            self.new, self.size = _Generation(), 0
            raise
        finally:
            for key in self.passing:
                new.pop(key, None)
            self.passing = []

    def _keys(self, text: str) -> list[str] | None:
        return None if "<|" in text or _AS_IS in text else keys_of(text)

    def _learn(self, texts: list[list[str] | None], exact: bool = False) -> set[str]:
        """Bring the values of all keys of the texts into ``new``; return those cut wrongly.

        ``exact``: some keys come from ``careful_keys``, and all are to be encoded as they are.
        """
        new, look = self.new, self.new.__getitem__
        new.missed = []
        for keys in texts:
            if keys is not None:
                deque(map(look, keys), maxlen=0)
        wanted = set(new.missed)
        self.passing += [key for key in wanted if len(key) > KEPT]
        wanted -= self._shared(wanted)
        words = [key for key in wanted if key.isalpha() and (key.isascii() or max(key) < _LATIN)]
        rest = wanted.difference(words)
        # A mark after a letter is always a token of its own.
        marked = [
            key
            for key in rest
            if key and key[-1] in _CUT and key[:-1].isalpha() and (key.isascii() or max(key) < _LATIN)
        ]
        rest.difference_update(marked)
        others, rough = [], set()
        for key in rest:
            if key == _AS_IS:
                new[key] = self.nothing
            elif exact or key.isalpha() or is_plain(key):
                others.append(key)
            else:
                rough.add(key)
        bases = {key[:-1] for key in marked}.difference(new)
        words += bases.difference(self._shared(bases))
        for start in range(0, len(words), 1024):
            part = words[start : start + 1024]
            values = self._words(part)
            if values is None:
                others += part
            else:
                self._keep(part, values)
        for start in range(0, len(others), 1024):
            part = others[start : start + 1024]
            self._keep(part, list(map(self.one, self._library([_piece(k) for k in part]))))
        self._keep(marked, [self.join((new[key[:-1]], self.marks[key[-1]])) for key in marked])
        for key in rough:
            del new[key]
        return rough

    def _shared(self, wanted: set[str]) -> set[str]:
        """Take over what is known to all workers or from the generation before."""
        taken = set()
        for shared in (self.known, self.old):
            hits = shared.keys() & wanted
            self._keep(list(hits), [shared[key] for key in hits])
            taken |= hits
        return taken

    def _keep(self, keys: list[str], values: list) -> None:
        self.new.update(zip(keys, values, strict=True))
        self.size += sum(map(sys.getsizeof, keys)) + sum(map(sys.getsizeof, values)) + _ENTRY * len(keys)

    def _words(self, words: list[str]) -> list | None:
        """The values of words of Latin letters, encoded as one text.

        Each is one token group of the library, told apart by the ids that begin
        or end a word. None if that gives another number of words.
        """
        ids = self._library([" " + " ".join(words)])[0]
        if self.first.any():
            starts = np.flatnonzero(self.first[ids])
        else:
            starts = np.concatenate([[0], np.flatnonzero(self.last[ids])[:-1] + 1])
        return self.cut(ids, starts) if len(starts) == len(words) else None

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]


def _piece(key: str) -> str:
    if key[0] == _AS_IS:
        return key[1:]
    return key if key[0] == "\n" else " " + key


@functools.cache
def worker_encoder(kind: type[PieceEncoder], path: str) -> PieceEncoder:
    """The encoder of this worker process: its cache outlives a task, not the process."""
    return kind(path)


class IdEncoder(PieceEncoder):
    """The ids themselves, as 16-bit numbers in bytes; the vocabulary must fit."""

    def __init__(self, path: str, known: dict | None = None, room: int = ROOM) -> None:
        if max(load_tokenizer(path).get_vocab(with_added_tokens=True).values()) >= 1 << 16:
            raise ValueError(f"{path} has ids beyond 16 bits")
        super().__init__(path, known, room)

    def cut(self, ids, starts):
        data = ids.astype("<u2").tobytes()
        places = (2 * np.append(starts, len(ids))).tolist()
        return [data[s:e] for s, e in itertools.pairwise(places)]

    def one(self, ids):
        return ids.astype("<u2").tobytes()

    def join(self, values):
        return b"".join(values)


class CountEncoder(PieceEncoder):
    """Numbers of ids."""

    def cut(self, ids, starts):
        return np.diff(np.append(starts, len(ids))).tolist()

    def one(self, ids):
        return len(ids)

    def join(self, values):
        return sum(values)
