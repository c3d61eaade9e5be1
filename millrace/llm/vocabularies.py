"""Token ids of whole texts through a cache of text units.

A unit is a piece of text whose tokens do not depend on what stands around it. Units repeat far more
often than texts do, so most of a text costs one lookup for each unit, and only new units are
encoded. The cache lives in one Python worker and goes from one of its tasks to the next. It holds about
``UNITS`` units and is emptied when full: that costs time, never results.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain

import numpy as np

UNITS = 600_000


def vocabulary(name_or_path: str) -> str:
    """A path as it is; a bare name is one of the installed public vocabularies."""
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


class UnitCache(dict):
    """Unit -> row of ``start`` and ``size``, its place in the pool of ids."""

    def __init__(
        self,
        split: Callable[[str], list[str]],
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        units: int = UNITS,
    ):
        super().__init__()
        self.split, self.encode, self.units = split, encode, units
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.pool = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def __missing__(self, unit: str) -> int:
        row = self[unit] = len(self)
        self.fresh.append(unit)
        return row

    def learn(self) -> None:
        sizes, ids = self.encode(self.fresh)
        begin, end = len(self) - len(self.fresh), len(self)
        self.pool = grown(self.pool, self.used + len(ids))
        self.start, self.size = grown(self.start, end), grown(self.size, end)
        self.pool[self.used : self.used + len(ids)] = ids
        self.size[begin:end] = sizes
        self.start[begin:end] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.fresh = []

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids of all texts one after the other."""
        if len(self) > self.units:
            self.empty()
        split = [self.split(t) for t in texts]
        per_text = np.fromiter(map(len, split), np.int64, len(split))
        rows = np.fromiter(
            map(self.__getitem__, chain.from_iterable(split)), np.int64, int(per_text.sum())
        )
        if self.fresh:
            self.learn()
        sizes = self.size[rows]
        before = np.r_[0, np.cumsum(sizes)]
        counts = np.diff(before[np.r_[0, np.cumsum(per_text)]])
        places = np.repeat(self.start[rows] - before[:-1], sizes) + np.arange(before[-1])
        return counts, self.pool[places]


def grown(array: np.ndarray, n: int) -> np.ndarray:
    if len(array) >= n:
        return array
    wider = np.zeros(max(n, 2 * len(array)), array.dtype)
    wider[: len(array)] = array
    return wider


_caches: dict[str, UnitCache] = {}


def word_vocabulary(path: str) -> UnitCache:
    """For vocabularies that drop white space: units are what stands between blanks and line ends.

    The library's whole encoder takes most of its time on each text's bookkeeping, so units of
    letters whose normal form is plain lower case go to its merge model at once, word by word; every
    other unit takes the whole way.
    """
    if path in _caches:
        return _caches[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import regex
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    described = json.loads(tokenizer.to_str())
    steps = [x["type"] for x in described["normalizer"]["normalizers"]]
    split = described["pre_tokenizer"]["pretokenizers"][0]
    if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"]:
        raise ValueError(f"{path} is not a vocabulary of lower-case words")
    words_in = regex.compile(split["pattern"]["Regex"]).findall
    model = tokenizer.model
    # How the byte-level step writes each byte, learned from the library.
    written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {
        b: ord(written.pre_tokenize_str(chr(b))[0][0][-1]) for b in range(128)
    } | {b: ord(written.pre_tokenize_str(chr(b))[0][0][-1]) for b in range(0x80, 0xC0)}
    letters |= {
        b: ord(written.pre_tokenize_str(bytes([b, 0x80] if b < 0xE0 else []).decode())[0][0][0])
        for b in range(0xC2, 0xE0)
    }

    def ids_of(word: str) -> list[int]:
        return [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(letters))]

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known: dict[str, list[int]] = {}
        found: list[list[int]] = []
        for unit in units:
            # Below U+0130 every letter is its own composed form and has one lower-case letter.
            if unit and max(unit) < "\u0130" and "<|" not in unit:
                ids: list[int] = []
                for word in words_in(unit.lower()):
                    own = known.get(word)
                    if own is None:
                        own = known[word] = ids_of(word)
                    ids += own
            else:
                ids = tokenizer.encode(unit, add_special_tokens=False).ids
            found.append(ids)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))

    _caches[path] = UnitCache(lambda t: t.replace("\n", " ").split(" "), encode)
    return _caches[path]
