"""Words of lower-cased texts as slices of one code point array, and hash lookup.

`Letters` takes runs of letters; `Tokens` takes digits, scripts without spaces and symbols as well.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Letters:
    """The words of some texts: every run of letters, in order.

    ``codes`` holds the code points of all texts with zero for whatever is no letter and zeros
    before and after every text, so a slice may reach one place beyond a word.
    """

    def __init__(self, texts: list[str | None]) -> None:
        lowered = [(t or "").lower() for t in texts]
        joined = "\0" + "\0".join(lowered) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        inside = _letter_table()[codes]
        self.codes = np.where(inside, codes, 0)
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = change[::2], change[1::2]
        sizes = np.array([len(t) + 1 for t in lowered], np.int64)
        firsts = np.searchsorted(self.starts - 1, np.r_[0, np.cumsum(sizes)])
        self.text = np.repeat(np.arange(len(sizes)), np.diff(firsts))


# First and last code points of scripts that put no spaces between words.
_UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x3040, 0x30FF),  # Hiragana, Katakana
    (0x3400, 0x4DBF),  # Han, as the next three
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0x20000, 0x323AF),
    (0xFF66, 0xFF9F),  # Katakana of half width
)
_NOTHING, _LETTER, _DIGIT, _CHARACTER, _SYMBOL = range(5)


@lru_cache(maxsize=1)
def _token_table() -> np.ndarray:
    kinds = np.fromiter(
        (
            _LETTER if c.isalpha() else _DIGIT if c.isalnum() else _SYMBOL if c > " " and not c.isspace() else _NOTHING
            for c in map(chr, range(0x110000))
        ),
        np.uint8,
        0x110000,
    )
    for first, last in _UNSPACED:
        part = kinds[first : last + 1]
        part[part == _LETTER] = _CHARACTER
    return kinds


class Tokens:
    """The tokens of some texts: runs of letters, runs of digits, and single characters of scripts
    without spaces; with ``symbols`` every other visible character as well, one by one.

    ``codes`` holds the code points of all texts with a zero before and after every text.
    """

    def __init__(self, texts: list[str | None], symbols: bool = False) -> None:
        lowered = [(t or "").lower() for t in texts]
        joined = "\0" + "\0".join(lowered) + "\0"
        self.codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds = _token_table()[self.codes]
        if not symbols:
            kinds[kinds == _SYMBOL] = _NOTHING
        change = kinds[1:] != kinds[:-1]
        single = kinds >= _CHARACTER
        self.starts = np.flatnonzero((change | single[1:]) & (kinds[1:] != _NOTHING)) + 1
        self.ends = np.flatnonzero((change | single[:-1]) & (kinds[:-1] != _NOTHING)) + 1
        self.weights = np.where(kinds[self.starts] == _CHARACTER, 0.5, 1.0)
        sizes = np.array([len(t) + 1 for t in lowered], np.int64)
        firsts = np.searchsorted(self.starts - 1, np.r_[0, np.cumsum(sizes)])
        self.text = np.repeat(np.arange(len(sizes)), np.diff(firsts))


class Lookup:
    """Positions of 64-bit keys in a list of different keys, -1 where a key is not in it."""

    def __init__(self, keys: np.ndarray) -> None:
        self._order = np.argsort(keys)
        self._sorted = keys[self._order]
        # Most keys asked for are not in the list; one bit per slot of a table tells.
        self._shift = np.uint64(64 - max(12, min(22, int(np.log2(len(keys) + 1)) + 7)))
        self._seen = np.zeros(1 << int(np.uint64(64) - self._shift), bool)
        self._seen[(keys >> self._shift).astype(np.int64)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        if not len(self._sorted):
            return out
        likely = np.flatnonzero(self._seen[(keys >> self._shift).astype(np.int64)])
        asked = keys[likely]
        at = np.minimum(np.searchsorted(self._sorted, asked), len(self._sorted) - 1)
        found = self._sorted[at] == asked
        out[likely[found]] = self._order[at[found]]
        return out
