"""Words and 8-word windows of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np

from playspan.llm.common import U, kept_in_worker, mix

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64) | U(1)


def per_text(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each [start, end)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


class Batch:
    """Bytes of some texts in one buffer, and where their words are.

    A blank stands after each text. ``owner`` is the text of each word; words are
    numbered through all texts, those of text i from ``first[i]`` to ``last[i]``.
    """

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if texts else np.zeros(0, np.int64)
        self.ends = self.starts + lengths
        self.bytes = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        space = _SPACE[self.bytes]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
        self.word_starts, self.word_ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.word_starts, self.starts)
        self.last = np.searchsorted(self.word_starts, self.ends)
        self.n_words = self.last - self.first
        self.owner = np.repeat(np.arange(len(texts)), self.n_words)
        self.space = space

    def word_hashes(self, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, the same on every machine."""
        n = len(self.bytes) + 1
        power, inverse = _powers(max(n, 1 << 20))
        values = _BYTE[_LOWER[self.bytes] if lower else self.bytes] * power[: n - 1]
        total = np.zeros(n, np.uint64)
        np.cumsum(values, out=total[1:])
        raw = (total[self.word_ends] - total[self.word_starts]) * inverse[self.word_starts]
        return mix(raw, (self.word_ends - self.word_starts).astype(np.uint64))

    def repeated_window_words(self, hashes: np.ndarray, n: int = 8) -> np.ndarray:
        """Per text: words in n-word windows (n a power of 2) found twice or more in it."""
        out = np.zeros(len(self.starts), np.int64)
        width, h = 1, hashes
        while width < n and len(h) > width:
            h = mix(h[:-width], h[width:])
            width *= 2
        if width < n or not len(h):
            return out
        inside = np.flatnonzero(self.owner[: len(h)] == self.owner[n - 1 : n - 1 + len(h)])
        keys = mix(h[inside], self.owner[inside].astype(np.uint64))
        order = np.sort(keys)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return out
        place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        at = inside[twice[place] == keys]
        change = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + n, -1)
        return per_text(np.cumsum(change)[:-1] > 0, self.first, self.last)

    def word_chars(self) -> np.ndarray:
        return per_text(((self.bytes & 0xC0) != 0x80) & ~self.space, self.starts, self.ends)

    def symbols(self) -> np.ndarray:
        return per_text(_SYMBOL[self.bytes], self.starts, self.ends)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << (n - 1).bit_length()

    def build():
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * U(pow(base, len(p), 1 << 64))])
            out.append(p)
        return tuple(out)

    if size > 1 << 22:  # a very long text: not kept
        return build()
    return kept_in_worker(("powers", size), build)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = text.split(b"\n")
    if len(lines) < 2:
        return 0
    real = [x for x in lines if x and (x[0] > 32 or x.split())]
    return len(real) - len(set(real))
