"""Windows of a sequence that also start elsewhere, found by content-defined segments.

The units of a sequence (bytes, or words) are hashed; ``Ladder`` then has a hash of every run of 1, 2, 4,
... units, each level made from the one below, as in the doubling construction of suffix arrays: names of
runs that are equal wherever they stand.  Every window of the wanted length is assigned to its anchor, the
run of a few units with the least hash in it.  Neighbouring windows mostly share their anchor and make one
segment; equal windows have the same anchor at the same distance, wherever they are.  So

* windows of an anchor that occurs once are unique;
* segments of equal content are repeated as a whole;
* only where an anchor occurs in segments of different content must single windows be compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from plycask.llm.words import mix

_U64 = np.uint64


@dataclass(frozen=True)
class Shape:
    """Units of a window and of an anchor (a power of two)."""

    window: int
    anchor: int

    @property
    def top(self) -> int:
        """The largest power of two that is not above the window."""
        return 1 << (self.window.bit_length() - 1)


#: For each level of the ladder an odd multiplier.
_LEVELS = mix(np.arange(1, 40, dtype=_U64) * _U64(0x9E3779B97F4A7C15)) | _U64(1)


class Ladder:
    """Hashes of runs of units of a buffer of sequences that follow each other."""

    def __init__(self, units: np.ndarray, shape: Shape):
        self.shape = shape
        level, size, x = 0, 1, units
        self.anchors = x
        while size < shape.top:
            x = x[: max(0, len(x) - size)] * _LEVELS[level] + x[size:]
            x ^= x >> _U64(29)
            size, level = 2 * size, level + 1
            if size == shape.anchor:
                self.anchors = x
        self.tops = x

    def spans(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Names of the runs from start, of at least top and at most window + (window - anchor) units."""
        top, longest = self.shape.top, 2 * self.shape.window - self.shape.anchor
        length = np.asarray(length)
        name = self.tops[start] * _LEVELS[30] + length.astype(_U64)
        for i in range(1, -(-longest // top)):
            name = mix(name) * _LEVELS[30 + i] + self.tops[start + np.minimum(i * top, length - top)]
        return mix(name)


@dataclass
class Segments:
    """Of each: the sequence's number, first and last window start (places in the buffer), the anchor's name, the content's name, and the anchor's place."""

    sequence: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    place: np.ndarray


def cut(units: np.ndarray, lengths: np.ndarray, shape: Shape) -> tuple[Ladder, Segments]:
    """The segments of sequences that follow each other in units."""
    ladder = Ladder(units, shape)
    ends = np.cumsum(lengths)
    n = max(0, len(units) - shape.window + 1)
    none = np.empty(0, np.int64)
    if not n:
        return ladder, Segments(none, none, none, none.astype(_U64), none.astype(_U64), none)
    # The least anchor of each window, the leftmost of equal ones: hash above, place below.
    low = (mix(ladder.anchors) & _U64(0xFFFFFFFF00000000)) | np.arange(len(ladder.anchors), dtype=_U64)
    reach, width = 1, shape.window - shape.anchor + 1
    while 2 * reach <= width:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    place = (low[:n] & _U64(0xFFFFFFFF)).astype(np.int64)
    starts = ends - lengths
    whole = np.zeros(n + 1, np.int32)
    fits = lengths >= shape.window
    np.add.at(whole, starts[fits], 1)
    np.add.at(whole, ends[fits] - shape.window + 1, -1)
    valid = np.cumsum(whole[:n]) > 0
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    fresh = starts[fits]
    new[fresh] = True
    first = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    sequence = np.searchsorted(ends, first, side="right")
    at = place[first]
    content = ladder.spans(first, stop - first + shape.window)
    content = mix(content + (at - first).astype(_U64))
    return ladder, Segments(sequence, first, stop, mix(ladder.anchors[at]), content, at)
