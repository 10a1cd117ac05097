"""Slices of a batch that bound the memory of array work on its texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

#: Characters of text in a slice, about: a slice ends behind the text that reaches them.
SLICE_CHARS = 400_000


def slices(sizes: Sequence[int], most: int, chars: int = SLICE_CHARS) -> Iterator[slice]:
    """Consecutive slices of at most ``most`` rows, each ended by the row whose size brings its sum to ``chars``."""
    begin, held = 0, 0
    for end, size in enumerate(sizes, 1):
        held += size
        if held >= chars or end - begin == most:
            yield slice(begin, end)
            begin, held = end, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))
