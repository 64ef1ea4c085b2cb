"""Where the pieces of overlapping chunks of one text certainly agree.

Splitting into pieces runs left to right and looks at most a few characters past a piece, so

1. the pieces of a chunk that begins at a true border are true, but for the last few characters;
2. from a common border of such a chunk and a later one on, the later one's pieces are true as well.

Texts are joined at a border that both chunks have and that is well inside the earlier one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

CHUNK = 1 << 15
OVERLAP = 1 << 8
GUARD = 32  # the last characters of a chunk, whose borders prove nothing

Split = Callable[[str], tuple[Sequence[int], Any]]


def spliced(text: str, split: Split, chunk: int = CHUNK, overlap: int = OVERLAP, guard: int = GUARD) -> Iterator[tuple[Any, int, int]]:
    """Yields ``(held, first, last)``: pieces ``first`` to ``last`` (exclusive) of each chunk make up ``text`` in order.

    ``split`` gives the borders of a chunk's pieces, its start and end included, and whatever the
    caller wants ``held`` of them. Where two chunks have no common border the overlap is doubled;
    once it reaches back to the last proven border, the earlier chunk is made longer instead.
    """
    start, end, first = 0, min(chunk, len(text)), 0
    borders, held = split(text[:end])
    while end < len(text):
        width, joined = overlap, None
        while joined is None:
            proven = start + borders[first]
            again = max(end - width, proven + 1)
            ahead = min(len(text), max(again + chunk, end + chunk // 2))
            later, later_held = split(text[again:ahead])
            at = {again + x: i for i, x in enumerate(later)}
            joined = next(((i, at[start + borders[i]]) for i in range(len(borders) - 2, first, -1)
                           if start + borders[i] <= end - guard and start + borders[i] in at), None)
            if joined is None and again == proven + 1:
                break
            width *= 2
        if joined is None:
            end = min(len(text), end + (end - start))
            borders, held = split(text[start:end])
            continue
        yield held, first, joined[0]
        start, end, first, borders, held = again, ahead, joined[1], later, later_held
    yield held, first, len(borders) - 1
