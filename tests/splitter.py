"""A plain version of the separator chunker, for one text."""

from collections import deque
from collections.abc import Iterator, Sequence

from cohortweave.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS


def _cut(text: str, separator: str) -> list[str]:
    """Pieces of ``text``; every piece after the first begins with its separator."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [piece for piece in (head, *(separator + r for r in rest)) if piece]


def _join(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Fill chunks with consecutive short pieces; a new chunk keeps up to ``overlap``
    characters worth of the previous one's last pieces."""
    window: deque[str] = deque()
    length = 0
    for piece in pieces:
        if window and length + len(piece) > size:
            yield "".join(window)
            while window and (length > overlap or length + len(piece) > size):
                length -= len(window.popleft())
        window.append(piece)
        length += len(piece)
    if window:
        yield "".join(window)


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: Sequence[str] = SEPARATORS) -> Iterator[str]:
    """Cut at the best separator present, refine over-long pieces with the next ones, and
    join short neighbours back together."""
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[at + 1:] if separators[at] else ()
    short: list[str] = []
    for piece in _cut(text, separators[at]):
        if len(piece) < size:
            short.append(piece)
            continue
        yield from _join(short, size, overlap)
        short = []
        if finer:
            yield from split_text(piece, size, overlap, finer)
        else:
            yield piece
    yield from _join(short, size, overlap)
