"""Words of a text as bytes, for tasks that work on Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame

#: A word, wherever an operator counts words: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BLOCK = 1 << 22


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 of every text of a column."""
    return column.cast(pa.large_binary()).to_pylist()


def word_blocks(text: bytes | None, block: int = _BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, a few megabytes at a time.

    ``bytes.split`` without arguments cuts at exactly the characters that ``WORD``
    leaves out. Cutting a very long text into blocks bounds the memory that its
    word objects take.
    """
    if not text:
        return
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > block:
            space = _SPACE.search(text, start + block)
            end = space.end() if space else end
        yield text[start:end].split()
        start = end


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


#: Bytes of a term: digits, ASCII letters in lower case, and all beyond ASCII.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def term_blocks(text: bytes | None) -> Iterator[list[bytes]]:
    """Like ``word_blocks``, with A-Z lower-cased and every other ASCII character than
    letters and digits taken for a space."""
    if text:
        yield from word_blocks(text.translate(_TERM_BYTES))


def free_name(stem: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case of letters."""
    taken = {c.lower() for f in frames for c in f.columns}
    return next(n for i in count() if (n := f"{stem}{i}") not in taken)
