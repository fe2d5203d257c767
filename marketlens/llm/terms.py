"""Terms of texts as bytes: runs of ASCII letters (and digits, if wanted) and of all characters beyond ASCII, A-Z lower-cased.

Every byte of a character beyond ASCII is 0x80 or more in UTF-8, so bytes can be told apart one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE = 1 << 20


def _table(digits: bool) -> bytes:
    def image(b: int) -> int:
        if b >= 0x80 or 0x61 <= b <= 0x7A or (digits and 0x30 <= b <= 0x39):
            return b
        return b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    return bytes(image(b) for b in range(256))


def term_lists(digits: bool) -> Callable[[bytes], Iterator[list[bytes]]]:
    """A function that gives the terms of a text in lists, each from about a megabyte of it, cut between terms."""
    table = _table(digits)

    def lists(data: bytes) -> Iterator[list[bytes]]:
        at = 0
        while at < len(data):
            part = data[at:at + SLICE].translate(table)
            if at + SLICE < len(data):
                cut = part.rfind(b" ") + 1
                if not cut:  # a term longer than a slice: up to its end
                    end = at + SLICE
                    while end < len(data) and table[data[end]] != 0x20:
                        end += 1
                    part = data[at:end].translate(table)
                    cut = len(part)
                part = part[:cut]
            at += len(part)
            yield part.split()
    return lists


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()
