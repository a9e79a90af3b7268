"""Words of texts as bytes: runs of ASCII letters and digits and of characters beyond ASCII,
with A-Z lower-cased. All bytes of a character beyond ASCII are 0x80 or more in UTF-8, so the
bytes can be sorted out without decoding them."""

from __future__ import annotations

import re
from collections.abc import Iterator

# Bytes of a text handled at a time.
PIECE_BYTES = 4 << 20

_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_WORD = [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]
_OTHER = bytes(sorted(set(range(256)) - set(_WORD)))
_PLAIN = bytes.maketrans(_OTHER + _LOWER[0], b" " * len(_OTHER) + _LOWER[1])

WORD_RUN = re.compile(rb"[^ ]+")


def plain(text: bytes) -> bytes:
    """The text with A-Z lower-cased and a space in place of every byte between words."""
    return text.translate(_PLAIN)


def pieces(low: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """Plain bytes in pieces of about ``most`` bytes that part no word."""
    if len(low) <= most:
        yield low
        return
    at = 0
    while at < len(low):
        to = low.find(b" ", at + most)
        to = len(low) if to < 0 else to
        yield low[at:to]
        at = to
