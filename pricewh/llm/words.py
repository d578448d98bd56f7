"""Words of whole texts as bytes: runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased.

Texts stay UTF-8 bytes: one translation lower-cases and turns every separator into a space.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

SPACE = 0x20
_KEPT = set((string.ascii_lowercase + string.digits).encode()) | set(range(0x80, 0x100))
#: ``bytes.translate`` table: lower-case A-Z, keep other word bytes, a space for every separator.
WORD_BYTES = bytes(ord(chr(b).lower()) if chr(b) in string.ascii_uppercase else b if b in _KEPT else SPACE
                   for b in range(0x100))

#: Very long texts are split into words in slices of this many bytes, cut at separators.
SLICE_BYTES = 1 << 20


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """Lists of the words of ``text`` in order; together they are all its words."""
    spaced, at = text.translate(WORD_BYTES), 0
    while at < len(spaced):
        end = spaced.find(b" ", at + SLICE_BYTES) if len(spaced) - at > SLICE_BYTES else -1
        end = len(spaced) if end < 0 else end
        yield spaced[at:end].split()
        at = end
