"""Words of texts as bytes, for texts of any length."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of text whose words are listed at a time.
BLOCK = 4_000_000
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def blocks(raw: bytes, limit: int = BLOCK) -> Iterator[bytes]:
    """The text in blocks of about ``limit`` bytes that end before white space, so that no word is cut.

    ``bytes.split()`` parts a block at the white space bytes 0x20 and 0x09 to 0x0D and nowhere else.
    """
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + limit)
        end = gap.start() if gap else len(raw)
        yield raw[at:end] if at or end < len(raw) else raw
        at = end
