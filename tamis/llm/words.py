"""Words of a text, for operators that run in Python tasks.

Both rules lower-case A-Z only. All bytes of a multi-byte character are 0x80 or more and
count as word characters, so words can be cut from UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, letters, anything beyond ASCII.
_ALNUM = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in _LOWER
)


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters; null has none."""
    return text.encode().translate(_ALNUM).split() if text else []


def spaced_words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and \\x09-\\x0D; null has none."""
    return text.encode().translate(_LOWER).split() if text else []


def alnum_spans(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each of ``alnum_words``, in characters of the text."""
    import re

    return [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def texts(batch: pa.RecordBatch, column: str) -> Iterator[str | None]:
    """The values of a string column, one by one: only one text is a Python object at a time."""
    return (value.as_py() for value in batch.column(column))
