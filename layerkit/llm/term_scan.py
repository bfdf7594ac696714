"""Scanning whole texts for terms as bytes: helpers of the operators that read words in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Maps a byte of a term to itself (A-Z lower-cased) and any other to a blank. Terms are runs of the
#: letters A-Z, a-z and of everything outside ASCII, whose UTF-8 bytes are all 0x80 or more.
TERM_BYTES = bytes(c if c >= 0x80 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_TERM_ARRAY = np.frombuffer(TERM_BYTES, np.uint8)
CHUNK = 4 << 20


def pieces(data: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """``data`` (blank-separated) in pieces of about ``size`` bytes, cut at blanks, so that no term is cut."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            end = cut + 1 if cut >= 0 else (data.find(b" ", end) + 1 or len(data))
        yield data[at:end] if at or end < len(data) else data
        at = end


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows one after the other, offsets: where each row begins, and the end) of a column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]


def term_spans(flat: np.ndarray, offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Terms of concatenated rows, a chunk of about ``size`` bytes at a time.

    Yields (the chunk, mapped by ``TERM_BYTES``; begin and length of each
    term in it; the row of each term). Chunks end at a blank or at the end
    of a row, so a chunk is longer only for a term that is.
    """
    at, n = 0, len(flat)
    while at < n:
        end = min(n, at + size)
        while end < n:
            row_end = offsets[np.searchsorted(offsets, end, "right") - 1]
            blank = np.flatnonzero(_TERM_ARRAY[flat[at:end]] == 32)
            cut = max(int(row_end), at + int(blank[-1]) + 1 if len(blank) else 0)
            if cut > at:
                end = cut
                break
            end = min(n, end + size)
        chunk = _TERM_ARRAY[flat[at:end]]
        inside = chunk != 32
        lo, hi = np.searchsorted(offsets, [at, end], "left")
        edges = offsets[lo:hi] - at  # rows that begin in this chunk
        edges = edges[edges < len(chunk)]
        before = np.empty(len(chunk), bool)
        before[0], before[1:] = False, inside[:-1]
        before[edges] = False
        begin = np.flatnonzero(inside & ~before)
        after = np.empty(len(chunk), bool)
        after[-1], after[:-1] = False, inside[1:]
        after[edges[edges > 0] - 1] = False
        length = np.flatnonzero(inside & ~after) + 1 - begin
        yield chunk, begin, length, np.searchsorted(offsets, begin + at, "right") - 1
        at = end
