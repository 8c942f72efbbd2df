"""Sets of word shingles of texts, for a whole Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from engagement_lake.llm.units import text_bytes
from engagement_lake.llm.words import lowered, mixed, owners, span_hashes, window_hashes, word_spans


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another; and n + 1 offsets.

    A shingle is ``width`` words with A-Z lowered. Fewer words are one shingle of their own kind;
    a text without words has none.
    """
    data, offsets = text_bytes(texts)
    data = lowered(data)
    begins, ends = word_spans(data, offsets)
    n_words = np.diff(np.searchsorted(begins, offsets))
    words = span_hashes(data, begins, ends)
    word_of = owners(n_words)
    windows = window_hashes(words, width)
    inside = word_of[: len(windows)] == word_of[width - 1 :] if len(windows) else np.zeros(0, bool)
    values, of = [windows[inside]], [word_of[: len(windows)][inside]]
    first = np.cumsum(n_words) - n_words
    for n in range(1, width):
        short = np.flatnonzero(n_words == n)
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for i in range(n):
                whole = whole * np.uint64(0xC2B2AE3D27D4EB4F) + words[first[short] + i]
            values.append(mixed(whole + np.uint64(n)))
            of.append(short)
    value, text = np.concatenate(values), np.concatenate(of)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    keep = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])] if len(value) else []
    value, text = value[keep], text[keep]
    return value, np.r_[0, np.cumsum(np.bincount(text, minlength=len(n_words)))]


def set_signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits that tell one set from another; 0 for the empty set."""
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), out=running[1:])
    total = running[offsets[1:]] - running[offsets[:-1]]
    return np.where(np.diff(offsets) > 0, mixed(total + np.diff(offsets).astype(np.uint64)), 0).view(np.int64)


def parity_bitmaps(values: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """Per set, one bit per bucket of hashes: whether the set has an odd number there.

    Two sets differ in at least as many members as their bitmaps differ in bits.
    """
    return _parities(values, np.diff(offsets), np.full(len(offsets) - 1, bits)).reshape(-1, bits // 8)


def wide_bitmaps(values: np.ndarray, offsets: np.ndarray, bits: int) -> list[bytes | None]:
    """The same for sets of more than so many members, at least one bit a member; none for the others.

    The widths are ``bits`` times powers of two: halves of a bitmap folded by exclusive or are the narrower one.
    """
    sizes = np.diff(offsets)
    large = np.flatnonzero(sizes > bits)
    widths = bits << np.ceil(np.log2(sizes[large] / bits)).astype(np.int64)
    whole = _parities(values[np.repeat(sizes > bits, sizes)], sizes[large], widths).tobytes()
    ends = np.cumsum(widths) // 8
    found: list[bytes | None] = [None] * len(sizes)
    for i, begin, end in zip(large.tolist(), (ends - widths // 8).tolist(), ends.tolist()):
        found[i] = whole[begin:end]
    return found


def _parities(values: np.ndarray, sizes: np.ndarray, widths: np.ndarray) -> np.ndarray:
    of = owners(sizes)
    bucket = (mixed(values ^ np.uint64(0x14057B7EF767814F)) % widths.astype(np.uint64)[of]).astype(np.int64)
    counts = np.bincount((np.cumsum(widths) - widths)[of] + bucket, minlength=int(widths.sum()))
    return np.packbits((counts & 1).astype(np.uint8))
