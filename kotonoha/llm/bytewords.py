"""Vectorised word and hash kernels over the byte buffers of Arrow string columns.

A block is a run of whole texts laid end to end in one ``uint8`` array. Words, n-grams and shingles of all texts of a
block come from a few numpy passes, so no Python code runs per word. Hashes are 64-bit polynomial prefix hashes
followed by a bit mixer. A block holds one text at least; hashes of texts beyond ``PIECE`` bytes are made piece by piece, so
that memory is about 10 bytes per byte of such a text and 40 per byte of a piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

# Classes of bytes: 0 separates, other values name the kind of word.
SPACES = np.ones(256, np.uint8)
SPACES[[0x20, *range(0x09, 0x0E)]] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.full(256, 2, np.uint8)
ALNUM[[0x20, *range(0x09, 0x0E)]] = 0
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
# Letters, digits and whatever is beyond ASCII.
TERMS = (ALNUM == 1).astype(np.uint8)


@dataclass
class Block:
    """Texts ``lo`` to ``hi`` of a batch: their bytes and the place of each text."""

    lo: int
    hi: int
    data: np.ndarray
    at: np.ndarray  # int64, one more than texts, from 0


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole texts of about ``limit`` bytes; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, place, data = column.buffers()
    place = np.frombuffer(place, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(place, place[lo] + limit, "right")) - 1)
        yield Block(lo, hi, data[place[lo] : place[hi]], place[lo : hi + 1] - place[lo])
        lo = hi


def words(block: Block, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text (and one past) its first word's number."""
    kind = kinds[block.data]
    if not len(kind):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(block.at), np.int64)
    edge = np.empty(len(kind) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[block.at] = True
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, block.at)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    size = 1 << max(20, int(len(data)).bit_length())
    up, _ = _powers(size)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, the same wherever the span lies."""
    size = 1 << max(20, int(len(prefix) - 1).bit_length())
    _, down = _powers(size)
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span; spans come in order of their starts and of their ends."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(data) <= PIECE:
        return span_hash(prefix_hash(data), starts, ends)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = int(ends[j - 1])
        if high - low > PIECE:
            out[i] = _long_hash(data[low:high])
        else:
            out[i:j] = span_hash(prefix_hash(data[low:high]), starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def _long_hash(data: np.ndarray) -> np.uint64:
    """Hash of one span beyond a piece, the same as ``span_hash`` would give."""
    total = 0
    for at in range(0, len(data), PIECE):
        total += int(prefix_hash(data[at : at + PIECE])[-1]) * pow(_BASE, at, 1 << 64)
    return mix(np.array([(total + len(data)) & _MASK], np.uint64))[0]


def window_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring hashes (also across texts: the caller drops those)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += hashes[j : j + n] * np.uint64(pow(_BASE, 2 * j + 3, 1 << 64))
    return mix(out + np.uint64(width))


def ranges(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """All whole numbers of the half-open ranges, one range after the other."""
    sizes = np.maximum(highs - lows, 0)
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(lows - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return first + np.arange(total)


def shingles(block: Block, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text after lower-casing A-Z.

    Returns the sorted 64-bit hashes of all texts, text after text, and their bounds. A text with fewer words has its
    whole sequence as the only shingle; one without words has none.
    """
    low = Block(block.lo, block.hi, LOWER[block.data], block.at)
    starts, ends, first = words(low, SPACES)
    hashes = hash_spans(low.data, starts, ends)
    n_texts, counts = len(block.at) - 1, np.diff(first)
    long = counts >= width
    at = ranges(first[:-1], np.where(long, first[1:] - width + 1, first[:-1]))
    owner = np.repeat(np.arange(n_texts), np.where(long, counts - width + 1, 0))
    all_windows = window_hash(hashes, width)
    found, texts = all_windows[at], owner
    extra, extra_texts = [], []
    for size in range(1, width):
        own = np.flatnonzero(counts == size)
        if len(own):
            h = np.zeros(len(own), np.uint64)
            for j in range(size):
                h += hashes[first[own] + j] * np.uint64(pow(_BASE, 2 * j + 3, 1 << 64))
            extra.append(mix(h + np.uint64(size)))
            extra_texts.append(own)
    if extra:
        found, texts = np.concatenate([found, *extra]), np.concatenate([texts, *extra_texts])
    order = np.lexsort((found, texts))
    found, texts = found[order], texts[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    found, texts = found[keep], texts[keep]
    return found, np.searchsorted(texts, np.arange(n_texts + 1))
