"""Word hashes of whole Arrow text columns in numpy, without a Python string
per word. A word's hash is a polynomial over its bytes, taken from prefix sums
of byte * BASE**i modulo 2**64, so one pass serves all words of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 18
#: A longer text is worked on in pieces of about so many bytes.
PIECE_BYTES = 1 << 20

#: Words are what stands between white space of the contracts.
SPACED = np.array([not (b == 0x20 or 9 <= b <= 13) for b in range(256)])
#: Words are runs of ASCII letters and digits and of anything beyond ASCII.
LETTERS = np.array([chr(b).isalnum() or b >= 128 for b in range(128)] + [True] * 128)
SAME = np.arange(256, dtype=np.uint8)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    filled = 1
    while filled < n:
        step = np.uint64(pow(base, filled, 1 << 64))
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


#: Bytes whose prefix sums are held at once, and the powers of BASE for them.
STRETCH = SLICE_BYTES
_UP, _DOWN = _powers(BASE, STRETCH), _powers(INVERSE, STRETCH)


def _sums_at(data: np.ndarray, fold: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The prefix sums before the ascending ``places``, stretch by stretch."""
    out = np.zeros(len(places), np.uint64)
    before = np.uint64(0)
    for at in range(0, len(data), STRETCH):
        part = data[at : at + STRETCH]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((fold[part].astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        sums = sums * np.uint64(pow(BASE, at, 1 << 64)) + before
        a, b = np.searchsorted(places, (at, at + len(part)), "left")
        out[a:b] = sums[places[a:b] - at]
        before = sums[-1]
    out[np.searchsorted(places, len(data), "left") :] = before
    return out


def _inverse_powers(places: np.ndarray) -> np.ndarray:
    """INVERSE to the power of each place."""
    whole = places // STRETCH
    tops = np.array([pow(INVERSE, STRETCH * k, 1 << 64) for k in range(int(whole.max(initial=0)) + 1)], np.uint64)
    return _DOWN[places - whole * STRETCH] * tops[whole]


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) in pieces of whole rows;
    null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends; no word crosses a row's end."""
    inside = in_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """The hash of each word between ascending bounds."""
    return mixed((_sums_at(data, fold, stops) - _sums_at(data, fold, starts)) * _inverse_powers(starts))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray, fold: np.ndarray = SAME, prefix: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(hash of each word, words before each row and in all, hash of each
    word's first ``prefix`` bytes or None)."""
    starts, stops = word_bounds(data, offsets, in_word)
    scale = _inverse_powers(starts)
    at_starts = _sums_at(data, fold, starts)
    words = mixed((_sums_at(data, fold, stops) - at_starts) * scale)
    begins = np.searchsorted(starts, offsets)
    short = None
    if prefix:
        short = mixed((_sums_at(data, fold, np.minimum(stops, starts + prefix)) - at_starts) * scale, 0x5BD1E995)
    return words, begins, short


def is_long(offsets: np.ndarray) -> bool:
    """Whether a slice is one text that is better worked on in pieces."""
    return len(offsets) == 2 and int(offsets[1]) > PIECE_BYTES


def word_pieces(
    data: np.ndarray, in_word: np.ndarray, fold: np.ndarray = SAME, prefix: int = 0
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """``word_hashes`` of one text, a piece at a time. Pieces end between words,
    so a single word of any length is in one piece."""
    at = 0
    while at < len(data):
        stop = min(at + PIECE_BYTES, len(data))
        while stop < len(data) and in_word[data[stop]]:
            ahead = in_word[data[stop : stop + STRETCH]]
            stop += int(np.argmin(ahead)) if not ahead.all() else len(ahead)
        words, _, short = word_hashes(data[at:stop], np.array([0, stop - at]), in_word, fold, prefix)
        yield words, short
        at = stop
