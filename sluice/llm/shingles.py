"""Word shingles of whole documents as 64-bit hashes, by numpy over Arrow buffers.

Words are the runs without ASCII white space, A-Z folded to a-z. A word's hash is a polynomial over its bytes with random
64-bit values, taken from running sums over the whole batch, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
SEGMENT = 1 << 18  # bytes hashed at a time; memory is about forty times that

_random = np.random.default_rng(20240229)
_BASE = int(_random.integers(1 << 62, 1 << 63)) | 1
_CODE = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_CODE[65:91] = _CODE[97:123]
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_STEP = _random.integers(0, 1 << 64, WIDTH, dtype=np.uint64) | np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers["up"]) < n:
        size = max(n, SEGMENT)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_words(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words in ``data``; ``first`` marks the bytes at which a document begins."""
    up, down = _power_tables(len(data))
    inside = ~_GAP[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    terms = _CODE[data] * up[:len(data)]
    sums = np.cumsum(terms)
    hashes = (sums[end] - sums[begin] + terms[begin]) * down[begin]
    return mix(hashes), begin


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT that end at a document's end, or at white space inside a longer document."""
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        end = min(at + SEGMENT, stop)
        if end < stop:
            bound = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            if bound > at:
                end = bound
            else:
                own_end = int(offsets[np.searchsorted(offsets, at, side="right")])
                gaps = np.flatnonzero(_GAP[data[at:end]])
                if len(gaps) and gaps[-1] > 0:
                    end = at + int(gaps[-1])
                else:  # one word longer than a segment
                    later = np.flatnonzero(_GAP[data[end:own_end]])
                    end = end + int(later[0]) if len(later) else own_end
        yield at, end
        at = end


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles; a shorter text is one shingle, an empty one has none."""
    data, offsets = _buffers(texts)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    for at, end in _segments(data, offsets):
        found, begin = _segment_words(data[at:end], opens[at:end])
        hashes.append(found)
        places.append(begin + at)
    words, where = np.concatenate(hashes), np.concatenate(places)
    bounds = np.searchsorted(where, offsets)
    sums = words[:max(len(words) - WIDTH + 1, 0)] * _STEP[0]
    for i in range(1, WIDTH):
        sums += words[i:i + len(sums)] * _STEP[i]
    windows = mix(sums)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= WIDTH:
            own = np.sort(windows[a:b - WIDTH + 1])
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[1:] != own[:-1]
            out.append(own[fresh])
        elif b > a:
            out.append(mix(np.sum(words[a:b] * _STEP[:b - a], keepdims=True), seed=b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
