"""Words and shingles of many texts as numpy hashes.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after A-Z became a-z. Hashes are 64 bits
wide and the same in every process: all constants come from fixed seeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
#: Bytes hashed at once; the working arrays take about forty times as much.
SLICE = 1 << 20

_draw = np.random.default_rng(20240501)
_BYTE = _draw.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_PLACE = _draw.integers(1, 2**64 - 1, SHINGLE, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE + 4096)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"] = np.cumprod(up, dtype=np.uint64)
        _POWERS["down"] = np.cumprod(down, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in an array of bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _WHITE[data], [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """The words of one text, of any length, in order."""
    data, found, at = np.frombuffer(text, np.uint8), [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        if end < len(data):
            white = np.flatnonzero(_WHITE[data[at:end]])
            while not len(white) and end < len(data):
                more = min(end + SLICE, len(data))
                white = np.flatnonzero(_WHITE[data[end:more]]) + (end - at)
                end = more
            if len(white):
                end = at + int(white[-1]) + 1
        piece = data[at:end]
        found.append(span_hashes(piece, *word_spans(piece)))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct shingles, sorted; all words as one if they are too few; none without words."""
    if not len(words):
        return words
    if len(words) < SHINGLE:
        whole = (words * _PLACE[: len(words)]).sum(dtype=np.uint64)
        return mix(np.array([whole + np.uint64(len(words))], np.uint64))
    n = len(words) - SHINGLE + 1
    total = words[:n] * _PLACE[0]
    for k in range(1, SHINGLE):
        total += words[k : k + n] * _PLACE[k]
    return np.unique(mix(total))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The set of each text. Texts are hashed together up to the slice size."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > SLICE:
            yield from _together(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    yield from _together(held)


def _together(raws: list[bytes]) -> Iterator[np.ndarray]:
    if len(raws) == 1:
        yield shingle_set(word_hashes(raws[0]))
    elif raws:
        data = np.frombuffer(b"\n".join(raws), np.uint8)
        starts, ends = word_spans(data)
        words = span_hashes(data, starts, ends)
        cuts = np.cumsum([len(r) + 1 for r in raws])
        first = 0
        for last in np.searchsorted(starts, cuts).tolist():
            yield shingle_set(words[first:last])
            first = last
