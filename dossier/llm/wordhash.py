"""Vectorised word splitting and hashing for batches of texts.

Words are found on UTF-8 bytes, so a delimiter class of ASCII characters gives the same words as the matching regular
expression over characters. Each word gets a 64-bit polynomial hash with a random value per byte; runs of words get a
polynomial over the word hashes. Everything is a pure function of the text, so a task that runs again gives the same.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _RUN_BASE = 0x9E3779B97F4A7C17, 0xC2B2AE3D27D4EB4B
#: Bytes hashed at once; longer texts go through in such steps.
_STEP = 1 << 19
_BATCH_BYTES = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


_POW, _INV = _powers(_BASE, _STEP + 1), _powers(_inverse(_BASE), _STEP + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for bytes that delimit words."""
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo : hi + 1] = True
    return out


#: What [^\x20\x09-\x0D]+ leaves out.
SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: What [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ leaves out.
NOT_WORD = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def encode(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def spans(buf: np.ndarray, delimiter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of buf, whose last byte is a delimiter."""
    inside = ~delimiter[buf]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    return edge[0::2], edge[1::2]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(ends, lo + _STEP, "right"))
        if j <= i:  # one word longer than a step
            acc = np.uint64(0)
            for k, p in enumerate(range(lo, int(ends[i]), _STEP)):
                part = _BYTE[buf[p : min(p + _STEP, int(ends[i]))]]
                acc = mix(np.array([acc ^ (part * _POW[: len(part)]).sum(dtype=np.uint64)]))[0]
            out[i] = acc
            i += 1
            continue
        s, e = starts[i:j] - lo, ends[i:j] - lo
        part = _BYTE[buf[lo : lo + int(e[-1])]]
        part *= _POW[: len(part)]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=total[1:])
        out[i:j] = mix((total[e] - total[s]) * _INV[s] + (e - s).astype(np.uint64))
        i = j
    return out


def batches(texts: list[str | None]):
    """(first, last, encoded texts) of pieces of about half a megabyte."""
    i = 0
    while i < len(texts):
        j, size, part = i, 0, []
        while j < len(texts) and (not part or size < _BATCH_BYTES):
            part.append(encode(texts[j]))
            size += len(part[-1])
            j += 1
        yield i, j, part
        i = j


def words(texts: list[str | None], delimiter: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one text after the other, and where each text's words begin (one more at the end)."""
    hashes, counts = [], []
    for _, _, part in batches(texts):
        buf = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        if fold:
            buf = _LOWER[buf]
        starts, ends = spans(buf, delimiter)
        hashes.append(hash_spans(buf, starts, ends))
        at = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in part], out=at[1:])
        counts.append(np.diff(np.searchsorted(starts, at)))
    first = np.zeros(len(texts) + 1, np.int64)
    if counts:
        np.cumsum(np.concatenate(counts), out=first[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), first


def run_hashes(hashes: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """The hash of the width words from each place on (fewer places than words, by width - 1)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = (_RUN_BASE + 2 * lane * 0x5851F42D4C957F2D) % (1 << 64) | 3
    w = mix(hashes + np.uint64((lane * 0x9E3779B97F4A7C15) % (1 << 64))) if lane else hashes
    if width <= 4:
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out += w[k : k + n] * np.uint64(pow(base, k, 1 << 64))
        return mix(out)
    total = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(w * _powers(base, len(w)), out=total[1:])
    return mix((total[width:] - total[:-width]) * _powers(_inverse(base), n))


def run_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Of the places of run_hashes(), True where the run stays in one text."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    change = np.zeros(n + 1, np.int64)
    lo = np.maximum(first[1:] - width + 1, first[:-1])
    np.add.at(change, np.minimum(lo, n), 1)
    np.add.at(change, np.minimum(first[1:], n), -1)
    return np.cumsum(change[:-1]) == 0


def planes(x: np.ndarray) -> bytes:
    """The bytes of x by significance, so that a codec can shorten the leading zeros."""
    x = np.ascontiguousarray(x)
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(dtype).ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending distinct values as differences."""
    return planes(np.diff(x, prepend=x.dtype.type(0))) if len(x) else b""


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64) if data else np.zeros(0, np.uint64)


def member(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """True where x is in the ascending array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x
