"""Words and word hashes of whole texts, shared by the operators.

A text arrives as UTF-8 bytes (``text.cast("binary")``), so broken encodings
cannot fail a job.  ``bytes.split()`` splits on exactly ``[\\x20\\x09-\\x0D]+``.
Words and n-grams are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash

MEMO_LIMIT = 200_000  # words remembered per Python worker (some 25 MB); the memo is emptied beyond it
LONG_WORD = 256       # bytes; longer words are hashed one by one
ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = bytes(int(i in b"\t\n\v\f\r ") for i in range(256))
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_MEMO = _Memo()


def word_hashes(words: list[bytes]) -> np.ndarray:
    memo = _MEMO
    return np.fromiter([memo[w] for w in words], dtype=np.uint64, count=len(words))


def _powers(base: int, count: int) -> np.ndarray:
    """1, ``base``, ``base`` ** 2, ... modulo 2 ** 64."""
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = {b: _powers(b, 1 << 18) for b in (_BASE, _INVERSE)}


def powers(base: int, count: int) -> np.ndarray:
    known = _POWERS[base]
    return known[:count] if count <= len(known) else _powers(base, count)


def sums_from(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, scale): ``(sums[b] - sums[a]) * scale[a]`` tells ``values[a:b]`` apart, wherever it stands."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, n), dtype=np.uint64, out=sums[1:])
    return sums, powers(_INVERSE, n)


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sums_from`` for bytes."""
    return sums_from(_BYTES[data])


def flat_word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and how many words each text has.

    The words are cut and hashed by numpy; other hashes than those of ``word_hashes``.
    """
    joined = b" ".join(raws)
    space = np.frombuffer(b"\1" + joined.translate(_SPACE) + b"\1", dtype=np.uint8)
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums, scale = byte_sums(np.frombuffer(joined, dtype=np.uint8))
    out = (sums[ends] - sums[starts]) * scale[starts]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(joined[starts[k]:ends[k]])
    sizes = np.array([len(r) + 1 for r in raws], dtype=np.int64)
    return out, np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))


def forget() -> None:
    """Empty the memo: for a task that needs the memory for something else."""
    _MEMO.clear()


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per window of ``n`` consecutive words (none if there are fewer)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = hashes[:m].copy()
    for j in range(1, n):
        out *= _MULTIPLIER
        out += hashes[j:m + j]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def repeated(values: np.ndarray) -> np.ndarray:
    """Mask of the entries whose value occurs at least twice."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    mask = np.zeros(len(values), dtype=bool)
    mask[order[1:][same]] = True
    mask[order[:-1][same]] = True
    return mask


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Mask over ``total`` words: those inside a window of ``width`` beginning at a true entry of ``starts``."""
    steps = np.zeros(total + 1, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + width, total), -1)
    return np.cumsum(steps[:-1]) > 0


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes at most (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.array([v or 0 for v in pa.compute.binary_length(batch.column(column)).to_pylist()])
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
