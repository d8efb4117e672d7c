"""Words and hashes of many texts at once, for use inside Arrow tasks.

All functions work on the UTF-8 bytes of an Arrow string array. Hashes have 64 bits; two
different words or shingles are taken for equal with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
BACK = U(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
STEP = 1 << 16


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = powers(BASE, 1), powers(BACK, 1)


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown when a longer piece comes."""
    global _POW, _INV
    if len(_POW) < n:
        _POW, _INV = powers(BASE, max(n, 1 << 20)), powers(BACK, max(n, 1 << 20))
    return _POW, _INV


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts have about ``most`` bytes; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += int(n)
    if at < batch.num_rows:
        yield batch.slice(at)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and where each text begins, with the end."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and for each text the index of its first word."""
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[flat]
    cut = np.zeros(len(flat) + 1, dtype=bool)
    cut[offsets] = True
    cut[:-1][1:] |= space[:-1]
    cut[0] = True
    start = np.flatnonzero(~space & cut[:-1])
    cut = np.zeros(len(flat) + 1, dtype=bool)
    cut[offsets] = True
    cut[:-1] |= space
    end = np.flatnonzero(~space & cut[1:]) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), dtype=U)
    for i in range(0, len(start), STEP):
        s, e = start[i : i + STEP], end[i : i + STEP]
        lo = s[0]
        part = flat[lo : e[-1]].astype(U) + U(1)
        p, q = tables(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=U)
        np.cumsum(part * p[: len(part)], out=total[1:])
        out[i : i + STEP] = (total[e - lo] - total[s - lo]) * q[s - lo]
    return mix(out)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, by its first word."""
    if len(hashes) < k:
        return np.zeros(0, dtype=U)
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= BASE
        out += hashes[j : j + n]
    return mix(out + U(k))


def lower(flat: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes as they are."""
    return np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles, lower-cased.

    A text of fewer words has one, of all its words; one without words has none.
    """
    flat, offsets = raw(texts)
    flat = lower(flat)
    start, end, first = words(flat, offsets)
    w = word_hashes(flat, start, end)
    grams = shingles(w, k)
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield shingles(w[a:b], int(b - a))
        else:
            yield np.zeros(0, dtype=U)
