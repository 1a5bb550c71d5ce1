"""Words and five-word shingles of whole texts as 64-bit hashes, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
SLICE_CHARS = 1_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_table() -> np.ndarray:
    """Which code points are letters, digits or marks of a word."""
    return np.char.isalnum(np.arange(0x110000, dtype=np.uint32).view("<U1"))


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` characters."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield begin, i
            begin, held = i, 0
        held += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def words(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number per text."""
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    isw = np.concatenate([[False], table[cps], [False]])
    edge = np.flatnonzero(isw[1:] != isw[:-1])
    begin, end = edge[::2], edge[1::2]
    n = len(cps)
    power = np.cumprod(np.full(n, ODD, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * power)])
    del power
    back = np.cumprod(np.full(n, INVERSE, dtype=np.uint64))
    h = mix((total[end] - total[begin]) * back[begin])
    ends = np.cumsum([len(t) + 1 for t in lowered])
    upto = np.searchsorted(begin, ends)
    return h, np.diff(np.concatenate([[0], upto]))


def shingles(texts: list[str], table: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text number, hash, occurrences), sorted.

    A text of fewer than ``k`` words has one shingle of all its words; a text
    without words has none."""
    h, count = words(texts, table)
    last = np.cumsum(count)
    first = last - count
    n = len(h)
    if n >= k:
        run = h[: n - k + 1].copy()
        for j in range(1, k):
            run = mix(run * ODD + h[j : n - k + 1 + j])
    else:
        run = np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(texts)), count)
    ok = np.flatnonzero(np.arange(len(run)) + k <= last[of[: len(run)]])
    doc, val = of[ok], run[ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, d in enumerate(short):
            acc = np.array([count[d]], np.uint64)
            for j in range(first[d], last[d]):
                acc = mix(acc * ODD + h[j : j + 1])
            extra[i] = acc[0]
        doc, val = np.concatenate([doc, short]), np.concatenate([val, extra])
    if not len(val):
        return doc.astype(np.int64), val, np.zeros(0, np.int64)
    order = np.lexsort((val, doc))
    doc, val = doc[order], val[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (val[1:] != val[:-1])])
    at = np.flatnonzero(new)
    return doc[at], val[at], np.diff(np.concatenate([at, [len(val)]]))
