"""Benchmark decontamination by q-gram lemma filtering.

An occurrence of an item of ``m`` characters with at most ``e = floor(RATE * m)``
edits shares at least ``m - q + 1 - q * e`` of the item's q-grams with the
text, all on diagonals (text position - item position) that differ by at most
``2 e``.  Each task slides a window of ``q`` characters over its whole texts, looks the
q-grams up in the benchmark's index, and counts, per item, the distinct item
positions hit in overlapping diagonal bands of width ``4 e + 1`` that start every
``2 e + 1`` diagonals, so that every occurrence lies whole in one band.
Bands that reach the lemma's bound are verified by banded
edit-distance alignment.  Case is folded and white space runs are one blank on both sides.

The benchmark is the stated query set.  Its index is sent to all tasks
while it has at most ``MAX_INDEX_CHARS`` characters; a larger benchmark is worked
off in parts of that size, each against all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import giving_back, read_table, shared_table, text_or_empty

Q, RATE = 8, 0.1
#: items of fewer characters are too short to tell and are searched exactly
LEAST_CHARS = 40
MAX_INDEX_CHARS = 4_000_000
#: characters that a task looks up at once; q-gram tables take about 50 bytes a character
SLICE_CHARS = 200_000
BITS = 22
MULT = np.uint64(0x9E3779B97F4A7C15)

HITS_SCHEMA = "_id bigint, _th bigint, item_id bigint, start bigint, end bigint, edits int"


def normalise(text: str) -> str:
    """Case folded, white space runs as one blank, no blank at the ends."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def qgrams(cps: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hash of the q-gram at each place."""
    n = len(cps) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = cps[:n].astype(np.uint64)
    for i in range(1, q):
        h *= MULT
        h += cps[i : i + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def build_index(items: list[tuple[int, str]], q: int = Q, rate: float = RATE) -> SimpleNamespace:
    """The q-grams of the items, sorted, with item and position, and a
    bit table that most q-grams of clean text fail."""
    code = [codes(t) for _, t in items]
    edits = [int(rate * len(c)) if len(c) >= LEAST_CHARS else 0 for c in code]
    grams = [qgrams(c, q) for c in code]
    key = np.concatenate([*grams, np.zeros(0, np.uint64)])
    item = np.concatenate([np.full(len(g), i, np.int32) for i, g in enumerate(grams)] + [np.zeros(0, np.int32)])
    place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams] + [np.zeros(0, np.int32)])
    order = np.argsort(key, kind="stable")
    bits = np.zeros(1 << BITS, bool)
    bits[(key & np.uint64((1 << BITS) - 1)).astype(np.int64)] = True
    return SimpleNamespace(
        ids=[i for i, _ in items], codes=code, edits=edits,
        bound=[max(1, len(c) - q + 1 - q * e) for c, e in zip(code, edits, strict=True)],
        key=key[order], item=item[order], place=place[order], bits=bits,
        # items shorter than q have no q-gram and are searched as they are
        short=[(i, t) for i, t in items if 0 < len(t) < q],
    )


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """Best occurrence of ``item`` in ``text`` within diagonals ``low`` .. ``high``.

    Semi-global edit distance: the item is used whole, text before and after
    is free.  Only cells ``(i, i + d)`` with ``d`` in the band are filled.  Returns
    (edits, start, end) or None beyond ``limit``."""
    m, n, width = len(item), len(text), high - low + 1
    big = limit + 1
    diag = np.arange(low, high + 1)
    ramp = np.arange(width)
    cost = np.where((diag >= 0) & (diag <= n), 0, big).astype(np.int64)
    start = diag.copy()
    for i in range(1, m + 1):
        j = diag + i  # text characters used
        ok = (j >= 1) & (j <= n)
        same = np.zeros(width, bool)
        same[ok] = text[j[ok] - 1] == item[i - 1]
        take = np.where(ok, cost + ~same, big)
        # leaving out an item character moves to the next lower diagonal
        drop = np.concatenate([cost[1:], [big]]) + 1
        drop_start = np.concatenate([start[1:], [0]])
        new = np.where(take <= drop, take, drop)
        new_start = np.where(take <= drop, start, drop_start)
        new = np.where((j >= 0) & (j <= n), new, big)
        # extra text characters move up the diagonals: a running minimum
        run = np.minimum.accumulate(new - ramp)
        best = run + ramp
        if (best < new).any():
            src = np.maximum.accumulate(np.where(new - ramp == run, ramp, 0))
            new_start = new_start[src]
        cost, start = np.minimum(best, big), new_start
        if cost.min() > limit:
            return None
    k = int(np.argmin(cost))
    if cost[k] > limit:
        return None
    return int(cost[k]), int(start[k]), int(diag[k] + m)


def exact(item: np.ndarray, text: np.ndarray, diagonals: np.ndarray) -> tuple[int, int, int] | None:
    """The occurrence without edits on the diagonal of most hits, if there is one."""
    at, n = np.unique(diagonals, return_counts=True)
    s = int(at[np.argmax(n)])
    if s >= 0 and np.array_equal(text[s : s + len(item)], item):
        return 0, s, s + len(item)
    return None


def search(cps: np.ndarray, index: SimpleNamespace, text_places: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Verified occurrences in one text: (item number, start, end, edits).

    ``text_places`` and ``rows`` are the q-gram hits: place in the text and row of
    the index.  The best occurrence of each item and stretch of bands is given."""
    found = []
    item, place = index.item[rows], index.place[rows]
    order = np.argsort(item, kind="stable")
    item, place, at = item[order], place[order], text_places[order]
    cut = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]]))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        k = int(item[a])
        if b - a < index.bound[k]:
            continue
        e = index.edits[k]
        step = 2 * e + 1
        d = at[a:b] - place[a:b]
        cell = np.floor_divide(d, step)
        size = np.bincount(cell - cell.min())
        if (size[:-1] + size[1:]).max(initial=size.max()) < index.bound[k]:
            continue
        # each hit counts in the band that starts at its cell and in the one before
        key = np.unique(np.concatenate([cell, cell - 1]) * (1 << 32) + np.concatenate([place[a:b], place[a:b]]))
        bands, counts = np.unique(key >> 32, return_counts=True)
        for c in bands[counts >= index.bound[k]]:
            low, high = int(c) * step - e, (int(c) + 2) * step + e
            got = exact(index.codes[k], cps, d[(cell == c) | (cell == c + 1)])
            got = got or align(index.codes[k], cps, low, high, e)
            if got is None:
                continue
            edits, s, t = got
            if found and found[-1][0] == k and s < found[-1][2]:  # the same place through the next band
                if edits < found[-1][3]:
                    found[-1] = (k, s, t, edits)
                continue
            found.append((k, s, t, edits))
    return found


def _searcher(held) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = held.value
        names = [c.split()[0] for c in HITS_SCHEMA.split(", ")]
        for batch in batches:
            out = []
            ids, ths, texts = batch["_id"].tolist(), batch["_th"].tolist(), batch["text"].tolist()
            begin = 0
            while begin < len(texts):
                group, size, stop = [], 0, begin
                while stop < len(texts) and (not group or size + len(texts[stop]) < SLICE_CHARS):
                    group.append(normalise(texts[stop]))
                    size += len(group[-1]) + 1
                    stop += 1
                cps = codes("\n".join(group) + "\n")
                ends = np.cumsum([len(t) + 1 for t in group])
                h = qgrams(cps)
                maybe = np.flatnonzero(index.bits[(h & np.uint64((1 << BITS) - 1)).astype(np.int64)])
                left = np.searchsorted(index.key, h[maybe], side="left")
                many = np.searchsorted(index.key, h[maybe], side="right") - left
                maybe, left, many = maybe[many > 0], left[many > 0], many[many > 0]
                doc = np.searchsorted(ends, maybe, side="right")
                cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(doc) else []
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    k = int(doc[a])
                    base = int(ends[k]) - len(group[k]) - 1
                    n = many[a:b]
                    rows = np.repeat(left[a:b] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    hits = search(cps[base : base + len(group[k])], index, np.repeat(maybe[a:b] - base, n), rows)
                    out += [(ids[begin + k], ths[begin + k], index.ids[i], s, t, e) for i, s, t, e in hits]
                for k, text in enumerate(group):
                    for i, t in index.short:
                        s = text.find(t)
                        while s >= 0:
                            out.append((ids[begin + k], ths[begin + k], i, s, s + len(t), 0))
                            s = text.find(t, s + 1)
                begin = stop
            df = pd.DataFrame(out, columns=names)
            df["_id"] = df["_id"].astype("Int64")
            yield df

    return run


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rate: float = RATE,
) -> DataFrame:
    """Occurrences of benchmark items in the rows' whole texts.

    Returns ``_id``, ``_th`` (text hash), ``item_id``, ``start`` and ``end`` in the
    normalised text, ``edits``; one row per occurrence and row of ``docs``.

    Defined cases: null or blank texts hold nothing; null or blank items and items with a null id
    are not searched; items under 40 characters are found exactly only, those
    under 8 by plain search; repeated rows give repeated results; empty tables give
    none; other columns are not read."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"))
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), text_or_empty("text").alias("text")
    ).distinct()
    found, part, size = [], [], 0

    def flush():
        held = spark.sparkContext.broadcast(build_index(part, Q, rate))
        found.append(shared_table(rows.mapInPandas(giving_back(_searcher(held)), HITS_SCHEMA), "leaks"))
        held.destroy()

    for r in items.orderBy("item_id", "text").toLocalIterator():
        t = normalise(r["text"])
        if not t:
            continue
        if part and size + len(t) > MAX_INDEX_CHARS:
            flush()
            part, size = [], 0
        part.append((r["item_id"], t))
        size += len(t)
    if part or not found:
        flush()
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """All occurrences of ``benchmark`` items in the whole texts of ``documents``."""
    out = contaminated_spans(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("_id").alias("doc_id"), "item_id", "start", "end", "edits")
