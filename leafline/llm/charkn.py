"""Character n-gram counts over the corpus and Kneser-Ney tables from them.

Counting.  Each task slides a window of five code points over its texts and
counts distinct 5-grams with numpy; Spark sums the counts.  Only 5-gram *types*
and counts are shuffled, never texts.

Tables.  All estimates are joins and aggregates on the sharded type tables: a
count or context is looked up by key, a lower order comes from the distinct
5-grams through continuation counts.

Scoring.  A document's value is a sum over its 5-grams of a per-type value.  The
``HOT`` most frequent types (a fixed number, whatever the corpus) are sent to
every task as arrays; all other 5-grams of a document are emitted as rows and
join the sharded table.  Nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import give_back, shared_table, text_or_empty

ORDER = 5
#: code points put before the first and after the last character of a text
START, END = 2, 3
#: types that every task holds at most (about 50 MB), the same for any corpus
HOT = 1 << 20
#: code points worked on at once, and types held before they are merged; more than half of that is sent
SLICE_CHARS, FLUSH_TYPES = 150_000, 400_000
#: rows sent at once, so that no worker holds many as Python strings
SENT_ROWS = 50_000
BASE = np.uint64(0x9E3779B97F4A7C15)

SCORED_SCHEMA = "_id bigint, _th bigint, _kind int, _values array<double>, _n bigint, g string, _c bigint, _tag string"


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each between start and end marks, and
    the offset of each text (one more offset at the end)."""
    pad = chr(START) * (ORDER - 1)
    joined = "".join(f"{pad}{t}{chr(END)}" for t in texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if (cps == 0).any():  # a NUL would be cut off the end of a 5-gram
        cps = np.where(cps == 0, np.uint32(0x1A), cps)
    sizes = np.fromiter((len(t) + ORDER for t in texts), dtype=np.int64, count=len(texts))
    return cps, np.concatenate([[0], np.cumsum(sizes)])


def gram_keys(cps: np.ndarray) -> np.ndarray:
    """64-bit key of the 5-gram that begins at each place."""
    c = cps.astype(np.uint64)
    n = len(c) - ORDER + 1
    h = c[:n].copy()
    for i in range(1, ORDER):
        h *= BASE
        h += c[i : i + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def gram_strings(cps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 5-grams that begin at the given places, as strings."""
    rows = cps[at[:, None] + np.arange(ORDER)]
    return np.ascontiguousarray(rows).view(f"<U{ORDER}").ravel()


def inside(starts: np.ndarray, total: int) -> np.ndarray:
    """Which places begin a 5-gram that stays inside its text."""
    ok = np.ones(total - ORDER + 1, dtype=bool)
    for b in starts[1:-1]:
        ok[b - ORDER + 1 : b] = False
    return ok


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct value, rising, and the number of every value among them.

    Places are written into an open table, the first of a slot last, and read back: a value
    meets its own first place or another value's; only the latter go another round, with another hash."""
    n = len(values)
    bits = max(8, int(2 * n).bit_length())
    first = np.empty(n, np.int32)
    table, left, salt = np.empty(1 << bits, np.int32), np.arange(n, dtype=np.int32), 0x9E3779B97F4A7C15
    while len(left):
        v = values[left]
        slot = ((v * np.uint64(salt)) >> np.uint64(64 - bits)).astype(np.intp)
        table[slot[::-1]] = left[::-1]
        found = table[slot]
        same = values[found] == v
        first[left[same]] = found[same]
        left, salt = left[~same], salt * 0xD1342543DE82EF95 % (1 << 64)
    at = np.flatnonzero(first == np.arange(n, dtype=np.int32))
    number = np.empty(n, np.int32)
    number[at] = np.arange(len(at), dtype=np.int32)
    return at, number[first]


def first_places(keys: np.ndarray, ok: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of the places in ``ok`` those where a text has its 5-gram for the first time."""
    of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(keys)]
    at = np.flatnonzero(ok)
    both = keys[at] + of[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    both ^= both >> np.uint64(30)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    once = np.zeros(len(keys), bool)
    once[at[distinct(both)[0]]] = True
    return once


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` characters."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n + ORDER
    if begin < len(sizes):
        yield begin, len(sizes)


def _counter(classes: int, once: bool) -> Callable:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        waiting = 0

        def merged():
            keys, grams, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return keys[first], grams[order[first]], np.add.reduceat(counts[order], first, axis=0)

        def frames(h):
            for i in range(0, len(h[0]), SENT_ROWS):
                part = slice(i, i + SENT_ROWS)
                out = {"g": h[1][part].astype(object)}
                out |= {f"n{k}": h[2][part, k] for k in range(classes + 1)}
                yield pd.DataFrame(out)

        for batch in batches:
            texts, cls = batch["text"].tolist(), batch["cls"].to_numpy()
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                cps, starts = padded(texts[a:b])
                keys = gram_keys(cps)
                ok = inside(starts, len(cps))
                if once:
                    ok = first_places(keys, ok, starts)
                at = np.flatnonzero(ok)
                keys = keys[at]
                where, place = distinct(keys)
                counts = np.zeros((len(where), classes + 1), dtype=np.int64)
                counts[:, classes] = np.bincount(place, minlength=len(where))
                of = np.repeat(cls[a:b], np.diff(starts))[at]
                for k in range(classes):
                    if (of == k).any():
                        counts[:, k] = np.bincount(place[of == k], minlength=len(where))
                held.append((keys[where], gram_strings(cps, at[where]), counts))
                waiting += len(where)
                if waiting > FLUSH_TYPES:
                    held.append(merged())
                    waiting = len(held[0][0])
                    if waiting > FLUSH_TYPES // 2:
                        yield from frames(held.pop())
                        waiting = 0
                        give_back()
        if held:
            yield from frames(merged())
        give_back()

    return count


def count_grams(
    docs: DataFrame, cls: Column, classes: int, text_col: str = "text", once: bool = False
) -> DataFrame:
    """Counts of all 5-gram types: ``g``, ``n0`` .. per class, and ``n{classes}``
    over every row.  ``cls`` is the class number, -1 for none.  With ``once`` a text
    counts a type once, so that repeated lines weigh no more than others."""
    rows = docs.select(text_or_empty(text_col).alias("text"), F.coalesce(cls, F.lit(-1)).cast("int").alias("cls"))
    names = [f"n{k}" for k in range(classes + 1)]
    schema = "g string, " + ", ".join(f"{n} bigint" for n in names)
    parts = rows.mapInPandas(_counter(classes, once), schema)
    return parts.groupBy("g").agg(*[F.sum(n).alias(n) for n in names])


def suffix(c: str, k: int) -> Column:
    """The last ``k`` characters of a gram of ``k + 1``."""
    return F.substring(F.col(c), 2, k)


def discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more.

    Where counts of counts are too few to tell, 0.5, 0.75 and 0.9."""
    at = [F.count(F.when(F.col("c") == k, 1)).alias(f"k{k}") for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = counts.agg(*at).first()
    default = [0.5, 0.75, 0.9]
    if not (n1 and n2 and n3 and n4):
        return default
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [d if 0 < d < k else z for d, k, z in zip(found, (1, 2, 3), default, strict=True)]


def discounted(d: list[float], c: Column | None = None) -> Column:
    c = F.col("c") if c is None else c
    cut = F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
    return F.greatest(c - cut, F.lit(0.0))


def contexts(counts: DataFrame, k: int, d: list[float]) -> DataFrame:
    """Per context of ``k - 1`` characters: total and back-off weight."""
    n = lambda cond: F.count(F.when(cond, 1))
    c = F.col("c")
    total = F.sum("c")
    free = d[0] * n(c == 1) + d[1] * n(c == 2) + d[2] * n(c >= 3)
    return counts.groupBy(F.substring("g", 1, k - 1).alias("h")).agg(
        total.alias("total"), (free / total).alias("gamma")
    )


def interpolate(types: DataFrame, counts: DataFrame, lower: DataFrame, k: int) -> DataFrame:
    """P_k of each gram of ``types``: its discounted count in its context plus
    the context's back-off weight times P_{k-1} of its suffix."""
    d = discounts(counts)
    seen = counts.select(F.col("g").alias("_cg"), discounted(d).alias("_dc"))
    ctx = contexts(counts, k, d).withColumnRenamed("h", "_h")
    low = lower.select(F.col("g").alias("_lg"), F.col("p").alias("_lp"))
    out = (
        types.join(seen, F.col("g") == F.col("_cg"), "left")
        .join(ctx, F.substring("g", 1, k - 1) == F.col("_h"), "left")
        .join(low, suffix("g", k - 1) == F.col("_lg"))
    )
    own = F.coalesce(F.col("_dc") / F.col("total"), F.lit(0.0))
    return out.select("g", (own + F.coalesce("gamma", F.lit(1.0)) * F.col("_lp")).alias("p"))


def top_order(counts: DataFrame, classes: list[str], lower: DataFrame) -> DataFrame:
    """P_5 of every row of ``counts`` (``g`` and a count per class), as ``p_<class>``.

    The classes share ``lower``, P_4 of the suffixes; contexts and discounts are each
    class's own.  Contexts of all classes come from one aggregate."""
    cut, terms = {}, []
    for c in classes:
        n = F.col(c)
        d = cut[c] = discounts(counts.select(n.alias("c")).where("c > 0"))
        free = sum(x * F.count(F.when(cond, 1)) for x, cond in zip(d, (n == 1, n == 2, n >= 3), strict=True))
        terms += [F.sum(n).alias(f"_total_{c}"), (free / F.nullif(F.sum(n), F.lit(0))).alias(f"_gamma_{c}")]
    ctx = counts.groupBy(F.substring("g", 1, ORDER - 1).alias("_h")).agg(*terms)
    low = lower.select(F.col("g").alias("_lg"), F.col("p").alias("_lp"))
    out = counts.join(ctx, F.substring("g", 1, ORDER - 1) == F.col("_h")).join(low, suffix("g", ORDER - 1) == F.col("_lg"))
    own = {c: F.coalesce(discounted(cut[c], F.col(c)) / F.nullif(F.col(f"_total_{c}"), F.lit(0)), F.lit(0.0)) for c in classes}
    return out.select(
        *counts.columns,
        *[(own[c] + F.coalesce(f"_gamma_{c}", F.lit(1.0)) * F.col("_lp")).alias(f"p_{c}") for c in classes],
    )


def lower_orders(types: DataFrame, counts: DataFrame) -> DataFrame:
    """P_4 of the last four characters of every 5-gram type.

    ``counts`` (g, c) holds the 5-grams trained on; orders 4 to 1 use their
    continuation counts, order 0 is uniform over the characters of ``types``
    and one unseen character."""
    want, have = {ORDER: types.select("g")}, {ORDER: counts.where(F.col("c") > 0)}
    for k in range(ORDER - 1, 0, -1):
        want[k] = want[k + 1].select(suffix("g", k).alias("g")).distinct()
        have[k] = have[k + 1].groupBy(suffix("g", k).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        if k == ORDER - 1:
            want[k], have[k] = shared_table(want[k], "kn-want"), shared_table(have[k], "kn-have")
    d = discounts(have[1])
    total, n1, n2, n3 = have[1].agg(
        F.coalesce(F.sum("c"), F.lit(0)), *[F.count(F.when(x, 1)) for x in (F.col("c") == 1, F.col("c") == 2, F.col("c") >= 3)]
    ).first()
    chars = want[1].count() + 1
    gamma = (d[0] * n1 + d[1] * n2 + d[2] * n3) / total if total else 1.0
    seen = have[1].select(F.col("g").alias("_cg"), (discounted(d) / max(total, 1)).alias("_dc"))
    p = want[1].join(seen, F.col("g") == F.col("_cg"), "left").select(
        "g", (F.coalesce("_dc", F.lit(0.0)) + gamma / chars).alias("p")
    )
    for k in range(2, ORDER):
        p = interpolate(want[k], have[k], p, k)
    return p


def hot_types(table: DataFrame, frequency: str, value: str, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of the most frequent types, at most ``most``.

    The least frequency comes from a table of frequencies, so that no
    sort of all types is needed."""
    by_count = table.groupBy(frequency).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col(frequency).desc())
    least, held = None, 0
    for r in by_count.toLocalIterator():
        if held + r["n"] > most:
            break
        least, held = r[frequency], held + r["n"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    rows = table.where(F.col(frequency) >= least).select("g", F.col(frequency).cast("bigint").alias("f"), F.col(value).cast("double").alias("v"))
    got = rows.mapInPandas(_keyed, "k bigint, f bigint, v double").toArrow()
    keys, often, values = (got[c].to_numpy() for c in ("k", "f", "v"))
    del got
    keys = keys.view(np.uint64)
    order = np.lexsort((keys, often))
    out = keys[order], values[order]
    give_back()
    return out


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Types as their keys, so that the driver gets numbers only and holds no strings."""
    for batch in batches:
        if len(batch):
            cps = np.frombuffer("".join(batch["g"]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            yield pd.DataFrame({"k": gram_keys(cps)[::ORDER].astype(np.int64), "f": batch["f"], "v": batch["v"]})


def slots(keys: np.ndarray, values: np.ndarray) -> tuple:
    """An open table: the slot of a key is its low bits and holds its row.

    Keys come by rising frequency; of those that share a slot the most frequent has it, the others
    are found in the sorted keys."""
    bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2))))
    row = np.full(1 << bits, -1, np.int32)
    row[(keys & np.uint64((1 << bits) - 1)).astype(np.int64)] = np.arange(len(keys), dtype=np.int32)
    order = np.argsort(keys, kind="stable").astype(np.int32)
    return keys, values, row, order


def lookup(held: tuple, keys: np.ndarray) -> np.ndarray:
    """Row of each key in the table, -1 for keys that it lacks."""
    known, _, row, order = held
    if not len(known):
        return np.full(len(keys), -1, np.int32)
    got = row[(keys & np.uint64(len(row) - 1)).astype(np.int64)]
    miss = np.flatnonzero(known[got] != keys)  # row -1 looks at the last key, which also differs
    at = np.minimum(np.searchsorted(known, keys[miss], sorter=order), len(known) - 1)
    found = order[at]
    got[miss] = np.where(known[found] == keys[miss], found, -1)
    return got


def _scorer(table, once: bool, excess: tuple[float, ...]) -> Callable:
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = slots(*table.value)
        cols = [c.split()[0] for c in SCORED_SCHEMA.split(", ")]
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices([len(t) for t in texts], SLICE_CHARS):
                cps, starts = padded(texts[a:b])
                keys = gram_keys(cps)
                ok = inside(starts, len(cps))
                if once:
                    ok = first_places(keys, ok, starts)
                row = np.full(len(keys), -1, np.int32)
                row[ok] = lookup(held, keys[ok])
                hit = row >= 0
                sums = np.zeros((b - a, 1 + len(excess)))
                if len(held[0]):
                    value = np.where(hit, held[1][row], 0.0)
                    sums[:, 0] = np.add.reduceat(value, starts[:-1])
                    for k, x in enumerate(excess):
                        sums[:, k + 1] = np.add.reduceat(np.maximum(value - x, 0.0), starts[:-1])
                size = np.add.reduceat(np.append(ok, np.zeros(ORDER - 1, bool)).astype(np.int64), starts[:-1])
                ids, ths = batch["_id"].iloc[a:b], batch["_th"].to_numpy()[a:b]
                done = pd.DataFrame({"_id": ids.astype("Int64"), "_th": ths, "_kind": 0, "_values": list(sums), "_n": size, "g": None, "_c": 0, "_tag": batch["_tag"].iloc[a:b]})
                yield done[cols]
                rare = np.flatnonzero(ok & ~hit)
                if len(rare):
                    of = np.searchsorted(starts, rare, side="right") - 1
                    tail = pd.DataFrame({"of": of, "g": gram_strings(cps, rare).astype(object)})
                    tail = tail.groupby(["of", "g"], sort=False).size().reset_index(name="_c")
                    of = tail["of"].to_numpy()
                    # the first row of a document's tail counts its occurrences
                    lead = np.concatenate([[1], (of[1:] != of[:-1]).astype(int)])
                    out = pd.DataFrame({"_th": ths[of], "_kind": 1, "_values": None, "_n": lead, "g": tail["g"], "_c": tail["_c"], "_tag": None})
                    out["_id"] = ids.astype("Int64").array[of]
                    for i in range(0, len(out), 100_000):
                        yield out.iloc[i : i + 100_000][cols]
        del held
        give_back()

    return score


def score_documents(
    docs: DataFrame, table: DataFrame, frequency: str, value: str,
    id_col: str = "doc_id", text_col: str = "text", tag_col: str | None = None,
    once: bool = False, excess: tuple[float, ...] = (), hot: int = HOT,
) -> DataFrame:
    """Sum of ``value`` over the 5-grams of every row's text (with ``once`` over the
    distinct ones), and of what exceeds each of ``excess`` in a 5-gram.

    ``table`` has ``g``, ``frequency`` and ``value`` for every type of the corpus.
    Returns ``_id``, ``_th`` (text hash), ``_tag`` (of ``tag_col``), the sums under the name of
    the value and ``over0``, ``over1``, ..., and ``n`` (5-grams; all: one more than the
    characters), a row for each row of ``docs``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(hot_types(table, frequency, value, hot))
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text).alias("_th"), text.alias("text"),
        (F.col(tag_col).cast("string") if tag_col else F.lit(None).cast("string")).alias("_tag"),
    )
    scored = shared_table(rows.mapInPandas(_scorer(held, once, excess), SCORED_SCHEMA), "kn-scored")
    held.destroy()
    whole = scored.where("_kind = 0").select("_id", "_th", "_tag", "_values", "_n")
    key = table.select(F.col("g").alias("_tg"), F.coalesce(value, F.lit(0.0)).alias("_tv"))
    parts = [F.col("_tv"), *[F.greatest(F.col("_tv") - x, F.lit(0.0)) for x in excess]]
    # rows that repeat (id, text) emit the same tail; each gets one share
    rare = scored.where("_kind = 1").join(key, F.col("g") == F.col("_tg"), "left").groupBy(
        F.col("_id").alias("_rid"), F.col("_th").alias("_rth")
    ).agg(*[(F.sum(F.coalesce(v, F.lit(0.0)) * F.col("_c")) / F.sum("_n")).alias(f"_r{k}") for k, v in enumerate(parts)])
    out = whole.join(rare, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left")
    names = [value, *[f"over{k}" for k in range(len(excess))]]
    return out.select(
        "_id", "_th", "_tag", F.col("_n").alias("n"),
        *[(F.get("_values", F.lit(k)) + F.coalesce(f"_r{k}", F.lit(0.0))).alias(v) for k, v in enumerate(names)],
    )
