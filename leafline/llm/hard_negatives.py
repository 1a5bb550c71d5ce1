"""Hard-negative mining with rotated one-bit codes.

Codes.  A vector is rotated (random signs and Walsh-Hadamard transforms, from a fixed
seed) and replaced by the signs of its coordinates.  Stored with the 64-bit words are the
alignment of vector and code and what is left of the vector.  One bit a
dimension leaves about 0.6 of a vector's length, which is wide for 64 dimensions, so the
rest is rotated and coded again in the same way, ``LEVELS`` times.

Search.  Anchors, rotated likewise, are split into bit planes.  Popcounts of code and plane give the
estimate of an inner product; by Cauchy and Schwarz the true one differs from it by at most
(length of the rest) x (length of the anchor) + the sum of (length of a coded part) x (length of what the
planes leave of the anchor).  A row whose interval can't reach what is asked for goes
after the first level that says so; what survives all levels is scored in integers.
The interval holds for every row, so the results are exact.

Anchors come in chunks of at most ``CHUNK`` rows, broadcast one after the other; all rows meet them in
blocks, and a task sends on only its own best rows for each anchor."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.llm.common import read_table, shared_table

#: codes of a vector, bit planes of an anchor, anchors of a chunk
LEVELS, PLANES, CHUNK = 4, 8, 8192
#: rows and anchors that meet at once
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 256
#: positives of an anchor, negatives of a positive, and the least share of its positive's score a negative has
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
SEED = 20240229
#: greatest squared length: 100 times a score stays below 2^63
MOST = float(1 << 56)

CODED = "row bigint, vec_id bigint, label bigint, v array<int>, codes array<bigint>, scales array<double>, rests array<double>"
FOUND = "anchor bigint, slot int, vec_id bigint, score bigint"


def width(dims: int) -> int:
    """The power of two, 64 at least, that holds the dimensions."""
    return max(64, 1 << max(dims - 1, 0).bit_length())


def rotated(x: np.ndarray, level: int) -> np.ndarray:
    """Rows of ``x`` (n x a power of two) after three rounds of random signs (others for each
    level) and a Walsh-Hadamard transform; lengths and inner products stay."""
    n, d = x.shape
    signs = np.random.default_rng([SEED, level]).integers(0, 2, (3, d)) * 2.0 - 1.0
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            y = x.reshape(n, d // (2 * h), 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
            h *= 2
        x = x / np.sqrt(d)
    return x


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (n x LEVELS x words), scale of each code and length of the rest after it."""
    rest, codes, scales, rests = v, [], [], []
    for level in range(LEVELS):
        rest = rotated(rest, level)
        plus = rest >= 0
        scale = np.abs(rest).mean(axis=1)  # the alignment with the code, over the code's length
        rest = rest - np.where(plus, scale[:, None], -scale[:, None])
        codes.append(packed(plus))
        scales.append(scale)
        rests.append(np.sqrt((rest * rest).sum(axis=1)))
    return np.concatenate(codes, axis=1), np.stack(scales, axis=1), np.stack(rests, axis=1)


def dense(column: pa.ListArray, d: int) -> np.ndarray:
    """A column of int lists as rows of ``d`` numbers; shorter ones end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), d), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _coder(dims: int) -> Callable:
    d = width(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                codes, scales, rests = encode(dense(part.column("v"), d).astype(np.float64))
                more = [pa.array(list(codes.view(np.int64)), pa.list_(pa.int64()))]
                more += [pa.array(list(x), pa.list_(pa.float64())) for x in (scales, rests)]
                yield pa.RecordBatch.from_arrays(part.columns + more, names=[f.split()[0] for f in CODED.split(", ")])

    return run


def code_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, int]:
    """The coded rows that take part, written once, and the number of dimensions."""
    x = F.col(vector_col)
    big = F.transform(x, lambda c: F.floor(c.cast("double") * 256))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    square = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.pow(F.floor(c.cast("double") * 256).cast("double"), F.lit(2.0)))
    label = F.col(label_col).cast("bigint")
    label = F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.where(F.col(label_col).isNotNull() & x.isNotNull() & good).where(square <= MOST).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
        label.alias("label"), F.transform(big, lambda c: c.cast("int")).alias("v"),
    )
    rows = shared_table(rows, "negatives-rows")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return shared_table(rows.mapInArrow(_coder(dims), CODED), "negatives-codes"), dims


class Anchors:
    """A chunk of anchors as arrays, by label."""

    def __init__(self, rows: list, dims: int):
        d = width(dims)
        rows = sorted(rows, key=lambda r: (r["label"], r["row"]))
        self.row = np.array([r["row"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        self.v = np.zeros((len(rows), d), dtype=np.int64)
        for i, r in enumerate(rows):
            self.v[i, : len(r["v"])] = r["v"]
        turned = self.v.astype(np.float64)
        self.length = np.sqrt((turned * turned).sum(axis=1))
        low, step, lost, total, planes = [], [], [], [], []
        for level in range(LEVELS):
            turned = rotated(turned, level)
            low.append(turned.min(axis=1))
            step.append(np.maximum((turned.max(axis=1) - low[-1]) / ((1 << PLANES) - 1), 1e-300))
            mark = np.rint((turned - low[-1][:, None]) / step[-1][:, None]).astype(np.int64)
            near = low[-1][:, None] + mark * step[-1][:, None]
            # a code's part is sqrt(d) x its scale long
            lost.append(np.sqrt(((turned - near) ** 2).sum(axis=1)) * np.sqrt(d))
            total.append(near.sum(axis=1))
            planes.append(np.stack([packed((mark >> b) & 1 == 1) for b in range(PLANES)], axis=1))
        self.low, self.step, self.lost, self.total, self.planes = (np.stack(x) for x in (low, step, lost, total, planes))
        self.floors = np.full((len(rows), 1), -np.inf)  # least wanted score per slot
        self.caps = np.full((len(rows), 1), np.inf)


def level_estimate(code: np.ndarray, scale: np.ndarray, a: Anchors, level: int, j) -> np.ndarray:
    """Estimated share of one code in the inner products, from popcounts.

    ``code`` (... x words) against the planes of the anchors ``j``, broadcast.  The sum over the
    dimensions of code x anchor is twice the sum over set bits less the sum over all."""
    planes = a.planes[level][j]
    above = np.zeros(np.broadcast_shapes(code.shape[:-1], planes.shape[:-2]))
    for b in range(PLANES):
        above += np.bitwise_count(code & planes[..., b, :]).sum(axis=-1, dtype=np.int64) * float(1 << b)
    ones = np.bitwise_count(code).sum(axis=-1, dtype=np.int64)
    return scale * (2.0 * (a.low[level][j] * ones + a.step[level][j] * above) - a.total[level][j])


class Best:
    """The first ``most`` rows of each (anchor, slot) so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, anchors: int, slots: int, most: int):
        self.slots, self.most = slots, most
        self.bar = np.full((anchors, slots), -np.inf)  # the last place's score once all places are taken
        self.key = self.score = self.id = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, key: np.ndarray, score: np.ndarray, null: np.ndarray, ident: np.ndarray) -> None:
        if not len(key):
            return
        key, score, null, ident = (np.concatenate(p) for p in ((self.key, key), (self.score, score), (self.null, null), (self.id, ident)))
        order = np.lexsort((ident, null, -score, key))
        k = key[order]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        place = np.arange(len(k)) - np.repeat(new, np.diff(np.concatenate([new, [len(k)]])))
        order = order[place < self.most]
        self.key, self.score, self.null, self.id = key[order], score[order], null[order], ident[order]
        last = place[place < self.most] == self.most - 1
        self.bar.ravel()[self.key[last]] = self.score[last]


def survivors(a: Anchors, j: slice, code, scale, rest, wanted: np.ndarray, bars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, anchor of ``j``) whose interval reaches a slot of the anchor after every level.

    ``bars``: what a row must reach per anchor and slot; ``caps`` of the anchors bound it from above."""
    floors = np.maximum(a.floors[j], bars[j])
    caps, words = a.caps[j], code.shape[1] // LEVELS
    names = np.arange(floors.shape[0]) + j.start
    r, n = np.nonzero(wanted)
    if not len(r):
        return r, names[n]
    est, loss = np.zeros(len(r)), np.zeros(len(r))
    length = scale.sum(axis=1) * np.sqrt(64 * words) + rest[:, -1]  # of the row, at most
    for level in range(LEVELS):
        here = slice(level * words, (level + 1) * words)
        if level:
            est = est + level_estimate(code[r, here], scale[r, level], a, level, names[n])
        else:
            est = level_estimate(code[:, None, here], scale[:, :1], a, level, names[None, :])[r, n]
        loss = loss + scale[r, level] * a.lost[level][names[n]]
        half = rest[r, level] * a.length[names[n]] + loss
        half = half + 1e-9 * (1.0 + a.length[names[n]] * length[r])  # rounding
        ok = np.zeros(len(r), bool)
        for s in range(floors.shape[1]):
            ok |= (est + half >= floors[n, s]) & (est - half <= caps[n, s])
        r, n, est, loss = r[ok], n[ok], est[ok], loss[ok]
    return r, names[n]


def _searcher(anchors, same: bool, most: int, dims: int) -> Callable:
    """A ``mapInArrow`` function: the task's best rows of each anchor and slot."""
    d = width(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Anchors = anchors.value
        slots = a.floors.shape[1]
        best = Best(len(a.row), slots, most)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                row, label = (part.column(c).to_numpy() for c in ("row", "label"))
                null = part.column("vec_id").is_null().to_numpy(zero_copy_only=False)
                ident = part.column("vec_id").fill_null(0).to_numpy()
                v = dense(part.column("v"), d)
                n = len(row)
                code = part.column("codes").flatten().to_numpy().reshape(n, -1).view(np.uint64)
                scale, rest = (part.column(c).flatten().to_numpy().reshape(n, LEVELS) for c in ("scales", "rests"))
                for b in range(0, len(a.row), BLOCK_ANCHORS):
                    j = slice(b, min(b + BLOCK_ANCHORS, len(a.row)))
                    wanted = (label[:, None] == a.label[None, j]) == same
                    if same:
                        wanted &= row[:, None] != a.row[None, j]
                    r, k = survivors(a, j, code, scale, rest, wanted, best.bar)
                    for cut in range(0, len(r), 1 << 16):
                        rr, kk = r[cut : cut + (1 << 16)], k[cut : cut + (1 << 16)]
                        score = np.einsum("ij,ij->i", v[rr], a.v[kk])
                        for s in range(slots):
                            ok = np.ones(len(rr), bool)
                            if not same:
                                p = a.positive[kk, s]
                                ok = (a.taken[kk, s]) & (SHARE * p <= 100 * score) & (score <= p)
                            ok &= score >= best.bar[kk, s]
                            best.add(kk[ok] * slots + s, score[ok], null[rr][ok], ident[rr][ok])
        if len(best.key):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a.row[best.key // slots]), pa.array((best.key % slots).astype(np.int32)),
                    pa.array(best.id, mask=best.null), pa.array(best.score),
                ],
                names=[f.split()[0] for f in FOUND.split(", ")],
            )

    return run


def _first(found: DataFrame, most: int) -> DataFrame:
    """The best rows of all tasks, numbered from 1 within (anchor, slot)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def anchor_chunks(anchors: DataFrame, most: int = CHUNK) -> Iterator[list]:
    """All anchors in lists of at most ``most``: by a hash of the row, in as many parts as that takes."""
    parts = max(1, -(-anchors.count() * 5 // (4 * most)))
    while True:
        named = anchors.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(parts)))
        top = named.groupBy("_part").count().agg(F.max("count")).first()[0] or 0
        if top <= most:
            break
        parts *= 2
    for k in range(parts):
        rows = named.where(F.col("_part") == k).select("row", "vec_id", "label", "v").collect()
        if rows:
            yield rows


def hard_negatives(
    vectors: DataFrame, anchor: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)``.

    Anchors are the rows where ``anchor`` holds (on ``vec_id`` and ``label``; as set, ids divisible by 100).  An anchor's
    positives are the first ``POSITIVES`` other rows of its label; for each, the first ``NEGATIVES`` rows of
    other labels whose score is ``SHARE`` to 100 percent of the positive's.

    Defined cases: rows with a null label or vector, or a null or non-finite component take no part, nor do
    those whose squared integer length is over 2^56 (scores would leave a long); of vectors of unlike length the
    shorter ends in zeros; each row of a repeated id is a row of its own; a null id is never an anchor and comes last
    among equal scores; a positive of negative score has no negatives; an empty table gives no rows; other
    columns are not read."""
    spark = vectors.sparkSession
    coded, dims = code_vectors(vectors, id_col, vector_col, label_col)
    chosen = coded.where(F.col("vec_id") % 100 == 0 if anchor is None else anchor)
    chosen = shared_table(chosen.select("row", "vec_id", "label", "v"), "negatives-anchors")
    out = None
    for rows in anchor_chunks(chosen):
        a = Anchors(rows, dims)
        sent = spark.sparkContext.broadcast(a)
        positives = _first(coded.mapInArrow(_searcher(sent, True, POSITIVES, dims), FOUND), POSITIVES)
        positives = shared_table(positives, "negatives-positives", 10_000)
        sent.destroy()
        # at most POSITIVES per anchor of the chunk
        place = {r: i for i, r in enumerate(a.row.tolist())}
        a.positive = np.zeros((len(a.row), POSITIVES), np.int64)
        a.taken = np.zeros((len(a.row), POSITIVES), bool)
        for p in positives.select("anchor", "place", "score").collect():
            a.positive[place[p["anchor"]], p["place"] - 1] = p["score"]
            a.taken[place[p["anchor"]], p["place"] - 1] = p["score"] >= 0
        a.caps = np.where(a.taken, a.positive, -np.inf).astype(np.float64)
        a.floors = np.where(a.taken, a.positive * (SHARE / 100.0) * (1 - 1e-12) - 1e-6, np.inf)
        sent = spark.sparkContext.broadcast(a)
        negatives = _first(coded.mapInArrow(_searcher(sent, False, NEGATIVES, dims), FOUND), NEGATIVES)
        negatives = shared_table(negatives, "negatives-found", 10_000)
        sent.destroy()
        of = positives.select(
            F.col("anchor").alias("_anchor"), (F.col("place") - 1).alias("_slot"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("place").alias("positive_rank"),
        )
        both = negatives.join(of, (F.col("anchor") == F.col("_anchor")) & (F.col("slot") == F.col("_slot")))
        both = both.join(chosen.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id")), F.col("anchor") == F.col("_row"))
        both = both.select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"), "positive_rank",
        )
        both = shared_table(both, "negatives-chunk", 10_000)
        out = both if out is None else out.unionByName(both)
    if out is None:
        out = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint, positive_rank int")
    return out


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every row of ``embeddings`` whose id is divisible by 100."""
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


ORACLES = {
    "op12_hard_negatives": f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS bid, a.label = b.label AS same,
    list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT ar, anchor_id, bid AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY ar ORDER BY score DESC, bid)::INTEGER AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, positive_id, positive_rank, bid AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, positive_rank ORDER BY score DESC, bid)::INTEGER AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT same AND {SHARE} * positive_score <= 100 * score AND score <= positive_score
  QUALIFY rank <= {NEGATIVES})
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n
"""
}
