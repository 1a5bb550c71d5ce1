import numpy as np
import pytest

import leafline.llm.hard_negatives as H
from leafline.llm.hard_negatives import Anchors, encode, hard_negatives, level_estimate, rotated

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, anchor string, slot string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows):
    keep = []
    for i, x, y in rows:
        if y is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        keep.append((i, np.floor(256 * np.array(x, np.float32).astype(float)).astype(object), (y + 1) % 10 if i is not None and i % 7 == 0 else y))
    last = 1 << 70
    out = []

    def dot(a, b):
        return int(sum(int(p) * int(q) for p, q in zip(a, b)))

    for k, (i, x, y) in enumerate(keep):
        if i is None or i % 100:
            continue
        score = [(-dot(x, x2), last if j is None else j, y2) for m, (j, x2, y2) in enumerate(keep) if m != k]
        for at, (s, j, _) in enumerate(sorted(r for r in score if r[2] == y)[:5]):
            found = sorted(r for r in score if r[2] != y and 80 * -s <= 100 * -r[0] <= 100 * -s)[:5]
            out += [(i, j, n + 1, j2, -s, -s2, at + 1) for n, (s2, j2, _) in enumerate(found)]
    return sorted(out)


def found(df):
    last = 1 << 70
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
    return sorted(tuple(last if r[c] is None else r[c] for c in names) for r in df.collect())


def clustered(n, dims, seed=1, spread=0.6, labels=10):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(labels, dims))
    y = rng.integers(0, labels, n)
    x = middle[y] + spread * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, x[i].astype(np.float32).tolist(), int(y[i])) for i in range(n)]


@pytest.mark.parametrize("dims", [5, 64, 100])
def test_equals_brute_force(spark, dims):
    rows = clustered(600, dims)
    assert found(hard_negatives(table(spark, rows).repartition(5))) == brute(rows)


def test_small_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 50)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 3)
    rows = [(i * 20, x, y) for i, x, y in clustered(300, 16, labels=3)]
    df = table(spark, rows)
    chunks = [len(c) for c in H.anchor_chunks(df.selectExpr("vec_id as row", "vec_id", "label", "embedding v").where("vec_id % 100 = 0"), 7)]
    assert max(chunks) <= 7 and sum(chunks) == 60
    monkeypatch.setattr(H.anchor_chunks, "__defaults__", (7,))
    assert found(hard_negatives(df)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, 0.5, 0.25, 0.0]
    rows = [
        (0, same, 1), (0, same, 1), (0, [0.1, 0.2, 0.3, 0.4], 2), (1, same, 1), (2, same, 1), (2, same, 1), (3, same, 2), (3, same, 2),
        (4, [0.5, 0.4, 0.3, 0.1], 2), (None, same, 1), (None, same, 2), (100, same, None), (200, None, 1), (300, [nan, 0.0, 0.0, 0.0], 1),
        (400, [inf, 0.0, 0.0, 0.0], 1), (500, [None, 0.0, 0.0, 0.0], 1), (600, [0.0] * 4, 2), (700, [-0.5, -0.5, 0.0, 0.0], 1), (-100, same, 3),
        (8, [], 1), (800, [], 4), (900, [0.5, 0.5], 2), (5, [0.0] * 4, 1), (6, [0.0] * 4, 2), (14, same, 9), (1000, same, 0),
    ]
    assert found(hard_negatives(table(spark, rows))) == brute(rows)


def test_ties_and_many_copies(spark):
    rows = [(i, [1.0, 0.0, 0.0], 1 + i % 2) for i in range(400)]
    assert found(hard_negatives(table(spark, rows).repartition(9))) == brute(rows)


def test_too_long_vectors_take_no_part(spark):
    rows = [(100, [1e30, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (200, [1.0, 0.0], 1)]
    assert found(hard_negatives(table(spark, rows))) == brute(rows[1:])


def test_empty_table(spark):
    out = hard_negatives(table(spark, []))
    assert out.collect() == [] and "anchor_id" in out.columns


def test_intervals_hold():
    rng = np.random.default_rng(3)
    v = rng.integers(-200, 200, (300, 64)).astype(float)
    v[:5] = [[7.0] * 64, [0.0] * 64, [1.0] + [0.0] * 63, [-3.0, 3.0] * 32, [100.0] + [0.0] * 63]
    turned = rotated(v, 0)
    assert np.allclose(turned @ turned.T, v @ v.T)
    codes, scales, rests = encode(v)
    a = Anchors([{"row": i, "label": 0, "v": v[i].astype(int).tolist()} for i in range(60)], 64)
    true, est, loss, widths = v @ a.v.T, 0.0, 0.0, []
    for level in range(H.LEVELS):
        est = est + level_estimate(codes[:, None, level : level + 1], scales[:, level : level + 1], a, level, np.arange(60)[None, :])
        loss = loss + scales[:, level : level + 1] * a.lost[level][None]
        half = rests[:, level : level + 1] * a.length[None] + loss
        assert (np.abs(est - true) <= half + 1e-6).all()
        widths.append(half.mean())
    assert widths[-1] < 0.3 * widths[0]
