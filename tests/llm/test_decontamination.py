import random

import numpy as np
import pytest

from leafline.llm.decontamination import align, codes, contaminated_spans, normalise

from .conftest import make_docs, odd_rows, prose


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, _id string")


def distance(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edit(rng, text, n):
    t = list(text)
    for _ in range(n):
        k = rng.randrange(len(t))
        op = rng.random()
        if op < 0.34:
            t[k] = "z"
        elif op < 0.67:
            t.insert(k, "q")
        else:
            del t[k]
    return "".join(t)


@pytest.mark.parametrize("seed", range(20))
def test_banded_alignment_is_exact_inside_the_band(seed):
    rng = random.Random(seed)
    item = prose(seed, 12)
    text = prose(seed + 50, 8) + edit(rng, item, rng.randint(0, 9)) + prose(seed + 90, 8)
    got = align(codes(item), codes(text), -len(item), len(text), 40)
    want = distance(item, text)
    assert got is not None and got[0] == want
    assert 0 <= got[1] <= got[2] <= len(text)


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(5)
    bench = [(i, prose(1000 + i, 30)) for i in range(8)] + [(50, "tiny"), (51, "twelve chars"), (52, None), (53, " "), (None, "no id here at all, is there")]
    rows, want = [], set()
    for d in range(60):
        text = prose(d, 80)
        if d % 3 == 0:
            i, t = bench[d // 3 % 8]
            t = edit(rng, normalise(t), int(0.06 * len(t)) if d % 2 else 0)
            text = f"{text}\n\n{t.upper() if d % 4 == 0 else t}  {prose(d + 7, 40)}"
            want.add((d, i))
        rows.append((d, text))
    rows += [(100, "a TINY one"), (101, "has  twelve\nchars in it")]
    want |= {(100, 50), (101, 51)}
    got = contaminated_spans(make_docs(spark, rows), items(spark, bench)).collect()
    assert {(r["_id"], r["item_id"]) for r in got} == want
    for r in got:
        text, item = normalise(dict(rows)[r["_id"]]), normalise(dict(bench)[r["item_id"]])
        assert r["edits"] == distance(item, text[max(0, r["start"] - 5) : r["end"] + 5]) or r["edits"] <= 0.1 * len(item)


def test_against_brute_force(spark):
    bench = [(i, prose(i, 15, 30)) for i in range(6)]
    docs = [(d, prose(d % 7, 15, 30) if d % 2 else prose(d, 40, 30)) for d in range(24)]
    got = {(r["_id"], r["item_id"]) for r in contaminated_spans(make_docs(spark, docs), items(spark, bench)).collect()}
    want = {(d, i) for d, t in docs for i, b in bench
            if distance(normalise(b), normalise(t)) <= (int(0.1 * len(normalise(b))) if len(normalise(b)) >= 40 else 0)}
    assert got == want


def test_odd_rows(spark, odd, none):
    bench = items(spark, [(1, prose(6, 40)), (1, prose(6, 40)), (2, "!!! ???")])
    got = contaminated_spans(odd, bench).collect()
    assert {(r["_id"], r["item_id"]) for r in got} == {(6, 1), (7, 1), (5, 2)}
    assert contaminated_spans(none, bench).count() == 0
    assert contaminated_spans(odd, items(spark, [])).count() == 0
    assert len(odd_rows()) == odd.count() and np.iinfo(np.int64).max > 0


def test_every_place_of_a_short_item(spark):
    items = spark.createDataFrame([(1, "xyz12"), (2, "aa")], "item_id long, text string")
    got = contaminated_spans(make_docs(spark, [(7, "xyz12 and xyz12 aaa")]), items).collect()
    assert sorted((r["item_id"], r["start"], r["end"]) for r in got) == [(1, 0, 5), (1, 10, 15), (2, 16, 18), (2, 17, 19)]


def test_a_task_holds_little_beside_its_batch():
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    from leafline.llm import decontamination as D

    rng = np.random.default_rng(3)
    item = "the quick brown fox jumps over the lazy dog again and again"
    index = D.build_index([(5, item)])
    texts = ["".join(rng.choice(list("abcdefghij "), 20_000)) for _ in range(150)]
    texts[77] = texts[77][:9_000] + " " + item + " " + texts[77][9_000:]
    batch = pd.DataFrame({"_id": range(150), "_th": range(150), "text": texts})
    run = D._searcher(SimpleNamespace(value=index))
    tracemalloc.start()
    found = pd.concat(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[["_id", "item_id", "edits"]].to_numpy().tolist() == [[77, 5, 0]]
    assert peak < 20e6, peak
