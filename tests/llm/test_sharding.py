import heapq
import random
from collections import Counter, defaultdict

import pytest

from leafline.llm.sharding import lpt_plan, shard_documents

from .conftest import make_docs, odd_rows


def naive_loads(sizes, shards):
    heap = [(0, i) for i in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, i))
    return sorted(heap, key=lambda x: x[1])


@pytest.mark.parametrize("seed", range(6))
def test_runs_deal_like_one_at_a_time(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 1, 1, 5, 7, 7, 40, rng.randint(1, 900)]) for _ in range(2000)]
    for shards in (1, 3, 16):
        loads = [0] * shards
        for size, ends in lpt_plan(list(Counter(sizes).items()), shards):
            before = 0
            for i, e in enumerate(ends):
                loads[i] += (e - before) * size
                before = e
        assert loads == [x for x, _ in naive_loads(sizes, shards)]


def check(rows, got, shards):
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = defaultdict(set)
    for r in got:
        texts[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in texts.values())


def test_odd_rows(spark, odd):
    check([(i, t) for i, t in odd_rows()], shard_documents(odd, 4).collect(), 4)


def test_loads_match_the_heap_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 60) + str(i)) for i in range(400)] + [(1000 + i, "copy of a text") for i in range(200)]
    got = shard_documents(make_docs(spark, rows), 8).collect()
    check(rows, got, 8)
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    sizes = [len(t) + 1 for _, t in rows[:400]] + [200 * 15]
    assert sorted(loads.values()) == sorted(x for x, _ in naive_loads(sizes, 8))


def test_empty(none):
    assert shard_documents(none, 4).count() == 0
