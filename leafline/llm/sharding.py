"""Sharding by longest-processing-time scheduling.

Rows whose text is equal form a group that must stay together.  Groups are
taken by falling size and each goes to the shard with the least load, kept in
a heap.

A run of groups that have the same size is dealt at once, with the result the
heap would give one group at a time: group ``j`` of the run that lands on
shard ``i`` is taken when that shard's load is ``load_i + j * size``, so the
``c`` smallest of these values (ties by shard number) are the ones taken.
The driver therefore sees one row per *distinct size*; as the sizes of a run
list add up to at most the total bytes, there are at most ``sqrt(2 * bytes)``
of them, whatever the number of groups.  Which group of a run goes to which of the run's
places, and the slots inside a shard, come from counts per hashed cell, so no
window holds more than a cell.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.llm.common import read_table, shared_table, text_or_empty

#: Rows that a cell of the ranking windows holds on average.
CELL_ROWS = 20_000


def deal_run(heap: list[tuple[int, int]], size: int, count: int) -> list[int]:
    """Deal ``count`` groups of equal ``size``; update ``heap`` in place.

    ``heap`` holds (load, shard).  Returns how many go to each shard."""
    shards = len(heap)
    dealt = [0] * shards
    if count > 4 * shards:
        # Every place below the level is taken for certain: the largest level
        # whose places (load + j * size < level) number at most ``count``.
        lo, hi = heap[0][0], heap[0][0] + size * (count + 1)

        def taken(level: int) -> list[int]:
            out = [0] * shards
            for load, i in heap:
                out[i] = max(0, -((load - level) // size))
            return out

        while lo < hi:
            mid = (lo + hi + 1) // 2
            if sum(taken(mid)) <= count:
                lo = mid
            else:
                hi = mid - 1
        dealt = taken(lo)
        heap[:] = [(load + dealt[i] * size, i) for load, i in heap]
        heapq.heapify(heap)
        count -= sum(dealt)
    for _ in range(count):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        dealt[i] += 1
    return dealt


def lpt_plan(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """LPT over ``(size, number of groups)``: per size, the running totals of
    the counts that shards 0, 1, ... take."""
    heap = [(0, i) for i in range(shards)]
    heapq.heapify(heap)
    plan = []
    for size, count in sorted(sizes, reverse=True):
        ends, total = [], 0
        for n in deal_run(heap, size, count):
            total += n
            ends.append(total)
        plan.append((size, ends))
    return plan


def _ranked(df: DataFrame, group: str, cell: str, order: list, rank: str) -> DataFrame:
    """Gapless rank from 0 within ``group``: by cell, then by ``order``.

    Offsets of the cells come from a count per (group, cell); the row number
    is taken inside a cell."""
    counts = df.groupBy(group, cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_og"),
        F.col(cell).alias("_oc"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
    )
    inside = Window.partitionBy(group, cell).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(inside) - 1)
    return out.join(
        offsets, (F.col(group) == F.col("_og")) & (F.col(cell) == F.col("_oc"))
    ).select(*df.columns, (F.col("_off") + F.col("_rn")).cast("bigint").alias(rank))


def shard_documents(
    docs: DataFrame, shards: int = 16, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Shard and slot of every row, by LPT over groups of equal texts.

    Returns ``id_col``, ``size`` (UTF-8 bytes + 1), ``text_crc32``, ``shard``
    (0 .. shards-1) and ``slot`` (gapless from 0 inside a shard).

    Defined cases: a null text counts as empty (size 1, one group with the
    empty texts); repeated rows each get a slot of their own; null ids sort
    first; an empty table gives an empty result; other columns are not read.
    A group of copies of any size stays whole; its rows spread over tasks.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("_g"),
    )
    rows = shared_table(rows, "shard-rows")
    n = rows.count()
    cells = max(4, math.ceil(n / CELL_ROWS))

    groups = rows.groupBy("_g").agg(F.sum("size").alias("_w")).withColumn(
        "_cell", F.pmod(F.xxhash64("_g"), F.lit(cells)).cast("int")
    )
    groups = shared_table(groups, "shard-groups")
    runs = groups.groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    plan = lpt_plan([(r["_w"], r["_n"]) for r in runs.toLocalIterator()], shards)
    plan_df = spark.createDataFrame(plan, "_pw bigint, _ends array<bigint>")

    ranked = _ranked(groups, "_w", "_cell", [F.col("_g")], "_rank")
    placed = ranked.join(plan_df, F.col("_w") == F.col("_pw")).select(
        F.col("_g").alias("_pg"),
        F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).alias("shard"),
    )
    # the row side of a hot text is split by adaptive skew handling; the
    # other side has one row per text
    out = rows.join(placed, F.col("_g") == F.col("_pg")).drop("_pg")
    out = out.withColumn(
        "_cell", F.pmod(F.xxhash64(id_col, "_g"), F.lit(cells)).cast("int")
    )
    out = _ranked(out, "shard", "_cell", [F.col("_g"), F.col(id_col)], "slot")
    return out.select(id_col, "size", "text_crc32", "shard", "slot")


def op7_shard_lpt(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 shards of near equal bytes (law ``bytes``)."""
    out = shard_documents(read_table(spark, sf_dir, "documents"), 16)
    return out.select(
        "doc_id",
        F.col("size").cast("bigint").alias("size"),
        F.col("text_crc32").cast("bigint").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
