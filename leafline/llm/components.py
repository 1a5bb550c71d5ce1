"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import shared_table


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` of every node in ``links`` (``a``, ``b``); ``comp`` is the
    smallest node of its component.

    Each round takes the least label among a node's neighbours and then the
    label's own label, until nothing changes.  Labels meet by partial
    minima, so a node with very many links is no burden; each round is
    written to the shared folder."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = shared_table(both, "cc-links")
    label = shared_table(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "cc-label"
    )
    while True:
        of = label.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        near = both.join(of, F.col("b") == F.col("_n")).groupBy("a").agg(F.min("_c").alias("_m"))
        step = label.join(near, F.col("node") == F.col("a")).select(
            "node", "comp", F.least("comp", "_m").alias("_new")
        )
        jump = step.join(of, F.col("_new") == F.col("_n")).select(
            "node", F.least("_new", "_c").alias("comp"), (F.col("comp") != F.least("_new", "_c")).alias("_moved")
        )
        jump = shared_table(jump, "cc-label")
        label = jump.select("node", "comp")
        if not jump.where("_moved").limit(1).count():
            return label
