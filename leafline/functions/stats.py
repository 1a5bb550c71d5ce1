"""Aggregates whose value does not depend on row order.

Floating-point sums depend on the order rows arrive in, which differs run
to run and engine to engine.  For columns with a known number of decimals
(money, shares) the sum is taken in DECIMAL (exact), and the mean is that
exact sum divided by the count in double: one correctly rounded division,
the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    """Order-independent sum of a column with at most ``scale`` decimals."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(38,{scale})"))


def exact_avg(col: Column | str, scale: int = 2) -> Column:
    """Order-independent mean (NULL over no rows)."""
    c = F.col(col) if isinstance(col, str) else col
    return (exact_sum(c, scale).cast("double") / F.count(c)).alias("avg")


def exact_avg_if(cond: Column, col: Column | str, scale: int = 2) -> Column:
    """Order-independent mean over the rows where ``cond`` holds."""
    c = F.col(col) if isinstance(col, str) else col
    return exact_avg(F.when(cond, c), scale)
