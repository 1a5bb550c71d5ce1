from pyspark.sql import functions as F

from leafline.operators import incremental as I


def test_retry_work_skips_done_and_given_up(spark):
    inputs = spark.createDataFrame([(i, f"t{i}") for i in (1, 2, 3, 4, 4)] + [(None, "x")], "k long, attempt_note string")
    tries = spark.createDataFrame(
        [(1, 1, "error"), (1, 2, "ok"), (2, 1, "error"), (3, 1, None), (3, 2, "error")], "k long, attempt int, status string"
    )
    got = sorted((r["k"], r["attempt"]) for r in I.retry_work(inputs, tries, "k", 2).collect())
    assert got == [(2, 2), (4, 1)]


def test_run_with_retries_ends(spark):
    inputs = spark.createDataFrame([(i,) for i in range(6)], "k long")
    rounds = []

    def attempt(work):
        rounds.append(1)
        return work.select("k", "attempt", F.when(F.col("k") < F.col("attempt"), "ok").otherwise("late").alias("status"))

    got = I.run_with_retries(inputs, "k", attempt, 3).groupBy("k").agg(F.max("attempt").alias("n"), F.max_by("status", "attempt").alias("s"))
    assert sorted(map(tuple, got.collect())) == [(0, 1, "ok"), (1, 2, "ok"), (2, 3, "ok"), (3, 3, "late"), (4, 3, "late"), (5, 3, "late")]
    assert len(rounds) == 3
    none = I.run_with_retries(inputs.limit(0), "k", attempt, 3)
    assert none.count() == 0 and len(rounds) == 4
