"""Mixing sources to target weights by soft domain membership, in DataFrame functions only.

A naive Bayes classifier over hashed words is counted from labelled rows; every
row then gets posteriors over the domains.  Document rates ``r >= 0`` (how
often a document is expected to be drawn) are fitted by projected-gradient
least squares, so that the expected tokens per domain, ``S_d = sum_i r_i n_i p_id``,
meet the targets ``T_d``:

    minimise  1/2 sum_d (S_d - T_d)^2 / M_d,   M_d = sum_i n_i p_id,   r_i >= floor

In the metric that weighs documents by their tokens the gradient of a row is
``sum_d p_id (S_d - T_d) / M_d`` and its Lipschitz constant is 1, so the step is 1.
A step needs only the domain sums: one aggregate over all rows per step, a few
numbers to the driver.  A row's rate follows from its posteriors and the list of
past residuals, so no state is kept on executors and a lost one costs
nothing but its tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm.common import read_table, shared_table, small_side, text_or_empty

#: hashed word cells of the classifier: the size of its table, whatever the corpus
CELLS = 4096
#: steps at most; they end when no domain moves by more than this share of all tokens
STEPS, TOLERANCE = 100, 1e-4


def words(text: Column) -> Column:
    """Lower-cased words between white space (an empty text has none)."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def cell(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(CELLS)).cast("int")


def domain_posteriors(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, list[str]]:
    """Posteriors of every row over the domains of ``labelled`` (``doc_id``, ``domain``).

    Returns ``_id``, ``_th`` (text hash), ``n`` (words) and ``p`` (array in the order of
    the domains, which are returned too), one row per row of ``docs``.

    The log-likelihood is divided by the square root of the number of words, so that
    long texts stay soft.  Defined cases: empty and null texts get the domains'
    shares; labels that are null or whose id is null are not used; of several
    labels the first in order holds; without any label there is one domain, ``all``."""
    spark = docs.sparkSession
    labels = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()).groupBy(
        F.col("doc_id").alias("_lid")
    ).agg(F.min("domain").alias("_dom"))
    labels = shared_table(labels, "mix-labels")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), words(text).alias("_w"))
    # learn: words of labelled rows by domain and cell
    seen = rows.join(small_side(labels), F.col("_id") == F.col("_lid")).select("_dom", F.explode("_w").alias("w"))
    counts = shared_table(seen.groupBy("_dom", cell(F.col("w")).alias("cell")).agg(F.count(F.lit(1)).alias("c")), "mix-counts")
    shares = {r["_dom"]: r["n"] for r in labels.groupBy("_dom").agg(F.count(F.lit(1)).alias("n")).orderBy("_dom").collect()}
    names = list(shares) or ["all"]
    total = {r["_dom"]: r["c"] for r in counts.groupBy("_dom").agg(F.sum("c").alias("c")).collect()}
    # one row per cell: log probability under each domain (add-one), a table of CELLS rows
    logs = [
        F.log((F.coalesce(F.sum(F.when(F.col("_dom") == d, F.col("c"))), F.lit(0)) + 1.0) / (total.get(d, 0) + CELLS)).alias(f"l{k}")
        for k, d in enumerate(names)
    ]
    every = spark.range(CELLS).select(F.col("id").cast("int").alias("_cell"))
    model = shared_table(
        every.join(counts, F.col("_cell") == F.col("cell"), "left").groupBy("_cell").agg(*logs), "mix-model"
    )
    # score: sums per row are formed where the row is read
    hit = rows.select("_id", "_th", F.explode("_w").alias("w")).select("_id", "_th", cell(F.col("w")).alias("_wc"))
    sums = hit.join(F.broadcast(model), F.col("_wc") == F.col("_cell")).groupBy(
        F.col("_id").alias("_sid"), F.col("_th").alias("_sth")
    ).agg(F.count(F.lit(1)).alias("_m"), *[F.sum(f"l{k}").alias(f"s{k}") for k in range(len(names))])
    light = rows.select("_id", "_th", F.size("_w").cast("bigint").alias("n"))
    out = light.join(sums, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_th") == F.col("_sth")), "left")
    labelled_rows = sum(shares.values()) or 1
    # rows that repeat (id, text) were summed together: n / _m of it is one row's share
    scale = F.col("n") / F.col("_m") / F.sqrt(F.greatest(F.col("n"), F.lit(1)))
    prior = [F.log(F.lit((shares.get(d, 0) + 1.0) / (labelled_rows + len(names)))) for d in names]
    out = out.withColumn(
        "_l", F.array(*[F.coalesce(F.col(f"s{k}") * scale, F.lit(0.0)) + prior[k] for k in range(len(names))])
    )
    out = out.withColumn("_e", F.transform("_l", lambda x: F.exp(x - F.array_max("_l"))))
    out = out.withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    return out.select("_id", "_th", "n", F.transform("_e", lambda x: x / F.col("_z")).alias("p")), names


def rate_after(history: list[list[float]], start: float, floor: float) -> Column:
    """A row's rate after the steps of ``history`` (scaled residuals per domain)."""
    r = F.lit(float(start))
    if not history:
        return r
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in h]) for h in history])

    def step(rate: Column, g: Column) -> Column:
        grad = F.aggregate(F.zip_with("p", g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.lit(float(floor)), rate - grad)

    return F.aggregate(steps, r, step)


def fit_rates(
    posteriors: DataFrame, domains: list[str], targets: dict[str, float] | None = None,
    temper: float = 0.0, budget: float | None = None, floor: float = 0.0, steps: int = STEPS, tolerance: float = TOLERANCE,
) -> tuple[DataFrame, list[tuple[float, float]]]:
    """Rates of all rows, and (expected, target) tokens per domain.

    ``targets`` are weights per domain (default: the domain's tokens to the power
    ``temper``; 0 is equal weights); ``budget`` is their sum
    in tokens (default: the tokens there are; with ``floor`` 1 the least sum for
    which no domain's target is below what it has).  A domain without tokens
    can't be met and is left out of the sums."""
    k = len(domains)
    table = shared_table(posteriors, "mix-posteriors")
    at = lambda c, d: F.coalesce(F.sum(F.col("n") * F.get("p", F.lit(d)) * c), F.lit(0.0))
    mass = [float(x) for x in table.agg(*[at(F.lit(1.0), d).alias(f"m{d}") for d in range(k)]).first()]
    if targets is None:
        weight = [m**temper if m > 0 else 0.0 for m in mass]
    else:
        weight = [float(targets.get(d, 0.0)) for d in domains]
    usable = [m > 0 and w > 0 for m, w in zip(mass, weight, strict=True)]
    whole = sum(w for w, u in zip(weight, usable, strict=True) if u) or 1.0
    if budget is None:
        budget = sum(mass)
        if floor > 0:
            budget = max([budget, *(floor * m * whole / w for m, w, u in zip(mass, weight, usable, strict=True) if u)])
    goal = [w / whole * budget if u else 0.0 for w, u in zip(weight, usable, strict=True)]
    scale = [m if m > 0 else 1.0 for m in mass]
    history: list[list[float]] = []
    start = max(1.0, floor)
    reached = [m * start for m in mass]
    for _ in range(steps):
        miss = [(s - t) for s, t in zip(reached, goal, strict=True)]
        history.append([x / m for x, m in zip(miss, scale, strict=True)])
        rate = rate_after(history, start, floor)
        now = [float(x) for x in table.agg(*[at(rate, d).alias(f"s{d}") for d in range(k)]).first()]
        moved = max((abs(a - b) for a, b in zip(now, reached, strict=True)), default=0.0)
        reached = now
        if moved <= tolerance * max(budget, 1.0):
            break
    rates = table.withColumn("rate", rate_after(history, start, floor))
    return rates, list(zip(reached, goal, strict=True))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    """Rates of all ``documents`` for equal tokens of each language.

    Domains are the languages of the rows of ``labels``; all other rows are known by their
    posteriors only.  Columns ``p_<k>`` are posteriors in the order of the domains."""
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_k"))
    known = docs.select("doc_id", F.col("lang").alias("domain")).join(labels, F.col("doc_id") == F.col("_k"), "left_semi")
    post, domains = domain_posteriors(docs, known)
    rates, _ = fit_rates(post, domains)
    return rates.select(
        F.col("_id").alias("doc_id"), F.col("n").alias("tokens"),
        F.lit(",".join(domains)).alias("domains"), F.col("p").alias("posterior"), "rate",
    )
