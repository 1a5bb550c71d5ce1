"""Document fingerprints by winnowing, in DataFrame functions only.

A word is a run of letters and digits; each character of a script without blanks
(Han, kana, Thai, Lao, Khmer, Burmese) is a word of its own, in every text.
Words are hashed, every run of ``k`` words gets a hash, and of each window of
``w`` consecutive k-grams the smallest hash is kept, the rightmost on ties,
with its position.  Any run of ``w + k - 1`` words that two texts share
therefore gives them a common fingerprint.

A selected k-gram is one long: 32 bits of hash above 31 bits that hold
``2^31 - 1 - position``, so the plain minimum prefers the rightmost of equal
hashes.  Window minima come from ``log2(w)`` passes that each combine
an array with itself shifted, so the work is linear in the text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.llm.common import read_table, shared_table, text_or_empty

K, W = 5, 8
POS = (1 << 31) - 1
#: what stands between words
GAP = r"[^\p{L}\p{N}]+"
#: a letter or digit of a script without blanks
LONE = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&[\p{L}\p{N}]]"
#: buckets of neighbouring ids, and rows that one holds on average
MAX_BUCKETS, BUCKET_ROWS = 65_536, 2_000


def add_fingerprint(
    df: DataFrame, text_col: str, out_col: str = "fp", k: int = K, w: int = W
) -> DataFrame:
    """Add ``out_col``: array of packed k-grams in order of position.

    A null or empty text has none.  A text of fewer than ``k`` words has one
    k-gram of all its words; a text without words one of its raw characters; a
    text of fewer than ``w`` k-grams has one window."""
    if w < 1 or w & (w - 1):
        raise ValueError("w must be a power of two")
    text = text_or_empty(text_col)
    low = F.lower(text)
    # a text of plain ASCII has none of them
    spaced = F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.regexp_replace(low, LONE, " $0 "))
    df = df.withColumn("_s", F.array_remove(F.split(spaced, GAP), ""))
    df = df.withColumn("_w", F.transform("_s", lambda x: F.xxhash64(x))).drop("_s")
    n = F.size("_w")

    def pack(h: Column, i: Column) -> Column:
        return F.shiftleft(h.bitwiseAND(F.lit(0xFFFFFFFF)), 31) + (F.lit(POS) - i)

    ws = F.col("_w")
    grams = (
        F.when(
            n >= k,
            F.transform(
                F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))),
                lambda i: pack(F.xxhash64(*[F.get(ws, i + j) for j in range(k)]), i),
            ),
        )
        .when(n > 0, F.array(pack(F.xxhash64(ws), F.lit(0))))
        .when(F.length(text) > 0, F.array(pack(F.xxhash64(text), F.lit(0))))
        .otherwise(F.array().cast("array<bigint>"))
    )
    df = df.withColumn("_m", grams).drop("_w")
    df = df.withColumn("_n", F.size("_m"))
    step = 1
    while step < w:
        shifted = F.slice("_m", F.lit(step + 1), F.greatest(F.size("_m"), F.lit(1)))
        df = df.withColumn("_m", F.zip_with("_m", shifted, lambda a, b: F.least(a, b)))
        step *= 2
    windows = F.slice("_m", F.lit(1), F.greatest(F.col("_n") - (w - 1), F.lit(1)))
    return df.withColumn(out_col, F.array_distinct(windows)).drop("_m", "_n")


def hashes(fp: str | Column) -> Column:
    """The distinct hashes of a packed fingerprint."""
    return F.array_distinct(F.transform(fp, lambda p: F.shiftright(p, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def digest(fp: str | Column) -> Column:
    """``position:hash`` of each selected k-gram, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            fp,
            lambda p: F.concat(
                (F.lit(POS) - p.bitwiseAND(F.lit(POS))).cast("string"), F.lit(":"),
                F.lower(F.hex(F.shiftright(p, 31))),
            ),
        ),
    )


def _bucket(order: str, bounds: list[int]) -> Column:
    """Number of bounds not above the order key, found in two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse, fine = bounds[::step], F.array(*[F.lit(b) for b in bounds])
    above = F.size(F.filter(F.array(*[F.lit(b) for b in coarse]), lambda b: b <= F.col(order)))
    start = F.greatest(above - 1, F.lit(0)) * step
    return start + F.size(F.filter(F.slice(fine, start + 1, step), lambda b: b <= F.col(order)))


def with_next(
    rows: DataFrame, id_col: str, text_col: str, max_buckets: int = MAX_BUCKETS
) -> DataFrame:
    """Add ``fp`` and ``next``: struct of text and ``fp`` of the row after this in falling id.

    After the last row comes the first.  Null ids come last; equal ids are
    ordered by text.  Rows are dealt to buckets of neighbouring ids
    (quantiles over all ids); each bucket also gets the first row of the bucket
    after it, so one shuffle and one window per bucket suffice."""
    order = F.coalesce(F.bitwise_not(F.col(id_col).cast("bigint")), F.lit((1 << 63) - 1))
    keyed = rows.withColumn("_ord", order)
    light = keyed.select("_ord")
    n = light.count()
    b = min(max_buckets, math.ceil(n / BUCKET_ROWS))
    bounds: list[int] = []
    if b > 1:
        q = F.percentile_approx("_ord", [i / b for i in range(1, b)], max(10_000, 20 * b))
        bounds = sorted(set(light.agg(q.alias("q")).first()["q"]))
    keyed = keyed.withColumn("_b", _bucket("_ord", bounds)).withColumn(
        "_tie", F.xxhash64(text_col)
    ).withColumn("_copy", F.lit(0))
    # the first row of each bucket: at most max_buckets keys
    heads = keyed.groupBy("_b").agg(F.min(F.struct("_ord", "_tie")).alias("_h"))
    heads = shared_table(heads.select("_b", "_h._ord", "_h._tie"), "winnow-heads")
    numbers = sorted(r["_b"] for r in heads.select("_b").toLocalIterator())
    if not numbers:
        return add_fingerprint(rows, text_col).withColumn("next", F.struct(text_col, "fp"))
    before = dict(zip(numbers, numbers[-1:] + numbers[:-1], strict=True))
    to = rows.sparkSession.createDataFrame(list(before.items()), "_hb int, _to int")
    heads = heads.join(to, F.col("_b") == F.col("_hb")).select(
        F.col("_to"), F.col("_ord").alias("_ho"), F.col("_tie").alias("_ht")
    )
    first = (
        keyed.join(F.broadcast(heads), (F.col("_ord") == F.col("_ho")) & (F.col("_tie") == F.col("_ht")))
        .withColumn("_b", F.col("_to"))
        .withColumn("_copy", F.lit(1))
        .dropDuplicates(["_b"])
        .select(*keyed.columns)
    )
    w = Window.partitionBy("_b").orderBy("_copy", "_ord", "_tie", text_col)
    both = add_fingerprint(keyed.unionByName(first), text_col)
    out = both.withColumn("next", F.lead(F.struct(text_col, "fp")).over(w))
    return out.where(F.col("_copy") == 0).select(*rows.columns, "fp", "next")


def fingerprint_with_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint of every text and of its edited text (see ``edit``).

    The edited text has the last third of its code points replaced by the
    first as many of the next text in falling id.  Returns the id, ``text``,
    ``edited``, packed ``fp``, ``edited_fp`` and ``next_fp``.

    Defined cases: null texts are empty and have no fingerprint; an empty table gives
    none; repeated rows follow each other; other columns are not read."""
    rows = docs.select(F.col(id_col).alias(id_col), text_or_empty(text_col).alias("text"))
    rows = with_next(rows, id_col, "text")
    n = F.char_length("text")
    m = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - m),
        F.substring(F.col("next.text"), F.lit(1), m),
    )
    rows = rows.withColumn("edited", edited).withColumn("next_fp", F.col("next.fp")).drop("next")
    return add_fingerprint(rows, "edited", "edited_fp")


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    rows = fingerprint_with_edits(read_table(spark, sf_dir, "documents"))
    rows = rows.withColumn("_own", hashes("fp"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("fp").alias("fingerprint"),
        digest("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("_own"), hashes("edited_fp")).alias("near_edited"),
        likeness(F.col("_own"), hashes("next_fp")).alias("near_next"),
    )
