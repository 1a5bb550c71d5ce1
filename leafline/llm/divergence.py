"""Source divergence audit with duplicate-text collapse.

Identical texts of a language are grouped, with how often each source holds them;
each distinct text is split into terms once and counts for all its holders.  A
source's smoothed term shares (integers, in parts of 10^9) are then compared
with those of the other sources of its language and with the language's.

Sparse pairs.  Most terms of a language are absent from most sources, and all absent
terms of a source have one share.  The sum over all terms is thus put
together from what two sources share (one row per term and pair that hold
it, summed within the task), from each source's own terms grouped by share, and from the number of
terms that neither holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.llm.common import measured_side, read_table, shared_table, text_or_empty
from leafline.llm.terms import COUNTED, TERM, term_counter

#: a term is kept if so many documents of its language hold it
MIN_DOCS = 3
#: parts of a whole share
PARTS = 1_000_000_000
#: reported terms of a source
TOP_TERMS = 200


def collapse_texts(docs: DataFrame) -> DataFrame:
    """``(lang, text, holders)`` per distinct text of a language.

    ``holders`` are its sources with how many rows of theirs are this text.  Copies meet as
    digests after they have been counted in their tasks; a text travels once per task that holds it."""
    rows = docs.select(
        text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty("text").alias("text")
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    holders = (
        rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("holders"))
    )
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(holders, ["lang", "digest"]).select("lang", "text", "holders")


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term of a source."""
    each = collapse_texts(docs).select("lang", F.col("text").cast("binary").alias("text"), "holders")
    # tasks have summed their rows; dealt by term, sources and languages are summed without moving again
    counted = each.mapInArrow(term_counter(), COUNTED).repartition("lang", "term")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (n + 1) / (total + terms)), exact for any counts."""
    up = F.lit(PARTS).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.call_function("div", up, (total + terms).cast("decimal(20,0)")) + 1


def _distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); both are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def source_shares(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Groups and the shares of their terms.

    Returns ``(groups, shares)``.  ``groups``, one row per occurring (lang, source):
    ``gid``, ``total`` (occurrences of kept terms), ``terms`` (kept terms of the
    language), ``own`` (kept terms it holds), ``p0`` (share of an absent term; null where the
    language keeps none).  ``shares``, one row per group and kept term that it holds: ``gid``, ``lang``,
    ``source``, ``term``, ``n``, ``p``, ``p0`` and ``q``, the language's share."""
    kept = shared_table(
        count_terms(docs)
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
        .where(F.col("docs") >= min_docs),
        "divergence-kept",
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    sums = (
        kept.select("lang", F.inline("held"))
        .groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    )
    occurring = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    groups = (
        occurring.join(sums, ["lang", "source"], "left").join(langs, ["lang"], "left")
        .select(F.monotonically_increasing_id().alias("gid"), "lang", "source", zero("total"), zero("own"), zero("terms"), zero("lang_total"))
        .withColumn("p0", F.when(F.col("terms") > 0, _share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))))
    )
    groups = shared_table(groups, "divergence-groups")
    shares = (
        kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("held"))
        .join(measured_side(groups), ["lang", "source"])
        .select(
            "gid", "lang", "source", "term", "n",
            _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0",
            _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
        )
    )
    return groups, shared_table(shares, "divergence-shares")


def pair_divergence(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``(gid, other, value)`` for each two groups of a language: the sum of
    floor((p - q)^2 / q) over all kept terms, with ``q`` the other's shares.

    Shares of a group add up to at most PARTS + terms, so every sum below fits in a
    long while a language keeps fewer than 10^9 terms."""
    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("gid", "p", "p0")).alias("held"))
    both = held.select("held", F.explode("held").alias("a")).select("a", F.explode("held").alias("b")).where("a.gid != b.gid")
    a, b = F.col("a"), F.col("b")
    # what a shared term adds to the sums below, which take it as absent from the other side
    more = _distance(a["p"], b["p"]) - _distance(a["p"], b["p0"]) - _distance(a["p0"], b["p"]) + _distance(a["p0"], b["p0"])
    shared = both.groupBy(a["gid"].alias("gid"), b["gid"].alias("other")).agg(F.sum(more).alias("value"))

    near = groups.select(F.col("lang").alias("_lang"), F.col("gid").alias("_gid"), F.col("p0").alias("_p0"), F.col("own").alias("_own"))
    near = measured_side(near)
    alike = shares.groupBy("lang", "gid", "p").agg(F.count(F.lit(1)).alias("m"))
    alike = alike.join(near, (F.col("lang") == F.col("_lang")) & (F.col("gid") != F.col("_gid")))
    alike = alike.groupBy("gid", "_gid").agg(
        F.sum(F.col("m") * _distance(F.col("p"), F.col("_p0"))).alias("_out"),
        F.sum(F.col("m") * _distance(F.col("_p0"), F.col("p"))).alias("_in"),
    )
    alike = alike.select(
        F.inline(F.array(
            F.struct(F.col("gid"), F.col("_gid").alias("other"), F.col("_out").alias("value")),
            F.struct(F.col("_gid").alias("gid"), F.col("gid").alias("other"), F.col("_in").alias("value")),
        ))
    )
    absent = groups.join(near, (F.col("lang") == F.col("_lang")) & (F.col("gid") != F.col("_gid"))).select(
        "gid", F.col("_gid").alias("other"),
        F.when(F.col("terms") > 0, (F.col("terms") - F.col("own") - F.col("_own")) * _distance(F.col("p0"), F.col("_p0")))
        .otherwise(F.lit(0)).cast("bigint").alias("value"),
    )
    return absent.unionByName(alike).unionByName(shared).groupBy("gid", "other").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """The audit: ``(lang, source, part, item, value, rank)``.

    Part ``pair``: each other source of the language by the divergence from it.  Part ``term``: the
    ``top_terms`` terms that the source holds more of than its language, by their share of the divergence from it.

    Defined cases: a null text, lang or source is the empty one; a lang without kept terms has pairs of
    value 0 and no terms; a source alone in its lang has no pairs; ties go by the item's UTF-8
    bytes; repeated rows count as documents of their own; an empty table gives no rows; other columns are not read."""
    groups, shares = source_shares(docs, min_docs)
    names = groups.select("gid", "lang", "source")
    others = groups.select(F.col("gid").alias("other"), F.col("source").alias("item"))
    pairs = pair_divergence(groups, shares).join(measured_side(names), "gid").join(measured_side(others), "other")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """The audit of the whole ``documents`` table."""
    return source_divergence(read_table(spark, sf_dir, "documents"))


ORACLES = {
    "op13_source_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS ts
  FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
c AS (SELECT t.lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM d),
tot AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({PARTS}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(tot.total, 0) + l.v) AS p,
    1 + ({PARTS}::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM grp g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN tot USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
}
