"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three fixed patterns give the base spans.  A wider pattern adds candidate
tokens.  Every candidate value is hashed and counted over the corpus by
distinct repository and owner: a value that many owners share, or that one owner
copies through many repositories, is a copied
example; one that stays with few of both and looks random is taken as live.
Live-looking wider tokens become further spans (kind ``owned``); base spans
always stay.

Spans are counted in code points.  Matches come from ``regexp_extract_all``, the
text between them from ``split`` by the same pattern, and positions from
running sums of their lengths, over the documents with matches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leafline.llm.common import read_table, shared_table, text_or_empty

# Fixed patterns: kind, pattern (Java and RE2), group of the value, least length of the value.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = [
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("owned", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
]
BASE = ("assign", "access", "hex")
#: an owner-specific value has at most so many owners
MAX_OWNERS = 2
#: and stands in at most so many repositories
MAX_REPOS = 20
#: a live-looking value has at least so many different characters
MIN_DISTINCT = 10
#: words that mark a value as a stand-in
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|xxxx|1234567"


def _of_kind(text: Column, no: int, rx: str, group: int) -> Column:
    """Matches of one pattern; null for a text without any."""
    r = F.lit(rx)
    zipped = F.arrays_zip(
        F.split(text, rx, -1).alias("before"),
        F.regexp_extract_all(text, r, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, r, F.lit(group)).alias("value"),
    )

    def one(z: Column, i: Column) -> Column:
        return F.struct(
            F.lit(no).alias("kind"), i.alias("place"), F.char_length(z["before"]).alias("before"),
            z["match"].alias("match"), z["value"].alias("value"),
        )

    return F.when(text.rlike(rx), F.transform(zipped, one))


def _matches(text: Column) -> Column:
    """All matches of a text: array of (kind number, place, before, match, value)."""
    found = [_of_kind(text, no, rx, group) for no, (_, rx, group, _) in enumerate(PATTERNS)]
    empty = F.array().cast(
        "array<struct<kind:int,place:int,before:int,match:string,value:string>>"
    )
    return F.flatten(F.array(*[F.coalesce(f, empty) for f in found]))


def live_looking(value: Column) -> Column:
    """Digits and letters, many different characters, no stand-in word."""
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT)
        & ~value.rlike(PLACEHOLDER)
    )


def widespread() -> Column:
    """More owners, or more repositories, than an owner-specific value has."""
    return (F.col("owners") > MAX_OWNERS) | (F.col("repos") > MAX_REPOS)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    repo_col: str = "doc_id", owner_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """Rows of the table and their spans.

    Returns ``(rows, spans)``: ``rows`` has ``_id`` and ``_th`` (text hash) of every
    row; ``spans`` has, per distinct ``(_id, _th)``, ``kind_no``, ``kind``, ``start``,
    ``end`` (exclusive), ``value``, ``repos`` and ``owners`` (how many distinct ones
    hold the value), ``base`` and ``live``.  Wider tokens that touch a base span or
    aren't live are left out.

    Defined cases: null texts are empty; a null repository or owner counts as one unnamed
    one; repeated rows have one set of spans but count once for
    frequencies; an empty table gives empty frames; other columns are not read."""
    text = text_or_empty(text_col)
    hits = _matches(text)
    rows = shared_table(
        docs.select(
            F.col(id_col).alias("_id"),
            F.xxhash64(text).alias("_th"),
            F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("_repo"),
            F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("_owner"),
            F.nullif(hits, F.array().cast("array<struct<kind:int,place:int,before:int,match:string,value:string>>")).alias("_hits"),
        ),
        "secret-rows",
    )
    some = rows.where(F.col("_hits").isNotNull())
    place = Window.partitionBy("_id", "_th", "kind").orderBy("place")
    earlier = place.rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("match")
    least = F.element_at(
        F.create_map(*[x for no, p in enumerate(PATTERNS) for x in (F.lit(no), F.lit(p[3]))]), F.col("kind_no")
    )
    found = (
        some.dropDuplicates(["_id", "_th"])
        .select("_id", "_th", F.inline("_hits"))
        .withColumn("start", F.sum("before").over(place.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(F.sum(length).over(earlier), F.lit(0)))
        .withColumn("end", F.col("start") + length)
        .withColumnRenamed("kind", "kind_no")
        .where(F.col("match").isNotNull() & (F.char_length("value") >= least))
        .withColumn("base", F.col("kind_no") < len(BASE))
    )
    # a wider token that touches a base span is that span's business
    row = Window.partitionBy("_id", "_th").orderBy("start", "kind_no")
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(row.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(row.rowsBetween(0, Window.unboundedFollowing))
    found = found.withColumn("_free", (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end")))
    found = found.where(F.col("base") | F.col("_free")).drop("_free", "place", "before", "match")
    found = shared_table(found.withColumn("_v", F.md5(F.col("value").cast("binary"))), "secret-found")

    # frequency by repository and owner: each step pre-aggregates in its tasks
    holders = (
        some.select("_repo", "_owner", F.explode("_hits.value").alias("value"))
        .where(F.col("value").isNotNull())
        .withColumn("_v", F.md5(F.col("value").cast("binary")))
        .groupBy("_v", "_owner", "_repo").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_v", "_owner").agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("_v").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
        .withColumnRenamed("_v", "_hv")
    )
    names = F.element_at(
        F.create_map(*[x for no, p in enumerate(PATTERNS) for x in (F.lit(no), F.lit(p[0]))]), F.col("kind_no")
    )
    spans = (
        found.join(holders, F.col("_v") == F.col("_hv"))
        .withColumn("kind", names)
        .withColumn("live", ~widespread() & live_looking(F.col("value")))
        .where(F.col("base") | F.col("live"))
        .select("_id", "_th", "kind_no", "kind", "start", "end", "value", "repos", "owners", "base", "live")
    )
    return rows.select("_id", "_th"), spans


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text; ``n_live`` base or wider spans look live,
    ``n_widespread`` base spans hold a value of more than two owners or 20 repositories.

    Each document stands for a repository, its source for the owner."""
    rows, spans = scan_secrets(read_table(spark, sf_dir, "documents"))
    ordered = F.sort_array(F.collect_list(F.struct("start", "kind_no", "kind", "end", "base")))
    count = lambda c: F.count(F.when(c, 1))
    per_row = spans.groupBy("_id", "_th").agg(
        ordered.alias("_s"),
        *[count(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        count(F.col("live")).alias("n_live"),
        count(F.col("base") & widespread()).alias("n_widespread"),
    )
    joined = lambda a: F.concat_ws(
        ",", F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
    per_row = per_row.select(
        F.col("_id").alias("_sid"), F.col("_th").alias("_sth"),
        *[f"n_{k}" for k in BASE], "n_live", "n_widespread",
        joined(F.filter("_s", lambda s: s["base"])).alias("_base"),
        joined(F.col("_s")).alias("spans"),
    )
    out = rows.join(per_row, rows["_id"].eqNullSafe(per_row["_sid"]) & (rows["_th"] == per_row["_sth"]), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(
        F.col("_id").alias("doc_id"),
        zero("n_assign"), zero("n_access"), zero("n_hex"),
        F.sha2(F.coalesce("_base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        zero("n_live"), zero("n_widespread"),
    )


def _oracle() -> str:
    parts = []
    for no, (kind, rx, group, least) in enumerate(PATTERNS):
        q = rx.replace("'", "''")
        parts.append(
            f"SELECT doc_id, source, {no} AS ko, '{kind}' AS kind, {least} AS least, "
            f"generate_subscripts(string_split_regex(t, '{q}'), 1) AS i, "
            f"unnest(string_split_regex(t, '{q}')) AS pre, "
            f"unnest(regexp_extract_all(t, '{q}', 0)) AS m, "
            f"unnest(regexp_extract_all(t, '{q}', {group})) AS v "
            f"FROM d WHERE regexp_matches(t, '{q}')"
        )
    union = "\nUNION ALL\n".join(parts)
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
raw AS ({union}),
pos AS (
  SELECT *, sum(length(pre)) OVER (PARTITION BY doc_id, ko ORDER BY i)
    + coalesce(sum(length(m)) OVER (PARTITION BY doc_id, ko ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM raw),
freq AS (SELECT v, count(DISTINCT source) AS owners,
    count(DISTINCT (source, doc_id)) AS repos FROM raw WHERE m IS NOT NULL GROUP BY v),
cand AS (SELECT doc_id, ko, kind, p.v, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e, owners, repos,
    owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS} AND regexp_matches(p.v, '[0-9]') AND regexp_matches(p.v, '[A-Za-z]')
      AND len(list_distinct(string_split(p.v, ''))) >= {MIN_DISTINCT}
      AND NOT regexp_matches(p.v, '{PLACEHOLDER}') AS live
  FROM pos p JOIN freq f ON p.v = f.v WHERE m IS NOT NULL AND length(p.v) >= least),
spans AS (SELECT * FROM cand c WHERE ko < {len(BASE)} OR (live AND NOT EXISTS (
    SELECT 1 FROM cand b WHERE b.doc_id = c.doc_id AND b.ko < {len(BASE)} AND b.s < c.e AND c.s < b.e))),
per AS (SELECT doc_id,
    count(*) FILTER (WHERE ko = 0) AS n_assign, count(*) FILTER (WHERE ko = 1) AS n_access,
    count(*) FILTER (WHERE ko = 2) AS n_hex, count(*) FILTER (WHERE live) AS n_live,
    count(*) FILTER (WHERE ko < {len(BASE)} AND (owners > {MAX_OWNERS} OR repos > {MAX_REPOS})) AS n_widespread,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ko) FILTER (WHERE ko < {len(BASE)}) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ko) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_widespread, 0) AS n_widespread
FROM d LEFT JOIN per ON d.doc_id = per.doc_id
"""


ORACLES = {"op2_secrets": _oracle()}
