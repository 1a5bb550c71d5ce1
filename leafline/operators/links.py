"""L — link discovery: hrefs -> canonical entity registry.

All row-local except L2 (one exchange by path) and L3 (an aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): ad/tracker domains blocked by substring.
REF_BLOCK_DOMAINS = (
    "doubleclick.net", "googlesyndication.com", "googleadservices.com", "google-analytics.com",
    "googletagmanager.com", "adservice.google.com", "pagead2.googlesyndication.com",
    "tpc.googlesyndication.com", "googletagservices.com", "gstatic.com/adsense",
    "facebook.net", "connect.facebook.net", "facebook.com/tr",
    "amazon-adsystem.com", "aax.amazon-adsystem.com",
    "adnxs.com", "ib.adnxs.com", "adsrvr.org", "rubiconproject.com", "pubmatic.com", "casalemedia.com",
    "openx.net", "smartadserver.com", "serving-sys.com", "contextweb.com", "yieldmo.com",
    "sharethrough.com", "indexexchange.com", "33across.com", "media.net",
    "taboola.com", "outbrain.com", "outbrainimg.com", "zergnet.com", "revcontent.com", "mgid.com",
    "criteo.com", "criteo.net", "moatads.com", "quantserve.com", "scorecardresearch.com",
    "sb.scorecardresearch.com", "bluekai.com", "demdex.com", "krxd.net", "cdn.permutive.com",
    "bat.bing.com", "ads.linkedin.com", "bidswitch.net", "rlcdn.com", "mathtag.com", "dotomi.com",
    "adsymptotic.com", "chartbeat.com", "newrelic.com", "nr-data.net",
    "securepubads.g.doubleclick.net", "ad.doubleclick.net", "cm.g.doubleclick.net",
    "stats.g.doubleclick.net", "connatix.com", "1rx.io", "yldbt.com", "bidsxchange.com", "liadm.com",
    "lijit.com", "sonobi.com", "spotxchange.com",
)
# Profile-path rule, index page and rank patterns.
REF_PATH_PATTERN = "(?i)/best-graduate-schools/top-business-schools/[^/]+-\\d+$"
REF_INDEX_PATTERN = "(?i)/mba-rankings$"
RANGE_RANK = "#\\d+-\\d+\\b"
EXACT_RANK = "#(\\d+)\\b"
#: the href of an opening tag: in double quotes, in single quotes or bare
HREF = "(?is)^<a\\s(?:[^>]*?\\s)?href\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"


def extract_links(pages: DataFrame, key: str = "page_id", html_col: str = "html") -> DataFrame:
    """L1 (first half): every anchor as ``(key, pos, href, anchor_text)``; ``href`` is that of
    the opening tag, quoted either way or bare, empty without one."""
    pairs = F.regexp_extract_all(F.col(html_col), F.lit("(?is)<a\\b[^>]*>.*?</a>"), 0)
    ex = pages.select(key, F.posexplode(pairs).alias("pos", "a"))
    href = F.concat(*[F.regexp_extract("a", HREF, k) for k in (1, 2, 3)])  # one group at most has matched
    text = F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]*>", ""), "\\s+", " "))
    return ex.select(key, F.col("pos").cast("bigint").alias("pos"), href.alias("href"), text.alias("anchor_text"))


def href_path(href: Column) -> Column:
    """Path part of a relative or absolute href (query/fragment dropped),
    one trailing ``/`` stripped."""
    no_scheme = F.regexp_replace(href, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = F.regexp_extract(no_scheme, "^([^?#]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    return F.regexp_replace(path, "(.)/$", "$1")


def profile_links(links: DataFrame, path_pattern: str = REF_PATH_PATTERN,
                  index_pattern: str = REF_INDEX_PATTERN) -> DataFrame:
    """L1: keep hrefs whose path matches the profile rule, not the index page."""
    p = href_path(F.col("href"))
    return links.withColumn("path", p).where(p.rlike(path_pattern) & ~p.rlike(index_pattern))


def has_exact_rank(text: Column) -> Column:
    return text.rlike(EXACT_RANK) & ~text.rlike(RANGE_RANK)


def best_link_row(rows: DataFrame, text_col: str = "row_text") -> DataFrame:
    """L2: one row per path: an exact rank beats none, then the longer text,
    then the first seen; ``first_seen`` is the path's first position.

    ``rows`` has ``page_id, pos, path`` and ``text_col``.  Minimum and best
    row are partial aggregates, so a link on every page of a site costs one
    row per task."""
    t = F.col(text_col)
    best = F.struct((~has_exact_rank(t)).alias("_no"), (-F.length(t)).alias("_len"), F.col("page_id"), F.col("pos"))
    rest = [c for c in rows.columns if c != "path"]
    picked = rows.groupBy("path").agg(
        F.min_by(F.struct(*rest), best).alias("_best"), F.min(F.struct("page_id", "pos")).alias("first_seen"))
    return picked.select(*[F.col("path") if c == "path" else F.col(f"_best.{c}").alias(c) for c in rows.columns], "first_seen")


def exact_rank(text: Column) -> Column:
    """L4: NULL for range ranks (``#12-20``) or no rank; else the number."""
    return F.when(has_exact_rank(text), F.regexp_extract(text, EXACT_RANK, 1).try_cast("bigint"))


def link_distinct(links: DataFrame, by: str = "page_id") -> DataFrame:
    """L3: distinct link paths per page (progress signal)."""
    return links.groupBy(by).agg(F.count_distinct("path").alias("n_distinct_links"))


def title_slug(slug: Column) -> Column:
    """Display name from a slug: Python ``slug.replace('-', ' ').title()``."""
    return py_title(F.replace(slug, F.lit("-"), F.lit(" ")))


def py_title(s: Column) -> Column:
    """Python ``str.title()``: a letter following a non-letter (digits and
    apostrophes included) is upper-cased, every other letter lower-cased.
    ``initcap`` differs after apostrophes and digits, hence the fold."""
    return F.aggregate(
        F.split(F.lower(s), ""),
        F.struct(F.lit("").alias("out"), F.lit(False).alias("prev_letter")),
        lambda acc, ch: F.struct(
            F.concat(acc["out"], F.when(~acc["prev_letter"] & ch.rlike("\\p{L}"), F.upper(ch)).otherwise(ch)).alias("out"),
            ch.rlike("\\p{L}").alias("prev_letter"),
        ),
        lambda acc: acc["out"],
    )


def canonical_url(href: Column, host: str, aliases: dict[str, str] | None = None) -> Column:
    """Relative hrefs get ``host`` prefixed; host aliases (regex ->
    replacement, applied in order) are rewritten."""
    url = F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)
    for pattern, repl in (aliases or {}).items():
        url = F.regexp_replace(url, pattern, repl)
    return url


def url_slug(url: Column) -> Column:
    """Last path segment after stripping trailing ``/``."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def block_urls(df: DataFrame, url_col: str, domains=REF_BLOCK_DOMAINS, keep_blocked: bool = False) -> DataFrame:
    """Drop (or keep only) rows whose URL contains any listed domain.

    The domain list is a fixed constant of bounded size, so it is a
    broadcast side; the predicate is a substring test (nested loop)."""
    spark = df.sparkSession
    dom = F.broadcast(spark.createDataFrame([(d,) for d in domains], "domain string"))
    how = "left_semi" if keep_blocked else "left_anti"
    return df.join(dom, F.col(url_col).contains(F.col("domain")), how)
