"""T — page text preparation: HTML -> visible text -> trimmed, cleaned text.

Per-document rules are row-local expressions.  Rules that depend on line
order (trim region, sponsored-block state machine) run on a line table
``(key, line_no, line)`` with window functions partitioned by document: one
exchange by document key, then the kept lines are joined back in order on
the same partitioning.  A document is one row of the input, so a window
partition is bounded by one input row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.functions.text import marker_count, py_strip

# Fixed values (must equal the reference's): trim, block and noise markers.
REF_START_MARKERS = ("Business School Overview",)
REF_FALLBACK_EQUALS = ("At-a-Glance",)
REF_FALLBACK_CONTAINS = ("in Best Business Schools",)
REF_END_MARKERS = (
    "Business School details based on",
    "Do you work at",
    "Reviews & Ratings",
    "MORE FROM",
    "YOU MAY ALSO LIKE",
)
REF_BLOCK_START = "Schools You Might Also Like"
REF_RESUME_MARKERS = (
    "Admissions",
    "Full-Time MBA Cost",
    "Student Population",
    "Academics",
    "Career & Salary",
    "Specialty Master",
)
REF_NOISE = ("SEE ALL GRAD SCHOOL RANKINGS",)
REF_REQUIRED_BLOCK = "Full-time MBA Ranking Scores"
REF_WRONG_VIEW = "Part-time MBA Ranking Scores"
REF_MIN_CHARS = 500
REF_EXPECTED_SECTIONS = 7
REF_GATE_KEYWORDS = ("wharton", "acceptance rate", "average base salary", "overall score", "peer assessment", "gmat")
REF_GATE_CHARS = 3000
# Ad-element attribute patterns (id / class substrings) and marker attributes.
REF_AD_ID_PATTERNS = ("google_ads", "gpt-ad", "ad-slot", "ad_slot", "AdSlot", "advertisement")
REF_AD_CLASS_PATTERNS = (
    "ad-container", "ad-slot", "ad-wrapper", "ad_wrapper", "advertisement", "sponsored",
    "taboola", "outbrain", "connatix", "zergnet",
)
REF_AD_ATTRIBUTES = ("data-google-query-id", "data-ad-slot")


@dataclass(frozen=True)
class CleanSpec:
    """Markers for T4-T6.  Defaults are the reference's fixed values."""

    start_markers: tuple[str, ...] = REF_START_MARKERS
    fallback_equals: tuple[str, ...] = REF_FALLBACK_EQUALS
    fallback_contains: tuple[str, ...] = REF_FALLBACK_CONTAINS
    fallback_back: int = 5
    end_markers: tuple[str, ...] = REF_END_MARKERS
    block_start: str = REF_BLOCK_START
    resume_markers: tuple[str, ...] = REF_RESUME_MARKERS
    noise: tuple[str, ...] = field(default=REF_NOISE)


def _any(col: Column, items, fn) -> Column:
    out = F.lit(False)
    for it in items:
        out = out | fn(col, F.lit(it))
    return out


# ---------------------------------------------------------------- HTML

_BLOCK_TAGS = "p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|main|aside|title|br"


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML fragment.

    Drops head/script/style/comments, turns block tags and ``<br>`` into
    line breaks, strips the remaining tags, decodes HTML entities (commons-
    text, shipped with Spark), collapses blanks, trims every line and drops
    empty lines."""
    t = F.regexp_replace(html, "(?is)<head\\b.*?</head>|<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->", "")
    t = F.regexp_replace(t, f"(?i)</?({_BLOCK_TAGS})\\b[^>]*>", "\n")
    t = F.regexp_replace(t, "<[^>]*>", "")
    t = F.call_function("reflect", F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), t)
    t = F.regexp_replace(t, "[ \\t\\x0B\\f\\r\\u00A0]+", " ")
    t = F.regexp_replace(t, "(?m)^ +| +$", "")
    t = F.regexp_replace(t, "\\n{2,}", "\n")
    return F.regexp_replace(t, "\\A\\n+|\\n+\\z", "")


def _inner(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def main_container_text(html: Column, min_chars: int = REF_MIN_CHARS) -> Column:
    """Text of the first of ``<main>``, ``role="main"``, ``<article>``
    whose text is longer than ``min_chars``; otherwise the whole body."""
    cands = [
        _inner(html, "(?is)<main\\b[^>]*>(.*?)</main>"),
        _inner(html, "(?is)<div\\b[^>]*\\brole\\s*=\\s*[\"']main[\"'][^>]*>(.*?)</div>"),
        _inner(html, "(?is)<article\\b[^>]*>(.*?)</article>"),
    ]
    texts = [html_to_text(c) for c in cands]
    body = F.regexp_extract(html, "(?is)<body\\b[^>]*>(.*)</body>", 1)
    fallback = html_to_text(F.when(body != "", body).otherwise(html))
    out = fallback
    for t in reversed(texts):
        out = F.when(F.length(t) > min_chars, t).otherwise(out)
    return out


def strip_ads(html: Column, class_words: Sequence[str] = ()) -> Column:
    """Remove iframes and elements (of any tag) whose id/class carries an ad
    pattern, whose class list has one of ``class_words`` as a whole word, or that
    carry an ad marker attribute.

    An element ends at the end tag that balances it, whatever it nests; a void
    element is its tag alone.  An element that nothing closes stays, and so does all
    after it.  Comments, scripts and styles are not searched for tags.  NULL stays NULL."""
    t = F.regexp_replace(html, "(?is)<iframe\\b.*?(</iframe>|/>)", "")
    attr = []
    for p in REF_AD_ID_PATTERNS:
        attr.append(f"\\bid\\s*=\\s*[\"'][^\"']*{p}[^\"']*[\"']")
    for p in REF_AD_CLASS_PATTERNS:
        attr.append(f"\\bclass\\s*=\\s*[\"'][^\"']*{p}[^\"']*[\"']")
    for w in class_words:
        attr.append(f"\\bclass\\s*=\\s*[\"'](?:[^\"']*\\s)?{w}(?:\\s[^\"']*)?[\"']")
    for a in REF_AD_ATTRIBUTES:
        attr.append(f"\\b{a}\\b")
    attrs = "|".join(attr)
    pieces = F.regexp_extract_all(t, F.lit(HTML_PIECES), 0)
    cuts = _balanced_cuts(pieces, f"(?is)^<[a-z][a-z0-9]*\\b[^>]*(?:{attrs})")
    starts = F.concat(F.array(F.lit(1)), F.transform(cuts, lambda c: c["last"] + 1))
    ends = F.concat(F.transform(cuts, lambda c: c["first"]), F.array(F.size(pieces) + 1))
    kept = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(pieces, a, b - a), ""))
    return F.array_join(kept, "")


#: a page cut at its tags; joined, the pieces are the page again
HTML_PIECES = "(?is)<!--.*?-->|<(script|style)\\b.*?</\\1\\s*>|<[^>]*>|[^<]+|<"
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]


def _balanced_cuts(pieces: Column, wanted: str) -> Column:
    """Places (first, last), from 1, of the outermost elements whose start tag matches ``wanted``.

    One fold over the pieces: it holds the open element's name and how deep that name nests."""
    name = lambda x: F.lower(F.regexp_extract(x, "^</?([A-Za-z][A-Za-z0-9]*)", 1))
    tags = F.transform(pieces, lambda x, i: F.struct(
        (i + 1).alias("at"), name(x).alias("name"), x.startswith("</").alias("end"),
        (name(x).isin(*VOID_TAGS) | x.rlike("(?i)^<(script|style)\\b")).alias("alone"), x.rlike(wanted).alias("wanted")))
    tags = F.filter(tags, lambda x: x["name"] != "")
    zero = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(0).alias("first"),
                    F.array().cast("array<struct<first:int,last:int>>").alias("cuts"))

    def step(acc: Column, x: Column) -> Column:
        outside = acc["depth"] == 0
        begins = outside & x["wanted"]
        same = ~outside & (x["name"] == acc["name"]) & ~x["alone"]
        depth = F.when(begins & ~x["alone"], 1).when(same, acc["depth"] + F.when(x["end"], -1).otherwise(1)).otherwise(acc["depth"])
        first = F.when(begins, x["at"]).otherwise(acc["first"])
        closed = (begins & x["alone"]) | (same & (depth == 0))
        cut = F.array(F.struct(first.alias("first"), x["at"].alias("last")))
        return F.struct(F.when(begins, x["name"]).otherwise(acc["name"]).alias("name"), depth.alias("depth"), first.alias("first"),
                        F.when(closed, F.concat(acc["cuts"], cut)).otherwise(acc["cuts"]).alias("cuts"))

    return F.aggregate(tags, zero, step, lambda acc: acc["cuts"])


# ---------------------------------------------------------------- lines

def to_lines(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Line table ``(key, line_no, line)``; order is explicit."""
    return df.select(key, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))


def clean_lines(df: DataFrame, key: str, text_col: str = "text", spec: CleanSpec = CleanSpec()) -> DataFrame:
    """T4+T5+T6: per document ``(key, cleaned)``.

    T4 START: the first line that contains a start marker (start there) or a
    fallback marker (start ``fallback_back`` lines earlier, floor 0); END:
    the first line from the top starting with an end marker (exclusive).
    T5: a line containing ``block_start`` is dropped and starts skipping;
    skipping ends at a line starting with a resume marker, which is kept.
    T6: lines containing a noise phrase are dropped; lines re-joined by \\n."""
    lines = to_lines(df, key, text_col)
    s = py_strip(F.col("line"))
    lines = lines.withColumn("_s", s).select(
        "*",
        _any(F.col("_s"), spec.start_markers, lambda c, m: c.contains(m)).alias("_is_start"),
        (_any(F.col("_s"), spec.fallback_equals, lambda c, m: c == m)
         | _any(F.col("_s"), spec.fallback_contains, lambda c, m: c.contains(m))).alias("_is_fb"),
        _any(F.col("_s"), spec.end_markers, lambda c, m: c.startswith(m)).alias("_is_end"),
    )
    whole = Window.partitionBy(key)
    lines = lines.withColumn(
        "_first", F.min(F.when(F.col("_is_start") | F.col("_is_fb"), F.col("line_no"))).over(whole)
    ).withColumn(
        "_end", F.coalesce(F.min(F.when(F.col("_is_end"), F.col("line_no"))).over(whole), F.count(F.lit(1)).over(whole))
    )
    first_is_start = F.max(F.when(F.col("_is_start") & (F.col("line_no") == F.col("_first")), F.lit(1))).over(whole)
    lines = lines.withColumn("_first_is_start", first_is_start)
    start = (
        F.when(F.col("_first").isNull(), F.lit(0))
        .when(F.col("_first_is_start") == 1, F.col("_first"))
        .otherwise(F.greatest(F.col("_first") - spec.fallback_back, F.lit(0)))
    )
    lines = lines.withColumn("_start", start)
    in_region = (F.col("line_no") >= F.col("_start")) & (F.col("line_no") < F.col("_end"))
    blk = F.col("_s").contains(spec.block_start)
    resume = _any(F.col("_s"), spec.resume_markers, lambda c, m: c.startswith(m)) & ~blk
    ordered = Window.partitionBy(key).orderBy("line_no")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # only lines inside the region take part in the state machine
    last_blk = F.max(F.when(in_region & blk, F.col("line_no"))).over(before)
    last_res = F.max(F.when(in_region & resume, F.col("line_no"))).over(upto)
    skipped = blk | (F.coalesce(last_blk, F.lit(-1)) > F.coalesce(last_res, F.lit(-1)))
    noisy = _any(F.col("line"), spec.noise, lambda c, m: c.contains(m))
    keep = in_region & ~skipped & ~noisy
    marked = lines.withColumn("_keep", keep)
    out = marked.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("_keep"), F.struct("line_no", "line")))).alias("_kept")
    )
    return out.select(key, F.array_join(F.transform("_kept", lambda x: x["line"]), "\n").alias("cleaned"))


# ---------------------------------------------------------------- gates

def quality_gate(text: Column, required_block: str = REF_REQUIRED_BLOCK, min_chars: int = REF_MIN_CHARS,
                 require_block: bool = True) -> Column:
    """``struct(status, reason)``; a rejected text is a row, not an error."""
    n = marker_count(text, required_block)
    stripped_len = F.length(py_strip(text))
    reason = F.when(
        F.lit(require_block) & (n != 1),
        F.format_string("expected exactly one required block; found %d", n),
    ).when(stripped_len < min_chars, F.format_string("text too short (%d chars)", F.length(text)))
    return F.struct(F.when(reason.isNull(), F.lit("ok")).otherwise(F.lit("rejected")).alias("status"), reason.alias("reason"))


def wrap_text(text: Column, rules: Column) -> Column:
    """message = page text wrapped in a content tag, then the rules."""
    return F.concat(F.lit("<page_content>\n"), text, F.lit("\n</page_content>\n\n"), rules)


def section_completeness(text: Column, expected: int = REF_EXPECTED_SECTIONS) -> Column:
    """Count lines that (trimmed, upper-cased) start with SEE LESS or
    equal LESS; ``struct(verified, expected, complete)``."""
    lines = F.split(text, "\n", -1)
    n = F.size(F.filter(lines, lambda l: F.upper(F.trim(l)).startswith("SEE LESS") | (F.upper(F.trim(l)) == "LESS")))
    return F.struct(n.cast("bigint").alias("verified"), F.lit(expected).alias("expected"), (n >= expected).alias("complete"))


def view_check(text: Column, marker: str = REF_REQUIRED_BLOCK, wrong_marker: str = REF_WRONG_VIEW) -> Column:
    """Accept if the marker occurs exactly once; reject if the wrong-view
    marker is present; otherwise accept."""
    return F.when(marker_count(text, marker) == 1, F.lit(True)).when(text.contains(wrong_marker), F.lit(False)).otherwise(F.lit(True))


def keyword_gate(text: Column, host_ok: Column, keywords=REF_GATE_KEYWORDS, n_chars: int | None = None) -> Column:
    """Any keyword in the lower-cased text, and the host condition.

    The reference looks only at the first 3000 characters; here the whole
    text is searched unless ``n_chars`` is given."""
    head = F.lower(text if n_chars is None else F.substring(text, 1, n_chars))
    return _any(head, keywords, lambda c, k: c.contains(k)) & host_ok
