"""Registered queries for groups T (text preparation) and L (links).

Marker parameters: the reference's markers belong to one web site and occur
in none of the supplied tables, so each query states the markers it uses on
the supplied documents/pages (``DOC_SPEC`` etc.); the operators' defaults
remain the reference's fixed values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.functions.text import marker_count, strip_fences
from leafline.operators import links as L
from leafline.operators import text as T
from leafline.sources.tables import table

# Stand-in markers for the supplied documents: licence lines close the
# content; a line with an e-mail address opens a block that a line starting
# with "The" or "Le" closes; credential lines are noise.
DOC_SPEC = T.CleanSpec(
    end_markers=("Licensed under", "Released under", "This work is licensed"),
    block_start="@",
    resume_markers=("The", "Le"),
    noise=("token =",),
)
PAGE_PATH_PATTERN = "^/[^/]+$"
PAGE_INDEX_PATTERN = "(?i)^/index$"
HOST_ALIASES = {"://(m|blog)\\.": "://"}


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _pages(spark, sf):
    return table(spark, sf, "pages")


def q_html_to_text(spark, sf):
    return _pages(spark, sf).select("page_id", T.html_to_text(F.col("html")).alias("text"))


def q_main_container(spark, sf):
    return _pages(spark, sf).select("page_id", T.main_container_text(F.col("html")).alias("text"))


def q_strip_ads(spark, sf):
    return _pages(spark, sf).select("page_id", T.strip_ads(F.col("html"), class_words=("ad",)).alias("html"))


def q_clean_lines(spark, sf):
    return T.clean_lines(_docs(spark, sf).select("doc_id", "text"), "doc_id", "text", DOC_SPEC)


def q_marker_count(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", marker_count(F.col("text"), "License").alias("n_license"),
                    marker_count(F.col("text"), "the").alias("n_the"))


def q_quality_gate(spark, sf):
    g = T.quality_gate(F.col("text"), required_block="Licensed under the Apache License")
    return _docs(spark, sf).select("doc_id", g["status"].alias("status"), g["reason"].alias("reason"))


def q_section_completeness(spark, sf):
    c = T.section_completeness(F.col("text"))
    return _docs(spark, sf).select("doc_id", c["verified"].alias("verified"), c["complete"].alias("complete"))


def q_view_check(spark, sf):
    return _docs(spark, sf).select("doc_id", T.view_check(F.col("text"), "MIT License", "Apache License").alias("accepted"))


def q_keyword_gate(spark, sf):
    ok = T.keyword_gate(F.col("text"), F.col("lang") == "en", keywords=("license", "token"))
    return _docs(spark, sf).select("doc_id", ok.alias("passes"))


def q_strip_fences(spark, sf):
    fenced = F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```"))
    return table(spark, sf, "conversations").select("conv_id", "turn", strip_fences(fenced).alias("text"))


def q_wrap_text(spark, sf):
    msg = T.wrap_text(F.col("text"), F.lit("Return the fields as JSON."))
    return table(spark, sf, "conversations").where(F.col("role") == "user").select("conv_id", "turn", msg.alias("message"))


# ------------------------------------------------------------------ links

def _page_links(spark, sf):
    return L.profile_links(L.extract_links(_pages(spark, sf)), PAGE_PATH_PATTERN, PAGE_INDEX_PATTERN)


def q_page_links(spark, sf):
    return _page_links(spark, sf).select("page_id", "pos", "href", "path", "anchor_text")


def q_best_link_row(spark, sf):
    best = L.best_link_row(_page_links(spark, sf), text_col="anchor_text")
    return best.select("path", "page_id", "pos", "anchor_text",
                       F.col("first_seen.page_id").alias("first_page"), F.col("first_seen.pos").alias("first_pos"))


def q_link_distinct(spark, sf):
    return L.link_distinct(_page_links(spark, sf))


def q_exact_rank(spark, sf):
    links = L.extract_links(_pages(spark, sf))
    return links.select("page_id", "pos", L.exact_rank(F.col("anchor_text")).alias("rank"))


def q_url_canonical(spark, sf):
    p = _pages(spark, sf)
    url = L.canonical_url(F.col("url"), "https://example.com", HOST_ALIASES)
    url = F.regexp_replace(url, "[?#].*$", "")
    title = F.trim(F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1))
    slug = L.url_slug(url)
    return p.select("page_id", url.alias("url"), slug.alias("slug"),
                    F.when(title != "", title).otherwise(L.title_slug(slug)).alias("display_name"),
                    L.title_slug(slug).alias("slug_title"))


#: a host of the supplied pages, so that the filter has something to drop
SPAM_HOST = "spam-farm.example.org"


def q_blocklist_filter(spark, sf):
    domains = [*L.REF_BLOCK_DOMAINS, SPAM_HOST]
    return L.block_urls(_pages(spark, sf).select("page_id", "url"), "url", domains)


QUERIES = {
    "html_to_text": q_html_to_text,
    "main_container": q_main_container,
    "strip_ads": q_strip_ads,
    "clean_lines": q_clean_lines,
    "marker_count": q_marker_count,
    "quality_gate": q_quality_gate,
    "section_completeness": q_section_completeness,
    "view_check": q_view_check,
    "keyword_gate": q_keyword_gate,
    "strip_fences": q_strip_fences,
    "wrap_text": q_wrap_text,
    "page_links": q_page_links,
    "best_link_row": q_best_link_row,
    "link_distinct": q_link_distinct,
    "exact_rank": q_exact_rank,
    "url_canonical": q_url_canonical,
    "blocklist_filter": q_blocklist_filter,
}

# ------------------------------------------------------------------ oracles

_H2T = r"""
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace({x},
        '(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
        '(?i)</?(p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|main|aside|title|br)\b[^>]*>', chr(10), 'g'),
        '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
    '[ \t\x0b\x0c\r\x{a0}]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\n{2,}', chr(10), 'g'), '\A\n+|\n+\z', '', 'g')"""

def _h2t(x: str) -> str:
    return _H2T.replace("{x}", x)


_PY_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^{_PY_WS}+|{_PY_WS}+$', '', 'g')"


# DuckDB has no Python-style title(); spelled out over characters: upper-case
# a letter whose predecessor is not a letter, lower-case the rest.
_PY_TITLE = r"""array_to_string(list_transform(range(1, length({s}) + 1), lambda i:
    CASE WHEN regexp_full_match(substr(lower({s}), i, 1), '\pL')
              AND (i = 1 OR NOT regexp_full_match(substr(lower({s}), i - 1, 1), '\pL'))
         THEN upper(substr(lower({s}), i, 1)) ELSE substr(lower({s}), i, 1) END), '')"""

_BLOCKED = ", ".join(f"('{d}')" for d in [*L.REF_BLOCK_DOMAINS, SPAM_HOST])

ORACLES = {
    "html_to_text": "SELECT page_id, " + _h2t("html") + " AS text FROM pages",
    "main_container": """
        SELECT page_id, CASE WHEN length(a) > 500 THEN a ELSE b END AS text FROM (
          SELECT page_id, """ + _h2t(r"regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)") + """ AS a,
                 """ + _h2t(r"coalesce(nullif(regexp_extract(html, '(?is)<body\b[^>]*>(.*)</body>', 1), ''), html)") + """ AS b FROM pages)""",
    "strip_ads": "SELECT page_id, regexp_replace(html, '<div class=\"ad\">[^<]*</div>', '', 'g') AS html FROM pages",
    "clean_lines": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
        f AS (SELECT *, """ + _pystrip("line") + r""" AS s FROM l),
        g AS (SELECT *,
                min(line_no) FILTER (WHERE contains(s, 'Business School Overview') OR s = 'At-a-Glance'
                                     OR contains(s, 'in Best Business Schools')) OVER (PARTITION BY doc_id) AS fh,
                coalesce(min(line_no) FILTER (WHERE starts_with(s, 'Licensed under') OR starts_with(s, 'Released under')
                                     OR starts_with(s, 'This work is licensed')) OVER (PARTITION BY doc_id),
                         count(*) OVER (PARTITION BY doc_id)) AS en
              FROM f),
        h AS (SELECT *, CASE WHEN fh IS NULL THEN 0
                             WHEN bool_or(line_no = fh AND contains(s, 'Business School Overview')) OVER (PARTITION BY doc_id) THEN fh
                             ELSE greatest(fh - 5, 0) END AS st FROM g),
        r AS (SELECT *, line_no >= st AND line_no < en AS inr, contains(s, '@') AS blk,
                     (starts_with(s, 'The') OR starts_with(s, 'Le')) AND NOT contains(s, '@') AS res FROM h),
        k AS (SELECT *,
                max(line_no) FILTER (WHERE inr AND blk) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lb,
                max(line_no) FILTER (WHERE inr AND res) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lr
              FROM r)
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (
                 WHERE inr AND NOT blk AND coalesce(lb, -1) <= coalesce(lr, -1) AND NOT contains(line, 'token =')), '') AS cleaned
        FROM k GROUP BY doc_id""",
    "marker_count": """
        SELECT doc_id, (length(text) - length(replace(text, 'License', ''))) // 7 AS n_license,
               (length(text) - length(replace(text, 'the', ''))) // 3 AS n_the FROM documents""",
    "quality_gate": """
        SELECT doc_id, CASE WHEN r IS NULL THEN 'ok' ELSE 'rejected' END AS status, r AS reason FROM (
          SELECT doc_id, CASE WHEN n <> 1 THEN 'expected exactly one required block; found ' || n
                              WHEN length(""" + _pystrip("text") + """) < 500 THEN 'text too short (' || length(text) || ' chars)' END AS r
          FROM (SELECT *, (length(text) - length(replace(text, 'Licensed under the Apache License', ''))) // 33 AS n FROM documents))""",
    "section_completeness": """
        SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)),
                 lambda l: starts_with(upper(trim(l)), 'SEE LESS') OR upper(trim(l)) = 'LESS')) AS BIGINT) AS verified,
               len(list_filter(string_split(text, chr(10)),
                 lambda l: starts_with(upper(trim(l)), 'SEE LESS') OR upper(trim(l)) = 'LESS')) >= 7 AS complete
        FROM documents""",
    "view_check": """
        SELECT doc_id, CASE WHEN (length(text) - length(replace(text, 'MIT License', ''))) // 11 = 1 THEN true
                            WHEN contains(text, 'Apache License') THEN false ELSE true END AS accepted FROM documents""",
    "keyword_gate": """
        SELECT doc_id, (contains(lower(text), 'license') OR contains(lower(text), 'token')) AND lang = 'en' AS passes
        FROM documents""",
    "strip_fences": """
        SELECT conv_id, turn, """ + _pystrip(
        "CASE WHEN ends_with(x, '```') THEN left(x, length(x) - 3) ELSE x END") + """ AS text
        FROM (SELECT conv_id, turn, CASE WHEN contains(f, chr(10)) THEN substr(f, strpos(f, chr(10)) + 1) ELSE substr(f, 4) END AS x
              FROM (SELECT conv_id, turn, """ + _pystrip("'```json' || chr(10) || text || chr(10) || '```'") + """ AS f FROM conversations))""",
    "wrap_text": """
        SELECT conv_id, turn, '<page_content>' || chr(10) || text || chr(10) || '</page_content>' || chr(10) || chr(10)
               || 'Return the fields as JSON.' AS message FROM conversations WHERE role = 'user'""",
    "page_links": r"""
        WITH a AS (
          SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>', 0)) AS a,
                 unnest(range(len(regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>', 0)))) AS pos FROM pages),
        b AS (SELECT page_id, pos, concat(regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"', 1),
                     regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*''([^'']*)''', 1),
                     regexp_extract(a, '(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*([^\s"''>]+)', 1)) AS href,
                     trim(regexp_replace(regexp_replace(a, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS anchor_text FROM a),
        c AS (SELECT *, regexp_replace(CASE WHEN p = '' THEN '/' ELSE p END, '(.)/$', '\1') AS path FROM (
                SELECT *, regexp_extract(regexp_replace(href, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1) AS p FROM b))
        SELECT page_id, pos, href, path, anchor_text FROM c
        WHERE regexp_matches(path, '^/[^/]+$') AND NOT regexp_matches(path, '(?i)^/index$')""",
    "link_distinct": None,
    "exact_rank": None,
    "best_link_row": None,
    "url_canonical": r"""
        SELECT page_id, url, slug, CASE WHEN title <> '' THEN title ELSE slug_title END AS display_name, slug_title FROM (
          SELECT page_id, url, slug, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title,
                 """ + _PY_TITLE.replace("{s}", "replace(slug, '-', ' ')") + r""" AS slug_title FROM (
            SELECT page_id, html, u AS url, list_last(string_split(regexp_replace(u, '/+$', ''), '/')) AS slug FROM (
              SELECT page_id, html, regexp_replace(regexp_replace(url, '://(m|blog)\.', '://'), '[?#].*$', '') AS u FROM pages)))""",
    "blocklist_filter": f"""
        SELECT page_id, url FROM pages p
        WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_BLOCKED}) b(domain) WHERE contains(p.url, b.domain))""",
}

_LINKS_CTE = ORACLES["page_links"].replace("SELECT page_id, pos, href, path, anchor_text FROM c\n        WHERE",
                                           "SELECT * FROM c WHERE", 1)
_LINKS_CTE = "WITH links AS (" + _LINKS_CTE.strip() + ")"
ORACLES["link_distinct"] = _LINKS_CTE + " SELECT page_id, count(DISTINCT path) AS n_distinct_links FROM links GROUP BY page_id"
ORACLES["best_link_row"] = _LINKS_CTE + r"""
    SELECT path, page_id, pos, anchor_text, first_page, first_pos FROM (
      SELECT *, row_number() OVER (PARTITION BY path ORDER BY
                  (regexp_matches(anchor_text, '#[0-9]+\b') AND NOT regexp_matches(anchor_text, '#[0-9]+-[0-9]+\b'))::INT DESC,
                  length(anchor_text) DESC, page_id, pos) AS rn,
             first_value(page_id) OVER (PARTITION BY path ORDER BY page_id, pos) AS first_page,
             first_value(pos) OVER (PARTITION BY path ORDER BY page_id, pos) AS first_pos
      FROM links) WHERE rn = 1"""
ORACLES["exact_rank"] = r"""
    WITH a AS (
      SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>', 0)) AS a,
             unnest(range(len(regexp_extract_all(html, '(?is)<a\b[^>]*>.*?</a>', 0)))) AS pos FROM pages),
    b AS (SELECT page_id, pos, trim(regexp_replace(regexp_replace(a, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS t FROM a)
    SELECT page_id, pos, CASE WHEN regexp_matches(t, '#[0-9]+\b') AND NOT regexp_matches(t, '#[0-9]+-[0-9]+\b')
                              THEN TRY_CAST(regexp_extract(t, '#([0-9]+)\b', 1) AS BIGINT) END AS rank FROM b"""

