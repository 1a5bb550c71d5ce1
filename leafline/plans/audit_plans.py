"""Registered queries for groups F (flatten) and A (audit), with oracles.

Records: one nested JSON per document (``doc_records``) audited against the
document's whole text; one nested JSON per order (``order_records``) for the
array/child-table operators.  Oracles are written from the semantics in
SQL over the base tables, not by translating the Spark code.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.functions.candidates import string_candidates
from leafline.operators import audit as A
from leafline.operators import flatten as FL
from leafline.sources.bindings import doc_records, doc_texts, order_records
from leafline.sources.tables import table

KEY = "doc_id"


def _audited(spark, sf):
    return A.audit_records(doc_records(spark, sf), doc_texts(spark, sf), KEY)


def q_flatten_leaves(spark, sf):
    return FL.flatten_leaves(doc_records(spark, sf), [KEY]).select(KEY, "path", "kind", "value_text")


def q_flatten_order_leaves(spark, sf):
    return FL.flatten_leaves(order_records(spark, sf), ["o_orderkey"]).select("o_orderkey", "path", "kind", "value_text")


def q_flatten_scalars(spark, sf):
    return FL.flatten_scalars(order_records(spark, sf), ["o_orderkey"]).select("o_orderkey", "path", "kind", "value_text")


def q_normalize_keep_arrays(spark, sf):
    df = FL.normalize_keep_arrays(order_records(spark, sf), ["o_orderkey"])
    n = F.when(F.col("kind") == "array", F.size(F.try_variant_get("value", "$", "array<variant>")).cast("bigint"))
    return df.select("o_orderkey", "path", "kind", n.alias("n_items"),
                     F.when(F.col("kind") != "array", F.col("value_text")).alias("value_text"))


ORDER_PATHS = ["customer.key", "order.date", "order.key", "order.priority", "order.status", "order.total"]


def q_pivot_wide(spark, sf):
    leaves = FL.flatten_scalars(order_records(spark, sf), ["o_orderkey"])
    return FL.pivot_wide(leaves, "o_orderkey", ORDER_PATHS)


def q_quick_comparison(spark, sf):
    wide = q_pivot_wide(spark, sf)
    return FL.quick_comparison(wide, ["order.key", "order.total", "order.rank", "order.status", "school_type", "customer.key"])


LINE_FIELDS = [("line", "bigint"), ("part", "bigint"), ("qty", "double"), ("price", "double"),
               ("discount", "double"), ("flag", "string")]


def q_explode_children(spark, sf):
    return FL.child_table(order_records(spark, sf), "o_orderkey", "lines", LINE_FIELDS, label_col="order")


def q_label_fallback(spark, sf):
    ev = table(spark, sf, "events").select(F.col("event_id"), F.col("props").alias("json"))
    return FL.label_fallback(ev, "event_id", "k")


def q_table_manifest(spark, sf):
    recs = order_records(spark, sf)
    leaves = FL.flatten_scalars(recs, ["o_orderkey"])
    return FL.table_manifest({
        "flat": FL.pivot_wide(leaves, "o_orderkey", ORDER_PATHS),
        "lines": FL.child_table(recs, "o_orderkey", "lines", LINE_FIELDS, label_col="order"),
        "empty_specialties": FL.child_table(recs, "o_orderkey", "specialties", [("name", "string")], label_col="order"),
    })


def q_text_views(spark, sf):
    from leafline.functions.text import compact_text, digits_view, normalize_text

    t = doc_texts(spark, sf)
    return t.select(KEY, F.lower("text").alias("lower"), normalize_text(F.col("text")).alias("normalized"),
                    compact_text(F.col("text")).alias("compact"), digits_view(F.col("text")).alias("digits"))


def q_candidates(spark, sf):
    leaves = A.candidate_leaves(doc_records(spark, sf), KEY)
    return leaves.select(KEY, "path", "kind", F.posexplode("candidates").alias("cand_no", "c")).select(
        KEY, "path", "kind", F.col("cand_no").cast("bigint").alias("cand_no"),
        F.col("c.text").alias("cand_text"), F.col("c.kind").alias("cand_kind"))


def q_date_variants(spark, sf):
    o = table(spark, sf, "orders")
    # equal rows go before the forms open: a month and day's forms are no other's, so (order, form) is unique after
    dates = o.select("o_orderkey", F.array(
        F.date_format("o_orderdate", "MMM. dd"), F.date_format("o_orderdate", "MMM d"),
        F.date_format("o_orderdate", "MM/dd"), F.date_format("o_orderdate", "M/d")).alias("forms")).distinct()
    forms = dates.select("o_orderkey", F.explode(F.array_distinct("forms")).alias("form"))
    return forms.select("o_orderkey", "form", F.posexplode(string_candidates(F.col("form"))).alias("cand_no", "c")).select(
        "o_orderkey", "form", F.col("cand_no").cast("bigint").alias("cand_no"),
        F.col("c.text").alias("cand_text"), F.col("c.kind").alias("cand_kind"))


def q_validate_leaf(spark, sf):
    return A.audit_leaves(_audited(spark, sf), KEY)


def q_audit_entity(spark, sf):
    return A.audit_entity(_audited(spark, sf), KEY).drop("match_types", "unsupported")


def q_audit_summary(spark, sf):
    return A.audit_summary(A.audit_entity(_audited(spark, sf), KEY), doc_records(spark, sf), KEY)


def q_audit_worst(spark, sf):
    return A.audit_worst(A.audit_entity(_audited(spark, sf), KEY), KEY)


def q_audit_top_paths(spark, sf):
    return A.audit_top_paths(A.audit_leaves(_audited(spark, sf), KEY))


def _texts_without_fr(spark, sf):
    return table(spark, sf, "documents").where(F.col("lang") != "fr").select(KEY, "text")


def q_audit_missing_text(spark, sf):
    return A.audit_missing_text(doc_records(spark, sf), _texts_without_fr(spark, sf), KEY)


def q_audit_selected(spark, sf):
    sel = table(spark, sf, "labels").select(KEY)
    recs = A.audit_selected(doc_records(spark, sf), sel, KEY)
    return A.audit_entity(A.audit_records(recs, doc_texts(spark, sf), KEY), KEY).drop("match_types", "unsupported")


QUERIES = {
    "flatten_leaves": q_flatten_leaves,
    "flatten_order_leaves": q_flatten_order_leaves,
    "flatten_scalars": q_flatten_scalars,
    "normalize_keep_arrays": q_normalize_keep_arrays,
    "pivot_wide": q_pivot_wide,
    "quick_comparison": q_quick_comparison,
    "explode_children": q_explode_children,
    "label_fallback": q_label_fallback,
    "table_manifest": q_table_manifest,
    "text_views": q_text_views,
    "string_candidates": q_candidates,
    "date_variants": q_date_variants,
    "validate_leaf": q_validate_leaf,
    "audit_entity": q_audit_entity,
    "audit_summary": q_audit_summary,
    "audit_worst": q_audit_worst,
    "audit_top_paths": q_audit_top_paths,
    "audit_missing_text": q_audit_missing_text,
    "audit_selected": q_audit_selected,
}

# --------------------------------------------------------------------------
# Oracles (DuckDB).  Shared CTEs are plain SQL text.

_DOC_LEAVES = r"""
d AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
lw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS ln,
         unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i
  FROM d
),
leaves AS (
  SELECT doc_id, 'doc.id' AS path, 'int' AS kind, CAST(doc_id AS VARCHAR) AS sval, NULL::DOUBLE AS dval FROM d
  UNION ALL SELECT doc_id, 'doc.lang', 'str', lang, NULL FROM d
  UNION ALL SELECT doc_id, 'doc.source', 'str', source, NULL FROM d
  UNION ALL SELECT doc_id, 'doc.chars', 'int', CAST(n_chars AS VARCHAR), NULL FROM d
  UNION ALL SELECT doc_id, 'label.quality', 'str', COALESCE(CAST(quality AS VARCHAR), 'NA'), NULL FROM d
  UNION ALL SELECT doc_id, 'label.toxic', 'str', COALESCE(CAST(toxic AS VARCHAR), 'NA'), NULL FROM d
  UNION ALL SELECT doc_id, 'text.first_word', 'str', regexp_extract(text, '^[ \t\r\n]*([^ \t\r\n]+)', 1), NULL FROM d
  UNION ALL SELECT doc_id, 'text.last_word', 'str', regexp_extract(text, '([^ \t\r\n]+)[ \t\r\n]*$', 1), NULL FROM d
  UNION ALL SELECT doc_id, 'text.lines', 'int', CAST(len(string_split(text, chr(10))) AS VARCHAR), NULL FROM d
  UNION ALL SELECT doc_id, 'text.upper_share', 'float', NULL,
    CASE WHEN length(text) > 0 THEN floor((length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) * 10000 / length(text)) / 10000.0 ELSE 0.0 END FROM d
  UNION ALL SELECT doc_id, 'text.digit_share', 'float', NULL,
    CASE WHEN length(text) > 0 THEN floor((length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) * 10000 / length(text)) / 10000.0 ELSE 0.0 END FROM d
  UNION ALL SELECT doc_id, 'text.has_digit', 'bool', CASE WHEN regexp_matches(text, '[0-9]') THEN 'true' ELSE 'false' END, NULL FROM d
  UNION ALL SELECT doc_id, 'line_words[' || i || ']', 'int',
    CAST(len(list_filter(regexp_split_to_array(ln, '[ \t\r]+'), lambda w: w <> '')) AS VARCHAR), NULL FROM lw
),
leafv AS (
  SELECT *, CASE WHEN kind = 'float' THEN CAST(dval AS VARCHAR) ELSE sval END AS value_text FROM leaves
)"""

_STRIP0 = "CASE WHEN contains({x}, '.') THEN rtrim(rtrim({x}, '0'), '.') ELSE {x} END"


def _pct(n: int, ord_: int) -> str:
    f = f"printf('%.{n}f', dval * 100)"
    s = _STRIP0.format(x=f)
    return (
        f"UNION ALL SELECT doc_id, path, kind, {ord_}, {s} || '%', 'percent' FROM leafv WHERE kind = 'float' AND dval BETWEEN 0 AND 1\n"
        f"  UNION ALL SELECT doc_id, path, kind, {ord_ + 1}, {s}, 'percent_plain' FROM leafv WHERE kind = 'float' AND dval BETWEEN 0 AND 1\n"
    )


_MONTHS = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"


def _str_cands(src: str, keycols: str) -> str:
    """Candidate rows for string values ``v`` of relation ``src``."""
    mre = r"'^([A-Za-z]{3})\.?\s+([0-9]{1,2})$'"
    sre = r"'^([0-9]{1,2})/([0-9]{1,2})$'"
    return f"""
  SELECT {keycols}, 1 AS ord, lower(v) AS text, 'exact' AS ckind FROM {src} WHERE v <> ''
  UNION ALL SELECT {keycols}, 2, regexp_replace(lower(v), '[^a-z0-9]+', '', 'g'), 'compact' FROM {src} WHERE v <> ''
  UNION ALL SELECT {keycols}, 2 + t.o, t.tok, 'na_token' FROM {src},
      (VALUES (1, 'n/a'), (2, 'a/v'), (3, 'na'), (4, 'not available')) t(o, tok) WHERE v = 'NA'
  UNION ALL SELECT {keycols}, 7, regexp_replace(v, '[^0-9]+', '', 'g'), 'digits' FROM {src}
      WHERE length(regexp_replace(v, '[^0-9]+', '', 'g')) >= 7
  UNION ALL SELECT {keycols}, 7 + t.o,
      CASE t.o WHEN 1 THEN lpad(CAST(m AS VARCHAR), 2, '0') || '/' || lpad(CAST(dd AS VARCHAR), 2, '0')
               WHEN 2 THEN CAST(m AS VARCHAR) || '/' || CAST(dd AS VARCHAR)
               ELSE mt || ' ' || lpad(CAST(dd AS VARCHAR), 2, '0') END, 'date_variant'
    FROM (SELECT *, lower(regexp_extract(v, {mre}, 1)) AS mt,
                 list_position({_MONTHS}, lower(regexp_extract(v, {mre}, 1))) AS m,
                 TRY_CAST(regexp_extract(v, {mre}, 2) AS INTEGER) AS dd
          FROM {src} WHERE regexp_full_match(v, {mre})) x, (VALUES (1), (2), (3)) t(o)
    WHERE m IS NOT NULL AND m > 0
  UNION ALL SELECT {keycols}, 10 + t.o,
      CASE t.o WHEN 1 THEN {_MONTHS}[m] || '. ' || lpad(CAST(dd AS VARCHAR), 2, '0')
               WHEN 2 THEN {_MONTHS}[m] || '. ' || CAST(dd AS VARCHAR)
               ELSE {_MONTHS}[m] || ' ' || lpad(CAST(dd AS VARCHAR), 2, '0') END, 'date_variant'
    FROM (SELECT *, TRY_CAST(regexp_extract(v, {sre}, 1) AS INTEGER) AS m,
                 TRY_CAST(regexp_extract(v, {sre}, 2) AS INTEGER) AS dd
          FROM {src} WHERE regexp_full_match(v, {sre})) x, (VALUES (1), (2), (3)) t(o)
    WHERE m BETWEEN 1 AND 12"""


_CANDS = (
    _DOC_LEAVES
    + """,
sv AS (SELECT doc_id, path, kind, trim(sval) AS v FROM leafv WHERE kind = 'str'),
raw_c AS (
  SELECT doc_id, path, kind, 1 AS ord, sval AS text, 'exact' AS ckind FROM leafv WHERE kind IN ('int', 'bool')
  UNION ALL SELECT doc_id, path, kind, 2, format('{:,}', CAST(sval AS HUGEINT)), 'formatted' FROM leafv WHERE kind = 'int'
  UNION ALL SELECT doc_id, path, kind, 3, '$' || format('{:,}', CAST(sval AS HUGEINT)), 'currency' FROM leafv WHERE kind = 'int'
  UNION ALL SELECT doc_id, path, kind, 4, '#' || sval, 'rank' FROM leafv WHERE kind = 'int'
  UNION ALL SELECT doc_id, path, kind, 1, """
    + _STRIP0.format(x="CAST(dval AS VARCHAR)")
    + """, 'exact' FROM leafv WHERE kind = 'float'
  """
    + "".join(_pct(n, 2 + 2 * n) for n in range(4))
    + """  UNION ALL SELECT * FROM ("""
    + _str_cands("sv", "doc_id, path, kind")
    + """)
),
cands AS (
  SELECT * FROM raw_c WHERE text IS NOT NULL AND text <> ''
  QUALIFY kind IN ('int', 'bool') OR row_number() OVER (PARTITION BY doc_id, path, text ORDER BY ord) = 1
),
cands_n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, path ORDER BY ord) - 1 AS cand_no FROM cands
)"""
)

_VERDICT = (
    _CANDS
    + r""",
views AS (
  SELECT doc_id, lower(text) AS lo, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS co,
         regexp_replace(text, '[^0-9]+', '', 'g') AS di FROM documents
),
hits AS (
  SELECT c.doc_id, c.path, c.cand_no, c.text, c.ckind FROM cands_n c JOIN views v ON c.doc_id = v.doc_id
  WHERE CASE WHEN c.ckind = 'compact' THEN contains(v.co, c.text)
             WHEN c.ckind = 'digits' THEN contains(v.di, c.text)
             WHEN regexp_full_match(left(c.text, 1), '[\pL\pN]') AND regexp_full_match(right(c.text, 1), '[\pL\pN]')
               THEN contains(v.lo, c.text) AND regexp_matches(v.lo, '(^|[^A-Za-z0-9])' || regexp_escape(c.text) || '([^A-Za-z0-9]|$)')
             ELSE contains(v.lo, c.text) END
  QUALIFY row_number() OVER (PARTITION BY c.doc_id, c.path ORDER BY c.cand_no) = 1
),
verdict AS (
  SELECT l.doc_id, l.path, l.kind, l.value_text, h.text IS NOT NULL AS supported,
         COALESCE(h.ckind, 'unsupported') AS match_type, h.text AS matched_candidate
  FROM leafv l JOIN documents t ON l.doc_id = t.doc_id
  LEFT JOIN hits h ON l.doc_id = h.doc_id AND l.path = h.path
),
mt AS (SELECT doc_id, match_type, count(*) AS n FROM verdict GROUP BY ALL),
ent AS (
  SELECT v.doc_id, count(*) AS total_fields, count(*) FILTER (WHERE supported) AS supported_fields,
         count(*) FILTER (WHERE NOT supported) AS unsupported_fields,
         CAST(printf('%.4f', (count(*) FILTER (WHERE supported)) / count(*)) AS DOUBLE) AS support_rate
  FROM verdict v GROUP BY v.doc_id
),
ent_json AS (
  SELECT doc_id, '{' || string_agg('"' || match_type || '":' || n, ',' ORDER BY match_type) || '}' AS match_types_json
  FROM mt GROUP BY doc_id
)"""
)

_ORDER_LEAVES = r"""
li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag) - 1 AS i,
         l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag
  FROM lineitem
),
leaves AS (
  SELECT o_orderkey, 'order.key' AS path, 'int' AS kind, CAST(o_orderkey AS VARCHAR) AS value_text FROM orders
  UNION ALL SELECT o_orderkey, 'order.status', 'str', o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, 'order.priority', 'str', o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, 'order.date', 'str', strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT o_orderkey, 'order.total', 'float', CAST(o_totalprice AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderkey, 'customer.key', 'int', CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].line', 'int', CAST(l_linenumber AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].part', 'int', CAST(l_partkey AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].qty', 'float', CAST(l_quantity AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].price', 'float', CAST(l_extendedprice AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].discount', 'float', CAST(l_discount AS VARCHAR) FROM li
  UNION ALL SELECT l_orderkey, 'lines[' || i || '].flag', 'str', l_returnflag FROM li
)"""

_PY_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

ORACLES = {
    "flatten_leaves": "WITH " + _DOC_LEAVES + " SELECT doc_id, path, kind, value_text FROM leafv",
    "flatten_order_leaves": "WITH " + _ORDER_LEAVES + " SELECT * FROM leaves",
    "flatten_scalars": "WITH " + _ORDER_LEAVES + " SELECT * FROM leaves WHERE NOT contains(path, '[')",
    "normalize_keep_arrays": "WITH " + _ORDER_LEAVES + """
        SELECT o_orderkey, path, kind, NULL::BIGINT AS n_items, value_text FROM leaves WHERE NOT contains(path, '[')
        UNION ALL
        SELECT o_orderkey, 'lines', 'array', (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey), NULL FROM orders""",
    "pivot_wide": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "customer.key", strftime(o_orderdate, '%Y-%m-%d') AS "order.date",
               CAST(o_orderkey AS VARCHAR) AS "order.key", o_orderpriority AS "order.priority",
               o_orderstatus AS "order.status", CAST(o_totalprice AS VARCHAR) AS "order.total"
        FROM orders""",
    "quick_comparison": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "order.key", CAST(o_totalprice AS VARCHAR) AS "order.total",
               o_orderstatus AS "order.status", CAST(o_custkey AS VARCHAR) AS "customer.key" FROM orders""",
    "explode_children": """
        SELECT CAST(l_orderkey AS VARCHAR) AS "order",
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag) - 1 AS item_no,
               CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_quantity AS qty, l_extendedprice AS price,
               l_discount AS discount, l_returnflag AS flag
        FROM lineitem""",
    "label_fallback": """
        SELECT event_id, CASE WHEN json_exists(props, '$.k') THEN json_extract_string(props, '$.k') ELSE CAST(event_id AS VARCHAR) END AS label,
               json_exists(props, '$.k') AS label_present FROM events""",
    "table_manifest": """
        SELECT 'flat' AS table_name, count(*) AS n_rows, 7::BIGINT AS n_cols, count(*) > 0 AS non_empty FROM orders
        UNION ALL SELECT 'lines', count(*), 8, count(*) > 0 FROM lineitem
        UNION ALL SELECT 'empty_specialties', 0, 3, false""",
    "text_views": f"""
        SELECT doc_id, lower(text) AS lower,
               trim(regexp_replace(lower(text), '{_PY_WS}+', ' ', 'g'), ' ') AS normalized,
               regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS compact,
               regexp_replace(text, '[^0-9]+', '', 'g') AS digits
        FROM documents""",
    "string_candidates": "WITH " + _CANDS + """
        SELECT doc_id, path, kind, cand_no, text AS cand_text, ckind AS cand_kind FROM cands_n""",
    "date_variants": """
        WITH forms AS (
          SELECT DISTINCT o_orderkey, f AS v FROM orders,
            unnest([strftime(o_orderdate, '%b. %d'), strftime(o_orderdate, '%b ') || CAST(day(o_orderdate) AS VARCHAR),
                    strftime(o_orderdate, '%m/%d'), CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR)]) t(f)
        ),
        raw_c AS (""" + _str_cands("forms", "o_orderkey, v") + """),
        c AS (SELECT * FROM raw_c WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY o_orderkey, v, text ORDER BY ord) = 1)
        SELECT DISTINCT o_orderkey, v AS form, row_number() OVER (PARTITION BY o_orderkey, v ORDER BY ord) - 1 AS cand_no,
               text AS cand_text, ckind AS cand_kind FROM c""",
    "validate_leaf": "WITH " + _VERDICT + " SELECT * FROM verdict",
    "audit_entity": "WITH " + _VERDICT + """
        SELECT e.*, j.match_types_json FROM ent e JOIN ent_json j ON e.doc_id = j.doc_id""",
    "audit_summary": "WITH " + _VERDICT + """
        SELECT count(*) AS entities_audited, count(*) FILTER (WHERE unsupported_fields > 0) AS entities_with_issues,
               0::BIGINT AS missing_text, CAST(sum(total_fields) AS BIGINT) AS total_fields,
               CAST(sum(supported_fields) AS BIGINT) AS supported_fields,
               CAST(sum(unsupported_fields) AS BIGINT) AS unsupported_fields,
               CAST(printf('%.4f', sum(supported_fields) / sum(total_fields)) AS DOUBLE) AS support_rate
        FROM ent""",
    "audit_worst": "WITH " + _VERDICT + """
        SELECT doc_id, unsupported_fields, total_fields, support_rate FROM ent
        ORDER BY unsupported_fields DESC, doc_id LIMIT 10""",
    "audit_top_paths": "WITH " + _VERDICT + """
        SELECT path, count(*) AS n_unsupported FROM verdict WHERE NOT supported GROUP BY path
        ORDER BY n_unsupported DESC, path LIMIT 50""",
    "audit_missing_text": "SELECT doc_id FROM documents WHERE lang = 'fr'",
    "audit_selected": "WITH " + _VERDICT + """
        SELECT e.*, j.match_types_json FROM ent e JOIN ent_json j ON e.doc_id = j.doc_id
        WHERE e.doc_id IN (SELECT doc_id FROM labels)""",
}
