"""Registered queries for groups X (extraction) and I (incremental runs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.functions.stats import exact_avg
from leafline.operators import extract as X
from leafline.operators import incremental as I
from leafline.operators import text as T
from leafline.sources.bindings import customer_profiles, doc_records, doc_texts
from leafline.sources.tables import table

# Stand-in rule table for the customer profile pages (the reference's own
# label map belongs to its site and matches nothing in the supplied data).
PROFILE_RULES = [
    ("Customer Profile", "Name", "after", "customer.name", "string"),
    ("Customer Profile", "Market Segment", "after", "customer.segment", "string"),
    ("Customer Profile", "Account Balance", "after", "customer.balance", "number"),
    ("Customer Profile", "Nation", "after", "customer.nation", "string"),
    ("Customer Profile", "Orders placed", "before", "customer.orders_elsewhere", "number"),
    ("Orders", "Orders placed", "before", "orders.count", "number"),
    ("Orders", "Total spend", "after", "orders.spend", "number"),
    ("Orders", "Urgent share", "glued", "orders.urgent_share", "number"),
    ("Orders", "Nation Rank", "rank", "orders.nation_rank", "number"),
    ("Orders", "Loyalty tier", "after", "orders.loyalty_tier", "string"),
]
RULE_PATHS = sorted({r[3] for r in PROFILE_RULES})
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
DOC_TEMPLATE = ["doc.chars", "doc.id", "doc.lang", "doc.source", "doc.title", "label.quality", "label.toxic",
                "text.digit_share", "text.first_word", "text.last_word", "text.lines", "text.upper_share"]


def _typed_profiles(spark, sf):
    prof = customer_profiles(spark, sf)
    fields = X.extract_fields(prof, "c_custkey", X.rules_frame(spark, PROFILE_RULES))
    typed = X.typed_fields(fields, "c_custkey")
    return X.complete_fields(typed, prof.select("c_custkey"), "c_custkey", RULE_PATHS)


def q_label_value_extract(spark, sf):
    t = _typed_profiles(spark, sf)
    return t.select("c_custkey", "path", F.round("value_num", 2).alias("value_num"), "value_str",
                    (F.col("json_value") == '"NA"').alias("is_na"))


def q_assemble_record(spark, sf):
    rec = X.assemble_record(_typed_profiles(spark, sf), "c_custkey")
    v = F.parse_json("json")
    return rec.select("c_custkey",
                      F.variant_get(v, "$.customer.name", "string").alias("name"),
                      F.try_variant_get(v, "$.orders.count", "bigint").alias("n_orders"),
                      F.variant_get(v, "$.orders.loyalty_tier", "string").alias("loyalty_tier"))


def q_clean_numeric(spark, sf):
    li = table(spark, sf, "lineitem")
    price = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    disc = F.concat(F.format_string("%.0f", F.col("l_discount") * 100), F.lit("%"))
    p, d = X.clean_numeric(price), X.clean_numeric(disc)
    return li.select("l_orderkey", "l_linenumber", F.round(p["value"], 2).alias("price"), p["is_int"].alias("price_is_int"),
                     F.round(d["value"], 4).alias("discount"), X.clean_numeric(F.col("l_returnflag")).isNull().alias("flag_not_number"))


def q_complete_categories(spark, sf):
    o = table(spark, sf, "orders")
    facts = o.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").agg(
        F.count("*").alias("n_orders"), exact_avg("o_totalprice").alias("avg_price"))
    ents = table(spark, sf, "customer").select("c_custkey")
    return X.complete_categories(ents, "c_custkey", facts, "o_orderpriority", PRIORITIES, "avg_price", "n_orders")


def q_template_conformance(spark, sf):
    c = X.template_conformance(doc_records(spark, sf), "doc_id", DOC_TEMPLATE)
    return c.select("doc_id", F.array_join("missing", ",").alias("missing"), F.size("unexpected").cast("bigint").alias("n_unexpected"))


def q_additional_fields(spark, sf):
    return X.additional_fields(doc_records(spark, sf), "doc_id", DOC_TEMPLATE)


def q_parse_or_error(spark, sf):
    """X6 on event properties; every eleventh event is cut short, as a reply
    that broke off would be."""
    ev = table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 11 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    ev = ev.select("event_id", raw.alias("raw"))
    v = F.try_parse_json("raw")
    return ev.select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"),
                     F.when(v.isNull(), F.lit("invalid_json")).alias("error"),
                     F.when(v.isNull(), F.col("raw")).alias("raw"))


def q_set_source_url(spark, sf):
    p = table(spark, sf, "pages")
    rec = F.to_json(F.struct(F.struct(F.col("page_id"), F.lit("").alias("source_url")).alias("metadata")))
    out = X.set_source_url(rec, F.col("url"))
    v = F.parse_json(out)
    return p.select("page_id", F.variant_get(v, "$.metadata.source_url", "string").alias("source_url"),
                    F.variant_get(v, "$.metadata.page_id", "bigint").alias("meta_page_id"))


def q_drop_internal_keys(spark, sf):
    r = doc_records(spark, sf)
    with_prov = X.add_provenance(F.col("json"), "_file", F.concat(F.col("doc_id").cast("string"), F.lit(".json")))
    dropped = X.drop_internal_keys(with_prov)
    keys = lambda j: F.array_join(F.array_sort(F.map_keys(F.try_variant_get(F.parse_json(j), "$", "map<string,variant>"))), ",")
    return r.select("doc_id", keys(with_prov).alias("keys_before"), keys(dropped).alias("keys_after"))


def q_edition_year(spark, sf):
    e = X.edition_years(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", e["data_year"].alias("data_year"), e["ranking_edition"].alias("ranking_edition"))


# ------------------------------------------------------------ incremental
# Stand-in runs over the documents: the previous run processed the English
# documents; a text under 500 characters yields a failure record.

REQUIRED = "doc"


def _process(spark, sf, texts):
    """The per-entity job of a run: gate, then the record or an error."""
    recs = doc_records(spark, sf)
    g = T.quality_gate(F.col("text"), require_block=False)
    gated = texts.select("doc_id", g["status"].alias("status"), g["reason"].alias("reason"))
    j = gated.join(recs, "doc_id", "left")
    err = F.to_json(F.struct(F.col("reason").alias("_error")))
    return j.select("doc_id", F.when(F.col("status") == "ok", F.col("json")).otherwise(err).alias("json"))


def _runs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    run1 = _process(spark, sf, docs.where(F.col("lang") == "en").select("doc_id", "text"))
    done1 = I.done_set(run1, "doc_id", REQUIRED)
    todo = I.remaining_work(docs.select("doc_id", "text"), done1, "doc_id")
    run2 = _process(spark, sf, todo)
    return docs, run1, done1, todo, run2


def q_done_set(spark, sf):
    return _runs(spark, sf)[2]


def q_remaining_work(spark, sf):
    return _runs(spark, sf)[3].select("doc_id")


def q_merge_results(spark, sf):
    _, run1, _, _, run2 = _runs(spark, sf)
    m = I.merge_results(run1.withColumn("run", F.lit(1)), run2.withColumn("run", F.lit(2)), "doc_id")
    return m.select("doc_id", "run", I.result_status(F.col("json"), REQUIRED).alias("status"))


def q_failure_ledger(spark, sf):
    _, run1, _, _, run2 = _runs(spark, sf)
    att = run1.withColumn("attempt", F.lit(1)).unionByName(run2.withColumn("attempt", F.lit(2)))
    att = att.withColumn("status", I.result_status(F.col("json"), REQUIRED))
    return I.failure_ledger(att, "doc_id")


RETRIES = 3


def q_failure_retry(spark, sf):
    """Every document tried up to three times; a document answers once its attempt
    number exceeds its text's length modulo 4, so some never do."""
    docs = table(spark, sf, "documents").select("doc_id", "text")

    def attempt(work):
        need = F.char_length("text") % 4
        status = F.when(F.col("text").isNull(), "missing").when(need < F.col("attempt"), "ok").otherwise("error: timeout")
        return work.select("doc_id", "attempt", status.alias("status"))

    tried = I.run_with_retries(docs, "doc_id", attempt, RETRIES)
    return tried.groupBy("doc_id").agg(
        F.max("attempt").cast("bigint").alias("attempts"), F.max_by("status", "attempt").alias("last_status")
    )


def q_run_summary(spark, sf):
    docs, _, done1, _, run2 = _runs(spark, sf)
    return I.run_summary(docs, done1, run2, "doc_id", REQUIRED)


QUERIES = {
    "label_value_extract": q_label_value_extract,
    "assemble_record": q_assemble_record,
    "clean_numeric": q_clean_numeric,
    "complete_categories": q_complete_categories,
    "template_conformance": q_template_conformance,
    "additional_fields": q_additional_fields,
    "parse_or_error": q_parse_or_error,
    "set_source_url": q_set_source_url,
    "drop_internal_keys": q_drop_internal_keys,
    "edition_year": q_edition_year,
    "done_set": q_done_set,
    "remaining_work": q_remaining_work,
    "merge_results": q_merge_results,
    "failure_ledger": q_failure_ledger,
    "failure_retry": q_failure_retry,
    "run_summary": q_run_summary,
}

_PROFILE = """
o AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend,
             count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY o_custkey),
c AS (SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, nn.n_name, o.n, o.spend, o.u,
             rank() OVER (PARTITION BY c.c_nationkey ORDER BY o.spend DESC, c.c_custkey) AS rk
      FROM customer c JOIN nation nn ON c.c_nationkey = nn.n_nationkey JOIN o ON o.o_custkey = c.c_custkey),
f AS (
  SELECT c_custkey, 'customer.name' AS path, NULL::DOUBLE AS value_num, c_name AS value_str FROM c
  UNION ALL SELECT c_custkey, 'customer.segment', NULL, c_mktsegment FROM c
  UNION ALL SELECT c_custkey, 'customer.balance', round(c_acctbal, 2), NULL FROM c
  UNION ALL SELECT c_custkey, 'customer.nation', NULL, n_name FROM c
  UNION ALL SELECT c_custkey, 'customer.orders_elsewhere', NULL, NULL FROM c
  UNION ALL SELECT c_custkey, 'orders.count', n, NULL FROM c
  UNION ALL SELECT c_custkey, 'orders.spend', round(spend, 2), NULL FROM c
  UNION ALL SELECT c_custkey, 'orders.urgent_share', CASE WHEN u > 0 THEN floor(u * 100 / n) / 100.0 END, NULL FROM c
  UNION ALL SELECT c_custkey, 'orders.nation_rank', rk, NULL FROM c
  UNION ALL SELECT c_custkey, 'orders.loyalty_tier', NULL, NULL FROM c
)"""

_PYWS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUNS = f"""
d AS (SELECT doc_id, lang, 'error: text too short (' || length(text) || ' chars)' AS why, length(regexp_replace(text, '^{_PYWS}+|{_PYWS}+$', '', 'g')) >= 500 AS ok FROM documents),
run1 AS (SELECT doc_id, ok, why FROM d WHERE lang = 'en'),
done1 AS (SELECT doc_id FROM run1 WHERE ok),
todo AS (SELECT doc_id, ok, why FROM d WHERE doc_id NOT IN (SELECT doc_id FROM done1)),
run2 AS (SELECT doc_id, ok, why FROM todo)"""

ORACLES = {
    "label_value_extract": "WITH " + _PROFILE + """
        SELECT c_custkey, path, value_num, value_str, value_num IS NULL AND value_str IS NULL AS is_na FROM f""",
    "assemble_record": "WITH " + _PROFILE + """
        SELECT c_custkey, c_name AS name, n AS n_orders, 'NA' AS loyalty_tier FROM c""",
    "clean_numeric": """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price, false AS price_is_int,
               round(round(l_discount * 100) / 100, 4) AS discount, true AS flag_not_number FROM lineitem""",
    "complete_categories": """
        WITH f AS (SELECT o_custkey, o_orderpriority, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(38,2)))::DOUBLE / count(*) AS a
                   FROM orders GROUP BY ALL),
        p AS (SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) t(o_orderpriority))
        SELECT c.c_custkey, p.o_orderpriority, coalesce(f.n, 0) AS n_orders, CASE WHEN f.n >= 2 THEN f.a END AS avg_price
        FROM customer c CROSS JOIN p LEFT JOIN f ON f.o_custkey = c.c_custkey AND f.o_orderpriority = p.o_orderpriority""",
    "template_conformance": """
        SELECT doc_id, 'doc.title' AS missing, CAST(len(string_split(text, chr(10))) + 1 AS BIGINT) AS n_unexpected
        FROM documents""",
    "additional_fields": """
        WITH lw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS ln,
                           unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
        SELECT doc_id, 'line_words[' || i || ']' AS path, CAST(len(regexp_extract_all(ln, '[^ \\t\\r]+')) AS VARCHAR) AS value_text FROM lw
        UNION ALL SELECT doc_id, 'text.has_digit', CASE WHEN regexp_matches(text, '[0-9]') THEN 'true' ELSE 'false' END FROM documents""",
    "parse_or_error": """
        SELECT event_id, CASE WHEN json_valid(raw) THEN TRY_CAST(json_extract_string(CASE WHEN json_valid(raw) THEN raw END, '$.k') AS BIGINT) END AS k,
               CASE WHEN NOT json_valid(raw) THEN 'invalid_json' END AS error, CASE WHEN NOT json_valid(raw) THEN raw END AS raw
        FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN left(props, length(props) - 1) ELSE props END AS raw FROM events)""",
    "set_source_url": "SELECT page_id, url AS source_url, page_id AS meta_page_id FROM pages",
    "drop_internal_keys": "SELECT doc_id, '_file,doc,label,line_words,text' AS keys_before, 'doc,label,line_words,text' AS keys_after FROM documents",
    "edition_year": """
        SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, 'based on ([0-9]{4}) data', 1), '') AS INTEGER) AS data_year,
               TRY_CAST(nullif(regexp_extract(text, '([0-9]{4}) Rankings', 1), '') AS INTEGER) AS ranking_edition FROM documents""",
    "done_set": "WITH " + _RUNS + " SELECT doc_id FROM done1",
    "remaining_work": "WITH " + _RUNS + " SELECT doc_id FROM todo",
    "merge_results": "WITH " + _RUNS + """
        SELECT doc_id, 1 AS run, CASE WHEN ok THEN 'ok' ELSE why END AS status FROM run1 WHERE doc_id NOT IN (SELECT doc_id FROM run2)
        UNION ALL SELECT doc_id, 2, CASE WHEN ok THEN 'ok' ELSE why END FROM run2""",
    "failure_ledger": "WITH " + _RUNS + """,
        att AS (SELECT doc_id, 1 AS attempt, ok, why FROM run1 UNION ALL SELECT doc_id, 2, ok, why FROM run2)
        SELECT doc_id, arg_max(why, attempt) AS reason, count(*) FILTER (WHERE NOT ok) AS failed_attempts FROM att
        GROUP BY doc_id HAVING NOT arg_max(ok, attempt)""",
    "failure_retry": f"""
        SELECT doc_id, CASE WHEN text IS NULL THEN {RETRIES} ELSE least(length(text) % 4 + 1, {RETRIES}) END::BIGINT AS attempts,
               CASE WHEN text IS NULL THEN 'missing' WHEN length(text) % 4 < {RETRIES} THEN 'ok' ELSE 'error: timeout' END AS last_status
        FROM documents""",
    "run_summary": "WITH " + _RUNS + """
        SELECT (SELECT count(*) FROM d) AS inputs, (SELECT count(*) FROM done1) AS previous,
               (SELECT count(*) FILTER (WHERE ok) FROM run2) AS new_ok, (SELECT count(*) FILTER (WHERE NOT ok) FROM run2) AS new_failed,
               (SELECT count(*) FROM done1) + (SELECT count(*) FILTER (WHERE ok) FROM run2) AS total_done,
               (SELECT count(*) FROM d) - (SELECT count(*) FROM done1) AS remaining_before_run,
               round(((SELECT count(*) FROM d) - (SELECT count(*) FROM done1)) * 0.02, 2)::DOUBLE AS estimated_cost""",
}
