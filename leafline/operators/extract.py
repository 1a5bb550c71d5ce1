"""X — structured extraction: page text -> labelled fields -> nested record.

The reference sends each page to a remote model with a rule document; here
the rules are a table ``(section, label, direction, path, type)`` and the
extraction is a Spark job over line tables:

* lines of each text, blank lines dropped, positions renumbered;
* section = the last section header seen (running ``last`` over the line
  order of one document; one exchange by document key);
* the value sits next to the label: ``after`` (next line), ``before``
  (previous line), ``glued`` (rest of the label line, ``Female26.8%``) or
  ``rank`` (``#n`` two lines above, the ``#n / in / label`` triple);
* rules are a small fixed table (metadata), joined by broadcast;
* the first hit per (document, path) wins; absent fields become "NA".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.functions.text import py_strip

RULE_SCHEMA = "section string, label string, direction string, path string, type string"
# Texts that mean "missing" for any field.
MISSING_TOKENS = ("N/A", "NA", "")


def json_str(c: Column) -> Column:
    """A string as a JSON string literal (quoted and escaped)."""
    arr = F.to_json(F.array(c))
    return F.call_function("substring", arr, F.lit(2), F.length(arr) - 2)


def clean_numeric(raw: Column) -> Column:
    """``struct(value double, is_int boolean)``; NULL when not a number.

    Currency symbols and thousands commas go; a trailing ``%`` divides by
    100 (exact decimal arithmetic); plain ints and floats stay as they are."""
    s = py_strip(raw)
    pct = s.endswith("%")
    number = F.when(pct, F.call_function("substring", s, F.lit(1), F.length(s) - 1)).otherwise(s)
    body = F.regexp_replace(number, "[$€£¥,\\s]", "")
    dec = body.try_cast("decimal(38,10)")
    value = F.when(pct, (dec / F.lit(100)).cast("double")).otherwise(body.try_cast("double"))
    is_int = ~pct & body.rlike("^[+-]?[0-9]+$")
    return F.when(value.isNotNull(), F.struct(value.alias("value"), is_int.alias("is_int")))


def missing_canonical(raw: Column) -> Column:
    """Absent or "N/A"-like -> NULL (rendered "NA" only in JSON)."""
    s = py_strip(raw)
    return F.when(s.isNull() | s.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(s)


def rules_frame(spark, rules: Sequence[tuple[str, str, str, str, str]]) -> DataFrame:
    """The rule table as a DataFrame (fixed, small: it is metadata)."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def extract_fields(texts: DataFrame, key: str, rules: DataFrame, text_col: str = "text") -> DataFrame:
    """``(key, path, type, raw)`` for the first hit of every rule path.

    Label lookup is section-scoped: the same label may map to different paths
    in different sections."""
    lines = texts.select(key, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))
    lines = lines.withColumn("line", py_strip(F.col("line"))).where(F.col("line") != "")
    sections = F.broadcast(rules.select(F.col("section").alias("_hdr")).distinct())
    lines = lines.join(sections, F.col("line") == F.col("_hdr"), "left")
    w = Window.partitionBy(key).orderBy("line_no")
    lines = lines.select(
        key, "line_no", "line",
        F.last("_hdr", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("section"),
        F.lag("line", 1).over(w).alias("prev1"),
        F.lag("line", 2).over(w).alias("prev2"),
        F.lead("line", 1).over(w).alias("next1"),
    )
    r = F.broadcast(rules)
    exact = lines.join(r.where(F.col("direction") != "glued"), ["section"]).where(F.col("line") == F.col("label"))
    glued = lines.join(r.where(F.col("direction") == "glued"), ["section"]).where(
        F.col("line").startswith(F.col("label")) & (F.length("line") > F.length("label"))
    )
    hits = exact.unionByName(glued)
    raw = (
        F.when(F.col("direction") == "after", F.col("next1"))
        .when(F.col("direction") == "before", F.col("prev1"))
        .when(F.col("direction") == "glued", F.expr("substring(line, length(label) + 1)"))
        .when((F.col("direction") == "rank") & (F.col("prev1") == "in") & F.col("prev2").rlike("^#[0-9]+$"),
              F.expr("substring(prev2, 2)"))
    )
    hits = hits.select(key, "line_no", "path", "type", raw.alias("raw")).where(F.col("raw").isNotNull())
    first = Window.partitionBy(key, "path").orderBy("line_no")
    return hits.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "line_no")


def typed_fields(fields: DataFrame, key: str) -> DataFrame:
    """X2+X3 on extracted raw values: ``value_num``/``value_str`` by type,
    NULL for missing; ``json_value`` is the JSON text ("NA" when missing)."""
    num = clean_numeric(F.col("raw"))
    s = missing_canonical(F.col("raw"))
    is_num = F.col("type") == "number"
    value_num = F.when(is_num, num["value"])
    json_num = F.when(num["is_int"], num["value"].cast("bigint").cast("string")).otherwise(num["value"].cast("string"))
    json_value = (
        F.when(is_num & num.isNotNull(), json_num)
        .when(~is_num & s.isNotNull(), json_str(s))
        .otherwise(F.lit('"NA"'))
    )
    return fields.select(key, "path", "type", "raw", value_num.alias("value_num"),
                         F.when(~is_num, s).alias("value_str"), json_value.alias("json_value"))


def complete_fields(typed: DataFrame, entities: DataFrame, key: str, rule_paths: Sequence[str]) -> DataFrame:
    """X3/X5 for scalar paths: every entity has every rule path; an absent
    field is "NA".  The path list is fixed metadata, exploded per entity."""
    grid = entities.select(key, F.explode(F.array(*[F.lit(p) for p in rule_paths])).alias("path"))
    return grid.join(typed, [key, "path"], "left").withColumn(
        "json_value", F.coalesce(F.col("json_value"), F.lit('"NA"'))
    )


def assemble_record(completed: DataFrame, key: str) -> DataFrame:
    """Fields (``section.field`` paths) -> one nested JSON record per entity.

    Fields of one entity are one group, bounded by the rule table."""
    parts = F.split(F.col("path"), "\\.", 2)
    g = completed.select(key, parts.getItem(0).alias("sec"), parts.getItem(1).alias("fld"), "json_value")
    secs = g.groupBy(key, "sec").agg(
        F.array_join(F.array_sort(F.collect_list(
            F.concat(json_str(F.col("fld")), F.lit(":"), F.col("json_value")))), ",").alias("body")
    )
    rec = secs.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_list(
            F.concat(json_str(F.col("sec")), F.lit(":{"), F.col("body"), F.lit("}")))), ",").alias("_b")
    )
    return rec.select(key, F.concat(F.lit("{"), F.col("_b"), F.lit("}")).alias("json"))


def complete_categories(entities: DataFrame, key: str, facts: DataFrame, category_col: str,
                        categories: Sequence[str], value_col: str, count_col: str, min_count: int = 2) -> DataFrame:
    """Fixed categories always present for every entity; a category the
    entity lacks has NULL value; a group reported by fewer than
    ``min_count`` carries no value (single-reporter suppression)."""
    grid = entities.select(key, F.explode(F.array(*[F.lit(c) for c in categories])).alias(category_col))
    j = grid.join(facts, [key, category_col], "left")
    return j.select(
        key, category_col,
        F.coalesce(F.col(count_col), F.lit(0)).cast("bigint").alias(count_col),
        F.when(F.col(count_col) >= min_count, F.col(value_col)).alias(value_col),
    )


def template_conformance(records: DataFrame, key: str, template_paths: Sequence[str],
                         json_col: str = "json") -> DataFrame:
    """Per record the template paths it lacks (``missing``) and the
    paths it has beyond the template (``unexpected``, X9's additional
    fields), at any depth.  Row-local set differences against a fixed path
    list; a record that is no JSON has NULL in both."""
    from leafline.operators.flatten import json_depth, leaf_array

    v = F.try_parse_json(F.col(json_col))
    paths = F.transform(leaf_array(v, F.when(v.isNotNull(), json_depth(F.col(json_col)))), lambda n: n["path"])
    tmpl = F.array(*[F.lit(p) for p in template_paths])
    return records.select(
        key,
        F.array_sort(F.array_except(tmpl, paths)).alias("missing"),
        F.array_sort(F.array_except(paths, tmpl)).alias("unexpected"),
    )


def additional_fields(records: DataFrame, key: str, template_paths: Sequence[str],
                      json_col: str = "json") -> DataFrame:
    """Leaves outside the template, as ``(key, path, value_text)``."""
    from leafline.operators.flatten import flatten_leaves

    leaves = flatten_leaves(records, [key], json_col)
    return leaves.where(~F.col("path").isin(*template_paths)).select(key, "path", "value_text")


def _root_map(json: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(json), "$", "map<string,variant>")


def _as_variant(c: Column) -> Column:
    return F.variant_get(F.parse_json(F.to_json(F.array(c))), "$[0]", "variant")


def set_source_url(json: Column, url: Column) -> Column:
    """Overwrite ``metadata.source_url`` only if ``metadata`` is an object
    and the url is non-empty; otherwise the record is unchanged."""
    root = _root_map(json)
    meta = F.try_variant_get(root["metadata"], "$", "map<string,variant>")
    new_meta = F.map_concat(F.map_filter(meta, lambda k, v: k != "source_url"),
                            F.create_map(F.lit("source_url"), _as_variant(url)))
    new_root = F.map_concat(F.map_filter(root, lambda k, v: k != "metadata"),
                            F.create_map(F.lit("metadata"), F.parse_json(F.to_json(new_meta))))
    ok = meta.isNotNull() & url.isNotNull() & (url != "")
    return F.when(ok, F.to_json(new_root)).otherwise(json)


def drop_internal_keys(json: Column, prefix: str = "_") -> Column:
    """Remove top-level keys starting with ``prefix``."""
    root = _root_map(json)
    return F.to_json(F.map_filter(root, lambda k, v: ~k.startswith(prefix)))


def add_provenance(json: Column, name: str, value: Column) -> Column:
    """Add a provenance key (e.g. ``_file``) at the top level."""
    root = _root_map(json)
    return F.to_json(F.map_concat(F.map_filter(root, lambda k, v: k != name), F.create_map(F.lit(name), _as_variant(value))))


def edition_years(text: Column) -> Column:
    """``struct(data_year, ranking_edition)`` from the footer phrase
    "details based on YYYY data" and a "YYYY Rankings" header."""
    data_year = F.regexp_extract(text, "based on ([0-9]{4}) data", 1)
    edition = F.regexp_extract(text, "([0-9]{4}) Rankings", 1)
    return F.struct(F.when(data_year != "", data_year.cast("int")).alias("data_year"),
                    F.when(edition != "", edition.cast("int")).alias("ranking_edition"))
