"""F — nested records to leaves, flat rows and child tables.

A record is a JSON text per row.  It is parsed once into a VARIANT; the
leaves are found by higher-order functions, one level of containers at a time
for as many levels as the text nests, all inside the row, so no step shuffles.  VARIANT stores object
keys sorted, so the leaf order inside one record is sorted-key order (the
reference keeps insertion order; nothing downstream depends on it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_T = "map<string,variant>"
ARR_T = "array<variant>"


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", MAP_T)


def _as_arr(v: Column) -> Column:
    return F.try_variant_get(v, "$", ARR_T)


def _node(path: Column, v: Column, keep_arrays: bool) -> Column:
    """A node carries its container tag, computed once when it is created:
    'o' object, 'a' array (only when arrays are opened), 's' anything else."""
    tag = F.when(_as_map(v).isNotNull(), F.lit("o"))
    if not keep_arrays:
        tag = tag.when(_as_arr(v).isNotNull(), F.lit("a"))
    return F.struct(path.alias("path"), v.alias("v"), tag.otherwise(F.lit("s")).alias("t"))


def _child_path(prefix: Column, key: Column) -> Column:
    return F.when(prefix == "", key).otherwise(F.concat(prefix, F.lit("."), key))


def _expand(n: Column, keep_arrays: bool) -> Column:
    """One level: an object/array node becomes its children, a scalar stays."""
    obj = F.transform(
        F.map_entries(_as_map(n["v"])),
        lambda e: _node(_child_path(n["path"], e["key"]), e["value"], keep_arrays),
    )
    out = F.when(n["t"] == "o", obj)
    if not keep_arrays:
        arr = F.transform(
            _as_arr(n["v"]),
            lambda x, i: _node(F.concat(n["path"], F.lit("["), i.cast("string"), F.lit("]")), x, keep_arrays),
        )
        out = out.when(n["t"] == "a", arr)
    return out.otherwise(F.array(n))


def json_depth(text: Column) -> Column:
    """How deep the brackets of a JSON text nest; 0 for a scalar, NULL for NULL.

    Escapes go first, then strings, then all that is no bracket; what is left
    has two characters a container.  For a text that is no JSON the number
    means nothing."""
    brackets = text
    for pattern in ("\\\\.", '"[^"]*"', "[^\\[\\]{}]+"):
        brackets = F.regexp_replace(brackets, pattern, "")
    steps = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0))
    walk = F.aggregate(
        steps, F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")),
        lambda acc, d: F.struct((acc["now"] + d).alias("now"), F.greatest(acc["top"], acc["now"] + d).alias("top")),
    )
    return walk["top"]


def leaf_array(v: Column, depth: Column, keep_arrays: bool = False) -> Column:
    """Array of (path, v, t) for every leaf of variant ``v`` whose containers
    nest ``depth`` deep (``json_depth`` of its text).

    Paths are ``a.b[0].c``.  Empty objects and arrays yield nothing; JSON
    null is a leaf.  With ``keep_arrays`` arrays are leaves themselves (F3).
    Each node is typed once; later levels only read its tag."""
    root = F.array(_node(F.lit(""), v, keep_arrays))
    levels = F.slice(F.sequence(F.lit(0), depth), 2, depth)  # one entry a level, none for depth 0
    return F.aggregate(levels, root, lambda nodes, _: F.flatten(F.transform(nodes, lambda n: _expand(n, keep_arrays))))


def _depth(json_col: str, max_depth: int | None) -> Column:
    depth = F.coalesce(json_depth(F.col(json_col)), F.lit(0))
    return depth if max_depth is None else F.least(depth, F.lit(max_depth))


def scalar_kind(v: Column, t: Column | None = None) -> Column:
    """Python-side type a JSON scalar would load as: bool/int/float/str/null.

    VARIANT keeps integers as integer types and decimals with a point as
    DECIMAL/DOUBLE; an integer beyond 64 bits arrives as DECIMAL(p,0), p>=19.
    ``t`` may carry an already computed ``schema_of_variant(v)``."""
    t = F.schema_of_variant(v) if t is None else t
    return (
        F.when(t == "BOOLEAN", F.lit("bool"))
        .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
        .when(t.rlike("^DECIMAL\\((19|[2-9][0-9]),0\\)$") & F.try_variant_get(v, "$", "bigint").isNull(), F.lit("int"))
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), F.lit("float"))
        .when(t == "STRING", F.lit("str"))
        .when(t == "VOID", F.lit("null"))
        .when(t.startswith("OBJECT") | t.startswith("ARRAY"), F.lit("container"))
        .otherwise(F.lit("other"))
    )


def _short_decimal_text(v: Column, t: Column) -> Column:
    """Python repr of a float that VARIANT holds as a DECIMAL of at most 15
    digits with magnitude 0 or in [1e-4, 1e16): the decimal's own digits
    (those round-trip, so they are the shortest form), '.0' if integral.
    NULL when the fast form does not apply."""
    prec = F.regexp_extract(t, "^DECIMAL\\(([0-9]+),", 1).try_cast("int")
    s = v.cast("string")
    d = F.variant_get(v, "$", "double")
    ok = (prec <= 15) & ((d == 0) | (F.abs(d) >= 1e-4))
    return F.when(ok, F.when(s.contains("."), s).otherwise(F.concat(s, F.lit(".0"))))


def _float_text(v: Column, t: Column) -> Column:
    """Python repr of a float; the long form stands in a lambda, which keeps it out of
    the generated code that every leaf runs through (too long a method is never compiled)."""
    from leafline.functions.numbers import py_float_repr

    slow = F.transform(F.array(F.variant_get(v, "$", "double")), py_float_repr)
    return F.coalesce(_short_decimal_text(v, t), F.get(slow, F.lit(0)))


def value_text(v: Column, kind: Column, t: Column | None = None) -> Column:
    """Readable text of a scalar leaf: the string itself, Python repr of a
    number, ``true``/``false``; JSON for containers, NULL for null."""
    t = F.schema_of_variant(v) if t is None else t
    return (
        F.when(kind == "str", F.variant_get(v, "$", "string"))
        .when(kind == "int", v.cast("string"))
        .when(kind == "float", _float_text(v, t))
        .when(kind == "bool", F.when(F.variant_get(v, "$", "boolean"), "true").otherwise("false"))
        .when(kind == "null", F.lit(None).cast("string"))
        .otherwise(F.to_json(v))
    )


def parse_records(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Parse JSON text to VARIANT; a bad text keeps its raw form and
    an error, never silently disappears."""
    v = F.try_parse_json(F.col(json_col))
    return df.withColumn("record", v).withColumn(
        "parse_error",
        F.when(v.isNull(), F.when(F.col(json_col).isNull(), F.lit("missing")).otherwise(F.lit("invalid_json"))),
    )


def flatten_leaves(
    df: DataFrame,
    keys: Sequence[str],
    json_col: str = "json",
    max_depth: int | None = None,
    keep_arrays: bool = False,
    spread: bool = False,
) -> DataFrame:
    """one row per leaf ``(keys..., ord, path, kind, value, value_text)``.

    Records may nest to any depth; with a ``max_depth`` a container below it is
    reported with kind ``depth_exceeded``.  An unparsable record gives one
    ``invalid_json`` row.  Nothing is shuffled, but with ``spread`` the records are
    hash-partitioned by key first, so that the leaves come out partitioned
    for a later per-record group-by or join."""
    src = df.select(*keys, json_col)
    if spread:
        from leafline.operators.audit import work_partitions

        src = src.repartition(work_partitions(src), *keys)
    # the depth is a column of its own, as the levels refer to it more than once
    parsed = parse_records(src, json_col).withColumn("_depth", _depth(json_col, max_depth))
    arr = leaf_array(F.col("record"), F.col("_depth"), keep_arrays)
    exploded = parsed.select(
        *keys,
        "parse_error",
        F.posexplode_outer(F.when(F.col("parse_error").isNull(), arr)).alias("ord", "leaf"),
    )
    v = F.col("leaf.v")
    deep = (F.col("leaf.t") == "o") if keep_arrays else F.col("leaf.t").isin("o", "a")
    held = F.size(F.coalesce(F.map_keys(_as_map(v)), _as_arr(v)))
    # empty containers that survive as the last level produce no leaf; told by the tag, before any leaf is typed
    exploded = exploded.where(F.coalesce(~(F.col("parse_error").isNull() & deep & (held == 0)), F.lit(True)))
    exploded = exploded.withColumn("_t", F.schema_of_variant(v))
    t = F.col("_t")
    kind0 = scalar_kind(v, t)
    kind = F.when(F.col("parse_error").isNotNull(), F.col("parse_error")).when(deep & (held > 0), F.lit("depth_exceeded"))
    if keep_arrays:
        kind = kind.when(t.startswith("ARRAY"), F.lit("array"))
    kind = kind.otherwise(kind0)
    out = exploded.select(
        *keys,
        F.coalesce(F.col("ord"), F.lit(0)).cast("bigint").alias("ord"),
        F.col("leaf.path").alias("path"),
        kind.alias("kind"),
        v.alias("value"),
        t.alias("_t"),
    )
    return out.withColumn("value_text", value_text(F.col("value"), F.col("kind"), F.col("_t"))).drop("_t")


def flatten_scalars(df: DataFrame, keys: Sequence[str], json_col: str = "json", max_depth: int | None = None) -> DataFrame:
    """scalar leaves outside arrays (paths without ``[``); nulls kept."""
    return flatten_leaves(df, keys, json_col, max_depth).where(~F.col("path").contains("["))


def normalize_keep_arrays(df: DataFrame, keys: Sequence[str], json_col: str = "json", max_depth: int | None = None) -> DataFrame:
    """like F1 but an array is one value, rendered as JSON text."""
    return flatten_leaves(df, keys, json_col, max_depth, keep_arrays=True)


def pivot_wide(leaves: DataFrame, key: str, paths: Sequence[str] | None = None) -> DataFrame:
    """one row per key, one column per path (values as text).

    ``paths`` fixes the columns; without it the distinct paths are read
    first (metadata-sized: the union of keys, not the rows)."""
    if paths is None:
        paths = [r[0] for r in leaves.select("path").distinct().orderBy("path").collect()]
    return leaves.groupBy(key).pivot("path", list(paths)).agg(F.first("value_text", ignorenulls=True))


def explode_children(records: DataFrame, key: str, array_path: str, label_col: str = "entity") -> DataFrame:
    """rows of one array of objects, each tagged with the entity label.

    Not-an-array gives no rows; non-object items are skipped; the item's own
    keys win over the label (the reference builds ``{school} | item``)."""
    v = F.try_parse_json(F.col("json")) if "record" not in records.columns else F.col("record")
    items = F.try_variant_get(v, f"$.{array_path}", ARR_T)
    ex = records.select(F.col(key), F.posexplode(F.coalesce(items, F.array())).alias("item_no", "item"))
    ex = ex.where(_as_map(F.col("item")).isNotNull())
    return ex.select(
        F.col(key).alias(label_col),
        "item_no",
        F.explode(F.map_entries(_as_map(F.col("item")))).alias("kv"),
    ).select(label_col, "item_no", F.col("kv.key").alias("field"), F.col("kv.value").alias("value"))


def child_table(records: DataFrame, key: str, array_path: str, fields: Sequence[tuple[str, str]],
                label_col: str = "entity", json_col: str = "json") -> DataFrame:
    """F6 in wide form: one row per object in the array at ``array_path``,
    ``label, item_no, <fields>``; an item's own field named like the label
    wins over the label.  ``fields`` is (name, spark type) of the items."""
    v = F.try_parse_json(F.col(json_col))
    items = F.try_variant_get(v, f"$.{array_path}", ARR_T)
    ex = records.select(F.col(key).alias("_label"), F.posexplode(F.coalesce(items, F.array())).alias("item_no", "item"))
    ex = ex.where(_as_map(F.col("item")).isNotNull())
    cols = [F.try_variant_get(F.col("item"), f"$.{name}", typ).alias(name) for name, typ in fields]
    names = [n for n, _ in fields]
    label = F.col("_label").cast("string")
    if label_col in names:
        label = F.coalesce(F.try_variant_get(F.col("item"), f"$.{label_col}", "string"), label)
    return ex.select(label.alias(label_col), F.col("item_no").cast("bigint").alias("item_no"),
                     *[c for c, n in zip(cols, names) if n != label_col])


def label_fallback(records: DataFrame, key: str, label_path: str, json_col: str = "json") -> DataFrame:
    """label = nested value if the key is present (a JSON null stays
    NULL), else the record's own key (the file stem in the reference)."""
    v = F.try_parse_json(F.col(json_col))
    node = F.try_variant_get(v, f"$.{label_path}", "variant")
    label = F.when(node.isNotNull(), F.try_variant_get(node, "$", "string")).otherwise(F.col(key).cast("string"))
    return records.select(key, label.alias("label"), node.isNotNull().alias("label_present"))


def quick_comparison(flat: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """the wanted columns that exist, in the wanted order."""
    return flat.select(*[F.col(f"`{c}`") for c in wanted if c in flat.columns])


def table_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """per table its row count, column count and non-empty flag.

    Each count is a distributed aggregate; the union is of one-row frames."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
            (F.col("n_rows") > 0).alias("non_empty"),
        )
        out = row if out is None else out.unionByName(row)
    return out
