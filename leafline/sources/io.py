"""S — sources and sinks.

Readers return lazy DataFrames; writers are distributed (one file per task)
and idempotent by overwrite.  Nothing here gathers rows on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal pandas' default NA tokens, which the reference's
# CSV read relies on).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_texts(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """One row per text file ``(entity_id, text)``; key = file stem."""
    df = spark.read.text(path, wholetext=True).select("value", "_metadata.file_name")
    stem = F.regexp_extract("file_name", f"^(.*){suffix.replace('.', '[.]')}$", 1)
    return df.select(stem.alias("entity_id"), F.col("value").alias("text")).where(F.col("entity_id") != "")


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file ``(entity_id, json, parse_error)``; a
    file that does not parse is kept with its error (quarantine), never
    silently skipped."""
    df = read_texts(spark, path, ".json").withColumnRenamed("text", "json")
    return df.withColumn("parse_error", F.when(F.try_parse_json("json").isNull(), F.lit("invalid_json")))


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S3: a JSON array file (or files) to rows."""
    r = spark.read.option("multiLine", True)
    if schema:
        r = r.schema(schema)
    return r.json(path)


def na_tokens_to_null(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Cells equal to any NA token become NULL (Spark's CSV ``nullValue``
    takes a single token, hence the explicit rule)."""
    return df.select(*[F.when(F.col(c).isin(*tokens), F.lit(None)).otherwise(F.col(c)).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


def read_csv_typed(spark: SparkSession, path: str, numeric: Sequence[str] = ()) -> DataFrame:
    """CSV with header read as strings, NA tokens to NULL, the listed
    columns cast with ``try_cast`` (invalid -> NULL, never an error)."""
    df = spark.read.option("header", True).csv(path)
    df = na_tokens_to_null(df, df.columns)
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in df.columns])


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry CSV ``school_name,url[,display_name]`` -> trimmed
    ``(entity_id, url, display_name)``; a missing display name is the slug."""
    df = spark.read.option("header", True).csv(path)
    disp = F.trim(F.col("display_name")) if "display_name" in df.columns else F.lit(None)
    ent = F.trim(F.col("school_name"))
    return df.select(ent.alias("entity_id"), F.trim("url").alias("url"),
                     F.coalesce(F.nullif(disp, F.lit("")), ent).alias("display_name"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, no index, overwrite (idempotent)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table_set(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """One dataset per table under ``path``, written only when it has a
    row (a ``limit(1)`` probe), plus a manifest (F11) saved beside them."""
    from leafline.operators.flatten import table_manifest

    for name, df in tables.items():
        if df.limit(1).count() > 0:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
    manifest = table_manifest(tables)
    manifest.write.mode("overwrite").parquet(f"{path}/_manifest")
    return manifest


def write_json_records(df: DataFrame, key: str, json_col: str, path: str) -> None:
    """One JSON object per entity as JSON Lines (``key`` + record).  The
    reference also writes one combined array file; at scale the JSON Lines
    folder is that combined output (a single array file would need one task)."""
    df.select(F.col(key).cast("string").alias("entity_id"), F.col(json_col).alias("record")).write.mode(
        "overwrite").json(path)


def save_artifact(df: DataFrame, path: str) -> None:
    """A fitted artifact (means, loadings, centroids, coefficients) as a
    parquet table; never pickle."""
    df.write.mode("overwrite").parquet(path)


def load_artifact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Audit report / summary as UTF-8 JSON Lines, sorted (range
    partitioned sort, so the files are in order)."""
    df.orderBy(*order).write.mode("overwrite").json(path)
