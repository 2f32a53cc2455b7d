"""Raw records: JSON lines, envelopes, search seeds, date spines, and file ledgers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import json_kind

ENVELOPE = "created_at timestamp, job_data variant, query_version_id bigint, gcs_uri string"
SEED = "query_id int, q string, location string, hl string, gl string, max_jobs int, google_domain string, active int"
ENRICHED = "job_id string, data_source string, skills string, created_at timestamp"
LINKEDIN = "job_id string, job_description string, created_at timestamp, search_term string, job_location string, job_title string, listing_details string, fit_level_preferences string"
DEFAULT_MAX_JOBS = 250
BAD_LINE = ("invalid_utf8", "invalid_json", "non_object_json")


def json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, value, fault) of each line that is not blank.

    The fault is one of BAD_LINE: bytes that are no UTF-8, text that is no JSON (NaN and Infinity
    are none), or a value other than an object. Lines have no size limit.
    """
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    return judged(lines.where(F.btrim("value", F.lit(" \t\r\n")) != ""))


def judged(lines: DataFrame) -> DataFrame:
    parsed = F.try_parse_json("value")
    fault = (
        F.when(~F.is_valid_utf8("value"), BAD_LINE[0]).when(parsed.isNull(), BAD_LINE[1])
        .when(~json_kind(parsed).startswith("OBJECT"), BAD_LINE[2])
    )
    return lines.withColumn("fault", fault)


def lenient_json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The good lines only."""
    return json_lines(spark, paths).where("fault is null").drop("fault")


def envelopes(lines: DataFrame) -> DataFrame:
    """Rows of ENVELOPE from good lines."""
    data = F.parse_json("value")
    field = lambda path, kind: F.try_variant_get(data, path, kind)
    return lines.select(
        F.to_timestamp(field("$.fetched_at", "string")).alias("created_at"), data.alias("job_data"),
        field("$.query_id", "string").try_cast("bigint").alias("query_version_id"), F.col("file").alias("gcs_uri"),
    )


# What a record must have, by the name of its check.
REQUIRED = {
    "source_name_not_null": "$.source_name", "query_id_not_null": "$.query_id", "q_not_null": "$.q",
    "location_not_null": "$.location", "fetched_at_not_null": "$.fetched_at", "job_job_id_not_null": "$.job.job_id",
}


def absent(data: Column | str, path: str) -> Column:
    """A path that is missing or null in JSON; empty text is there."""
    found = F.try_variant_get(data, path, "variant")
    return found.isNull() | F.is_variant_null(found)


def not_null_counts(rows: DataFrame, data: str = "job_data", paths: dict[str, str] = REQUIRED, by: list[str] | None = None) -> DataFrame:
    """Rows and failures of each check in one pass."""
    counts = [F.count_if(absent(data, path)).alias(f"failed_{name}") for name, path in paths.items()]
    return rows.groupBy(*(by or [])).agg(F.count("*").alias("row_count"), *counts)


def query_versions(spark: SparkSession, path: str) -> DataFrame:
    """The seed of searches with its plain text."""
    return with_plain_text(spark.read.schema(SEED).csv(path, header=True))


def with_plain_text(seed: DataFrame) -> DataFrame:
    return seed.withColumn("q_plain_text", F.initcap(F.replace("q", F.lit("+"), F.lit(" "))))


def active_searches(seed: DataFrame) -> DataFrame:
    """Active searches in order: trimmed, decoded, empty texts as null, and a job limit where none or 0 is given."""
    text = lambda c: F.nullif(F.btrim(F.try_url_decode(c) if c in ("q", "location") else F.col(c)), F.lit(""))
    texts = {c: text(c) for c in ("q", "location", "hl", "gl", "google_domain")}
    limit = F.coalesce(F.nullif("max_jobs", F.lit(0)), F.lit(DEFAULT_MAX_JOBS))
    return seed.where("active = 1").withColumns(texts | {"max_jobs": limit}).orderBy("query_id")


def unseen(objects: DataFrame, ledger: DataFrame, suffix: str = ".jsonl") -> DataFrame:
    """Objects (bucket, object_name) of this suffix that the ledger does not have."""
    return objects.where(F.endswith("object_name", F.lit(suffix))).join(ledger, ["bucket", "object_name"], "left_anti")


def date_spine(spark: SparkSession, start: date | str, end: date | str, step: str = "1 day") -> DataFrame:
    """Dates from start to end, both included."""
    ends = [F.lit(str(x)).cast("date") for x in (start, end)]
    return spark.range(1).select(F.explode(F.sequence(*ends, F.expr(f"interval {step}"))).alias("date"))


def dim_dates(spark: SparkSession, start: str = "2018-01-01", end: str = "2050-12-31") -> DataFrame:
    """A row for each day with its calendar attributes.

    week_of_year counts from the first Sunday and week_of_year_iso, despite its name, from the
    first Monday; days before it are in week 0.
    """
    d = F.col("date")
    text = lambda form: F.date_format(d, form)
    week = lambda offset: F.floor((F.dayofyear(d) + 6 - offset) / 7)
    return date_spine(spark, start, end).select(
        d.cast("string").alias("date_id"), d, F.unix_date(d).cast("bigint").__mul__(86_400).alias("epoch"),
        F.lpad(F.day(d).cast("string"), 2, " ").alias("day_suffix"), text("EEEE").alias("day_name"), text("EEE").alias("day_name_abbr"),
        F.dayofweek(d).alias("day_of_week"), F.day(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
        week(F.dayofweek(d) - 1).cast("int").alias("week_of_year"), F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year"),
        F.lpad(week(F.weekday(d)).cast("string"), 2, "0").alias("week_of_year_iso"), F.month(d).alias("month_"), text("MMMM").alias("month_name"),
        text("MMM").alias("month_name_abbr"), F.quarter(d).alias("quarter_"), F.year(d).alias("year_"), F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def stale(table: DataFrame, as_of: Column, column: str = "created_at", hours: int = 75) -> DataFrame:
    """One row: the last load, and whether it is older than hours."""
    last = table.agg(F.max(column).alias("last_loaded_at"))
    return last.withColumn("is_stale", F.coalesce(F.timestamp_diff("HOUR", F.col("last_loaded_at"), as_of) >= hours, F.lit(True)))
