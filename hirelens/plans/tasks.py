"""Tasks of the command line. Paths and dates come from the environment."""

from __future__ import annotations

import os
from collections.abc import Iterable
from datetime import UTC, date, datetime

from pyspark.sql import SparkSession

from ..functions.shared import temporary
from ..operators import enrich, listings
from ..sources import records
from ..sources.sinks import DayTable, partitions_to_replace
from .models import INCREMENTAL, MODELS, Context


def session() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def context(spark: SparkSession) -> Context:
    """Raw tables under RAW_DIR: api/ (JSON lines), linkedin/, enriched/ (Parquet) and query_versions.csv."""
    root, as_of = os.environ["RAW_DIR"], os.environ.get("AS_OF")
    raw = {
        "api_jobs": records.envelopes(records.lenient_json_lines(spark, f"{root}/api")),
        "linkedin_jobs": spark.read.schema(records.LINKEDIN).parquet(f"{root}/linkedin"),
        "enriched": spark.read.schema(records.ENRICHED).parquet(f"{root}/enriched"),
        "query_versions": spark.read.schema(records.SEED).csv(f"{root}/query_versions.csv", header=True),
    }
    return Context(spark, raw, date.fromisoformat(as_of) if as_of else datetime.now(UTC).date())


def refresh(ctx: Context, out: str, num_days: object = None, names: Iterable[str] = MODELS) -> None:
    """Writes each table once, in the order of their references; later tables read what was written.

    With num_days the tables kept by day replace that many days, to the day that counts as today, and leave
    all others as they are: raw rows of other days are not parsed, and rows that are gone from raw go. Tables that are
    not there yet, and those not kept by day, are built whole.
    """
    days = None if num_days in (None, "") else partitions_to_replace(ctx.as_of, num_days)
    for name in names:
        path = f"{out}/{name}"
        with temporary():
            made = ctx.ref(name)
            if name in INCREMENTAL:
                table = DayTable(ctx.spark, path, INCREMENTAL[name])
                table.replace(made, days if table.schema is not None else None)
            else:
                made.write.mode("overwrite").parquet(path)
        made.unpersist()
        ctx.built[name] = table.read().select(*made.columns) if name in INCREMENTAL else ctx.spark.read.parquet(path)


def build_models() -> int:
    """All tables to OUT_DIR; NUM_DAYS makes it an incremental run."""
    refresh(context(session()), os.environ["OUT_DIR"], os.environ.get("NUM_DAYS"))
    return 0


def enrich_skills() -> int:
    ctx = context(session())
    limit = int(os.environ.get("DAILY_MAX_JOBS", "300"))
    chosen = listings.enrichment_candidates(ctx.ref("dim_job_listings"), ctx.raw["enriched"], limit)
    enrich.enrich(chosen).write.mode("append").parquet(f"{os.environ['RAW_DIR']}/enriched")
    return 0


