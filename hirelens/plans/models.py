"""The tables of the product as functions of a context, built once each and in the order of their references."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import experience, listings, opportunity, work_setting
from ..sources import records

Model = Callable[["Context"], DataFrame]
MODELS: dict[str, Model] = {}
#: Models that are kept by day, and the column of the day: an incremental run replaces some days of them.
INCREMENTAL = {"int_api_jobs": "created_date", "int_linkedin_jobs": "created_date", "fact_scraped_jobs": "created_date"}


def model(fn: Model) -> Model:
    MODELS[fn.__name__] = fn
    return fn


@dataclass
class Context:
    """Raw tables by name, the date that counts as today, and the models already built.

    days limits the typed listings to these UTC dates, as an incremental run does.
    """

    spark: SparkSession
    raw: dict[str, DataFrame]
    as_of: date
    days: list[date] | None = None
    built: dict[str, DataFrame] = field(default_factory=dict)

    def ref(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = MODELS[name](self)
        return self.built[name]

    @property
    def today(self) -> Column:
        return F.lit(self.as_of)

    def recent(self, df: DataFrame) -> DataFrame:
        return df if self.days is None else df.where(F.col("created_at_utc").cast("date").isin(self.days))


@model
def query_versions(ctx: Context) -> DataFrame:
    return records.with_plain_text(ctx.raw["query_versions"])


@model
def stg_api_jobs(ctx: Context) -> DataFrame:
    return listings.stage_api(ctx.raw["api_jobs"])


@model
def stg_linkedin_jobs(ctx: Context) -> DataFrame:
    return listings.stage_linkedin(ctx.raw["linkedin_jobs"])


@model
def int_api_jobs(ctx: Context) -> DataFrame:
    return listings.parse_api(ctx.recent(ctx.ref("stg_api_jobs")), ctx.ref("query_versions"))


@model
def int_linkedin_jobs(ctx: Context) -> DataFrame:
    return listings.parse_linkedin(ctx.recent(ctx.ref("stg_linkedin_jobs")))


@model
def dim_dates(ctx: Context) -> DataFrame:
    return records.dim_dates(ctx.spark)


@model
def dim_job_listings(ctx: Context) -> DataFrame:
    return listings.dim_job_listings([ctx.ref("int_api_jobs"), ctx.ref("int_linkedin_jobs")])


@model
def fact_scraped_jobs(ctx: Context) -> DataFrame:
    return listings.fact_scraped_jobs([ctx.ref("int_api_jobs"), ctx.ref("int_linkedin_jobs")])


@model
def dim_job_skills(ctx: Context) -> DataFrame:
    return listings.dim_job_skills(ctx.raw["enriched"])


@model
def format_skills(ctx: Context) -> DataFrame:
    return listings.format_skills(ctx.ref("dim_job_skills"))


@model
def jobs_detail_day(ctx: Context) -> DataFrame:
    return listings.jobs_detail_day(ctx.ref("fact_scraped_jobs"))


@model
def jobs_detail(ctx: Context) -> DataFrame:
    """One row for each job; kept, as four models read it and the parsers are its main cost."""
    lived = listings.lifecycle(ctx.ref("dim_job_listings"), ctx.ref("jobs_detail_day"), ctx.today)
    return work_setting.classify(experience.with_years(lived)).persist()


@model
def opportunity_facts(ctx: Context) -> DataFrame:
    """Sums by month and segment, from which the scores follow."""
    return opportunity.month_facts(ctx.ref("jobs_detail"))


@model
def opportunity_month(ctx: Context) -> DataFrame:
    return opportunity.scores(ctx.ref("opportunity_facts"), ctx.today)


@model
def jobs_detail_report(ctx: Context) -> DataFrame:
    return opportunity.with_score(ctx.ref("jobs_detail"), ctx.ref("opportunity_month"))


@model
def rpt_job_skills(ctx: Context) -> DataFrame:
    return opportunity.job_skills_report(ctx.ref("jobs_detail"), ctx.ref("opportunity_month"), ctx.ref("format_skills"))


@model
def jobs_flow_week(ctx: Context) -> DataFrame:
    return opportunity.jobs_flow_week(ctx.ref("jobs_detail"))


@model
def jobs_flow_week_trends(ctx: Context) -> DataFrame:
    return opportunity.jobs_flow_week_trends(ctx.ref("jobs_flow_week"))
