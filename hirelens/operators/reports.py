"""Parameterised reports: options, figures, charts and extracts over the reporting tables.

`jobs` is the jobs report with state columns, `skills` the job-skill report,
`flow` and `trends` the weekly flows. Rankings run on aggregated rows: a row for
each company, skill or title. Every order that decides a limit is total. What a report
reads several times, the few columns of its filtered rows, is written to the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import divide, filled, ladder, month_start, week_start
from ..functions.shared import written
from .filters import CHOICES, FilterSpec, apply_filters

# The degrees in their order, the label for all options, the kinds of flow, the match methods.
DEGREE_ORDER = ("High School", "Associate's", "Bachelor's", "Master's", "Doctorate", "Degree Not Specified")
ALL_LABEL = "𝐀𝐥𝐥 Values"
FLOW_TYPES = (("New Jobs", 1), ("Removed Jobs", 2))
LOCATIONS = (("All", ALL_LABEL, 0), ("United States", "United States", 1))
MATCH_METHODS = (("contains", "Contains", 0), ("is", "Is", 1), ("does_not_contain", "Does Not Contain", 2))
NO_COMPANY = "Company Not Specified (Missing)"

jobs_of = lambda *c: F.countDistinct(F.when(c[0], F.col("job_id")) if c else F.col("job_id"))


def job_counts(rows: DataFrame, keys: list[str], flags: dict[str, Column], means: dict[str, Column]) -> DataFrame:
    """By keys: jobs, the distinct ones; of flags, how many of them have a row where it holds; of means, the mean over rows.

    In two levels, a row for each job of a group first, so rows are not multiplied for each count.
    """
    sums = [x for n, c in means.items() for x in (F.sum(c).alias(f"{n}_sum"), F.count(c).alias(f"{n}_rows"))]
    each = rows.groupBy(*keys, "job_id").agg(F.count("*").alias("rows"), *(F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()), *sums)
    counts = [F.count("job_id").alias("jobs"), *(F.count_if(F.col(n) & F.col("job_id").isNotNull()).alias(n) for n in flags)]
    return each.groupBy(*keys).agg(*counts, *(divide(F.sum(f"{n}_sum"), F.sum(f"{n}_rows")).alias(n) for n in means))


def _rank(*order: Column) -> Column:
    return F.row_number().over(Window.orderBy(*order))


# -- options ------------------------------------------------------------------


def available_dates(jobs: DataFrame) -> DataFrame:
    return jobs.where("posted_date is not null").select("posted_date").distinct()


def options(jobs: DataFrame, column: str) -> DataFrame:
    """'All' and then each value in order."""
    values = jobs.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    ranked = values.select("value", F.col("value").alias("label"), _rank(F.col("value")).alias("ordinal"))
    return _all_row(jobs.sparkSession).unionByName(ranked)


def _all_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit("All").alias("value"), F.lit(ALL_LABEL).alias("label"), F.lit(0).alias("ordinal"))


def platform_options(jobs: DataFrame) -> DataFrame:
    """'All' and then platforms by their number of jobs."""
    counts = jobs.where("job_platform is not null").groupBy(F.col("job_platform").alias("value")).agg(jobs_of().alias("record_count"))
    label = F.concat("value", F.lit(" ("), F.col("record_count").cast("string"), F.lit(")"))
    ranked = counts.select("value", label.alias("label"), "record_count", _rank(F.desc("record_count"), F.col("value")).alias("ordinal"))
    return _all_row(jobs.sparkSession).withColumn("record_count", F.lit(None).cast("bigint")).unionByName(ranked)


def location_options(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOCATIONS, "value string, label string, ordinal int")


def match_method_options(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MATCH_METHODS, "value string, label string, ordinal int")


# -- jobs -----------------------------------------------------------------------

_NO_STATUS = tuple(c for c in CHOICES if c != "listing_status")
_NO_TERM = tuple(c for c in CHOICES if c != "search_term")


def kpis(jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    """One row; the status filter does not count here, active jobs are picked by each measure."""
    active = F.col("listing_status") == "Active"
    recent = F.col("posted_date") >= F.date_sub(F.lit(spec.end), 7)
    chosen = apply_filters(jobs, spec, only=_NO_STATUS).select("job_id", "company_name", "job_platform", active.alias("active"), recent.alias("recent"), *(F.when(active, F.col(c)).alias(c) for c in ("days_listed", "avg_annual_pay_range")))
    chosen = written(chosen, "kpis")
    counts = job_counts(chosen, [], {"active_jobs": F.col("active"), "new_jobs_last_7_days": F.col("recent")}, {"avg_days_listed_active": F.col("days_listed"), "avg_salary_active": F.col("avg_annual_pay_range")})
    of_active = lambda c, name: F.broadcast(chosen.where("active").agg(F.countDistinct(c).alias(name)))  # noqa: E731  one row
    both = counts.crossJoin(of_active("company_name", "companies_hiring")).crossJoin(of_active("job_platform", "job_platforms_active"))
    return both.select("active_jobs", "new_jobs_last_7_days", "companies_hiring", "avg_days_listed_active", "avg_salary_active", "job_platforms_active")


_DETAIL = ("company_name", "search_term", "job_location", "search_location", "job_platform", "schedule_type", "job_level", "degree_requirement", "avg_annual_pay_range", "posted_date", "days_listed", "opportunity_score", "opportunity_tier", "data_source", "job_id")


def apply_link(url: Column | str) -> Column:
    safe = F.replace(F.col(url) if isinstance(url, str) else url, F.lit('"'), F.lit("%22"))
    return F.concat(F.lit('<a class="apply-link-button markdown" href="'), safe, F.lit('" target="_blank" rel="noopener noreferrer">Apply</a>'))


def active_jobs_detail(jobs: DataFrame, spec: FilterSpec, limit: int = 1000) -> DataFrame:
    chosen = apply_filters(jobs.where("listing_status = 'Active'"), spec, only=_NO_STATUS).select("job_title", apply_link("source_link").alias("apply_link"), *_DETAIL)
    return chosen.orderBy(F.desc_nulls_last("posted_date"), F.desc_nulls_last("opportunity_score"), "job_id").limit(limit)


def top_terms(jobs: DataFrame, spec: FilterSpec, limit: int = 10) -> DataFrame:
    scored = apply_filters(jobs.where("opportunity_score is not null"), spec, only=_NO_TERM)
    return scored.groupBy("search_term").agg(F.round(F.avg("opportunity_score"), 1).alias("opportunity_score")).orderBy(F.desc_nulls_last("opportunity_score"), "search_term").limit(limit)


def demand_vs_pay(jobs: DataFrame, spec: FilterSpec, limit: int = 25) -> DataFrame:
    """Terms with active jobs; a term without any score counts as 1."""
    sums = apply_filters(jobs, spec).groupBy("search_term").agg(
        F.sum(F.when(F.col("listing_status") == "Active", 1).otherwise(0)).alias("active_jobs"), F.avg("avg_annual_pay_range").alias("avg_annual_pay_range"),
        F.round(F.coalesce(F.avg("opportunity_score"), F.lit(1.0)), 1).alias("opportunity_score"),
    )
    return sums.where("active_jobs > 0").orderBy(F.desc("opportunity_score"), "search_term").limit(limit)


def days_listed_distribution(jobs: DataFrame, spec: FilterSpec, width: int = 2, bound: int = 32) -> DataFrame:
    """Jobs by bins [a, a + width) of the days they were listed."""
    start = (F.floor(F.col("days_listed") / width) * width).cast("int")
    bins = apply_filters(jobs.where((F.col("days_listed") >= 0) & (F.col("days_listed") < bound)), spec).groupBy(start.alias("bin_start")).agg(jobs_of().alias("record_count"))
    bucket = F.format_string("[%d, %d)", F.col("bin_start"), F.col("bin_start") + width)
    return bins.select(bucket.alias("days_bucket"), "record_count", F.lit("Record Count").alias("record_series"), "bin_start").orderBy("bin_start")


def degree_distribution(jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    name = F.coalesce(F.col("degree_requirement"), F.lit(DEGREE_ORDER[-1]))
    sums = apply_filters(jobs, spec).groupBy(name.alias("name")).agg(jobs_of().alias("value"))
    return sums.withColumn("degree_order", ladder([(F.col("name") == d, k) for k, d in enumerate(DEGREE_ORDER, 1)], len(DEGREE_ORDER) + 1)).orderBy("degree_order", "name")


def jobs_by_location(jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    placed = apply_filters(jobs.where("lat is not null and long is not null"), spec)
    return placed.groupBy(F.col("state_name").alias("point_name"), "lat", "long").agg(jobs_of().alias("jobs_posted")).orderBy(F.desc("jobs_posted"), "point_name")


def company_concentration(jobs: DataFrame, spec: FilterSpec, top: int = 20) -> DataFrame:
    """Active jobs of the largest companies, the rest as Others, with their share; jobs without company have a slice."""
    active = written(apply_filters(jobs.where("listing_status = 'Active'"), spec, only=_NO_STATUS).select("job_id", "company_name"), "companies")
    company = filled("company_name")
    key = F.coalesce(F.concat(F.lit("company:"), company), F.lit("synthetic:missing-company"))
    shown = ladder([(company.isNull(), NO_COMPANY), (company == "Others", "Others (Company)")], company)
    sizes = active.groupBy(key.alias("name"), shown.alias("display_name"), F.coalesce(company, F.lit("")).alias("sort")).agg(jobs_of().alias("value"))
    order = [F.desc("value"), F.col("sort"), F.col("name")]
    first = sizes.orderBy(*order).limit(top)
    slices = first.select("name", "display_name", "value", _rank(*order).alias("display_order"))  # top rows
    rest = sizes.join(F.broadcast(first.select("name")), "name", "left_anti").agg(F.sum("value").alias("value")).where("value is not null")
    slices = slices.unionByName(rest.select(F.lit("synthetic:tail").alias("name"), F.lit("Others").alias("display_name"), "value", F.lit(top + 1).alias("display_order")))
    total = active.agg(jobs_of().alias("total"))  # one row
    share = F.round(100.0 * F.col("value") / F.nullif("total", F.lit(0)), 1)
    return slices.crossJoin(F.broadcast(total)).select("name", "display_name", "value", F.col("value").alias("active_job_count"), share.alias("percentage"), "display_order").orderBy("display_order", "display_name").drop("display_order")


# -- weeks ------------------------------------------------------------------------


def _weeks(spark: SparkSession, spec: FilterSpec, lead: int = 0) -> DataFrame:
    """The Sundays of the window, with some weeks before it."""
    bounds = spark.range(1).select(F.date_sub(week_start(F.lit(spec.start)), 7 * lead).alias("low"), week_start(F.lit(spec.end)).alias("high"))
    return bounds.select(F.explode(F.sequence("low", "high", F.expr("interval 7 days"))).alias("week"))


def _in_weeks(df: DataFrame, spec: FilterSpec, lead: int = 0) -> DataFrame:
    return df.where(F.col("week_beginning").between(F.date_sub(week_start(F.lit(spec.start)), 7 * lead), week_start(F.lit(spec.end))))


_FLOW_CHOICES = ("search_term", "job_platform", "search_location")


def flow_trend(flow: DataFrame, spec: FilterSpec) -> DataFrame:
    """New and removed jobs for every week of the window; empty if there is none at all."""
    chosen = apply_filters(_in_weeks(flow, spec), spec, day=None, only=_FLOW_CHOICES, states=False, tokens=False)
    types = flow.sparkSession.createDataFrame(FLOW_TYPES, "job_flow_type string, series_order int")
    sums = chosen.where(F.col("type").isin(*(t for t, _ in FLOW_TYPES))).groupBy(F.col("week_beginning").alias("week"), F.col("type").alias("job_flow_type")).agg(F.sum("jobs_count").alias("job_count"))
    any_ = sums.limit(1).select(F.lit(True).alias("any"))
    spine = _weeks(flow.sparkSession, spec).crossJoin(F.broadcast(types)).join(F.broadcast(any_), how="left_semi")  # a row for each week and type
    return spine.join(sums, ["week", "job_flow_type"], "left").select("week", "job_flow_type", F.coalesce("job_count", F.lit(0)).alias("job_count"), "series_order").orderBy("week", "series_order")


def _weekly_mean(jobs: DataFrame, day: Column, order: list[Column], measure: str) -> DataFrame:
    """The weekly mean of one row for each job."""
    rank = F.row_number().over(Window.partitionBy("job_id").orderBy(*order))
    one = jobs.withColumn("rank", rank).where("rank = 1")
    return one.groupBy(week_start(day).alias("week")).agg(F.avg(measure).alias(f"avg_{measure}".replace("avg_avg", "avg"))).orderBy("week")


def days_listed_over_time(jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    """The last row of each job, by the week it was last seen."""
    day = F.col("last_seen_at_utc").cast("date")
    known = apply_filters(jobs.where("job_id is not null and last_seen_at_utc is not null and days_listed is not null"), spec, day=day)
    return _weekly_mean(known, day, [F.desc("last_seen_at_utc"), F.desc("days_listed")], "days_listed")


def pay_over_time(jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    """The first row of each job, by the week it was posted."""
    known = apply_filters(jobs.where("job_id is not null and posted_date is not null and avg_annual_pay_range is not null"), spec)
    return _weekly_mean(known, F.col("posted_date"), [F.asc("posted_date"), F.desc("avg_annual_pay_range")], "avg_annual_pay_range")


def posted_trends(trends: DataFrame, spec: FilterSpec) -> DataFrame:
    """Change of new jobs against the calendar week before, by term; weeks without jobs count as 0."""
    chosen = apply_filters(_in_weeks(trends.where("type = 'New Jobs'"), spec, 1), spec, day=None, only=("search_term", "search_location"), states=False, tokens=False)
    sums = chosen.groupBy(F.col("week_beginning").alias("week"), "search_term").agg(F.sum("jobs_count").alias("jobs_count"))
    terms = sums.select("search_term").distinct()
    spine = terms.crossJoin(F.broadcast(_weeks(trends.sparkSession, spec, 1)))  # a row for each week of the window
    dense = spine.alias("s").join(sums.alias("c"), (F.col("s.week") == F.col("c.week")) & F.col("s.search_term").eqNullSafe(F.col("c.search_term")), "left")
    dense = dense.select("s.week", "s.search_term", F.coalesce("c.jobs_count", F.lit(0)).alias("n"))
    before = F.lag("n").over(Window.partitionBy("search_term").orderBy("week"))
    changed = dense.withColumn("before", before).select(F.col("week").alias("week_beginning"), "search_term", divide(F.col("n") - F.col("before"), "before").alias("wow_percent_change"))
    return _in_weeks(changed, spec).where("wow_percent_change is not null").orderBy("week_beginning", "search_term")


# -- skills -----------------------------------------------------------------------


def chosen_skills(skills: DataFrame, jobs: DataFrame, spec: FilterSpec) -> DataFrame:
    """Rows of the job-skill report under the filters; states are looked up by job, each job once."""
    rows = apply_filters(skills.where(filled("skill").isNotNull()), spec.but(location_like=True), states=False)
    if "All" not in spec.states:
        rows = rows.join(jobs.where(F.col("state_name").isin(*spec.states)).select("job_id").distinct(), "job_id", "left_semi")
    return rows


def skill_kpis(skills: DataFrame, jobs: DataFrame, spec: FilterSpec, least: int = 100) -> DataFrame:
    """The most frequent skill, the best paid one with enough jobs, and the number of skills."""
    pay = F.col("avg_annual_pay_range")
    sums = job_counts(chosen_skills(skills, jobs, spec), ["skill"], {"paid": pay.isNotNull()}, {"pay": pay}).withColumnRenamed("jobs", "n")
    paid = F.when((F.col("paid") >= least) & F.col("pay").isNotNull(), F.struct((-F.col("pay")).alias("pay"), F.col("skill").alias("skill")))
    top = F.min(F.struct((-F.col("n")).alias("n"), F.col("skill").alias("skill")))["skill"]
    return sums.agg(F.coalesce(top, F.lit("No skills")).alias("top_skill"), F.coalesce(F.min(paid)["skill"], F.lit("No salary data")).alias("highest_salary_skill"), F.count("*").alias("skills_tracked"))


def top_skills(rows: DataFrame, k: int, name: str = "distinct_job_count") -> DataFrame:
    return rows.groupBy("skill").agg(jobs_of().alias(name)).orderBy(F.desc(name), "skill").limit(k)


def top_requested_skills(skills: DataFrame, jobs: DataFrame, spec: FilterSpec, k: int = 15) -> DataFrame:
    return top_skills(chosen_skills(skills, jobs, spec), k)


def skill_demand_salary(skills: DataFrame, jobs: DataFrame, spec: FilterSpec, rank: int = 40, least: int = 3, limit: int = 25) -> DataFrame:
    """Skills among the first by demand or by pay."""
    pay = F.col("avg_annual_pay_range")
    sums = job_counts(chosen_skills(skills, jobs, spec), ["skill"], {"salary_job_count": pay.isNotNull()}, {"avg_annual_pay_range": pay}).withColumnRenamed("jobs", "distinct_job_count")
    sums = sums.where(f"avg_annual_pay_range is not null and salary_job_count >= {least}")
    order = [F.desc("distinct_job_count"), F.desc_nulls_last("avg_annual_pay_range"), F.col("skill")]
    paid = written(sums.withColumn("salary_coverage_pct", divide("salary_job_count", "distinct_job_count")), "skills")  # a row for each skill
    either = paid.orderBy(order[0], order[2]).limit(rank).union(paid.orderBy(order[1], order[2]).limit(rank)).distinct()  # 2 * rank rows
    return either.orderBy(*order).limit(limit)


def skill_trend(skills: DataFrame, jobs: DataFrame, spec: FilterSpec, k: int = 10) -> DataFrame:
    """Jobs by month for the most frequent skills."""
    rows = written(chosen_skills(skills, jobs, spec).select("job_id", "skill", "posted_date"), "job-skills")
    few = F.broadcast(top_skills(rows, k).select("skill"))  # k rows
    sums = rows.join(few, "skill").groupBy(month_start("posted_date").alias("day"), "skill").agg(jobs_of().alias("distinct_job_count"))
    return sums.orderBy("day", "skill").select(F.date_format("day", "MMM yyyy").alias("month"), "skill", "distinct_job_count")


def skill_penetration(skills: DataFrame, jobs: DataFrame, spec: FilterSpec, titles: int = 20, k: int = 10) -> DataFrame:
    """The share of jobs of each frequent title that ask for each frequent skill; absent pairs are 0."""
    named = written(apply_filters(jobs.where(filled("job_title").isNotNull()), spec.but(location_like=True)).select("job_id", "job_title").distinct(), "titles")
    top = named.groupBy("job_title").agg(jobs_of().alias("title_job_count")).orderBy(F.desc("title_job_count"), "job_title").limit(titles)
    asked = skills.where(filled("skill").isNotNull()).select("job_id", F.trim("skill").alias("skill"))
    cohort = written(named.join(F.broadcast(top.select("job_title")), "job_title").join(asked, "job_id").distinct(), "cohort")  # top: titles rows
    few = top_skills(cohort, k, "skill_job_count")
    pairs = cohort.join(F.broadcast(few.select("skill")), "skill").groupBy("job_title", "skill").agg(jobs_of().alias("pair"))
    count = F.coalesce("pair", F.lit(0))
    grid = top.crossJoin(F.broadcast(few)).join(pairs, ["job_title", "skill"], "left")  # titles * k rows
    return grid.select("job_title", "skill", divide(count, "title_job_count").alias("penetration_pct"), "title_job_count", "skill_job_count", count.alias("skill_title_job_count")).orderBy(F.desc("title_job_count"), "job_title", F.desc("skill_job_count"), "skill")


# -- extracts -----------------------------------------------------------------------

_TEXTS = ("job_title", "company_name", "job_location", "job_platform", "schedule_type", "degree_requirement", "source_link")


def jobs_extract(jobs: DataFrame) -> DataFrame:
    """Typed columns with blank texts as nulls."""
    have = [c for c in _TEXTS if c in jobs.columns]
    numbers = {c: F.col(c).try_cast(t) for c, t in (("avg_annual_pay_range", "double"), ("days_listed", "bigint"), ("opportunity_score", "double"), ("posted_date", "date")) if c in jobs.columns}
    return jobs.withColumns({c: filled(c) for c in have} | numbers)


def flow_extract(flow: DataFrame) -> DataFrame:
    return flow.withColumns({"week_beginning": F.col("week_beginning").cast("date"), "jobs_count": F.col("jobs_count").try_cast("bigint")})


def trends_extract(trends: DataFrame) -> DataFrame:
    return flow_extract(trends).withColumns({"previous_week_jobs_count": F.col("previous_week_jobs_count").try_cast("bigint"), "wow_percent_change": F.col("wow_percent_change").try_cast("double")})


def skills_extract(skills: DataFrame) -> DataFrame:
    return skills.where("skill is not null and skill <> ' '").select("skill", "job_id", "posted_date", "search_term", "job_level", "degree_requirement", "job_title", "company_name", "search_location", "job_platform", "listing_status", "avg_annual_pay_range")
