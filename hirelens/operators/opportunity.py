"""Weekly job flow and the monthly opportunity score of search terms.

The month spine times the segments is the only product of rows, and it is one row
for each reported row. Active jobs come from the sums of starts and ends by
month: a job adds one to the month it was posted in and takes one away after the
month it was removed in, so a running sum over the spine counts it in each month
between without a range join.

The score has two layers. Facts are sums by month and segment: jobs that entered and
left, new jobs, their pay and companies. A changed job touches only the month it was created
in and those it enters and leaves, so facts are kept and updated (`updated_facts`). Scores follow from
the facts alone, which are a row for each month and segment, however many jobs there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import divide, filled, ladder, month_start, week_start, within
from ..functions.shared import written

SEGMENT = ["search_term", "search_location"]
GRAIN = ["month_start_date", *SEGMENT]
# Weights of the components and lower bounds of the tiers.
WEIGHTS = (("demand_score", 0.30), ("growth_score", 0.30), ("salary_score", 0.25), ("long_tail_score", 0.15))
TIERS = ((80, "Strong Opportunity"), (60, "Good Opportunity"), (40, "Moderate Opportunity"))
LARGE_COMPANIES = 10


# -- weekly flow ------------------------------------------------------------------


def jobs_flow_week(jobs: DataFrame) -> DataFrame:
    """New and removed jobs by week, from Sunday, term, platform and location."""
    keys = ["week_beginning", "search_term", "job_platform", "search_location", "type"]

    def flow(df: DataFrame, day: Column, kind: str) -> DataFrame:
        return df.select(week_start(day).alias("week_beginning"), *keys[1:4], F.lit(kind).alias("type"), "job_id").groupBy(*keys).agg(F.countDistinct("job_id").alias("jobs_count"))

    new = flow(jobs, F.coalesce(F.col("posted_date"), F.col("created_at_utc").cast("date")), "New Jobs")
    return new.unionByName(flow(jobs.where("removed_date is not null"), F.col("removed_date"), "Removed Jobs"))


def jobs_flow_week_trends(flow: DataFrame) -> DataFrame:
    """New jobs by week against the previous week that has a row, which need not be the calendar week before."""
    keys = ["week_beginning", *SEGMENT, "type"]
    sums = flow.where("type = 'New Jobs'").groupBy(*keys).agg(F.sum("jobs_count").alias("jobs_count"))
    before = F.lag("jobs_count").over(Window.partitionBy(*SEGMENT).orderBy("week_beginning"))
    return sums.withColumn("previous_week_jobs_count", before).withColumn("wow_percent_change", divide(F.col("jobs_count") - F.col("previous_week_jobs_count"), "previous_week_jobs_count"))


# -- monthly score ------------------------------------------------------------------


def segments(jobs: DataFrame) -> DataFrame:
    return jobs.where("search_term is not null and search_location is not null")


# Facts: each is a sum over the jobs of a month and segment, in two levels. The first has a row for each job, month, company
# and pay, so jobs are read once and no count of distinct jobs needs a level of its own.


def per_job(jobs: DataFrame) -> DataFrame:
    """The first level: how many rows, first posting and last removal; low and high bounds stand in for pay where the jobs have those columns."""
    have = lambda c, kind: F.col(c).cast(kind) if c in jobs.columns else F.lit(None).cast(kind)
    low, high = have("low_annual_pay_range", "double"), have("high_annual_pay_range", "double")
    estimate = F.coalesce(F.col("avg_annual_pay_range").cast("double"), (low + high) / 2, low, high)
    posted = have("posted_date", "date")
    rows = jobs.select(
        month_start(F.col("created_at_mst").cast("date")).alias("month_start_date"), *SEGMENT, "job_id", filled(have("company_name", "string")).alias("company"), estimate.alias("estimate"),
        posted.alias("posted"), F.when(posted.isNotNull(), F.coalesce(have("removed_date", "date"), F.lit("9000-01-01").cast("date"))).alias("removed"),
    )
    return rows.groupBy(*GRAIN, "job_id", "company", "estimate").agg(F.count("*").alias("rows"), F.min("posted").alias("posted"), F.max("removed").alias("removed"))


def steps(each: DataFrame) -> DataFrame:
    """entered: jobs posted in the month; left: those removed in the month before."""
    known = segments(each).where("posted is not null").groupBy("job_id", *SEGMENT).agg(F.min("posted").alias("posted"), F.max("removed").alias("removed"))
    month = lambda at, name: F.struct(at.alias("month_start_date"), *(F.lit(int(name == n)).alias(n) for n in ("entered", "left")))
    both = F.array(month(month_start("posted"), "entered"), month(F.add_months(month_start("removed"), 1), "left"))
    moved = known.where("removed >= trunc(posted, 'month')").select(*SEGMENT, F.explode(both).alias("s"))
    return moved.groupBy(F.col("s.month_start_date").alias("month_start_date"), *SEGMENT).agg(F.sum("s.entered").alias("entered"), F.sum("s.left").alias("left"))


def new_jobs(each: DataFrame) -> DataFrame:
    """new_jobs_count, by whatever month and segment is known: these also say from when on and for which segments there are scores."""
    return each.groupBy(*GRAIN).agg(F.countDistinct("job_id").alias("new_jobs_count"))


def pay(each: DataFrame) -> DataFrame:
    """Distinct jobs with pay, mean and median over rows."""
    rows = each.where("estimate is not null").select(*GRAIN, "job_id", F.explode(F.array_repeat("estimate", F.col("rows").cast("int"))).alias("estimate"))
    return rows.groupBy(*GRAIN).agg(F.countDistinct("job_id").alias("jobs_with_salary_count"), F.avg("estimate").alias("avg_salary"), F.percentile_approx("estimate", 0.5, 10_000).alias("median_salary"))


def companies(each: DataFrame) -> DataFrame:
    """New jobs of the ten companies with most of them, and of all others."""
    sizes = each.where("company is not null").groupBy(*GRAIN, "company").agg(F.countDistinct("job_id").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*GRAIN).orderBy(F.desc("n"), "company"))
    large, n = F.col("rank") <= LARGE_COMPANIES, F.col("n")
    return sizes.withColumn("rank", rank).groupBy(*GRAIN).agg(
        F.sum("n").alias("long_tail_total_jobs_count"), F.count("*").alias("company_count"),
        F.sum(F.when(large, n).otherwise(0)).alias("top_10_company_jobs_count"), F.sum(F.when(large, 0).otherwise(n)).alias("long_tail_jobs_count"),
    )


COUNTED = ("new_jobs_count", "jobs_with_salary_count", "avg_salary", "median_salary", "long_tail_total_jobs_count", "company_count", "top_10_company_jobs_count", "long_tail_jobs_count")

#: What the facts read of a job; the bounds of pay may be missing.
READ = ("job_id", *SEGMENT, "company_name", "created_at_mst", "posted_date", "removed_date", "avg_annual_pay_range", "low_annual_pay_range", "high_annual_pay_range")


def _together(parts: list[DataFrame], *key: Column | str) -> DataFrame:
    """One row of each month and segment, null ones too, from parts that have different columns."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    have = [c for c in COUNTED if c in first.columns]
    return first.groupBy(*(key or GRAIN)).agg(*(F.sum(c).alias(c) for c in ("entered", "left") if c in first.columns), *(F.max(c).alias(c) for c in have))


#: Facts of the jobs that are new in a month.
OF_NEW = (new_jobs, pay, companies)


def month_facts(jobs: DataFrame, parts: Sequence[Callable[[DataFrame], DataFrame]] = (steps, *OF_NEW)) -> DataFrame:
    """All facts, or these parts of them. Jobs are read once: the first level is written, when this is called."""
    each = written(per_job(jobs), "jobs-by-month")
    return _together([part(each) for part in parts])


def updated_facts(facts: DataFrame, before: DataFrame, after: DataFrame, jobs: DataFrame) -> DataFrame:
    """The facts of jobs, from those of an earlier time, and the rows of the changed jobs as they were and as they are.

    What left and entered is taken away and added; months in which a changed job was or is created are counted
    again, from the jobs of these months and segments alone. Equal to month_facts(jobs).
    """
    moved = steps(per_job(after)).unionByName(steps(per_job(before)).select(*GRAIN, (-F.col("entered")).alias("entered"), (-F.col("left")).alias("left")))
    grain = lambda df: df.select(month_start(F.col("created_at_mst").cast("date")).alias("month_start_date"), *SEGMENT)
    touched = grain(before).unionByName(grain(after)).distinct()
    same = lambda df: [df[c].eqNullSafe(touched[c]) for c in SEGMENT]
    again = jobs.join(touched, [month_start(jobs["created_at_mst"].cast("date")).eqNullSafe(touched["month_start_date"]), *same(jobs)], "left_semi")
    kept = facts.join(touched, [facts["month_start_date"].eqNullSafe(touched["month_start_date"]), *same(facts)], "left_anti").select(*GRAIN, *COUNTED)
    made = _together([facts.select(*GRAIN, "entered", "left"), moved, kept, month_facts(again, OF_NEW)])
    gone = " and ".join(["coalesce(entered, 0) = 0", "coalesce(left, 0) = 0", *(f"{c} is null" for c in COUNTED)])
    return made.where(f"not ({gone})")


# Scores.


def month_spine(facts: DataFrame, as_of: Column) -> DataFrame:
    """Every month from the first sighting to as_of, for every segment that has jobs."""
    last = month_start(as_of)
    bounds = facts.where("new_jobs_count > 0").agg(F.coalesce(F.min("month_start_date"), last).alias("low"))
    months = bounds.select(F.explode(F.when(F.col("low") <= last, F.sequence("low", last, F.expr("interval 1 month")))).alias("month_start_date"))
    return segments(facts.where("new_jobs_count > 0")).select(*SEGMENT).distinct().crossJoin(F.broadcast(months))  # a row for each month of the table's time


def _month_segment() -> Window:
    return Window.partitionBy("month_start_date", "search_location")


def _scaled(x: Column, tied: Column | float) -> Column:
    """x on 0..100 between the least and the greatest of its month and location."""
    low, high = F.min(x).over(_month_segment()), F.max(x).over(_month_segment())
    return F.when(high == low, tied).otherwise(divide(x - low, high - low) * 100)


def on_spine(facts: DataFrame, as_of: Column) -> DataFrame:
    """The facts of each month of the spine; jobs that entered before its first month have entered in it."""
    spine = month_spine(facts, as_of)
    first = facts.where("new_jobs_count > 0").agg(F.coalesce(F.min("month_start_date"), month_start(as_of)).alias("first_month"))
    clipped = facts.crossJoin(F.broadcast(first))  # one row
    return spine.join(_together([clipped], F.greatest("month_start_date", "first_month").alias("month_start_date"), *SEGMENT), GRAIN, "left")


def demand(counted: DataFrame) -> DataFrame:
    """Jobs active in each month of the spine: posted by its end and not removed before its start."""
    running = Window.partitionBy(*SEGMENT).orderBy("month_start_date")
    step = F.coalesce("entered", F.lit(0)) - F.coalesce("left", F.lit(0))
    active = counted.withColumn("active_jobs_count", F.sum(step).over(running)).drop("entered", "left")
    none = F.max("active_jobs_count").over(_month_segment()) == 0
    logged = active.withColumn("weight", F.log1p("active_jobs_count"))
    return logged.withColumn("demand_score", _scaled(F.col("weight"), F.when(none, 0.0).otherwise(100.0))).drop("weight")


def growth(counted: DataFrame, as_of: Column) -> DataFrame:
    """New jobs against the month before, smoothed and weighted by the logarithm of their number."""
    new, before = F.col("new_jobs_count"), F.col("prior_month_new_jobs_count")
    counted = counted.withColumn("new_jobs_count", F.coalesce("new_jobs_count", F.lit(0)))
    counted = counted.withColumn("prior_month_new_jobs_count", F.coalesce(F.lag("new_jobs_count").over(Window.partitionBy(*SEGMENT).orderBy("month_start_date")), F.lit(0)))
    rated = counted.withColumn("smoothed_monthly_growth_rate", divide(new - before, before + 1)).withColumn("weighted_growth", F.col("smoothed_monthly_growth_rate") * F.log1p(new))
    idle = (F.max(new).over(_month_segment()) == 0) & (F.max(before).over(_month_segment()) == 0)
    scaled = within(_scaled(F.col("weighted_growth"), F.when(idle, 0.0).otherwise(100.0)), 0.0, 100.0)
    return rated.withColumn("growth_score", F.when((new == 0) & (before == 0), 0.0).otherwise(scaled)).withColumn("is_partial_month", F.col("month_start_date") == month_start(as_of))


def salary(paid: DataFrame) -> DataFrame:
    """Pay with its coverage and score."""
    score = F.when(F.col("avg_salary").isNotNull(), within(_scaled(F.col("avg_salary"), F.lit(100.0)), 0.0, 100.0))
    new = F.col("new_jobs_count") > 0
    paid = paid.withColumns({"salary_total_jobs_count": F.when(new, F.col("new_jobs_count")), "jobs_with_salary_count": F.when(new, F.coalesce("jobs_with_salary_count", F.lit(0)))})
    return paid.withColumn("salary_coverage_pct", divide("jobs_with_salary_count", "salary_total_jobs_count")).withColumn("salary_score", score)


def long_tail(sizes: DataFrame) -> DataFrame:
    """The share of jobs that companies beyond the ten largest offer."""
    share = lambda c: divide(c, "long_tail_total_jobs_count")
    return sizes.withColumns({"top_10_company_share": share("top_10_company_jobs_count"), "long_tail_share": share("long_tail_jobs_count"), "long_tail_score": share("long_tail_jobs_count") * 100})


FINAL = (
    "month_start_date", "month", *SEGMENT, "active_jobs_count", "new_jobs_count", "prior_month_new_jobs_count", "smoothed_monthly_growth_rate", "weighted_growth",
    "salary_total_jobs_count", "jobs_with_salary_count", "salary_coverage_pct", "avg_salary", "median_salary", "long_tail_total_jobs_count", "company_count",
    "top_10_company_jobs_count", "long_tail_jobs_count", "top_10_company_share", "long_tail_share", "demand_score", "growth_score", "salary_score", "long_tail_score",
    "opportunity_score", "opportunity_tier", "is_partial_month",
)


def scores(facts: DataFrame, as_of: Column) -> DataFrame:
    """All components by month and segment, and their weighted mean over those that are known. Reads facts only."""
    parts = long_tail(salary(growth(demand(on_spine(facts, as_of)), as_of)))
    have = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in WEIGHTS), F.lit(0.0))
    weight = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in WEIGHTS), F.lit(0.0))
    raw = divide(have, weight)
    tier = ladder([*((raw >= low, name) for low, name in TIERS), (raw.isNull(), "Insufficient Data")], "Weak Opportunity")
    return parts.withColumns({"month": F.col("month_start_date"), "opportunity_score": within(raw, 0.0, 100.0), "opportunity_tier": tier}).select(*FINAL)


def opportunity_score(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Scores of jobs whose facts are not kept: these are made first and written, a few thousand rows as a rule. Eager."""
    return scores(written(month_facts(jobs), "opportunity-facts"), as_of)


def with_score(jobs: DataFrame, scores: DataFrame) -> DataFrame:
    """jobs with the score and tier of the month they were posted in."""
    few = scores.select(F.col("month_start_date").alias("score_month"), *SEGMENT, "opportunity_score", "opportunity_tier")
    return jobs.withColumn("score_month", month_start("posted_date")).join(few, ["score_month", *SEGMENT], "left").drop("score_month")


def job_skills_report(jobs: DataFrame, scores: DataFrame, skills: DataFrame) -> DataFrame:
    """A row for each job and skill, with the score; jobs without skills are not in it."""
    return with_score(jobs, scores).join(skills.where("skill is not null"), ["job_id", "data_source"])
