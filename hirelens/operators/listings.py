"""From raw records to typed listings of both sources, and on to the mart tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import captured, json_strings, json_text, json_tree, ladder, local_time, matches, normalized, surrogate_key

HIGHLIGHTS = "array<struct<title:string,item:string>>"

# Hours, months and weeks that make a year of pay.
PAY_UNITS = (("hour", 1920), ("month", 12), ("week", 52))
# Degrees, lowest first, as they appear in a posting's lower-cased JSON.
DEGREES = (
    ("High School", r"\b(high school diploma|high school degree|ged)\b"),
    ("Associate's", r"\b(associate'?s?|associates?|associate degree|associate's degree|a\.s\.|a\.a\.|2[- ]year degree)\b"),
    ("Bachelor's", r"\b(bachelor'?s?|bachelors?|bachelor degree|bachelor'?s degree|b\.s\.|b\.a\.|b\.sc\.?|undergraduate degree|4[- ]year degree)\b"),
    ("Master's", r"\b(master'?s?|masters?|master degree|master'?s degree|mba|m\.s\.|m\.a\.|m\.sc\.?)\b"),
    ("Doctorate", r"\b(ph\.?d\.?|p\.?h\.?d\.?|doctorate|doctoral)\b"),
)
# Parts of which each match of a degree's pattern has one.
DEGREE_CUES = {
    "High School": ("high school d", "ged"), "Associate's": ("associate", "a.s.", "a.a.", "year degree"),
    "Bachelor's": ("bachelor", "b.s.", "b.a.", "b.sc", "undergraduate degree", "year degree"), "Master's": ("master", "mba", "m.s.", "m.a.", "m.sc"),
    "Doctorate": ("ph", "p.h", "doctora"),
}
NO_DEGREE = "Degree Not Specified"
# Parts of lower-cased titles and the level they stand for; the first that fits counts.
LEVELS = (
    ("%principal%", "Principal"), ("%distinguished%", "Principal"), ("%lead%", "Lead"), ("%sr%", "Senior"), ("%senior%", "Senior"), ("%mid%", "Mid Level"),
    ("%staff%", "Staff"), ("% iii", "Mid Level"), ("% ii", "Mid Level"), ("% 3", "Mid Level"), ("%entry%", "Entry"), ("%junior%", "Entry"),
)
# LinkedIn preferences and what they mean.
SCHEDULES = (("%full%", "Full-time"), ("%part%", "Part-time"), ("%contract%", "Contract"), ("%intern%", "Internship"))
PLACES = (("%remote%", "Remote"), ("%hybrid%", "Hybrid"), ("%on-site%", "On-site"))


def like_ladder(text: Column, cases: tuple[tuple[str, str], ...], otherwise: str | None = None) -> Column:
    return ladder([(text.like(pattern), value) for pattern, value in cases], otherwise)


def job_level(title: Column | str) -> Column:
    return like_ladder(F.lower(title), LEVELS, "Mid Level")


def degree(text: Column) -> Column:
    """The lowest degree that lower-cased text names. A pattern runs only where one of its cues is."""
    cue = lambda name: reduce(or_, (text.contains(c) for c in DEGREE_CUES[name]))
    return ladder([(cue(name) & matches(text, pattern), name) for name, pattern in DEGREES], NO_DEGREE)


# -- pay ----------------------------------------------------------------------


def pay_phrase(extensions: Column | str) -> Column:
    """The first extension that names a unit of time; an age such as "20 hours ago" counts too."""
    return F.get(F.filter(extensions, lambda x: matches(F.lower(x), "(?:year|hour|week|month)")), F.lit(0))


def annual_pay(extensions: Column | str) -> Column:
    """(low, high) a year: the first two numbers, thousands for a k, times the unit. One number serves as both.

    A comma ends a number, so "$120,000" reads as 120 and 000.
    """
    phrase = F.lower(pay_phrase(extensions))
    numbers = F.transform(
        F.regexp_extract_all(phrase, F.lit(r"\d+(?:\.\d+)?\s*k?"), F.lit(0)),
        lambda t: F.regexp_extract(t, r"\d+(?:\.\d+)?", 0).try_cast("double") * F.when(t.contains("k"), 1000).otherwise(1),
    )
    unit = ladder([(phrase.contains(name), times) for name, times in PAY_UNITS], 1)
    low = F.get(numbers, F.lit(0))
    return F.struct((low * unit).alias("low"), (F.coalesce(F.get(numbers, F.lit(1)), low) * unit).alias("high"))


def preference_pay(text: Column | str) -> Column:
    """(low, high) a year of texts like "$120K - $150K" or "$50/hr - $60/hr"; commas are taken out of numbers."""
    text = F.col(text) if isinstance(text, str) else text

    def amount(mark: str, scope: str) -> Column:
        number = F.regexp_replace(captured(text, mark + r"\$(\d+(?:,\d{3})?)"), ",", "").try_cast("bigint")
        return number * ladder([(matches(text, scope + "K"), 1000), (matches(text, scope + "/hr"), 1920)], 1)

    return F.struct(amount("", "").cast("double").alias("low"), amount(r"-\s*", "-.*").cast("double").alias("high"))


def average_pay(low: Column | str, high: Column | str) -> Column:
    """Mean of the bounds that are known."""
    low, high = (F.col(x) if isinstance(x, str) else x for x in (low, high))
    known = low.isNotNull().cast("int") + high.isNotNull().cast("int")
    zero = F.lit(0.0)
    return F.when(known > 0, (F.coalesce(low, zero) + F.coalesce(high, zero)) / known)


# -- relative dates -------------------------------------------------------------


def posted_date(phrase: Column, utc: Column, local_day: Column, n: Column) -> Column:
    """The date n hours, days, weeks or months before; hours count from the instant, the rest from a day."""
    n = n.cast("int")
    return ladder([
        (phrase.contains("hour"), F.timestamp_add("HOUR", -n, utc).cast("date")),
        (phrase.contains("day"), F.date_sub(local_day, n)),
        (phrase.contains("week"), F.date_sub(local_day, 7 * n)),
        (phrase.contains("month"), F.add_months(local_day, -n)),
    ])


# -- the two sources --------------------------------------------------------------

_API_FIELDS = {
    "gl": "$.gl", "google_domain": "$.google_domain", "hl": "$.hl", "search_location": "$.location", "page": "$.page", "query_text": "$.q", "query_id": "$.query_id",
    "serpapi_json_endpoint": "$.serpapi_json_endpoint", "serpapi_search_id": "$.serpapi_search_id", "source_name": "$.source_name", "job_title": "$.job.title",
    "company_name": "$.job.company_name", "job_description": "$.job.description", "platform_job_id": "$.job.job_id", "job_location": "$.job.location", "job_platform": "$.job.via",
    "job_share_link": "$.job.share_link", "source_link": "$.job.source_link", "job_thumbnail": "$.job.thumbnail", "posted_since": "$.job.detected_extensions.posted_at",
    "schedule_type": "$.job.detected_extensions.schedule_type",
}


def highlights(data: Column | str) -> Column:
    """(section title, item) of every string item, in order."""
    sections = F.coalesce(json_tree(data, "$.job.job_highlights").try_cast("array<variant>"), F.array().cast("array<variant>"))
    each = lambda s: F.transform(json_strings(s, "$.items"), lambda x: F.struct(json_text(s, "$.title").alias("title"), x.alias("item")))
    return F.flatten(F.transform(sections, each)).cast(HIGHLIGHTS)


def stage_api(raw: DataFrame) -> DataFrame:
    """created_at as UTC and Denver time beside the payload."""
    return raw.select(F.col("created_at").alias("created_at_utc"), local_time("created_at").alias("created_at_mst"), "job_data", "query_version_id", "gcs_uri")


def parse_api(staged: DataFrame, searches: DataFrame) -> DataFrame:
    """Typed listings of the search API. searches (query_id, q_plain_text) is a seed of a few rows."""
    data = F.col("job_data")
    parsed = staged.select(
        "*", *(json_text(data, path).alias(name) for name, path in _API_FIELDS.items()),
        json_tree(data, "$.job.apply_options").alias("apply_options_json"), json_tree(data, "$.job.extensions").alias("extensions_json"),
        json_tree(data, "$.job.job_highlights").alias("job_highlights_json"), json_strings(data, "$.job.extensions").alias("work_setting_extensions"),
        highlights(data).alias("work_setting_highlights"), F.try_variant_get(data, "$.job.detected_extensions.work_from_home", "boolean").alias("work_from_home"),
        F.lit(None).cast("string").alias("work_setting_source_metadata"), F.lower(F.to_json("job_data")).alias("payload_text"),
    )
    since = F.lower("posted_since")
    pay = annual_pay("work_setting_extensions")
    typed = parsed.withColumns({
        "page": F.col("page").try_cast("bigint"), "query_id": F.col("query_id").try_cast("bigint"), "created_date": F.col("created_at_utc").cast("date"),
        "posted_date_parsed": posted_date(since, F.col("created_at_utc"), F.col("created_at_mst").cast("date"), captured(since, r"(\d+)").try_cast("bigint")),
        "low_annual_pay_range": pay["low"], "high_annual_pay_range": pay["high"],
        "degree_requirement": degree(F.col("payload_text")),
        "job_title_normalized": normalized("job_title"), "job_description_normalized": normalized("job_description"), "job_location_normalized": normalized("job_location"),
        "data_source": F.lit("Serpapi"),
    }).drop("payload_text")
    return typed.join(F.broadcast(searches.select("query_id", F.col("q_plain_text").alias("search_term"))), "query_id", "left")


def stage_linkedin(raw: DataFrame) -> DataFrame:
    return raw.select(
        "job_id", "job_description", F.col("created_at").alias("created_at_utc"), local_time("created_at").alias("created_at_mst"), "search_term",
        F.col("job_location").alias("search_job_location"), "job_title", "listing_details", "fit_level_preferences",
    )


def linkedin_posted_date(details: Column | str, utc: Column | str) -> Column:
    """"3 hours ago" counts from the front; "Reposted 2 weeks ago" has its number as the third blank-separated token."""
    utc = F.col(utc) if isinstance(utc, str) else utc
    since = F.get(F.split(details, "·"), F.lit(1))
    front = F.coalesce(*(F.when(since.contains(u), F.btrim(F.get(F.split(since, u), F.lit(0)))) for u in ("hour", "day", "week", "month")))
    token = F.when(since.contains("Reposted"), F.get(F.split(since, " "), F.lit(2))).otherwise(front)
    return posted_date(since, utc, utc.cast("date"), token.try_cast("bigint"))


def parse_linkedin(staged: DataFrame) -> DataFrame:
    liked = F.lower("fit_level_preferences")
    pay = preference_pay("fit_level_preferences")
    null = F.lit(None)
    return staged.select(
        F.col("job_id").alias("platform_job_id"), "job_title", "created_at_utc", "created_at_mst", F.col("created_at_utc").cast("date").alias("created_date"),
        null.cast("string").alias("company_name"), "search_term", F.col("search_job_location").alias("search_location"), F.lit("LinkedIn").alias("job_platform"),
        F.get(F.split("listing_details", "·"), F.lit(0)).alias("job_location"), F.get(F.split("listing_details", "·"), F.lit(1)).alias("posted_since"),
        linkedin_posted_date("listing_details", "created_at_utc").alias("posted_date_parsed"),
        like_ladder(liked, SCHEDULES).alias("schedule_type"), like_ladder(liked, PLACES).alias("work_location"),
        pay["low"].alias("low_annual_pay_range"), pay["high"].alias("high_annual_pay_range"), "job_description", F.lit("LinkedIn").alias("data_source"),
        F.array().cast("array<string>").alias("work_setting_extensions"), F.array().cast(HIGHLIGHTS).alias("work_setting_highlights"), null.cast("boolean").alias("work_from_home"),
        F.col("fit_level_preferences").alias("work_setting_source_metadata"), null.cast("string").alias("degree_requirement"), null.cast("string").alias("source_link"),
    )


# -- marts ------------------------------------------------------------------------

FACT = (
    "created_at_utc", "created_at_mst", "created_date", "platform_job_id", "job_title", "company_name", "search_location", "search_term", "job_location", "job_platform",
    "posted_date_parsed", "schedule_type", "low_annual_pay_range", "high_annual_pay_range", "job_description", "data_source",
)
DIM = (*(c for c in FACT if c != "created_date"), "degree_requirement", "source_link", "work_setting_extensions", "work_setting_highlights", "work_from_home", "work_setting_source_metadata")
KEY = ("platform_job_id", "company_name", "data_source", "search_term", "search_location")


def keyed(sources: list[DataFrame], columns: tuple[str, ...]) -> DataFrame:
    """Union of the sources with job_id; one posting found by two searches has two ids."""
    first, *rest = (s.select(*columns) for s in sources)
    for other in rest:
        first = first.unionByName(other)
    return first.withColumn("job_id", surrogate_key(*KEY))


def fact_scraped_jobs(sources: list[DataFrame]) -> DataFrame:
    return keyed(sources, FACT)


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in this order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("first_rank", rank).where("first_rank = 1").drop("first_rank")


def dim_job_listings(sources: list[DataFrame]) -> DataFrame:
    """The first appearance of each job_id; scrapes of one instant are ordered by what differs."""
    ties = [F.col("created_at_utc").asc(), F.col("job_title").asc_nulls_last(), F.col("job_description").asc_nulls_last(), F.xxhash64("job_location", "source_link", "posted_date_parsed", "low_annual_pay_range")]
    return first_of(keyed(sources, DIM), ["job_id"], ties)


def jobs_detail_day(facts: DataFrame) -> DataFrame:
    return facts.drop("job_description").withColumns({"search_location": F.initcap("search_location"), "avg_annual_pay_range": average_pay("low_annual_pay_range", "high_annual_pay_range")})


def lifecycle(listings: DataFrame, days: DataFrame, as_of: Column, unseen_days: int = 21) -> DataFrame:
    """First and last sighting, pay over scrapes, posted and removed date, status, days listed and level.

    A listing unseen for unseen_days before as_of counts as removed the day after it was last seen.
    """
    seen = days.groupBy("job_id").agg(F.avg("avg_annual_pay_range").alias("avg_annual_pay_range"), F.min("created_at_utc").alias("first_seen_at_utc"), F.max("created_at_utc").alias("last_seen_at_utc"))
    joined = listings.drop("low_annual_pay_range", "high_annual_pay_range").withColumn("search_location", F.initcap("search_location")).join(seen, "job_id", "left")
    last = F.col("last_seen_at_utc").cast("date")
    dated = joined.withColumns({
        "removed_date": F.when(F.datediff(as_of, last) >= unseen_days, F.date_add(last, 1)),
        "posted_date": F.coalesce(F.col("posted_date_parsed"), F.col("first_seen_at_utc").cast("date")),
    })
    return dated.withColumns({
        "listing_status": F.when(F.col("removed_date").isNotNull(), "Removed").otherwise("Active"),
        "days_listed": F.datediff(last, F.coalesce(F.col("posted_date"), F.col("created_at_utc").cast("date"))).cast("bigint"),
        "job_level": job_level("job_title"),
    })


# -- skills -------------------------------------------------------------------------


def dim_job_skills(enriched: DataFrame) -> DataFrame:
    """Distinct upper-cased skills of the latest enrichment of each job and source.

    That is one row, so its skills are told apart inside it: no table of all of them is kept by a task.
    """
    latest = first_of(enriched, ["job_id", "data_source"], [F.col("created_at").desc(), F.col("skills")])
    each = F.array_distinct(F.transform(F.split("skills", ","), lambda x: F.upper(F.btrim(x))))
    return latest.select("job_id", "data_source", F.explode(each).alias("skill")).where("skill <> ''")


def format_skills(skills: DataFrame) -> DataFrame:
    return skills.where("skill not like '%YEARS%' and skill not like '%DEGREE%' and skill <> ' '")


def enrichment_candidates(listings: DataFrame, enriched: DataFrame, limit: int = 300) -> DataFrame:
    """Listings with text that are not enriched yet, oldest first."""
    known = enriched.select("job_id", "data_source").distinct()
    open_ = listings.where("nullif(trim(job_description), '') is not null and nullif(trim(data_source), '') is not null").join(known, ["job_id", "data_source"], "left_anti")
    return open_.orderBy("created_at_utc", "job_id").limit(limit).select("job_id", "data_source", "job_description")

