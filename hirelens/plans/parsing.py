"""The way in: searches, raw records of both sources told from orders, what is parsed from them, and the cases of the text rules."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import experience, work_setting
from ..operators import listings as L
from ..operators import opportunity as O
from ..sources import records
from . import adapter as A
from .registry import query

#: The cases that the text rules are tested with.
CASES = Path(__file__).resolve().parent / "cases"
SEED = ((1, "data+engineer"), (2, "BI+analyst"))


def _text(*parts: object) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def _of(key: Column, *values: str) -> Column:
    return C.ladder([(key % len(values) == k, v) for k, v in enumerate(values)])


def searches(spark: SparkSession) -> DataFrame:
    return records.with_plain_text(spark.createDataFrame(SEED, "query_id int, q string"))


def api_rows(spark: SparkSession, d: str) -> DataFrame:
    """Typed listings of the search API, from payloads that orders are told as.

    An order of a few bytes becomes a payload of a kilobyte, so a file's split holds millions; orders are dealt over all tasks first.
    """
    key = F.col("o_orderkey")
    amount = (key % 50 + 10).cast("string")
    company = F.when(key % 5 != 0, _text('"company_name": "Company ', (key % 100).cast("string"), '", ')).otherwise("")
    home = _of(key, ', "work_from_home": true', ', "work_from_home": false', "")
    value = _text(
        '{"location": "salt LAKE city", "page": "', (key % 3 + 1).cast("string"), '", "q": "x", "query_id": ', (key % 3 + 1).cast("string"), ', "job": {', company, '"title": "', F.col("o_orderpriority"), '", "job_id": "', key.cast("string"),
        '", "description": "Needs: ', _of(key, "high school diploma", "an associate degree", "Bachelor\\'s or Master\\'s", "a master\\'s", "Ph.D.", "nothing"), '.", "location": " Salt\\u00a0Lake \\u2013  CITY", "via": "Board", "apply_options": [{"title": "Board", "link": "u', key.cast("string"),
        '"}], "extensions": ["Full-time", 7, "$', amount, "–$", (key % 50 + 30).cast("string"), _of(key, " an hour", " a month", " a year", "K a year"), '"], "detected_extensions": {"posted_at": "', (key % 9 + 1).cast("string"), _of(key, " hours", " days", " weeks", " months"), ' ago", "schedule_type": "Full-time"', home,
        '}, "job_highlights": [{"title": "Qualifications", "items": ["item ', key.cast("string"), '", 3, null, "B"]}, {"items": ["c"]}]}}',
    )
    value = F.replace(value, F.lit("\\'"), F.lit("'"))
    dealt = A.read(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority").repartition("o_orderkey")
    raw = dealt.select(F.col("o_orderdate").alias("created_at"), F.parse_json(value).alias("job_data"), key.alias("query_version_id"), F.lit("f").alias("gcs_uri"))
    return L.parse_api(L.stage_api(raw), searches(spark))


API = """api as (
  select o_orderkey as k, cast(o_orderkey as varchar) as platform_job_id, o_orderpriority as job_title, case when o_orderkey % 5 <> 0 then 'Company ' || o_orderkey % 100 end as company_name, cast(o_orderkey % 3 + 1 as bigint) as page,
    case o_orderkey % 3 when 0 then 'Data Engineer' when 1 then 'Bi Analyst' end as search_term, cast(o_orderdate as date) as created_date,
    case o_orderkey % 4 when 0 then cast(o_orderdate - to_hours(cast(o_orderkey % 9 + 1 as int)) as date) when 1 then cast(o_orderdate as date) - 1 - cast(o_orderkey % 9 + 1 as int) when 2 then cast(o_orderdate as date) - 1 - 7 * cast(o_orderkey % 9 + 1 as int)
      else cast((cast(o_orderdate as date) - 1) - to_months(cast(o_orderkey % 9 + 1 as int)) as date) end as posted_date_parsed,
    case o_orderkey % 4 when 0 then 1920 when 1 then 12 else 1 end as unit,
    cast(o_orderkey % 50 + 10 as double) * unit as low_annual_pay_range, cast(o_orderkey % 50 + 30 as double) * unit * case when o_orderkey % 4 = 3 then 1000 else 1 end as high_annual_pay_range,
    case o_orderkey % 6 when 0 then 'High School' when 1 then 'Associate''s' when 2 then 'Bachelor''s' when 3 then 'Master''s' when 4 then 'Doctorate' else 'Degree Not Specified' end as degree_requirement,
    case o_orderkey % 3 when 0 then true when 1 then false end as work_from_home
  from orders
)"""


@query(f"""with {API} select platform_job_id, job_title, company_name, page, search_term, 'Full-time' as schedule_type, posted_date_parsed, low_annual_pay_range, high_annual_pay_range, degree_requirement, work_from_home,
'salt lake - city' as job_location_normalized, ['Full-time', '$' || (k % 50 + 10) || chr(8211) || '$' || (k % 50 + 30) || case k % 4 when 0 then ' an hour' when 1 then ' a month' when 2 then ' a year' else 'K a year' end] as extensions,
'Qualifications:item ' || k || ',Qualifications:B,:c' as highlights, '[{{"link":"u' || k || '","title":"Board"}}]' as apply_options from api""")
def api_listing_parse(spark: SparkSession, d: str) -> DataFrame:
    names = ("platform_job_id", "job_title", "company_name", "page", "search_term", "schedule_type", "posted_date_parsed", "low_annual_pay_range", "high_annual_pay_range", "degree_requirement", "work_from_home", "job_location_normalized")
    lines = F.transform("work_setting_highlights", lambda h: F.concat(F.coalesce(h["title"], F.lit("")), F.lit(":"), h["item"]))
    return api_rows(spark, d).select(*names, F.col("work_setting_extensions").alias("extensions"), F.array_join(lines, ",").alias("highlights"), F.to_json("apply_options_json").alias("apply_options"))


def linkedin_rows(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    low, high, n = (key % 50 + 50).cast("string"), (key % 50 + 70).cast("string"), (key % 9 + 1).cast("string")
    since = F.concat(F.when(key % 2 == 0, "Reposted ").otherwise(""), n, _of(key, " hours", " days", " weeks", " months", " weeks"), F.lit(" ago"))
    pay = C.ladder([(key % 4 == 0, _text("$", low, "K - $", high, "K · Remote · Full-time")), (key % 4 == 1, _text("$", low, "/hr - $", high, "/hr · Hybrid · Part-time")), (key % 4 == 2, _text("$", low, ",000 - $", high, ",000 · On-site · Contract"))])
    raw = A.read(spark, d, "orders").select(
        key.cast("string").alias("job_id"), F.lit("text").alias("job_description"), F.col("o_orderdate").alias("created_at"), F.lit("term").alias("search_term"), F.lit("new YORK").alias("job_location"),
        F.col("o_orderpriority").alias("job_title"), _text("Denver, CO · ", since, " · 50 applicants").alias("listing_details"), pay.alias("fit_level_preferences"),
    )
    return L.parse_linkedin(L.stage_linkedin(raw))


LINKEDIN = """linkedin as (
  select cast(o_orderkey as varchar) as platform_job_id, cast(o_orderdate as date) as created_date, ' ' || case when o_orderkey % 2 = 0 then 'Reposted ' else '' end || (o_orderkey % 9 + 1) || case o_orderkey % 5 when 0 then ' hours' when 1 then ' days' when 3 then ' months' else ' weeks' end || ' ago ' as posted_since,
    case o_orderkey % 5 when 0 then cast(o_orderdate - to_hours(cast(o_orderkey % 9 + 1 as int)) as date) when 1 then cast(o_orderdate as date) - cast(o_orderkey % 9 + 1 as int) when 3 then cast(cast(o_orderdate as date) - to_months(cast(o_orderkey % 9 + 1 as int)) as date)
      else cast(o_orderdate as date) - 7 * cast(o_orderkey % 9 + 1 as int) end as posted_date_parsed,
    case o_orderkey % 4 when 0 then 'Full-time' when 1 then 'Part-time' when 2 then 'Contract' end as schedule_type, case o_orderkey % 4 when 0 then 'Remote' when 1 then 'Hybrid' when 2 then 'On-site' end as work_location,
    case when o_orderkey % 4 < 3 then (o_orderkey % 50 + 50) * case o_orderkey % 4 when 1 then 1920.0 else 1000.0 end end::double as low_annual_pay_range,
    case when o_orderkey % 4 < 3 then (o_orderkey % 50 + 70) * case o_orderkey % 4 when 1 then 1920.0 else 1000.0 end end::double as high_annual_pay_range
  from orders
)"""


@query(f"with {LINKEDIN} select platform_job_id, 'Denver, CO ' as job_location, posted_since, posted_date_parsed, schedule_type, work_location, low_annual_pay_range, high_annual_pay_range from linkedin")
def linkedin_listing_parse(spark: SparkSession, d: str) -> DataFrame:
    return linkedin_rows(spark, d).select("platform_job_id", "job_location", "posted_since", "posted_date_parsed", "schedule_type", "work_location", "low_annual_pay_range", "high_annual_pay_range")


NULL_KEY = f"'{C.KEY_NULL}'"


@query(f"""with {API}, {LINKEDIN}, facts as (
  select platform_job_id, company_name, 'Serpapi' as data_source, search_term, 'salt LAKE city' as place, created_date, low_annual_pay_range as low, high_annual_pay_range as high from api
  union all select platform_job_id, null, 'LinkedIn', 'term', 'new YORK', created_date, low_annual_pay_range, high_annual_pay_range from linkedin
) select md5(platform_job_id || '-' || coalesce(company_name, {NULL_KEY}) || '-' || data_source || '-' || coalesce(search_term, {NULL_KEY}) || '-' || place) as job_id, data_source,
  case data_source when 'Serpapi' then 'Salt Lake City' else 'New York' end as search_location, created_date, (low + high) / 2 as avg_annual_pay_range from facts""")
def facts_of_both_sources(spark: SparkSession, d: str) -> DataFrame:
    return L.jobs_detail_day(L.fact_scraped_jobs([api_rows(spark, d), linkedin_rows(spark, d)])).select("job_id", "data_source", "search_location", "created_date", "avg_annual_pay_range")


@query("""select cast(n_nationkey as int) as query_id, replace(n_name, ' ', '_') || ' & co' as q, case when n_nationkey % 4 > 0 then 'a,b' end as location, case when n_nationkey % 3 = 2 then cast(n_nationkey as int) else 250 end as max_jobs, n_name || ' Data Ai' as plain
from (select * replace (initcap_name as n_name) from (select *, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') as initcap_name from nation)) where n_nationkey % 2 = 1""".replace("replace(n_name, ' ', '_')", "lower(replace(n_name, ' ', '_'))"))
def search_seed(spark: SparkSession, d: str) -> DataFrame:
    """Active searches with their texts decoded, and the plain text of a search."""
    key, name = F.col("n_nationkey"), F.lower("n_name")
    seed = A.read(spark, d, "nation").select(
        key.cast("int").alias("query_id"), _text(" ", F.replace(name, F.lit(" "), F.lit("_")), "+%26%20co ").alias("q"), F.when(key % 4 == 0, " ").otherwise("a%2Cb").alias("location"), F.lit("en").alias("hl"), F.lit(" ").alias("gl"),
        C.ladder([(key % 3 == 0, F.lit(None).cast("int")), (key % 3 == 1, 0)], key.cast("int")).cast("int").alias("max_jobs"), F.lit(None).cast("string").alias("google_domain"), (key % 2).cast("int").alias("active"), _text(F.upper("n_name"), "+DATA+ai").alias("plain"),
    )
    plain = records.with_plain_text(seed.select("query_id", F.col("plain").alias("q"))).select("query_id", F.col("q_plain_text").alias("plain"))
    return records.active_searches(seed.drop("plain")).select("query_id", "q", "location", "max_jobs").join(plain, "query_id")


@query("select p_partkey as part, p_name || '.jsonl' as object_name from part where p_partkey % 3 <> 0 and p_partkey % 5 <> 0")
def unseen_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of the right kind that the ledger does not have."""
    parts, key = A.read(spark, d, "part"), F.col("p_partkey")
    objects = parts.select(key.cast("string").alias("bucket"), F.concat("p_name", F.when(key % 3 == 0, ".txt").otherwise(".jsonl")).alias("object_name"))
    ledger = parts.where(key % 5 == 0).select(key.cast("string").alias("bucket"), F.concat("p_name", F.lit(".jsonl")).alias("object_name"))
    return records.unseen(objects, ledger).select(F.col("bucket").cast("bigint").alias("part"), "object_name")


@query("select event_id, case when event_id % 3 <> 0 then ts end as created_at, case when event_id % 2 = 0 then event_id end as query_version_id from events")
def record_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the landing table from lines; a missing time, and an id that is no number, are null."""
    key = F.col("event_id")
    time = F.when(key % 3 == 0, "null").otherwise(F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"')))
    value = _text('{"n": ', key.cast("string"), ', "fetched_at": ', time, ', "query_id": "', F.when(key % 2 == 0, key.cast("string")).otherwise("x"), '"}')
    good = records.judged(A.read(spark, d, "events").select(key, "ts", value.alias("value"), F.lit("f").alias("file"))).where("fault is null")
    found = records.envelopes(good)
    return found.select(F.try_variant_get("job_data", "$.n", "bigint").alias("event_id"), F.to_timestamp_ntz(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("created_at"), "query_version_id")


@query("""with pay as (select cast(date_trunc('month', o_orderdate) as date) as month_start_date, o_orderpriority as search_term, 'x' as search_location, case when o_orderkey % 3 = 0 then o_totalprice end as mean, case when o_orderkey % 5 <> 0 then o_totalprice / 2 end as low, case when o_orderkey % 7 <> 0 then o_totalprice * 2 end as high from orders)
select month_start_date, search_term, count(*) as salary_total_jobs_count, count(coalesce(mean, (low + high) / 2, low, high)) as jobs_with_salary_count, round(avg(coalesce(mean, (low + high) / 2, low, high)), 4) as avg_salary from pay group by all""")
def salary_from_bounds(spark: SparkSession, d: str) -> DataFrame:
    """The columns of the bounds are read where jobs have them."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    jobs = A.read(spark, d, "orders").select(
        key.cast("string").alias("job_id"), F.col("o_orderpriority").alias("search_term"), F.lit("x").alias("search_location"), F.col("o_orderdate").alias("created_at_mst"),
        F.when(key % 3 == 0, price).alias("avg_annual_pay_range"), F.when(key % 5 != 0, price / 2).alias("low_annual_pay_range"), F.when(key % 7 != 0, price * 2).alias("high_annual_pay_range"),
    )
    return O.salary(O.month_facts(jobs, (O.new_jobs, O.pay))).select("month_start_date", "search_term", "salary_total_jobs_count", "jobs_with_salary_count", F.round("avg_salary", 4).alias("avg_salary"))


TITLES = ("Principal X", "Distinguished X", "Lead X", "Sr. X", "Senior X", "Mid X", "Staff X", "X III", "X II", "X 3", "Entry X", "Junior X", "X")
RUNGS = ("Principal", "Principal", "Lead", "Senior", "Senior", "Mid Level", "Staff", "Mid Level", "Mid Level", "Mid Level", "Entry", "Entry", "Mid Level")


@query("select o_orderkey, case o_orderkey % 13 " + " ".join(f"when {k} then '{level}'" for k, level in enumerate(RUNGS)) + " end as job_level from orders")
def job_levels(spark: SparkSession, d: str) -> DataFrame:
    """Every rung of the ladder of titles."""
    return A.read(spark, d, "orders").select("o_orderkey", L.job_level(_of(F.col("o_orderkey"), *TITLES)).alias("job_level"))


@query("select o_orderkey, 'a' || " + "case o_orderkey % 16 " + " ".join(f"when {k} then {mark}" for k, mark in enumerate(["chr(39)"] * 4 + ["chr(34)"] * 4 + ["'-'"] * 7 + ["' '"])) + " end || 'b ' || lower(o_orderpriority) as normalized from orders")
def folded_marks(spark: SparkSession, d: str) -> DataFrame:
    """Each quote, dash and blank beyond ASCII in its plain form."""
    marks = ("\u2018", "\u2019", "\u201a", "\u201b", "\u201c", "\u201d", "\u201e", "\u201f", "\u2010", "\u2011", "\u2012", "\u2013", "\u2014", "\u2015", "\u2212", "\xa0")
    text = _text(" \tA", _of(F.col("o_orderkey"), *marks), "B\n ", F.upper("o_orderpriority"), "\u3000")
    return A.read(spark, d, "orders").select("o_orderkey", C.normalized(text).alias("normalized"))


# -- the cases of the text rules -----------------------------------------------------


def _cases(name: str) -> list[dict]:
    return json.loads((CASES / f"{name}.json").read_text())


def _dealt(name: str, column: str, kind: str) -> str:
    told = lambda v: "null" if v is None else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    cases = _cases(name)
    each = " ".join(f"when {k} then {told(c['expected'])}" for k, c in enumerate(cases))
    return f"select o_orderkey, cast(case o_orderkey % {len(cases)} {each} end as {kind}) as {column} from orders"


def _listings(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Every order as one of the cases, by its number."""
    cases = _cases(name)
    rows = [
        (k, c.get("title", "Data Engineer"), c.get("description"), c.get("extensions", []), [(h.get("title"), h.get("item")) for h in c.get("highlights", [])], c.get("wfh"), c.get("metadata"))
        for k, c in enumerate(cases)
    ]
    few = spark.createDataFrame(rows, f"k bigint, job_title string, job_description string, work_setting_extensions array<string>, work_setting_highlights {L.HIGHLIGHTS}, work_from_home boolean, work_setting_source_metadata string")
    orders = A.read(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % len(cases)).alias("k")).repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return orders.join(F.broadcast(few), "k")  # a row for each case


@query(_dealt("work_setting", "work_setting", "varchar"))
def work_setting_rules(spark: SparkSession, d: str) -> DataFrame:
    return work_setting.classify(_listings(spark, d, "work_setting")).select("o_orderkey", "work_setting")


@query(_dealt("required_experience", "required_years_experience", "bigint"))
def experience_rules(spark: SparkSession, d: str) -> DataFrame:
    return experience.with_years(_listings(spark, d, "required_experience")).select("o_orderkey", "required_years_experience")
