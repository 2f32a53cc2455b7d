"""Every operator on the driver's tables, each beside SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.shared import new_folder, written
from ..operators import experience, work_setting
from ..operators import listings as L
from ..operators import opportunity as O
from ..operators import reports as R
from ..operators.filters import FilterSpec, Tokens, apply_filters
from ..operators.states import STATES, with_state
from ..sources import records, sinks
from ..streaming import ingest
from . import adapter as A
from . import parsing, tasks  # noqa: F401  the queries of parsing are registered too
from .models import INCREMENTAL, Context
from .registry import BEYOND_SQL, ORACLES, QUERIES, beyond_sql, query  # noqa: F401

# -- shared SQL ------------------------------------------------------------------

JOBS = """jobs as (
  select cast(o_orderkey as varchar) as job_id, title as job_title, c_name as company_name, c_mktsegment as search_term, r_name as search_location,
    o_orderpriority as job_platform, o_orderdate as created_at_utc, o_orderdate as created_at_mst, cast(o_orderdate as date) as posted_date,
    case when o_orderstatus <> 'O' then last_ship end as removed_date, coalesce(last_ship, cast(o_orderdate as date)) as last_seen,
    case when o_orderstatus <> 'O' and last_ship is not null then 'Removed' else 'Active' end as listing_status,
    cast(date_diff('day', cast(o_orderdate as date), coalesce(last_ship, cast(o_orderdate as date))) as bigint) as days_listed,
    case when o_orderkey % 3 <> 0 then o_totalprice end as avg_annual_pay_range,
    case when lower(title) like '%senior%' then 'Senior' when lower(title) like '% iii' then 'Mid Level' when lower(title) like '%junior%' then 'Entry' else 'Mid Level' end as job_level,
    case o_orderkey % 4 when 0 then 'High School' when 1 then 'Bachelor''s' when 2 then 'Master''s' else 'Degree Not Specified' end as degree_requirement,
    'https://jobs.example.com/' || o_orderkey || '"x' as source_link,
    case r_name when 'AFRICA' then 'Utah' when 'AMERICA' then 'Colorado' when 'ASIA' then 'Texas' when 'EUROPE' then 'New York' end as state_name
  from (select *, concat_ws(' ', case when o_orderkey % 7 = 0 then 'Senior' when o_orderkey % 11 = 0 then 'Junior' end, c_mktsegment, case when o_orderkey % 5 = 0 then 'III' end) as title
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
  left join (select l_orderkey, cast(max(l_shipdate) as date) as last_ship from lineitem group by l_orderkey) on o_orderkey = l_orderkey
)"""
WINDOW = "posted_date between date '1998-01-01' and date '1999-06-30'"
SOME = WINDOW + " and search_location = 'ASIA' and (lower(job_title) like '%building%' or lower(job_title) like '%machinery%') and not lower(company_name) like '%9%'"
SKILLS = """skills as (
  select distinct cast(l_orderkey as varchar) as job_id, upper(trim(skill)) as skill
  from lineitem join part on l_partkey = p_partkey, unnest(string_split(p_name, ' ')) as t(skill) where trim(skill) <> ''
), job_skills as (select jobs.*, skill from jobs join skills using (job_id))"""
SCORES = """segments as (select distinct search_term, search_location from jobs),
months as (select cast(unnest(generate_series(date_trunc('month', (select min(created_at_mst) from jobs)), timestamp '2001-08-01', interval 1 month)) as date) as m),
spine as (select m, search_term, search_location from months cross join segments),
active as (
  select s.m, s.search_term, s.search_location, count(distinct job_id) as active_jobs_count
  from spine s left join jobs j on s.search_term = j.search_term and s.search_location = j.search_location and j.posted_date <= last_day(s.m) and (j.removed_date is null or j.removed_date >= s.m)
  group by all
), demand as (
  select *, case when max(ln(1 + active_jobs_count)) over w = min(ln(1 + active_jobs_count)) over w then case when max(active_jobs_count) over w = 0 then 0 else 100 end
      else (ln(1 + active_jobs_count) - min(ln(1 + active_jobs_count)) over w) / (max(ln(1 + active_jobs_count)) over w - min(ln(1 + active_jobs_count)) over w) * 100 end as demand_score
  from active window w as (partition by m, search_location)
), fresh as (
  select cast(date_trunc('month', created_at_mst) as date) as m, search_term, search_location, count(distinct job_id) as n from jobs group by all
), counted as (
  select m, search_term, search_location, coalesce(n, 0) as new_jobs_count, coalesce(lag(coalesce(n, 0)) over (partition by search_term, search_location order by m), 0) as prior_month_new_jobs_count
  from spine left join fresh using (m, search_term, search_location)
), rated as (
  select *, (new_jobs_count - prior_month_new_jobs_count) / (prior_month_new_jobs_count + 1) as smoothed_monthly_growth_rate,
    (new_jobs_count - prior_month_new_jobs_count) / (prior_month_new_jobs_count + 1) * ln(1 + new_jobs_count) as weighted_growth from counted
), growth as (
  select *, case when new_jobs_count = 0 and prior_month_new_jobs_count = 0 then 0
      when max(weighted_growth) over w = min(weighted_growth) over w then 100
      else least(100, greatest(0, (weighted_growth - min(weighted_growth) over w) / (max(weighted_growth) over w - min(weighted_growth) over w) * 100)) end as growth_score
  from rated window w as (partition by m, search_location)
), pay as (
  select cast(date_trunc('month', created_at_mst) as date) as m, search_term, search_location, count(distinct job_id) as salary_total_jobs_count, count(distinct case when avg_annual_pay_range is not null then job_id end) as jobs_with_salary_count,
    avg(avg_annual_pay_range) as avg_salary, quantile_disc(avg_annual_pay_range, 0.5) as median_salary from jobs group by all
), salary as (
  select *, jobs_with_salary_count / salary_total_jobs_count as salary_coverage_pct,
    case when avg_salary is null then null when max(avg_salary) over w = min(avg_salary) over w then 100 else (avg_salary - min(avg_salary) over w) / (max(avg_salary) over w - min(avg_salary) over w) * 100 end as salary_score
  from pay window w as (partition by m, search_location)
), firms as (
  select cast(date_trunc('month', created_at_mst) as date) as m, search_term, search_location, trim(company_name) as company, count(distinct job_id) as n from jobs where trim(company_name) <> '' group by all
), ranked as (select *, row_number() over (partition by m, search_term, search_location order by n desc, company) as r from firms),
tail as (
  select m, search_term, search_location, cast(sum(n) as bigint) as long_tail_total_jobs_count, count(*) as company_count, cast(sum(case when r <= 10 then n else 0 end) as bigint) as top_10_company_jobs_count,
    cast(sum(case when r > 10 then n else 0 end) as bigint) as long_tail_jobs_count from ranked group by all
), joined as (
  select *, long_tail_jobs_count / long_tail_total_jobs_count * 100 as long_tail_score from demand left join growth using (m, search_term, search_location) left join salary using (m, search_term, search_location) left join tail using (m, search_term, search_location)
), weighed as (
  select *, (coalesce(demand_score * 0.30, 0) + coalesce(growth_score * 0.30, 0) + coalesce(salary_score * 0.25, 0) + coalesce(long_tail_score * 0.15, 0))
      / nullif(case when demand_score is null then 0 else 0.30 end + case when growth_score is null then 0 else 0.30 end + case when salary_score is null then 0 else 0.25 end + case when long_tail_score is null then 0 else 0.15 end, 0) as raw from joined
), scores as (
  select *, m as month_start_date, least(100, greatest(0, raw)) as opportunity_score,
    case when raw >= 80 then 'Strong Opportunity' when raw >= 60 then 'Good Opportunity' when raw >= 40 then 'Moderate Opportunity' when raw is null then 'Insufficient Data' else 'Weak Opportunity' end as opportunity_tier from weighed
)"""
SCORED = "scored as (select jobs.*, opportunity_score, opportunity_tier from jobs left join scores s on cast(date_trunc('month', posted_date) as date) = s.m and jobs.search_term = s.search_term and jobs.search_location = s.search_location)"


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


def _facts(spark: SparkSession, d: str, *parts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return written(O.month_facts(A.jobs(spark, d), parts or (O.steps, *O.OF_NEW)), "facts")


# -- projection, predicates, joins --------------------------------------------------


@query("select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 2) as revenue, cast(l_shipdate as date) as ship_day from lineitem where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1998-02-01' and l_returnflag in ('A', 'R')")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    rows = A.read(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz '1998-01-01' and l_shipdate < timestamp_ntz '1998-02-01' and l_returnflag in ('A', 'R')")
    return rows.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("revenue"), F.col("l_shipdate").cast("date").alias("ship_day"))


@query(f"with {JOBS} select job_level, count(*) as n from jobs group by job_level")
def when_ladder(spark: SparkSession, d: str) -> DataFrame:
    return A.jobs(spark, d).groupBy(L.job_level("job_title").alias("job_level")).agg(F.count("*").alias("n"))


def _token_query(method: str, text: str, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        spec = FilterSpec(job_title=Tokens(text, method))
        return apply_filters(A.jobs(spark, d), spec).groupBy("search_term").agg(F.countDistinct("job_id").alias("n"))

    run.__name__ = f"token_filter_{method}"
    query(f"with {JOBS} select search_term, count(distinct job_id) as n from jobs where {sql} group by search_term")(run)


_token_query("is", " senior building |||MACHINERY||| ", "lower(job_title) in ('senior building', 'machinery')")
_token_query("contains", "senior|||build%iii", "(lower(job_title) like '%senior%' or lower(job_title) like '%build%iii%')")
_token_query("does_not_contain", "Senior|||furni_ure", "not (lower(job_title) like '%senior%' or lower(job_title) like '%furni_ure%')")


@query("""with a as (select nullif(event_type, 'error') as kind, count(*) as n from events group by 1), b as (select nullif(event_type, 'error') as kind, max(value) as top from events group by 1)
select a.kind, n, top from a left join b on a.kind is not distinct from b.kind""")
def null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    events = A.read(spark, d, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    a, b = events.groupBy("kind").agg(F.count("*").alias("n")), events.groupBy(F.col("kind").alias("k")).agg(F.max("value").alias("top"))
    return a.join(b, F.col("kind").eqNullSafe(F.col("k")), "left").select("kind", "n", "top")


@query("select c_custkey, count(o_orderkey) as n, round(sum(o_totalprice), 2) as spent from customer left join orders on c_custkey = o_custkey group by c_custkey")
def left_join_using(spark: SparkSession, d: str) -> DataFrame:
    sums = A.read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("spent"))
    joined = A.read(spark, d, "customer").select("c_custkey").join(sums, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.round("spent", 2).alias("spent"))


@query(f"with {JOBS}, {SCORES} select m as month_start_date, search_term, search_location, active_jobs_count from active")
def interval_overlap_active(spark: SparkSession, d: str) -> DataFrame:
    return O.demand(O.on_spine(_facts(spark, d, O.steps, O.new_jobs), F.lit(A.AS_OF))).select(*O.GRAIN, "active_jobs_count")


@query("""with days as (select cast(unnest(generate_series(timestamp '2024-01-01', timestamp '2024-02-04', interval 1 day)) as date) as day), kinds as (select distinct event_type from events),
sums as (select cast(ts as date) as day, event_type, count(*) as n from events group by all) select day, event_type, coalesce(n, 0) as n from days cross join kinds left join sums using (day, event_type)""")
def cross_spine_fill(spark: SparkSession, d: str) -> DataFrame:
    events = A.read(spark, d, "events").select(F.col("ts").cast("date").alias("day"), "event_type")
    days = records.date_spine(spark, "2024-01-01", "2024-02-04").withColumnRenamed("date", "day")
    spine = days.crossJoin(F.broadcast(events.select("event_type").distinct()))  # 35 days by 5 kinds
    return spine.join(events.groupBy("day", "event_type").agg(F.count("*").alias("n")), ["day", "event_type"], "left").select("day", "event_type", F.coalesce("n", F.lit(0)).alias("n"))


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    large = A.read(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return A.read(spark, d, "customer").select("c_custkey").join(large, "c_custkey", "left_semi")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    done = A.read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return A.read(spark, d, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("select p_partkey, cast(pos - 1 as int) as pos, word from (select p_partkey, unnest(string_split(p_name, ' ')) as word, generate_subscripts(string_split(p_name, ' '), 1) as pos from part)")
def unnest_lateral(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))


@query("select n_name, n_regionkey, lag_name from (select n_name, n_regionkey, lag(n_name) over (partition by n_regionkey order by n_nationkey) as lag_name from nation) where n_regionkey between 1 and 3")
def drop_columns_between(spark: SparkSession, d: str) -> DataFrame:
    before = F.lag("n_name").over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    return A.read(spark, d, "nation").withColumn("lag_name", before).where(F.col("n_regionkey").between(1, 3)).drop("n_nationkey")


# -- aggregates, windows, sets --------------------------------------------------------


@query(f"with {JOBS} select search_term, count(distinct job_id) as jobs, count(distinct case when listing_status = 'Active' then job_id end) as active, count(distinct case when avg_annual_pay_range > 300000 then company_name end) as payers from jobs group by search_term")
def count_distinct_case(spark: SparkSession, d: str) -> DataFrame:
    payer = F.when(F.col("avg_annual_pay_range") > 300000, F.col("company_name"))
    return A.jobs(spark, d).groupBy("search_term").agg(R.jobs_of().alias("jobs"), R.jobs_of(F.col("listing_status") == "Active").alias("active"), F.countDistinct(payer).alias("payers"))


@query("select count(*) as n, count(*) filter (where value > 50) as high, count(*) filter (where event_type = 'click') as clicks, bool_or(value > 400) as any_large, avg(case when event_type = 'view' then 1.0 else 0.0 end) as views, min(ts) as first, max(ts) as last from events")
def filtered_counts(spark: SparkSession, d: str) -> DataFrame:
    view = F.when(F.col("event_type") == "view", 1.0).otherwise(0.0)
    return A.read(spark, d, "events").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.count_if(F.col("event_type") == "click").alias("clicks"), F.bool_or(F.col("value") > 400).alias("any_large"), F.avg(view).alias("views"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("select event_type, quantile_disc(value, 0.5) as median from events group by event_type")
def median_disc(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "events").groupBy("event_type").agg(F.percentile_approx("value", 0.5, 1_000_000).alias("median"))


@query("select o_custkey, count(*) as n_orders from orders group by o_custkey having n_orders > 15")
def having_alias(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders")).where("n_orders > 15")


@query(f"with {JOBS} select '[' || bin_start || ', ' || (bin_start + 2) || ')' as days_bucket, count(distinct job_id) as record_count, 'Record Count' as record_series, bin_start from (select job_id, cast(floor(days_listed / 2) * 2 as int) as bin_start from jobs where days_listed >= 0 and days_listed < 32 and {WINDOW}) group by all")
def histogram_bins(spark: SparkSession, d: str) -> DataFrame:
    return R.days_listed_distribution(A.jobs(spark, d), A.WINDOW)


@query(f"""with {JOBS}, active as (select * from jobs where listing_status = 'Active' and {WINDOW}), sizes as (select company_name, count(distinct job_id) as n from active group by 1),
ranked as (select *, row_number() over (order by n desc, company_name) as r from sizes),
slices as (select 'company:' || company_name as name, company_name as display_name, n as value from ranked where r <= 20 union all select 'synthetic:tail', 'Others', cast(sum(n) as bigint) from ranked where r > 20 having count(*) > 0)
select name, display_name, value, value as active_job_count, round(100.0 * value / (select count(distinct job_id) from active), 1) as percentage from slices""")
def top_n_others(spark: SparkSession, d: str) -> DataFrame:
    return R.company_concentration(A.placed(A.jobs(spark, d)), A.WINDOW)


@query("select user_id, event_type, event_id, ts from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events) where r = 1")
def first_seen_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = A.read(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return L.first_of(rows, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@query(f"with {JOBS}, {SCORES} select m as month_start_date, search_term, search_location, new_jobs_count, prior_month_new_jobs_count, round(smoothed_monthly_growth_rate, 6) as smoothed_monthly_growth_rate from growth")
def lag_growth(spark: SparkSession, d: str) -> DataFrame:
    grown = O.growth(O.on_spine(_facts(spark, d, O.new_jobs), F.lit(A.AS_OF)), F.lit(A.AS_OF))
    return rounded(grown.select(*O.GRAIN, "new_jobs_count", "prior_month_new_jobs_count", "smoothed_monthly_growth_rate"), "smoothed_monthly_growth_rate", places=6)


@query("select s_suppkey, s_nationkey, case when hi = lo then null else round((s_acctbal - lo) / (hi - lo), 6) end as share from (select *, max(s_acctbal) over (partition by s_nationkey) as hi, min(s_acctbal) over (partition by s_nationkey) as lo from supplier)")
def minmax_over(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("s_nationkey")
    low, high = F.min("s_acctbal").over(w), F.max("s_acctbal").over(w)
    return A.read(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.round(C.divide(F.col("s_acctbal") - low, high - low), 6).alias("share"))


@query("select p_partkey, p_brand, cast(p_retailprice as double) as price, p_size from part order by p_size desc nulls last, price desc, p_partkey limit 25")
def topk_nulls_last(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "part").select("p_partkey", "p_brand", F.col("p_retailprice").alias("price"), "p_size").orderBy(F.desc_nulls_last("p_size"), F.desc("price"), "p_partkey").limit(25)


# -- scalar functions ---------------------------------------------------------------


@query("select doc_id, lower(lang) || '/' || upper(source) as tag, length(text) as n, starts_with(text, 'The') as the, nullif(replace(source, 'src', ''), '0') as num, repeat(chr(42), 3) || lang as stars from documents")
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return A.read(spark, d, "documents").select("doc_id", F.concat(F.lower("lang"), F.lit("/"), F.upper("source")).alias("tag"), F.length(text).cast("bigint").alias("n"), text.startswith("The").alias("the"), F.nullif(F.replace("source", F.lit("src"), F.lit("")), F.lit("0")).alias("num"), F.concat(F.repeat(F.char(F.lit(42)), F.lit(3)), F.col("lang")).alias("stars"))


@query(r"select doc_id, nullif(regexp_extract(text, '(\d{1,3})\.(\d{1,3})\.', 2), '') as second, coalesce(len(regexp_extract_all(text, '[0-9]+')), 0) as numbers, regexp_matches(text, '\b(the|and)\b') as english, regexp_replace(text, '(\w+) (\w+)', '\2 \1') as swapped from documents")
def regex_functions(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    swapped = F.regexp_replace(text, r"(?s)^(.*?)(?<![0-9A-Za-z_])([0-9A-Za-z_]++) ([0-9A-Za-z_]++)", "$1$3 $2")
    return A.read(spark, d, "documents").select("doc_id", F.nullif(C.captured(text, r"(\d{1,3})\.(\d{1,3})\.", 2), F.lit("")).alias("second"), F.regexp_count(text, F.lit("[0-9]+")).cast("bigint").alias("numbers"), C.matches(text, r"\b(the|and)\b").alias("english"), swapped.alias("swapped"))


@query("select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as int) as level, try_cast(o_orderpriority as int) as none, round(o_totalprice / nullif(o_orderkey % 3, 0), 4) as share, least(100.0, greatest(0.0, o_totalprice / 1000)) as held from orders")
def casts_and_guards(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice")
    return A.read(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"), F.col("o_orderpriority").try_cast("int").alias("none"), F.round(C.divide(price, F.col("o_orderkey") % 3), 4).alias("share"), C.within(price / 1000, 0.0, 100.0).alias("held"))


@query("select o_orderkey, cast(o_orderdate as date) - cast(dayofweek(o_orderdate) as int) as week, cast(date_trunc('month', o_orderdate) as date) as month, last_day(o_orderdate) as month_end, cast(o_orderdate - interval 1 month as date) as month_before, cast(o_orderdate - interval 14 day as date) as weeks_before, strftime(o_orderdate, '%b %Y') as label from orders")
def sunday_week(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return A.read(spark, d, "orders").select("o_orderkey", C.week_start(day).alias("week"), C.month_start(day).alias("month"), F.last_day(day).alias("month_end"), F.add_months(day, -1).alias("month_before"), F.date_sub(day, 14).alias("weeks_before"), F.date_format(day, "MMM yyyy").alias("label"))


@query("""select strftime(d, '%Y-%m-%d') as date_id, d as date, cast(epoch(d) as bigint) as epoch, lpad(cast(day(d) as varchar), 2, ' ') as day_suffix, strftime(d, '%A') as day_name, strftime(d, '%a') as day_name_abbr, cast(dayofweek(d) + 1 as int) as day_of_week,
cast(day(d) as int) as day_of_month, cast(dayofyear(d) as int) as day_of_year, cast(strftime(d, '%U') as int) as week_of_year, cast(isoyear(d) as int) as iso_year, strftime(d, '%W') as week_of_year_iso, cast(month(d) as int) as month_, strftime(d, '%B') as month_name, strftime(d, '%b') as month_name_abbr,
cast(quarter(d) as int) as quarter_, cast(year(d) as int) as year_, dayofweek(d) in (0, 6) as is_weekend, coalesce(n, 0) as n_orders
from (select cast(unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders), interval 1 day)) as date) as d) left join (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1) using (d)""")
def date_dim(spark: SparkSession, d: str) -> DataFrame:
    """Every day between the first and the last order, with how many there were."""
    counts = A.read(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n_orders"))
    first, last = counts.agg(F.min("date"), F.max("date")).first()
    days = records.dim_dates(spark, str(first), str(last)).join(counts, "date", "left")
    return days.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query("select event_id, cast(props ->> '$.k' as bigint) as k, props ->> '$.missing' as missing, cast(props ->> '$.k' as bigint) > 50 as high from events")
def json_scalars(spark: SparkSession, d: str) -> DataFrame:
    rows = A.read(spark, d, "events").withColumn("v", F.try_parse_json("props"))
    k = C.json_text("v", "$.k").try_cast("bigint")
    return rows.select("event_id", k.alias("k"), C.json_text("v", "$.missing").alias("missing"), (k > 50).alias("high"))


@query("""select event_id, ['type:' || event_type, 'k' || (props ->> '$.k'), event_type] as strings, 3 as n from events""")
def json_array_strings(spark: SparkSession, d: str) -> DataFrame:
    parts = F.concat(F.lit('{"a": ["type:'), "event_type", F.lit('", 7, null, "k'), F.get_json_object("props", "$.k"), F.lit('", {"b": 1}, "'), "event_type", F.lit('"]}'))
    strings = C.json_strings(F.parse_json(parts), "$.a")
    return A.read(spark, d, "events").select("event_id", strings.alias("strings"), F.size(strings).alias("n"))


@query("""select o_orderkey, k * thousand * unit as low, (k + 20) * thousand * unit as high
from (select o_orderkey, o_orderkey % 90 + 1 as k, case when o_orderkey % 4 = 0 then 1000 else 1 end::double as thousand, case o_orderkey % 3 when 0 then 1920 when 1 then 12 else 1 end as unit from orders)""")
def regex_extract_all_pay(spark: SparkSession, d: str) -> DataFrame:
    k, thousand = F.col("o_orderkey") % 90 + 1, F.when(F.col("o_orderkey") % 4 == 0, "K").otherwise("")
    unit = C.ladder([(F.col("o_orderkey") % 3 == 0, " an hour"), (F.col("o_orderkey") % 3 == 1, " a month")], " a year")
    pay = L.annual_pay(F.array(F.lit("Full-time"), F.concat(F.lit("$"), k.cast("string"), thousand, F.lit("–$"), (k + 20).cast("string"), thousand, unit)))
    return A.read(spark, d, "orders").select("o_orderkey", pay["low"].alias("low"), pay["high"].alias("high"))


@beyond_sql
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    """The whole text of every document, normalized."""
    return A.read(spark, d, "documents").select("doc_id", C.normalized("text").alias("normalized"))


@query("select o_orderkey, md5(concat_ws('-', coalesce(cast(o_custkey as varchar), '_dbt_utils_surrogate_key_null_'), o_orderstatus, coalesce(nullif(o_orderstatus, 'F'), '_dbt_utils_surrogate_key_null_'))) as id from orders")
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "orders").select("o_orderkey", C.surrogate_key("o_custkey", "o_orderstatus", F.nullif("o_orderstatus", F.lit("F"))).alias("id"))


# -- domain ---------------------------------------------------------------------------

LIFE = """seen as (select cast(user_id as varchar) as job_id, avg(value) as pay, min(ts) as first_seen, max(ts) as last_seen from events group by 1)"""


@query(f"""with {LIFE} select job_id, round(pay, 4) as avg_annual_pay_range, first_seen as first_seen_at_utc, last_seen as last_seen_at_utc,
case when date_diff('day', cast(last_seen as date), date '2024-02-18') >= 21 then cast(last_seen as date) + 1 end as removed_date, cast(first_seen as date) as posted_date,
case when date_diff('day', cast(last_seen as date), date '2024-02-18') >= 21 then 'Removed' else 'Active' end as listing_status, cast(date_diff('day', cast(first_seen as date), cast(last_seen as date)) as bigint) as days_listed from seen""")
def lifecycle(spark: SparkSession, d: str) -> DataFrame:
    days = A.read(spark, d, "events").select(F.col("user_id").cast("string").alias("job_id"), F.col("ts").alias("created_at_utc"), F.col("value").alias("avg_annual_pay_range"))
    nothing = {c: F.lit(None).cast(t) for c, t in (("posted_date_parsed", "date"), ("low_annual_pay_range", "double"), ("high_annual_pay_range", "double"), ("search_location", "string"), ("job_title", "string"))}
    lived = L.lifecycle(L.first_of(days, ["job_id"], [F.col("created_at_utc")]).drop("avg_annual_pay_range").withColumns(nothing), days, F.lit(date(2024, 2, 18)))
    return rounded(lived.select("job_id", "avg_annual_pay_range", "first_seen_at_utc", "last_seen_at_utc", "removed_date", "posted_date", "listing_status", "days_listed"), "avg_annual_pay_range")


@query(f"""with {JOBS}, new as (select posted_date - cast(dayofweek(posted_date) as int) as week_beginning, search_term, job_platform, search_location, 'New Jobs' as type, count(distinct job_id) as jobs_count from jobs group by all),
gone as (select removed_date - cast(dayofweek(removed_date) as int) as week_beginning, search_term, job_platform, search_location, 'Removed Jobs' as type, count(distinct job_id) as jobs_count from jobs where removed_date is not null group by all) select * from new union all select * from gone""")
def union_flow_week(spark: SparkSession, d: str) -> DataFrame:
    return O.jobs_flow_week(A.jobs(spark, d))


TRENDS = """weekly as (select posted_date - cast(dayofweek(posted_date) as int) as week_beginning, search_term, search_location, 'New Jobs' as type, count(distinct job_id) as jobs_count from jobs group by all),
trends as (select *, lag(jobs_count) over (partition by search_term, search_location order by week_beginning) as previous_week_jobs_count from weekly)"""


@query(f"with {JOBS}, {TRENDS} select *, round((jobs_count - previous_week_jobs_count) / nullif(previous_week_jobs_count, 0), 6) as wow_percent_change from trends")
def wow_trend(spark: SparkSession, d: str) -> DataFrame:
    return rounded(O.jobs_flow_week_trends(O.jobs_flow_week(A.jobs(spark, d))), "wow_percent_change", places=6)


@query(f"""with {JOBS}, new as (select posted_date - cast(dayofweek(posted_date) as int) as week_beginning, search_term, search_location, count(distinct job_id) as jobs_count from jobs group by all) select * from new""")
def flow_extract(spark: SparkSession, d: str) -> DataFrame:
    """Typed again from the texts of an exported table."""
    flow = O.jobs_flow_week(A.jobs(spark, d)).where("type = 'New Jobs'").groupBy("week_beginning", "search_term", "search_location").agg(F.sum("jobs_count").alias("jobs_count"))
    return R.flow_extract(flow.select(F.col("week_beginning").cast("string").alias("week_beginning"), "search_term", "search_location", F.col("jobs_count").cast("string").alias("jobs_count")))


@query(f"with {JOBS}, {TRENDS} select week_beginning, search_term, search_location, jobs_count, previous_week_jobs_count, round((jobs_count - previous_week_jobs_count) / nullif(previous_week_jobs_count, 0), 6) as wow_percent_change from trends")
def trends_extract(spark: SparkSession, d: str) -> DataFrame:
    trends = O.jobs_flow_week_trends(O.jobs_flow_week(A.jobs(spark, d)))
    texts = trends.select(*(F.col(c).cast("string").alias(c) for c in ("week_beginning", "search_term", "search_location", "jobs_count", "previous_week_jobs_count", "wow_percent_change")))
    return rounded(R.trends_extract(texts), "wow_percent_change", places=6)


_SCORE = ("smoothed_monthly_growth_rate", "weighted_growth", "salary_coverage_pct", "avg_salary", "demand_score", "growth_score", "salary_score", "long_tail_score", "opportunity_score")


@query(f"""with {JOBS}, {SCORES} select month_start_date, search_term, search_location, active_jobs_count, new_jobs_count, prior_month_new_jobs_count, salary_total_jobs_count, jobs_with_salary_count, median_salary,
long_tail_total_jobs_count, company_count, top_10_company_jobs_count, long_tail_jobs_count, {', '.join(f'round({c}, 4) + 0.0 as {c}' for c in _SCORE)}, opportunity_tier, month_start_date = date '2001-08-01' as is_partial_month from scores""")
def opportunity_final(spark: SparkSession, d: str) -> DataFrame:
    return rounded(O.scores(_facts(spark, d), F.lit(A.AS_OF)).drop("month", "top_10_company_share", "long_tail_share"), *_SCORE)


CHANGED = JOBS.replace("case when o_orderstatus <> 'O' then last_ship end as removed_date", "case when o_orderdate >= timestamp '1998-01-01' then date '2000-01-01' when o_orderstatus <> 'O' then last_ship end as removed_date").replace(
    "then o_totalprice end as avg_annual_pay_range", "then o_totalprice * case when o_orderdate >= timestamp '1998-01-01' then 2 else 1 end end as avg_annual_pay_range"
)


@query(f"with {CHANGED}, {SCORES} select month_start_date, search_term, search_location, active_jobs_count, new_jobs_count, jobs_with_salary_count, long_tail_jobs_count, round(opportunity_score, 4) as opportunity_score from scores")
def opportunity_updated(spark: SparkSession, d: str) -> DataFrame:
    """Scores after the jobs posted from 1998 on have changed, from the facts of before and the rows of these jobs."""
    jobs = A.jobs(spark, d)
    jobs = written(jobs.select(*(c for c in O.READ if c in jobs.columns)), "jobs")
    recent = F.col("posted_date") >= F.lit(date(1998, 1, 1))
    before = jobs.where(recent)
    after = before.withColumns({"removed_date": F.lit(date(2000, 1, 1)), "avg_annual_pay_range": 2 * F.col("avg_annual_pay_range")})
    now = written(jobs.where(~recent).unionByName(after), "jobs-now")
    facts = written(O.updated_facts(written(O.month_facts(jobs), "facts"), before, after, now), "facts-now")
    return rounded(O.scores(facts, F.lit(A.AS_OF)).select(*O.GRAIN, "active_jobs_count", "new_jobs_count", "jobs_with_salary_count", "long_tail_jobs_count", "opportunity_score"), "opportunity_score")


@query(f"with {JOBS}, {SCORES}, {SCORED} select job_id, round(opportunity_score, 4) as opportunity_score, opportunity_tier from scored")
def score_attach(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.scored(spark, d).select("job_id", "opportunity_score", "opportunity_tier"), "opportunity_score")


@query(f"with {JOBS}, {SKILLS} select job_id, skill from skills where skill not like '%YEARS%' and skill not like '%DEGREE%'")
def skills_explode(spark: SparkSession, d: str) -> DataFrame:
    rows = A.skills(spark, d).withColumn("created_at", F.lit(date(2024, 1, 1)).cast("timestamp_ntz")).withColumnRenamed("skill", "skills")
    joined = rows.groupBy("job_id", "data_source", "created_at").agg(F.array_join(F.sort_array(F.collect_set(F.concat(F.lit(" "), F.lower("skills")))), ",").alias("skills"))
    return L.format_skills(L.dim_job_skills(joined)).select("job_id", "skill")


@query(f"with {JOBS} select job_id, title_state as state_abbr, name as state_name from (select job_id, case r_state when 'XX' then null else r_state end as title_state, state_name as name from (select *, case search_location when 'AFRICA' then 'UT' when 'AMERICA' then 'CO' when 'ASIA' then 'TX' when 'EUROPE' then 'NY' else 'XX' end as r_state from jobs))")
def state_infer(spark: SparkSession, d: str) -> DataFrame:
    return with_state(A.jobs(spark, d)).select("job_id", "state_abbr", "state_name")


@query("""with v as (select case when event_id % 5 <> 0 then 1 end as q, case when event_id % 7 <> 0 then 1 end as k from events)
select count(*) as row_count, count(*) filter (where q is null) as failed_q, count(*) filter (where k is null) as failed_k from v""")
def not_null_checks(spark: SparkSession, d: str) -> DataFrame:
    q = C.ladder([(F.col("event_id") % 10 == 0, '"q": null, '), (F.col("event_id") % 5 == 0, "")], '"q": "", ')
    k = C.ladder([(F.col("event_id") % 7 == 0, '{"z": 1}')], '{"k": [1]}')
    rows = A.read(spark, d, "events").select(F.parse_json(F.concat(F.lit("{"), q, F.lit('"n": '), k, F.lit("}"))).alias("job_data"))
    return records.not_null_counts(rows, paths={"q": "$.q", "k": "$.n.k"})


@query("select event_id, case when event_id % 4 = 1 then 'invalid_json' when event_id % 4 = 2 then 'non_object_json' end as fault from events")
def line_faults(spark: SparkSession, d: str) -> DataFrame:
    line = C.ladder([(F.col("event_id") % 4 == 1, '{"a": NaN}'), (F.col("event_id") % 4 == 2, "[1]")], F.col("props"))
    return records.judged(A.read(spark, d, "events").select("event_id", line.alias("value"))).select("event_id", "fault")


# Descriptions by the order's number, and what the rules make of them.
SETTINGS = (
    ("This role is fully remote within the United States.", "Remote"), ("This position is onsite.", "Office"), ("This role is hybrid.", "Hybrid"),
    ("This role is remote or hybrid.", "Unknown"), ("Build hybrid cloud infrastructure.", "Unknown"), ("#LI-Remote", "Remote"),
    ("Work onsite 3 days per week. Work from home 2 days per week.", "Hybrid"), ("We are a fully remote company", "Remote"), ("Provides direct patient care in the hospital setting", "Office"),
)
YEARS = (
    ("3–5 years of experience required", 3), ("5 years overall experience and 2 years SQL experience", 5), ("13 months of experience required", 2), ("No experience required", 0),
    ("Preferred qualifications: 7 years experience", None), ("BS with 5 years experience or MS with 3 years experience", 3), ("Our company has 20 years of history", None),
)


def _described(spark: SparkSession, d: str, texts: tuple[tuple[str, object], ...]) -> DataFrame:
    text = C.ladder([(F.col("o_orderkey") % len(texts) == k, t) for k, (t, _) in enumerate(texts)])
    none = {"work_setting_extensions": F.array().cast("array<string>"), "work_setting_highlights": F.array().cast(L.HIGHLIGHTS), "work_from_home": F.lit(None).cast("boolean"), "work_setting_source_metadata": F.lit(None).cast("string")}
    # The rules take a good part of a millisecond a row: rows of one small file are dealt out to all cores.
    orders = A.read(spark, d, "orders").select("o_orderkey").repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    return orders.select("o_orderkey", F.lit("Data Engineer").alias("job_title"), text.alias("job_description")).withColumns(none)


def _case(texts: tuple[tuple[str, object], ...]) -> str:
    value = lambda v: "null" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    return f"case o_orderkey % {len(texts)} " + " ".join(f"when {k} then {value(v)}" for k, (_, v) in enumerate(texts)) + " end"


@query(f"select o_orderkey, {_case(SETTINGS)} as work_setting from orders")
def work_setting_cases(spark: SparkSession, d: str) -> DataFrame:
    return work_setting.classify(_described(spark, d, SETTINGS)).select("o_orderkey", "work_setting")


@query(f"select o_orderkey, cast({_case(YEARS)} as bigint) as required_years_experience from orders")
def experience_cases(spark: SparkSession, d: str) -> DataFrame:
    return experience.with_years(_described(spark, d, YEARS)).select("o_orderkey", "required_years_experience")


@query("select event_id, cast(ts as date) as created_date, case when cast(ts as date) between date '2024-01-18' and date '2024-01-20' then value * 2 else value end as value from events")
def partition_overwrite(spark: SparkSession, d: str) -> DataFrame:
    rows = A.read(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("created_date"), "value").repartition("created_date")
    path = new_folder(spark, "days")
    every = [r.created_date for r in rows.select("created_date").distinct().collect()]  # one for each day
    sinks.overwrite_days(rows, path, every)
    sinks.overwrite_days(rows.withColumn("value", F.col("value") * 2), path, sinks.partitions_to_replace(date(2024, 1, 20)))
    return spark.read.parquet(path).select("event_id", "created_date", "value")


@query("""select event_id, cast(ts as date) as created_date, case when cast(ts as date) in (date '2024-01-18', date '2024-01-20') then value * 2 else value end as value from events where cast(ts as date) <> date '2024-01-19'""")
def partition_overwrite_emptied(spark: SparkSession, d: str) -> DataFrame:
    """Three days are replaced; one of them has no rows any more."""
    rows = A.read(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("created_date"), "value")
    table = sinks.DayTable(spark, new_folder(spark, "days"))
    table.replace(rows)
    table.replace(rows.where("created_date <> date '2024-01-19'").withColumn("value", F.col("value") * 2), sinks.partitions_to_replace(date(2024, 1, 20)))
    return table.read().select("event_id", "created_date", "value")


def _scrapes(spark: SparkSession, d: str, description: str) -> dict[str, DataFrame]:
    """Raw tables in which each event is a listing of the second source."""
    text = lambda c: F.lit(c).cast("string")
    linked = A.read(spark, d, "events").select(
        F.col("event_id").cast("string").alias("job_id"), text(description).alias("job_description"), F.col("ts").cast("timestamp").alias("created_at"), F.col("event_type").alias("search_term"),
        text("utah").alias("job_location"), text("Analyst").alias("job_title"), text("Provo, UT · 3 days ago").alias("listing_details"), text("$50/hr").alias("fit_level_preferences"),
    )
    none = spark.createDataFrame([], records.SEED)
    return {"linkedin_jobs": linked, "api_jobs": spark.createDataFrame([], records.ENVELOPE), "query_versions": none, "enriched": spark.createDataFrame([], records.ENRICHED)}


@query("""select event_id, cast(ts as date) as created_date, case when cast(ts as date) in (date '2024-01-18', date '2024-01-20') then 'second' else 'first' end as job_description, 96000.0::double as low_annual_pay_range
from events where cast(ts as date) <> date '2024-01-19'""")
def incremental_build(spark: SparkSession, d: str) -> DataFrame:
    """Facts after two runs of the table graph: the second replaces three days, one of which raw has lost."""
    out, as_of = new_folder(spark, "graph"), date(2024, 1, 20)
    tasks.refresh(Context(spark, _scrapes(spark, d, "first"), as_of), out, names=INCREMENTAL)
    raw = _scrapes(spark, d, "second")
    raw["linkedin_jobs"] = raw["linkedin_jobs"].where("cast(created_at as date) <> date '2024-01-19'")
    tasks.refresh(Context(spark, raw, as_of), out, 3, names=INCREMENTAL)
    facts = sinks.DayTable(spark, f"{out}/fact_scraped_jobs").read()
    return facts.select(F.col("platform_job_id").cast("bigint").alias("event_id"), "created_date", "job_description", "low_annual_pay_range")


@query("select event_id, event_type as q from events")
def loaded_once(spark: SparkSession, d: str) -> DataFrame:
    """Rows of files that were loaded by a program that ended before it moved them, and then met by another: each once."""
    root, lit = new_folder(spark, "ingest"), lambda c: F.lit(c).cast("string")
    lines = A.read(spark, d, "events").select(
        F.crc32(F.col("event_type").cast("binary")).alias("query_id"), lit("s").alias("source_name"), F.col("event_type").alias("q"), lit("l").alias("location"),
        lit("2024-01-01T00:00:00Z").alias("fetched_at"), F.struct(F.col("event_id").cast("string").alias("job_id")).alias("job"),
    )
    files = sinks.write_json_lines(lines, root, "events", "20240101T000000")
    log = ingest.LoadLog(spark, f"{root}/landing")

    def ended(*_: object) -> None:
        raise OSError("the program ends here")

    with suppress(OSError):
        ingest.Ingest(spark, log, ended).run(files)
    ingest.Ingest(spark, log, ingest.hadoop_move(spark, root)).run(files)
    field = lambda path, kind: F.variant_get("job_data", path, kind)
    return log.read().select(field("$.job.job_id", "bigint").alias("event_id"), field("$.q", "string").alias("q"))


@query("select max(ts) as last_loaded_at, date_diff('hour', max(ts), timestamp '2024-02-05 00:00:00') >= 75 as is_stale from events")
def freshness(spark: SparkSession, d: str) -> DataFrame:
    """Of a table kept by day: only its newest day is read."""
    table = sinks.DayTable(spark, new_folder(spark, "loads"))
    table.replace(A.read(spark, d, "events").select("event_id", "ts", F.col("ts").cast("date").alias("created_date")))
    return records.stale(table.newest(), F.lit("2024-02-05 00:00:00").cast("timestamp_ntz"), "ts")


# -- reports ------------------------------------------------------------------------------


@query(f"""with {JOBS} select count(distinct case when listing_status = 'Active' then job_id end) as active_jobs, count(distinct case when posted_date >= date '1999-06-23' then job_id end) as new_jobs_last_7_days,
count(distinct case when listing_status = 'Active' then company_name end) as companies_hiring, round(avg(case when listing_status = 'Active' then days_listed end), 4) as avg_days_listed_active,
round(avg(case when listing_status = 'Active' then avg_annual_pay_range end), 4) as avg_salary_active, count(distinct case when listing_status = 'Active' then job_platform end) as job_platforms_active from jobs where {SOME}""")
def kpis(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.kpis(A.placed(A.jobs(spark, d)), A.SOME), "avg_days_listed_active", "avg_salary_active")


@query(f"with {JOBS} select distinct posted_date from jobs")
def available_dates(spark: SparkSession, d: str) -> DataFrame:
    return R.available_dates(A.jobs(spark, d))


def _option_query(column: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return R.options(A.placed(A.jobs(spark, d)), column)

    run.__name__ = f"options_{column}"
    query(f"with {JOBS} select 'All' as value, '{R.ALL_LABEL}' as label, 0 as ordinal union all select value, value, cast(row_number() over (order by value) as int) from (select distinct {column} as value from jobs where {column} is not null)")(run)


for _column in ("search_term", "state_name", "listing_status", "job_level", "degree_requirement"):
    _option_query(_column)


@query(f"""with {JOBS}, counts as (select job_platform as value, count(distinct job_id) as record_count from jobs group by 1) select 'All' as value, '{R.ALL_LABEL}' as label, 0 as ordinal, cast(null as bigint) as record_count
union all select value, value || ' (' || record_count || ')', cast(row_number() over (order by record_count desc, value) as int), record_count from counts""")
def platform_options(spark: SparkSession, d: str) -> DataFrame:
    return R.platform_options(A.jobs(spark, d))


@query(f"with {JOBS} select 'All' as value, '{R.ALL_LABEL}' as label, 0 as ordinal, count(distinct job_id) as record_count from jobs union all select 'United States', 'United States', 1, count(distinct case when state_name is not null then job_id end) from jobs")
def location_options(spark: SparkSession, d: str) -> DataFrame:
    """The places to choose from, with how many jobs each finds."""
    jobs = A.placed(A.jobs(spark, d))
    counts = jobs.agg(R.jobs_of().alias("All"), R.jobs_of(F.col("state_name").isNotNull()).alias("United States"))
    return R.location_options(spark).join(counts.unpivot([], ["All", "United States"], "value", "record_count"), "value")


@query(f"""with {JOBS} select 'contains' as value, 'Contains' as label, 0 as ordinal, count(distinct case when lower(job_title) like '%building%' then job_id end) as record_count from jobs
union all select 'is', 'Is', 1, count(distinct case when lower(job_title) = 'building' then job_id end) from jobs union all select 'does_not_contain', 'Does Not Contain', 2, count(distinct case when not lower(job_title) like '%building%' then job_id end) from jobs""")
def match_method_options(spark: SparkSession, d: str) -> DataFrame:
    """The ways to match a text, with how many jobs each finds for one title."""
    jobs = written(A.jobs(spark, d).select("job_id", "job_title"), "titles")
    found = [apply_filters(jobs, FilterSpec(job_title=Tokens("Building", m))).agg(F.lit(m).alias("value"), R.jobs_of().alias("record_count")) for m, *_ in R.MATCH_METHODS]
    return R.match_method_options(spark).join(found[0].unionByName(found[1]).unionByName(found[2]), "value")


@query(f"""with {JOBS}, {SCORES}, {SCORED} select job_id, job_title, '<a class="apply-link-button markdown" href="' || replace(source_link, '"', '%22') || '" target="_blank" rel="noopener noreferrer">Apply</a>' as apply_link, company_name, posted_date, round(opportunity_score, 4) as opportunity_score
from scored where listing_status = 'Active' and {WINDOW} order by posted_date desc nulls last, scored.opportunity_score desc nulls last, job_id limit 1000""")
def active_jobs_detail(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.active_jobs_detail(A.scored(spark, d), A.WINDOW).select("job_id", "job_title", "apply_link", "company_name", "posted_date", "opportunity_score"), "opportunity_score")


@query(f"with {JOBS}, {SCORES}, {SCORED} select search_term, round(avg(opportunity_score), 1) as opportunity_score from scored where opportunity_score is not null and {WINDOW} group by search_term order by 2 desc nulls last, 1 limit 10")
def top_terms(spark: SparkSession, d: str) -> DataFrame:
    return R.top_terms(A.scored(spark, d), A.WINDOW)


@query(f"""with {JOBS}, {SCORES}, {SCORED} select search_term, count(*) filter (where listing_status = 'Active') as active_jobs, round(avg(avg_annual_pay_range), 4) as avg_annual_pay_range, round(coalesce(avg(opportunity_score), 1), 1) as opportunity_score
from scored where {SOME} group by search_term having active_jobs > 0 order by opportunity_score desc, search_term limit 25""")
def demand_vs_pay(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.demand_vs_pay(A.scored(spark, d), A.SOME), "avg_annual_pay_range")


@query(f"with {JOBS} select degree_requirement as name, count(distinct job_id) as value, case degree_requirement when 'High School' then 1 when 'Bachelor''s' then 3 when 'Master''s' then 4 else 6 end as degree_order from jobs where {WINDOW} group by all")
def degree_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.degree_distribution(A.jobs(spark, d), A.WINDOW)


@query("with " + JOBS + ", centers(point_name, lat, long) as (values " + ", ".join(f"('{n}', {a}::double, {b}::double)" for _, n, a, b in STATES if n in ("Utah", "Colorado", "Texas", "New York")) + f") select point_name, lat, long, count(distinct job_id) as jobs_posted from jobs join centers on state_name = point_name where {WINDOW} group by all")
def jobs_by_location(spark: SparkSession, d: str) -> DataFrame:
    return R.jobs_by_location(A.placed(A.jobs(spark, d)), A.WINDOW)


FLOW_ALL = "flow as (select posted_date - cast(dayofweek(posted_date) as int) as week, 'New Jobs' as kind, job_id, search_term, job_platform, search_location from jobs union all select removed_date - cast(dayofweek(removed_date) as int), 'Removed Jobs', job_id, search_term, job_platform, search_location from jobs where removed_date is not null)"
WEEKS = "weeks as (select cast(unnest(generate_series(timestamp '1997-12-28', timestamp '1999-06-27', interval 7 day)) as date) as week)"


@query(f"""with {JOBS}, {FLOW_ALL}, {WEEKS}, kinds(job_flow_type, series_order) as (values ('New Jobs', 1), ('Removed Jobs', 2)), sums as (select week, kind as job_flow_type, count(distinct job_id || search_term) as n from flow where search_location = 'ASIA' group by all)
select week, job_flow_type, coalesce(n, 0) as job_count, series_order from weeks cross join kinds left join sums using (week, job_flow_type)""")
def flow_trend(spark: SparkSession, d: str) -> DataFrame:
    return R.flow_trend(O.jobs_flow_week(A.jobs(spark, d)), A.WINDOW.but(search_location="ASIA"))


@query(f"with {JOBS} select last_seen - cast(dayofweek(last_seen) as int) as week, round(avg(days_listed), 4) as avg_days_listed from jobs where last_seen between date '1998-01-01' and date '1999-06-30' group by 1")
def days_listed_over_time(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.days_listed_over_time(A.jobs(spark, d), A.WINDOW), "avg_days_listed")


@query(f"with {JOBS} select posted_date - cast(dayofweek(posted_date) as int) as week, round(avg(avg_annual_pay_range), 4) as avg_annual_pay_range from jobs where {WINDOW} and avg_annual_pay_range is not null group by 1")
def pay_over_time(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.pay_over_time(A.jobs(spark, d), A.WINDOW), "avg_annual_pay_range")


@query(f"""with {JOBS}, {TRENDS}, weeks as (select cast(unnest(generate_series(timestamp '1997-12-21', timestamp '1999-06-27', interval 7 day)) as date) as week), sums as (select week_beginning as week, search_term, sum(jobs_count) as n from trends where search_location = 'ASIA' and week_beginning between date '1997-12-21' and date '1999-06-27' group by all),
dense as (select week, search_term, coalesce(n, 0) as n from weeks cross join (select distinct search_term from sums) left join sums using (week, search_term)), changed as (select *, lag(n) over (partition by search_term order by week) as b from dense)
select week as week_beginning, search_term, round((n - b) / nullif(b, 0), 6) as wow_percent_change from changed where week >= date '1997-12-28' and nullif(b, 0) is not null""")
def posted_trends(spark: SparkSession, d: str) -> DataFrame:
    trends = O.jobs_flow_week_trends(O.jobs_flow_week(A.jobs(spark, d)))
    return rounded(R.posted_trends(trends, A.WINDOW.but(search_location="ASIA")), "wow_percent_change", places=6)


CHOSEN = f"chosen as (select * from job_skills where {WINDOW} and search_location like '%AS%' and state_name in ('Texas', 'Utah'))"
SKILL_SPEC = A.WINDOW.but(search_location="AS", states=("Texas", "Utah"))


def _skill_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return A.job_skills(spark, d), A.placed(A.jobs(spark, d))


@query(f"""with {JOBS}, {SKILLS}, {CHOSEN} select coalesce((select skill from chosen group by skill order by count(distinct job_id) desc, skill limit 1), 'No skills') as top_skill,
coalesce((select skill from chosen where avg_annual_pay_range is not null group by skill having count(distinct job_id) >= 100 order by avg(avg_annual_pay_range) desc, skill limit 1), 'No salary data') as highest_salary_skill, count(distinct skill) as skills_tracked from chosen""")
def skill_kpis(spark: SparkSession, d: str) -> DataFrame:
    return R.skill_kpis(*_skill_rows(spark, d), SKILL_SPEC)


@query(f"with {JOBS}, {SKILLS}, {CHOSEN} select skill, count(distinct job_id) as distinct_job_count from chosen group by skill order by 2 desc, 1 limit 15")
def top_requested_skills(spark: SparkSession, d: str) -> DataFrame:
    return R.top_requested_skills(*_skill_rows(spark, d), SKILL_SPEC)


@query(f"""with {JOBS}, {SKILLS}, {CHOSEN}, m as (select skill, count(distinct job_id) as distinct_job_count, avg(avg_annual_pay_range) as pay, count(distinct case when avg_annual_pay_range is not null then job_id end) as salary_job_count from chosen group by skill),
r as (select *, row_number() over (order by distinct_job_count desc, skill) as a, row_number() over (order by pay desc nulls last, skill) as b from m where pay is not null and salary_job_count >= 3)
select skill, distinct_job_count, round(pay, 4) as avg_annual_pay_range, salary_job_count, round(salary_job_count / distinct_job_count, 6) as salary_coverage_pct from r where a <= 40 or b <= 40 order by distinct_job_count desc, pay desc, skill limit 25""")
def dual_rank(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(R.skill_demand_salary(*_skill_rows(spark, d), SKILL_SPEC), "avg_annual_pay_range"), "salary_coverage_pct", places=6)


@query(f"""with {JOBS}, {SKILLS}, {CHOSEN}, top as (select skill from chosen group by skill order by count(distinct job_id) desc, skill limit 10) select strftime(date_trunc('month', posted_date), '%b %Y') as month, skill, count(distinct job_id) as distinct_job_count from chosen where skill in (select skill from top) group by all""")
def skill_trend(spark: SparkSession, d: str) -> DataFrame:
    return R.skill_trend(*_skill_rows(spark, d), SKILL_SPEC)


@query(f"""with {JOBS}, {SKILLS}, f as (select distinct job_id, job_title from jobs where {WINDOW} and search_location like '%AS%' and state_name in ('Texas', 'Utah')), t as (select job_title, count(distinct job_id) as title_job_count from f group by 1 order by 2 desc, 1 limit 20),
c as (select distinct f.job_id, f.job_title, s.skill from f join t using (job_title) join job_skills s on f.job_id = s.job_id), k as (select skill, count(distinct job_id) as skill_job_count from c group by 1 order by 2 desc, 1 limit 10),
p as (select job_title, skill, count(distinct job_id) as n from c group by all) select job_title, skill, round(coalesce(n, 0) / title_job_count, 6) as penetration_pct, title_job_count, skill_job_count, coalesce(n, 0) as skill_title_job_count from t cross join k left join p using (job_title, skill)""")
def skill_penetration(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.skill_penetration(*_skill_rows(spark, d), SKILL_SPEC), "penetration_pct", places=6)


@query(f"with {JOBS} select job_id, trim(job_title) as job_title, try_cast(days_listed as bigint) as days_listed, posted_date from jobs")
def jobs_extract(spark: SparkSession, d: str) -> DataFrame:
    return R.jobs_extract(A.jobs(spark, d)).select("job_id", "job_title", "days_listed", "posted_date")


@query(f"with {JOBS}, {SKILLS} select skill, job_id, posted_date, search_term, job_level, degree_requirement, job_title, company_name, search_location, job_platform, listing_status, avg_annual_pay_range from job_skills")
def skills_extract(spark: SparkSession, d: str) -> DataFrame:
    return R.skills_extract(A.job_skills(spark, d))


@query(f"with {JOBS}, {SCORES} select search_term, search_location, count(*) as months, round(max(opportunity_score), 4) as best from scores group by all")
def opportunity_summary(spark: SparkSession, d: str) -> DataFrame:
    scores = O.scores(_facts(spark, d), F.lit(A.AS_OF))
    return rounded(scores.groupBy("search_term", "search_location").agg(F.count("*").alias("months"), F.max("opportunity_score").alias("best")), "best")


@query("select o_orderkey, o_orderdate as created_at_utc, o_orderdate at time zone 'UTC' at time zone 'America/Denver' as created_at_mst from orders")
def denver_time(spark: SparkSession, d: str) -> DataFrame:
    return A.read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("created_at_utc"), C.local_time("o_orderdate").alias("created_at_mst"))


@query(f"with {JOBS} select job_id, 'Orders' as data_source, job_title as job_description from jobs where not exists (select 1 from orders where cast(o_orderkey as varchar) = job_id and o_orderkey % 2 = 0) order by created_at_utc, job_id limit 300")
def enrichment_candidates(spark: SparkSession, d: str) -> DataFrame:
    jobs = A.jobs(spark, d).withColumn("job_description", F.col("job_title"))
    done = A.read(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("job_id"), F.lit("Orders").alias("data_source"))
    return L.enrichment_candidates(jobs, done)
