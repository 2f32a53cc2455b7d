"""Listings, skills and scrapes told from the driver's star schema.

An order stands for a listing: its market segment is the search term, the region
the location, the priority the platform, the customer the company. It is removed
when its last line ships, unless its status is O. The words of its part names are
skills. Events are scrapes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ladder
from ..operators import listings as L
from ..operators import opportunity as O
from ..operators.filters import FilterSpec, Tokens
from ..operators.states import centers

AS_OF = date(2001, 8, 15)
WINDOW = FilterSpec(start=date(1998, 1, 1), end=date(1999, 6, 30))
SOME = WINDOW.but(search_location="ASIA", job_title=Tokens("BUILDING|||machinery", "contains"), company_name=Tokens("9", "does_not_contain"))
# The states that regions stand for in place reports.
REGION_STATES = (("AFRICA", "UT"), ("AMERICA", "CO"), ("ASIA", "TX"), ("EUROPE", "NY"))
DEGREES = ("High School", "Bachelor's", "Master's", "Degree Not Specified")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the jobs report, but for the score."""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    places = read(spark, sf_dir, "nation").join(F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 and 5 rows
    last = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("last_ship"))
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    posted = F.col("o_orderdate").cast("date")
    removed = F.when(F.col("o_orderstatus") != "O", F.col("last_ship"))
    title = F.concat_ws(" ", F.when(F.col("o_orderkey") % 7 == 0, "Senior").when(F.col("o_orderkey") % 11 == 0, "Junior"), "c_mktsegment", F.when(F.col("o_orderkey") % 5 == 0, "III"))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("job_id"), title.alias("job_title"), F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("search_term"),
        F.col("r_name").alias("search_location"), F.col("o_orderpriority").alias("job_platform"), F.col("o_orderdate").alias("created_at_utc"),
        F.col("o_orderdate").alias("created_at_mst"), posted.alias("posted_date"), removed.alias("removed_date"),
        F.coalesce(F.col("last_ship"), posted).cast("timestamp_ntz").alias("last_seen_at_utc"),
        F.when(removed.isNotNull(), "Removed").otherwise("Active").alias("listing_status"),
        F.datediff(F.coalesce("last_ship", posted), posted).cast("bigint").alias("days_listed"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("avg_annual_pay_range"), L.job_level(title).alias("job_level"),
        ladder([(F.col("o_orderkey") % 4 == k, d) for k, d in enumerate(DEGREES)]).alias("degree_requirement"),
        F.concat(F.lit("https://jobs.example.com/"), F.col("o_orderkey").cast("string"), F.lit('"x')).alias("source_link"),
        F.concat("n_name", F.lit(", "), ladder([(F.col("r_name") == r, s) for r, s in REGION_STATES], "XX")).alias("job_location"),
        F.lit("Full-time").alias("schedule_type"), F.lit("Orders").alias("data_source"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """rows with the centre of the state at the end of their location."""
    return rows.withColumn("state_abbr", F.substring("job_location", -2, 2)).join(F.broadcast(centers(rows.sparkSession)), "state_abbr", "left")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs report: with score, tier and place."""
    rows = jobs(spark, sf_dir)
    return placed(O.with_score(rows, O.opportunity_score(rows, F.lit(AS_OF))))


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, data_source, skill) from the part names of an order, in the form of an enrichment."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    named = lines.join(read(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    each = named.select(F.col("l_orderkey").alias("key"), F.explode(F.split("p_name", " ")).alias("skill")).select("key", F.upper(F.btrim("skill")).alias("skill")).where("skill <> ''").distinct()
    return each.select(F.col("key").cast("string").alias("job_id"), F.lit("Orders").alias("data_source"), "skill")


def job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).join(skills(spark, sf_dir), ["job_id", "data_source"])
