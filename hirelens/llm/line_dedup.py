"""Operator 7, line dedup by site-relative frequency (native).

A page's text is cut into lines at block tags. For each host, the pages that
contain a line are divided by the host's pages; lines above the boilerplate ratio
are dropped from all pages of the host. The ratio is the whole rule: a host of one to three pages
keeps nothing, as each of its lines is above it.

Lines are counted once a page and aggregated before the shuffle. A host has
fewer than (mean lines of a page / ratio) dropped lines, however many pages it
has, so they travel as one array. Lines are cut once and written; counts, totals and these
arrays are written too before they are joined, so that adaptive execution can split a host that
holds a third of all pages, whatever their number; hosts are not salted.

Edge cases: a null html has no lines; a null url or one without host leaves the
page as it is; an empty table gives an empty result; a page stored twice counts
twice; a line at exactly the ratio stays. Blank lines are no lines. Very long
pages are read whole. Columns other than page_id, url and html are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Scratch

RATIO = 0.3

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)"
UNSEEN = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
BREAKS = r"(?i)<(/?(p|div|li|ul|ol|h[1-6]|table|tr|td|th|br|hr|nav|article|section|header|footer|title|head|body|html|pre|blockquote|a)\b[^>]*|!doctype[^>]*)>"
TAGS = r"<[^>]*>"


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def lines(html: Column) -> Column:
    """Lines of the visible text, trimmed, without blank ones."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), BREAKS, "\n"), TAGS, "")
    return F.coalesce(F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\n"))), lambda x: x != ""), F.array().cast("array<string>"))


def dedup(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """page_id, host, n_lines, n_dropped and the kept lines joined by line feeds, for every page."""
    scratch = Scratch(pages.sparkSession, "lines")
    cut = scratch.write(pages.select("page_id", host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines")), "cut")
    named = cut.where("host is not null")
    totals = scratch.write(named.groupBy("host").agg(F.count("*").alias("pages")), "totals")
    counts = (
        named.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n"))
    )
    # One page of a host with fewer than 1 / ratio pages is above the ratio: all its lines go, uncounted.
    small = ratio * F.col("pages") < 1
    frequent = scratch.write(counts, "counts").join(totals.where(~small), "host").where(F.col("n") > ratio * F.col("pages"))
    common = frequent.groupBy("host").agg(F.collect_list("line").alias("common"), F.lit(False).alias("all_gone"))
    common = scratch.write(common.unionByName(totals.where(small).select("host", F.lit(True).alias("all_gone")), allowMissingColumns=True), "common")
    scratch.drop("counts", "totals")
    kept = F.filter("lines", lambda x: ~F.coalesce(F.col("all_gone") | F.array_contains("common", F.xxhash64(x)), F.lit(False)))
    return cut.join(common, "host", "left").select(
        "page_id", "host", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(kept)).cast("bigint").alias("n_dropped"), F.array_join(kept, "\n").alias("kept"),
    )


ORACLE = rf"""
with cut as (
  select page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') as host,
    coalesce(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html, '{UNSEEN}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g'), chr(10)),
      lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(10))), lambda x: x <> ''), cast([] as varchar[])) as lines
  from pages
), each_line as (
  select host, line, count(*) as n from (select host, unnest(list_distinct(lines)) as line from cut where host is not null) group by host, line
), totals as (
  select host, count(*) as pages from cut where host is not null group by host
), common as (
  select e.host, list(e.line) as common from each_line e join totals t on e.host = t.host where e.n > {RATIO} * t.pages group by e.host
), filtered as (
  select page_id, cut.host, lines, list_filter(lines, lambda x: not coalesce(list_contains(common, x), false)) as kept from cut left join common on cut.host = common.host
)
select page_id, host, cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(kept) as bigint) as n_dropped, array_to_string(kept, chr(10)) as kept from filtered
"""
