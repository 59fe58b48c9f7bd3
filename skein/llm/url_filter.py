"""Operator 9, URL filters by a temporal list join.

A block list changes over time: entries are added and removed on dates. Each entry's dated changes become validity
intervals [since, until); a capture is then judged by the list as it stood at its fetch time. An entry names a host,
which covers its subdomains, or a host and a path prefix. A capture is looked up by each suffix of its host; a suffix
and a time meet at most the intervals that hold then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import boxed, table

#: scheme, optional user, host, optional port, rest
URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)(?::\d*)?([^?#]*)"


def host(url: Column) -> Column:
    """Lower-case host of a URL without a last dot; null without one."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", ""), F.lit(""))


def path(url: Column) -> Column:
    return F.when(F.regexp_extract(url, URL, 2) == "", "/").otherwise(F.regexp_extract(url, URL, 2))


def intervals(changes: DataFrame) -> DataFrame:
    """(entry_host, entry_path, since, until, list_id) from (host, path, action, at, list_id) rows.

    ``action`` is 'add' or 'remove'; ``until`` is null while an entry still holds. Of several changes of one entry at
    one time a removal is last. Changes of null host, time or unknown action are passed over; a null path is '/'."""
    rows = changes.filter("host is not null and at is not null and action in ('add', 'remove')")
    rows = rows.select(F.regexp_replace(F.lower("host"), r"\.$", "").alias("entry_host"), F.coalesce("path", F.lit("/")).alias("entry_path"), "at", "action", "list_id")
    per = rows.groupBy("entry_host", "entry_path", "list_id", "at").agg(F.max("action").alias("action"))  # 'remove' over 'add'
    w = Window.partitionBy("entry_host", "entry_path", "list_id").orderBy("at")
    # only turns count: an 'add' to what is on the list already changes nothing
    turns = per.withColumn("before", F.lag("action").over(w)).filter("before is null or before <> action")
    held = turns.withColumn("until", F.lead("at").over(w)).filter("action = 'add'")
    return held.select("entry_host", "entry_path", F.col("at").alias("since"), "until", "list_id")


def suffixes(h: Column) -> Column:
    """A host and its parent domains, longest first."""
    labels = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (all columns; it has page_id, url and fetched) with host, n_entries, rule, rule_since and blocked.

    n_entries counts the intervals that cover a capture at its fetch time; rule is the most specific (longest host, then
    longest path, then first in order) with its start. A null or hostless URL, or a null time, meets no entry. Repeated
    rows are judged each. An empty list blocks nothing; empty captures give no rows."""
    held = intervals(changes)
    # each URL and time once, however often it was captured
    seen = captures.select("url", F.col("fetched").alias("f")).distinct()
    slim = seen.select("url", "f", host(F.col("url")).alias("h"), path(F.col("url")).alias("p")).filter("h is not null and f is not null")
    keyed = slim.select("url", "f", "p", F.explode(suffixes(F.col("h"))).alias("entry_host"))
    # no hint: Spark weighs the list's size and splits a host that very many captures have
    met = keyed.join(held, "entry_host").filter((F.col("since") <= F.col("f")) & (F.col("until").isNull() | (F.col("f") < F.col("until"))) & F.col("p").startswith(F.col("entry_path")))
    rank = F.struct(-F.length("entry_host"), -F.length("entry_path"), "entry_host", "entry_path", "list_id", "since")
    best = met.groupBy(F.col("url").alias("b_url"), F.col("f").alias("b_f")).agg(F.count("*").alias("n_entries"), F.min(rank).alias("m"))
    rows = captures.select(boxed(captures, "host", "n_entries", "rule", "rule_since", "blocked").alias("r"))
    out = rows.join(best, (F.col("r.url") == F.col("b_url")) & (F.col("r.fetched") == F.col("b_f")), "left")
    return out.select(
        "r.*",
        host(F.col("r.url")).alias("host"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.concat("m.entry_host", "m.entry_path").alias("rule"),
        F.col("m.since").alias("rule_since"),
        F.col("m").isNotNull().alias("blocked"),
    )


def _day(n: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))


def listed(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``, since the test tables hold none: about half of the hosts are added on a
    day set by the host's CRC and two thirds of these removed later, half of the removed added again; some add a path."""
    hosts = pages.select(F.regexp_extract("url", r"^[a-z]+://([^/?#:]*)", 1).alias("host")).filter("host <> ''").distinct()
    c = F.conv(F.substring(F.md5("host"), 1, 8), 16, 10).cast("long")
    hosts = hosts.withColumn("c", c).filter("c % 2 = 0")
    day = (F.col("c") / 4).cast("long") % 200
    rows = F.array(
        F.struct(F.lit("add").alias("action"), _day(day).alias("at"), F.lit("/").alias("path"), F.lit(1).alias("list_id")),
        F.when(F.col("c") % 3 > 0, F.struct(F.lit("remove").alias("action"), _day(day + 60).alias("at"), F.lit("/").alias("path"), F.lit(1).alias("list_id"))),
        F.when(F.col("c") % 3 > 1, F.struct(F.lit("add").alias("action"), _day(day + 120).alias("at"), F.lit("/").alias("path"), F.lit(1).alias("list_id"))),
        F.when(F.col("c") % 5 == 0, F.struct(F.lit("add").alias("action"), _day(day + 30).alias("at"), F.lit("/en").alias("path"), F.lit(2).alias("list_id"))),
    )
    return hosts.select("host", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("host", "r.*")


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch date set by the page's id."""
    return pages.select("page_id", "url", _day(F.pmod(F.col("page_id") * 37, F.lit(366))).alias("fetched"))


def op9(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge(captures(pages), listed(pages))
    return out.select("page_id", "url", "fetched", "host", "n_entries", "rule", "rule_since", "blocked")


SQL = r"""
with hosts as (
  select distinct regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) host from pages),
coded as (select host, ('0x' || substr(md5(host), 1, 8))::bigint c from hosts where host <> ''),
days as (select host, c, (c // 4) % 200 d from coded where c % 2 = 0),
held as (
  select host, '/' path, d since, case when c % 3 > 0 then d + 60 end til from days
  union all select host, '/', d + 120, null from days where c % 3 > 1
  union all select host, '/en', d + 30, null from days where c % 5 = 0),
entries as (select host, path, date '2024-01-01' + since::int since, date '2024-01-01' + til::int til from held),
caps as (
  select page_id, url, date '2024-01-01' + ((page_id * 37) % 366)::int fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) host,
    case when regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' then '/' else regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) end p
  from pages),
met as (
  select c.page_id, e.host, e.path, e.since,
    row_number() over (partition by c.page_id order by length(e.host) desc, length(e.path) desc, e.host, e.path, e.since) rk,
    count(*) over (partition by c.page_id) n
  from caps c join entries e on (c.host = e.host or ends_with(c.host, '.' || e.host))
    and e.since <= c.fetched and (e.til is null or c.fetched < e.til) and starts_with(c.p, e.path))
select c.page_id, c.url, c.fetched::date fetched, c.host, coalesce(m.n, 0)::bigint n_entries, m.host || m.path as rule,
  m.since::date rule_since, m.host is not null blocked
from caps c left join met m on m.page_id = c.page_id and m.rk = 1
"""
