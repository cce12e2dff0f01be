"""The registered queries over the driver's tables, each beside the SQL that it is held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, urls
from millrace.operators import guards, records, snapshots
from millrace.sources import raw

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

HALF = "2024-01-16"
AS_OF = "2026-10-10"


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, sf_dir, "events")
    cut = F.expr(f"timestamp_ntz'{HALF}'")
    return events.where(F.col("ts") < cut), events.where(F.col("ts") >= cut)


_VERDICT = f"""
with p as (select event_type, count(*) as n_previous from events where ts < timestamp '{HALF}' group by 1),
c as (select event_type, count(*) as n_current from events where ts >= timestamp '{HALF}' group by 1),
v as (select event_type, coalesce(n_previous, 0) as n_previous, coalesce(n_current, 0) as n_current from p full join c using (event_type))
"""


@_query(_VERDICT + f"""
select e.*, e.ts < timestamp '{HALF}' as served_from_previous from events e join v using (event_type)
where (e.ts >= timestamp '{HALF}') = (n_current > 0 and n_current >= n_previous)
""")
def guarded_last_good(spark, sf_dir):
    return guards.last_good(*_halves(spark, sf_dir), "event_type")


@_query(f"""
with e as (select event_id, ts < timestamp '{HALF}' as old, case when event_type = 'view' then null else event_type end as event_type from events),
v as (select event_type, count(*) filter (not old) > 0 and count(*) filter (not old) >= count(*) filter (old) as accepted from e group by 1)
select event_id, e.event_type, old as served_from_previous from e join v on e.event_type is not distinct from v.event_type where old <> accepted
""")
def guarded_null_source(spark, sf_dir):
    """Rows without a source are guarded like those of any other."""
    unnamed = F.when(F.col("event_type") != "view", F.col("event_type"))
    before, after = (x.select("event_id", unnamed.alias("event_type")) for x in _halves(spark, sf_dir))
    return guards.last_good(before, after, "event_type")


@_query(_VERDICT + """
select *, n_current > 0 and n_current >= n_previous as accepted,
  case when n_current = 0 then 'missing' when n_current < n_previous then 'fewer rows' else '' end as reason from v
""")
def source_report(spark, sf_dir):
    return guards.report(*_halves(spark, sf_dir), "event_type")


_PAYLOADS = [(1, '{"tournaments": ["a", "b"]}'), (2, '{"tournaments": []}'), (3, '{"tournaments":'), (4, '{"other": 1}'), (5, None), (6, '{"tournaments": 3}')]


@_query("select * from (values (1, true), (2, false), (3, false), (4, false), (5, false), (6, false)) t(id, valid)")
def payload_validity(spark, sf_dir):
    return spark.createDataFrame(_PAYLOADS, "id int, payload string").select("id", guards.valid_payload(F.col("payload"), "tournaments").alias("valid"))


@_query("select page_id, split_part(split_part(url, '#', 1), '?', 1) as url, split_part(split_part(url, '#', 1), '?', 1) in (select split_part(split_part(url, '#', 1), '?', 1) from pages where page_id = 0) as known from pages")
def normalised_urls(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    known = pages.where("page_id = 0").select(urls.without_query(F.col("url")).alias("url")).distinct().withColumn("known", F.lit(True))
    out = pages.select("page_id", urls.without_query(F.col("url")).alias("url"))
    return out.join(known, "url", "left").select("page_id", "url", F.coalesce("known", F.lit(False)).alias("known"))


@_query(r"""
with r as (select page_id, regexp_replace(regexp_replace(url, '//[^/]*/', '//app/'), '/[0-9]+(\.html|/)?', '/') as url from pages),
b as (select *, split_part(split_part(url, '#', 1), '?', 1) as bare from r)
select page_id, case when page_id % 7 = 0 then 'skip: method' when not starts_with(url, 'https://') then 'skip: origin' when page_id % 5 = 0 then 'navigation'
  when bare = 'https://app/de/' then 'data' when bare in ('https://app/en/', 'https://app/es/') then 'shell' else 'skip: unknown' end as route from b
""")
def routed_requests(spark, sf_dir):
    """Requests to one host for a path of a language: every rule of the router has some."""
    url = F.regexp_replace(F.regexp_replace("url", "//[^/]*/", "//app/"), r"/[0-9]+(\.html|/)?", "/")
    method, mode = F.when(F.col("page_id") % 7 == 0, "POST").otherwise("GET"), F.when(F.col("page_id") % 5 == 0, "navigate").otherwise("cors")
    route = urls.route(method, url, mode, "https://", "https://app/de/", ["https://app/en/", "https://app/es/"])
    return _table(spark, sf_dir, "pages").select("page_id", route.alias("route"))


@_query("select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host from pages where regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) in ('ththed.example.org', 'thther.example.org')")
def allowed_hosts(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").where(urls.on_hosts(F.col("url"), ["ththed.example.org", "thther.example.org"]))
    return pages.select("page_id", urls.host_of(F.col("url")).alias("host"))


@_query("""
with l as (select page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) as links from pages)
select page_id, cast(len(links) as integer) as n_links, array_to_string(links, ' ') as links from l
""")
def page_links(spark, sf_dir):
    found = _table(spark, sf_dir, "pages").select("page_id", urls.links_in(F.col("html")).alias("links"))
    return found.select("page_id", F.size("links").alias("n_links"), F.array_join("links", " ").alias("links"))


@_query("select year(o_orderdate) - case when month(o_orderdate) <= 3 then 1 else 0 end as fiscal_year, count(*) as n from orders group by 1")
def fiscal_years(spark, sf_dir):
    return _table(spark, sf_dir, "orders").groupBy(dates.fiscal_year(F.col("o_orderdate")).alias("fiscal_year")).agg(F.count(F.lit(1)).alias("n"))


@_query("select o_orderkey, case when (dayofweek(o_orderdate) + 6) % 7 = o_orderkey % 7 then cast(o_orderdate as date) end as deadline from orders")
def checked_deadlines(spark, sf_dir):
    deadline = dates.checked_deadline(F.to_date("o_orderdate"), (F.col("o_orderkey") % 7).cast("int"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", deadline.alias("deadline"))


@_query("select distinct source from documents where starts_with(source, 'src1') and source <> 'src12'")
def outdated_versions(spark, sf_dir):
    return snapshots.outdated(_table(spark, sf_dir, "documents").select("source").distinct(), "source", "src1", "src12")


@_query("select max(source) as by_text, 'src' || max(cast(substr(source, 4) as integer)) as by_number from documents where starts_with(source, 'src')")
def latest_versions(spark, sf_dir):
    names = _table(spark, sf_dir, "documents").select("source")
    by_text, by_number = (snapshots.latest(names, "source", "src", n).withColumnRenamed("latest", c) for n, c in ((False, "by_text"), (True, "by_number")))
    return by_text.crossJoin(by_number)  # one row each


@_query("select min(doc_id) as doc_id, md5(text) as digest from documents group by text")
def exact_copies(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return records.first_of_each(docs, ["digest"], [F.col("doc_id")])


@_query("select doc_id, source from documents qualify row_number() over (partition by source order by doc_id) <= 3")
def capped_per_source(spark, sf_dir):
    return records.capped(_table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], [F.col("doc_id")], 3)


@_query("select * from customer except all select c_custkey, c_name, c_nationkey, case when c_custkey % 100 = 0 then c_acctbal + 1 else c_acctbal end, c_mktsegment from customer where c_custkey % 50 <> 1")
def lost_rows(spark, sf_dir):
    before = _table(spark, sf_dir, "customer")
    after = before.where("c_custkey % 50 <> 1").withColumn("c_acctbal", F.expr("case when c_custkey % 100 = 0 then c_acctbal + 1 else c_acctbal end"))
    return guards.lost_rows(before, after)


@_query("select event_type, count(*) as n from events group by rollup (event_type)")
def source_counts(spark, sf_dir):
    return records.counts(_table(spark, sf_dir, "events"), "event_type")


@_query("select event_type, count(*) as n, min(ts) as first_ts, count(distinct user_id) as users from events group by 1")
def event_summary(spark, sf_dir):
    return _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.countDistinct("user_id").alias("users"))


@_query("""
select d.doc_id, case when d.doc_id % 3 = 0 then 1 else coalesce(l.quality, case when d.doc_id % 2 = 0 then 0 end) end as quality, l.doc_id is not null as matched,
  coalesce(d.doc_id % 3 = 0 and l.quality <> 1, false) as conflict from documents d left join labels l using (doc_id)
""")
def enriched_documents(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).alias("quality"))
    old = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 0).alias("quality"))
    return records.enriched(docs, _table(spark, sf_dir, "labels"), ["doc_id"], ["quality"], old)


@_query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def excluded_documents(spark, sf_dir):
    return records.excluded(_table(spark, sf_dir, "documents").select("doc_id"), _table(spark, sf_dir, "labels"), "doc_id")


@_query("select n_nationkey, n_name, r_name as area from nation left join region on n_regionkey = r_regionkey")
def located_nations(spark, sf_dir):
    areas = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("area"))
    return records.located(_table(spark, sf_dir, "nation"), areas, "n_regionkey").select("n_nationkey", "n_name", "area")


@_query("select 'customer' as source, c_custkey as id, c_name as name from customer union all select 'supplier', s_suppkey, s_name from supplier")
def merged_sources(spark, sf_dir):
    one = _table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return records.merged(one, _table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@_query("select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY') and c_nationkey = 7")
def searched_customers(spark, sf_dir):
    return records.searched(_table(spark, sf_dir, "customer"), c_mktsegment=["BUILDING", "MACHINERY"], c_nationkey=7).select("c_custkey", "c_mktsegment")


_ENTRIES = [
    (1, 2026, "11/8,15", "申込開始", "2027-03-31 20:00:00", "20歳以上（学生不可）", "A級オープン/B級登録"),
    (2, 2026, "1/10", "締切", "2026-12-01 00:00:00", "誰でも", "一般・ベテラン・一般"),
    (3, 2026, "2/30", "期日", "2026-12-01 00:00:00", "A級はオープン", ""),
    (4, 2026, "PDF", None, None, None, None),
]


@_query("""
select * from (values
  (1, '2026-11-08 2026-11-15', timestamp '2027-03-31 20:00:00', null::date, 20, 'no students', 'A級オープン B級登録', false, true),
  (2, '2027-01-10', null, date '2026-12-01', null, '', '一般 ベテラン', false, true),
  (3, '', null, null, null, 'other conditions apply', '', null, false),
  (4, '', null, null, null, '', null, null, false)
) t(id, days, entry_start, deadline, min_age, flags, divisions, finished, pending)
""")
def typed_entries(spark, sf_dir):
    rows = spark.createDataFrame(_ENTRIES, "id int, fiscal int, days string, label string, at string, who string, what string")
    rows = rows.withColumn("days", dates.days_in(F.col("days"), F.col("fiscal"))).withColumn("e", dates.typed_entry(F.col("label"), F.col("at").cast("timestamp_ntz"))).withColumn("q", records.eligibility(F.col("who")))
    over = dates.finished(F.col("days"), F.to_date(F.lit(AS_OF)))
    return rows.select(
        "id", F.array_join(F.transform("days", lambda d: d.cast("string")), " ").alias("days"), "e.entry_start", "e.deadline", "q.min_age",
        F.array_join("q.flags", " ").alias("flags"), F.array_join(records.divisions(F.col("what")), " ").alias("divisions"), over.alias("finished"), F.coalesce(~over, F.lit(False)).alias("pending"),
    )


@_query("select * from (values (1, '安城'), (2, null), (3, null)) t(id, text)")
def decoded_bytes(spark, sf_dir):
    rows = spark.createDataFrame([(1, bytearray.fromhex("88C08FE9")), (2, bytearray.fromhex("81")), (3, None)], "id int, content binary")
    return rows.select("id", raw.decoded(F.col("content")).alias("text"))


@_query("select page_id, cast(len(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>')) as integer) as n_rows from pages")
def table_rows(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.size(raw.table_cells(F.col("html"))).alias("n_rows"))


_TABLES = [(1, "<table><TR><th>Day</th><td class='d'> <b>11/8</b>,15 </td></TR><tr>\n<td>PDF</td></tr></table>"), (2, "<p>none</p>"), (3, None)]


@_query("select * from (values (1, 'Day|11/8,15 PDF'), (2, ''), (3, null)) t(id, cells)")
def hand_made_tables(spark, sf_dir):
    rows = raw.table_cells(F.col("html"))
    return spark.createDataFrame(_TABLES, "id int, html string").select("id", F.array_join(F.transform(rows, lambda r: F.array_join(r, "|")), " ").alias("cells"))


_RESERVES = [(1, 2026, "11/8,15", "11/22", "2026-11-08"), (2, 2026, "1/24", "2/30", "2026-01-24"), (3, 2026, None, "3/14", None)]


@_query("""
select * from (values (1, '2026-11-08 2026-11-15', '2026-11-22', true), (2, '2027-01-24', '', false), (3, '', '2027-03-14', null)) t(id, event_days, reserve_days, year_fits)
""")
def reserve_days(spark, sf_dir):
    """Reserve days stay apart from event days, and a stated year is held against the fiscal year."""
    rows = spark.createDataFrame(_RESERVES, "id int, fiscal int, days string, reserve string, stated string")
    text = lambda c: F.array_join(F.transform(dates.days_in(F.col(c), F.col("fiscal")), lambda d: d.cast("string")), " ")
    fits = dates.explicit_year_fits(F.try_to_date("stated"), F.col("fiscal"))
    return rows.select("id", F.coalesce(text("days"), F.lit("")).alias("event_days"), text("reserve").alias("reserve_days"), fits.alias("year_fits"))


@_query(_VERDICT + f"""
select event_type, count(*) as n from events
where (ts >= timestamp '{HALF}') = (select bool_and(n_current > 0 and n_current >= n_previous) from v) group by 1
""")
def published_snapshot(spark, sf_dir):
    """The first half is published, and the second if the guard accepts all its sources; else readers still see the first."""
    before, after = _halves(spark, sf_dir)
    root = f"{_shared(spark)}/millrace-snapshots-{uuid.uuid4().hex}"
    snapshots.guarded_publish(before, root, "v1", 1, before.limit(1).count() > 0)
    snapshots.guarded_publish(after, root, "v2", 2, guards.report(before, after, "event_type").where("not accepted").count() == 0)
    return snapshots.read_last_good(spark, root).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@_query("select c_mktsegment, count(*) as n, sum(c_custkey) as keys from customer group by 1")
def published_json(spark, sf_dir):
    """Records that are published as JSON, a line each, and read again."""
    root = f"{_shared(spark)}/millrace-json-{uuid.uuid4().hex}"
    customers = _table(spark, sf_dir, "customer")
    snapshots.build(customers, root, "v1", "json")
    read = spark.read.schema(customers.schema).json(f"{root}/v1")
    return read.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@_query("select 'src' || max(cast(substr(source, 4) as integer)) as latest from documents where starts_with(source, 'src') and lang = 'fr'")
def latest_holding(spark, sf_dir):
    return snapshots.latest_holding(_table(spark, sf_dir, "documents"), "source", "lang", "fr", "src")


@_query("""
with k as (select o_custkey, min(o_orderpriority) as low, max(o_orderpriority) as high, true as found from orders group by 1)
select c_custkey, c_custkey % 2 as matched, case when low = high then low end as o_orderpriority, coalesce(low <> high, false) as conflict, coalesce(found, false) as enriched_matched
from customer left join k on o_custkey = c_custkey
""")
def enriched_once(spark, sf_dir):
    """Several details of one key that contradict each other give no value, and double no row; a column `matched` is kept."""
    rows = _table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 2).alias("matched"))
    details = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    return records.enriched(rows, details, ["c_custkey"], ["o_orderpriority"])


def _shared(spark: SparkSession) -> str:
    """The folder that the cluster shares; our own only where none is set and there is one machine."""
    import re
    import tempfile

    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"file://{tempfile.mkdtemp(prefix='millrace-')}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
