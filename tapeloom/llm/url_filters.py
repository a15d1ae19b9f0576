"""Which captures stood on a list when they were fetched.

A list is kept as dated entries that add or remove a domain or a URL. Each entry holds until the next one for
the same thing, so entries become intervals, and a capture meets those that are open at its fetch time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.operators.joins import BROADCAST_BYTES, join_lookup
from tapeloom.operators.skew import GROUP_ROWS

# Fixed value: scheme, user, host and port of a URL; what follows is path and query, up to a fragment.
PARTS = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)(?::\d*)?([^#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without a dot at its end; empty where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, PARTS, 1)), r"\.+$", "")


def page_of(url: Column) -> Column:
    """Host, path and query: the URL without scheme, user, port and fragment."""
    return F.concat(host_of(url), F.regexp_extract(url, PARTS, 2))


def keys_of(url: Column) -> Column:
    """What a list can name to meet a URL: its host, all domains above it, and the page itself."""
    labels = F.split(host_of(url), r"\.")
    size = F.size(labels)
    counts = F.sequence(F.lit(1), size)
    domains = F.transform(counts, lambda n: F.array_join(F.slice(labels, size - n + 1, n), "."))
    page = F.concat(F.lit("="), page_of(url))
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(F.concat(domains, F.array(page)))


def intervals(entries: DataFrame) -> DataFrame:
    """list, key, valid_from, valid_to: when each key stands on each list; valid_to is exclusive or NULL.

    ``entries`` has list, key, dated and action (``add`` or ``remove``). Of entries with one date a removal
    is the last. Entries without a list, key or date are left out; repeated ones change nothing.
    """
    known = entries.where(F.expr("list is not null and key is not null and dated is not null and action in ('add', 'remove')"))
    known = known.select("list", "key", "dated", "action").distinct()
    order = Window.partitionBy("list", "key").orderBy("dated", "action")
    ends = known.withColumn("valid_to", F.lead("dated").over(order))
    open_ones = ends.where((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("dated"))))
    return open_ones.select("list", "key", F.col("dated").alias("valid_from"), "valid_to")


def judged(
    captures: DataFrame, entries: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = GROUP_ROWS
) -> DataFrame:
    """page_id, url, fetched_at, blocked, lists (sorted, comma-joined) and n_active entries, a row per capture.

    Other columns are not read. A capture without a URL, a host or a fetch time meets no entry. Equal
    captures are judged once and repeated in the result. Intervals that fit are sent to every executor;
    beyond that both sides are shuffled by key and the captures of hot hosts spread over many tasks. No
    pair of a capture and a closed interval is put out.
    """
    own = ["page_id", "url", "fetched_at"]
    distinct = captures.groupBy(*own).agg(F.count(F.lit(1)).alias("copies"))
    rows = distinct.select(*own, "copies", F.explode_outer(keys_of(F.col("url"))).alias("key"))
    lookup = intervals(entries)
    met = join_lookup(rows, lookup, "key", "left", spread_by=own[:2], broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)
    at = F.col("fetched_at")
    active = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    hit = F.when(active, F.col("list"))
    found = met.groupBy(*own, "copies").agg(F.collect_set(hit).alias("lists"), F.count(hit).alias("n_active"))
    each = found.select(*own, "lists", "n_active", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    return each.select(
        *own, (F.col("n_active") > 0).alias("blocked"), F.array_join(F.sort_array("lists"), ",").alias("lists"), "n_active"
    )


# The supplied pages carry no fetch time and come without a list; both follow from hashes of their columns.
START = "2024-01-01 00:00:00"
SPAN_DAYS = 730


def _digits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _after(days: Column, seconds: Column | int = 0) -> Column:
    start = F.lit(START).cast("timestamp_ntz")
    return start + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), F.lit(seconds) if isinstance(seconds, int) else seconds)


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time somewhere in two years."""
    when = _digits(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return pages.select(
        "page_id", "url", _after(when % SPAN_DAYS, (when % 86_400).cast("decimal(18,6)")).alias("fetched_at")
    )


def entries_of(pages: DataFrame) -> DataFrame:
    """Entries for a third of the hosts (added, removed, added again) and for a fiftieth of the single pages."""
    hosts = pages.select(host_of(F.col("url")).alias("key")).where(F.col("key") != "").distinct()
    hosts = hosts.withColumn("n", _digits(F.col("key"))).where(F.col("n") % 3 == 0)
    turns = [("add", F.col("n") % 200), ("remove", F.col("n") % 300 + 200), ("add", F.col("n") % 100 + 500)]
    changes = F.array(*[F.struct(F.lit(action).alias("action"), _after(day).alias("dated")) for action, day in turns])
    name = F.when(F.col("n") % 2 == 0, F.lit("spam")).otherwise(F.lit("adult"))
    by_host = hosts.select(name.alias("list"), "key", F.inline(changes))
    single = pages.select(F.concat(F.lit("="), page_of(F.col("url"))).alias("key")).where(F.length("key") > 1).distinct()
    single = single.withColumn("n", _digits(F.col("key"))).where(F.col("n") % 50 == 0)
    by_page = single.select(F.lit("takedown").alias("list"), "key", F.lit("add").alias("action"), _after(F.col("n") % 700).alias("dated"))
    return by_host.unionByName(by_page.select("list", "key", "action", "dated"))


ORACLE_SQL = r"""
with parts as (
  select page_id, url,
         regexp_replace(lower(regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)(?::\d*)?([^#]*)', 1)), '\.+$', '') as host,
         regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)(?::\d*)?([^#]*)', 2) as rest,
         ('0x' || substr(md5(page_id::varchar), 1, 8))::bigint as n
  from pages
),
captures as (
  select page_id, url, host, '=' || host || rest as page,
         timestamp '2024-01-01' + to_days((n % 730)::integer) + to_seconds(n % 86400) as fetched_at
  from parts
),
hosts as (
  select host as key, ('0x' || substr(md5(host), 1, 8))::bigint as n from (select distinct host from captures where host <> '')
),
singles as (
  select page as key, ('0x' || substr(md5(page), 1, 8))::bigint as n from (select distinct page from captures where length(page) > 1)
),
entries as (
  select case when n % 2 = 0 then 'spam' else 'adult' end as list, key, u.action, timestamp '2024-01-01' + to_days(u.day::integer) as dated
  from hosts, lateral (values ('add', n % 200), ('remove', n % 300 + 200), ('add', n % 100 + 500)) as u(action, day)
  where n % 3 = 0
  union all
  select 'takedown', key, 'add', timestamp '2024-01-01' + to_days((n % 700)::integer) from singles where n % 50 = 0
),
held as (
  select list, key, action, dated as valid_from, lead(dated) over (partition by list, key order by dated, action) as valid_to
  from (select distinct * from entries)
),
keyed as (
  select page_id, url, fetched_at,
         unnest(list_concat([page], list_transform(range(1, len(string_split(host, '.')) + 1),
           lambda k: array_to_string(string_split(host, '.')[-k:], '.')))) as key
  from captures where host <> ''
),
met as (
  select k.page_id, k.url, k.fetched_at, count(*) as n_active, string_agg(distinct h.list, ',' order by h.list) as lists
  from keyed k join held h on k.key = h.key and h.action = 'add' and h.valid_from <= k.fetched_at
       and (h.valid_to is null or k.fetched_at < h.valid_to)
  group by all
)
select c.page_id, c.url, c.fetched_at, m.n_active is not null as blocked, coalesce(m.lists, '') as lists,
       coalesce(m.n_active, 0)::bigint as n_active
from captures c left join met m on c.page_id = m.page_id and c.url = m.url
"""
