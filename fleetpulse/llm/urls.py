"""URL filters by a temporal list join, in DataFrame operations only.

A block list is a log of dated entries (pattern, day, action 'add' or
'remove'). The entries of a pattern become validity intervals: each holds
from its day to the day of the pattern's next entry. A capture is looked up
by every pattern that could cover its URL (the host, its parent domains,
host and first path segment), and the as-of join keeps the intervals that
hold on the day it was fetched.

The join is an equi-join on the pattern with the range as a condition, over
two plain tables, so Spark splits a pattern that covers a third of all
captures; hits are added up per capture with sums that combine before they
are shuffled. Intervals need the log of one pattern together, which is small:
entries of one day are reduced to one first.

A host is read as a browser reads it: blanks around the URL and line breaks
and tabs within it go, what stands before the last @ of the authority and the
port do not belong to the host, nor do dots at its end; a backslash counts as a
slash.

Defined cases: a URL that is null, empty or without a host matches nothing
(host is null); entries with a null field are ignored; of entries for one
pattern and day 'remove' wins; repeated entries count once; captures are
told by their id, URL and day together (nulls included): rows equal in all
three give one row, rows that share an id alone are captures of their own;
empty lists match nothing; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetpulse.llm.tables import staged


HEAD = r"^[A-Za-z][A-Za-z0-9+.\-]*://"      # scheme
APART = r"/?#\\"                             # what ends an authority or a path segment


def cleaned(url: Column) -> Column:
    return F.regexp_replace(F.translate(url, "\t\r\n", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def host_of(url: Column) -> Column:
    authority = F.regexp_extract(cleaned(url), HEAD + rf"([^{APART}]*)", 1)
    named = F.regexp_extract(F.regexp_replace(authority, r"^.*@", ""), r"^(\[[^\]]*\]|[^:]*)", 1)
    host = F.lower(F.regexp_replace(named, r"\.+$", ""))
    return F.when(host != "", host)


def patterns_of(url: Column) -> Column:
    """The host, its parents of two labels or more, host and first path segment."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segment = F.regexp_extract(cleaned(url), HEAD + rf"[^{APART}]*[/\\]([^{APART}]+)", 1)
    return F.array_distinct(F.concat(parents, F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment)))
                                     .otherwise(F.array().cast("array<string>"))))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, from_day, to_day): when each pattern is listed."""
    log = (entries.where("pattern is not null and day is not null and action is not null")
           .groupBy("pattern", "day").agg(F.max("action").alias("action")))
    following = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    return (log.withColumn("to_day", F.coalesce(following, F.lit(2 ** 31 - 1)))
            .where("action = 'add'").select("pattern", F.col("day").alias("from_day"), "to_day"))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (id, url, day) -> (id, day, n_active, rule), a row for every
    capture: how many listed patterns cover it on its day, and the first of
    them by name."""
    listed = staged(intervals(entries), "list-intervals")
    # A capture is known by its URL's digest from here on, however long the URL is.
    told = captures.select("id", "day", "url", F.unhex(F.md5("url")).alias("u"))
    hits = (told.select("id", "day", "u", F.explode(patterns_of(F.col("url"))).alias("pattern"))
            .join(listed, "pattern").where("from_day <= day and day < to_day")
            .select("id", "day", "u", F.lit(0).alias("copy"), F.col("pattern").alias("rule")))
    itself = told.select("id", "day", "u", F.lit(1).alias("copy"), F.lit(None).cast("string").alias("rule"))
    # The intervals of a pattern are disjoint, so each copy of a capture hits it at most once.
    return (itself.union(hits).groupBy("id", "day", "u")
            .agg(F.sum("copy").alias("copies"), F.count("rule").alias("hits"), F.min("rule").alias("rule"))
            .select("id", "day", F.expr("hits div copies").alias("n_active"), "rule"))


def number(text: Column, salt: str, below: int) -> Column:
    """A number from a text, the same in any engine."""
    return (F.conv(F.substring(F.md5(F.concat(text, F.lit(salt))), 1, 6), 16, 10).cast("int") % below).cast("int")


def dated_entries(captures: DataFrame) -> DataFrame:
    """A dated list over the captures' own hosts, parents and paths: about a
    quarter of the patterns are added on some day, most of those are removed
    later, some are added again."""
    pattern = captures.select(F.explode(patterns_of(F.col("url"))).alias("pattern")).distinct()
    added = number(F.col("pattern"), "added", 300)
    removed = added + 20 + number(F.col("pattern"), "removed", 200)
    event = lambda day, action: F.struct(day.cast("int").alias("day"), F.lit(action).alias("action"))
    events = F.concat(
        F.array(event(added, "add")),
        F.when(number(F.col("pattern"), "gone", 4) != 0, F.array(event(removed, "remove"))).otherwise(F.array().cast(
            "array<struct<day:int,action:string>>")),
        F.when(number(F.col("pattern"), "gone", 4) == 1, F.array(event(removed + 40, "add"))).otherwise(F.array().cast(
            "array<struct<day:int,action:string>>")))
    return (pattern.where(number(F.col("pattern"), "listed", 4) == 0)
            .select("pattern", F.explode(events).alias("e")).select("pattern", "e.day", "e.action"))


SQL = r"""
    WITH c AS (SELECT DISTINCT page_id, url, ('0x' || substr(md5(url || 'fetched'), 1, 6))::INT % 365 AS day FROM pages),
         t AS (SELECT row_number() OVER () AS id, page_id, day, trim(replace(replace(replace(
                      url, chr(9), ''), chr(10), ''), chr(13), ''), array_to_string([chr(k::INT) for k in range(1, 33)], '')) AS u
               FROM c),
         r AS (SELECT *, substr(u, strpos(u, '://') + 3) AS rest FROM t
               WHERE strpos(u, '://') > 0 AND regexp_full_match(split_part(u, '://', 1), '[A-Za-z][A-Za-z0-9+.\-]*')),
         s AS (SELECT *, string_split_regex(rest, '[/?#\\]') AS parts FROM r),
         o AS (SELECT *, string_split(parts[1], '@')[-1] AS named, substr(rest, length(parts[1]) + 1, 1) AS mark FROM s),
         h AS (SELECT id, day, lower(rtrim(CASE WHEN starts_with(named, '[') THEN split_part(named, ']', 1) || ']'
                                               ELSE split_part(named, ':', 1) END, '.')) AS host,
                      CASE WHEN mark IN ('/', chr(92)) THEN nullif(parts[2], '') END AS segment FROM o),
         l AS (SELECT *, string_split(host, '.') AS labels FROM h WHERE host <> ''),
         a AS (SELECT DISTINCT id, day, unnest(list_concat(
                      [array_to_string(labels[i:], '.') for i in range(1, greatest(len(labels), 2))],
                      CASE WHEN segment IS NULL THEN [] ELSE [host || '/' || segment] END)) AS pattern FROM l),
         p AS (SELECT DISTINCT pattern FROM a),
         n AS (SELECT pattern, ('0x' || substr(md5(pattern || 'added'), 1, 6))::INT % 300 AS added,
                      ('0x' || substr(md5(pattern || 'removed'), 1, 6))::INT % 200 AS more,
                      ('0x' || substr(md5(pattern || 'gone'), 1, 6))::INT % 4 AS gone FROM p
               WHERE ('0x' || substr(md5(pattern || 'listed'), 1, 6))::INT % 4 = 0),
         i AS (SELECT pattern, added AS lo, CASE WHEN gone = 0 THEN 2147483647 ELSE added + 20 + more END AS hi FROM n
               UNION ALL SELECT pattern, added + 60 + more, 2147483647 FROM n WHERE gone = 1),
         f AS (SELECT id, count(DISTINCT a.pattern) AS n_active, min(a.pattern) AS rule
               FROM a JOIN i ON a.pattern = i.pattern AND i.lo <= a.day AND a.day < i.hi GROUP BY id)
    SELECT t.page_id, t.day AS fetch_day, coalesce(f.n_active, 0) AS n_active, f.rule AS rule, f.id IS NOT NULL AS blocked
    FROM t LEFT JOIN f ON t.id = f.id"""
