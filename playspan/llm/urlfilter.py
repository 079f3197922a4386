"""URL filters by a temporal join with dated block lists.

A list is a log of dated entries (name, day, action): from its day on an entry holds for the
host ``name`` and all hosts below it, until the next entry for the same name. Entries become
validity intervals [valid_from, valid_to); several of one name and day count as the one that
sorts last by action. Each different (host, fetch day) is looked up once with every name the
host is under, however deep: an equality join on the names with the interval as a condition.
The longest name with an entry in force decides; without one the capture passes. Captures
are joined to that one result of their host and day, so they are never multiplied.

A host with a third of all captures is no more than a skewed join key, which Spark splits;
no group is collected. The list side is broadcast only if Spark finds it small.

Null and malformed URLs have no host and pass, as do captures without a fetch day and those
before the first entry. Entries with a null name, day or action say nothing. Repeated
captures are judged one by one; other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from playspan.llm.common import free_name, quoted


#: Other full stops that stand for a dot in a host.
DOTS = "\u3002\uff0e\uff61"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute http(s) URL as a browser finds it; else null.

    Blanks around the URL, tabs and line ends in it say nothing, a backslash is a slash. The
    host stands behind the last ``@`` of the authority, percent signs are decoded (a broken one
    is left as it is), other full stops are dots; port and final dots go.
    """
    plain = F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]+", "")
    authority = F.regexp_extract(F.replace(plain, F.lit("\\"), F.lit("/")), r"^(?i:https?)://([^/?#]*)", 1)
    host = F.replace(F.regexp_replace(authority, "^.*@", ""), F.lit("+"), F.lit("%2B"))
    host = F.translate(F.coalesce(F.try_url_decode(host), host), DOTS, "...")
    host = F.regexp_extract(host, r"^([^/?#:@\[\]]+)", 1)
    host = F.regexp_replace(F.lower(host), r"\.+$", "")
    return F.when(host != "", host)


def names_of(host: Column) -> Column:
    """The host and all names of two labels or more above it, most specific first; null without a host."""
    labels = F.split(host, r"\.")
    ups = F.sequence(F.lit(0), F.greatest(F.size(labels) - 2, F.lit(0)))
    return F.transform(ups, lambda up: F.array_join(F.slice(labels, up + 1, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (name, day, action) as (name, action, valid_from, valid_to); an open end is null."""
    real = entries.where("name IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
    daily = real.groupBy(F.lower("name").alias("name"), "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("name").orderBy("day")
    return daily.select("name", "action", F.col("day").alias("valid_from"), F.lead("day").over(order).alias("valid_to"))


def as_of(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with a struct column appended: host, name, action, valid_from, valid_to, kept."""
    host, result = free_name(captures, "host"), free_name(captures, "filter")
    found = captures.withColumn(host, host_of(quoted(url)))
    key, at, hit = (free_name(found, n) for n in ("hit_host", "hit_day", "hit"))
    asked = found.select(F.col(host).alias(key), quoted(day).alias(at)).dropna().distinct()
    asked = asked.select(key, at, F.posexplode(names_of(F.col(key))).alias("up", "asked"))
    within = (F.col("asked") == F.col("name")) & (F.col(at) >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))
    )
    span = F.struct("name", "action", "valid_from", "valid_to")
    hits = asked.join(intervals(entries), within).groupBy(key, at).agg(F.min_by(span, "up").alias(hit))
    found = found.join(hits, (F.col(host) == F.col(key)) & (quoted(day) == F.col(at)), "left")
    first = F.col(hit)
    kept = F.coalesce(first["action"] != "block", F.lit(True))
    judged = F.struct(
        F.col(host).alias("host"), *[first[c].alias(c) for c in ("name", "action", "valid_from", "valid_to")],
        kept.alias("kept"),
    )
    return found.withColumn(result, judged).drop(host, key, at, hit)


# The test tables have neither fetch days nor a list. Both are derived from ``pages``: the
# fetch day from the page id; entries for every host and every registered name from the ids
# of its pages, so that the list grows with the table.

FETCH_STEP, DAYS = 37, 365


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.pmod(F.col("page_id") * FETCH_STEP, F.lit(DAYS)).cast("int").alias("day"))


def entries_of(pages: DataFrame) -> DataFrame:
    names = names_of(host_of(F.col("url")))
    named = pages.select("page_id", F.explode(F.slice(names, 1, 2)).alias("name"))
    least = named.groupBy("name").agg(F.min("page_id").alias("m"))
    return least.select(
        "name",
        F.explode(F.array(*[
            F.struct(
                F.pmod(F.col("m") * 11 + step, F.lit(DAYS)).cast("int").alias("day"), F.lit(action).alias("action")
            )
            for step, action in ((0, "block"), (120, "allow"), (250, "block"))
        ])).alias("e"),
    ).where(F.pmod(F.col("m"), F.lit(3)) != 0).select("name", "e.day", "e.action")


def digest(pages: DataFrame) -> DataFrame:
    found = as_of(captures_of(pages), entries_of(pages))
    return found.select(
        "page_id", "url", F.col("day").alias("fetch_day"), "filter.host", "filter.name", "filter.action",
        "filter.valid_from", "filter.valid_to", "filter.kept",
    )
