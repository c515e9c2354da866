"""URL filters by dated lists: an as-of join of captures with validity intervals.

A list entry says that from a day on a host pattern has an action (``block``, ``allow`` or ``drop``,
which ends what held before). The next entry of the same list and pattern ends its interval, so
entries become intervals [from, to). A capture is checked against the entries active on the day
it was fetched, for its host and every parent domain; the most specific pattern decides and,
between lists, ``block`` wins over ``allow``.

Captures first collapse to (host, day) with map-side combine, so the join sees a dominant host at
most once per day; the verdicts then go back to the captures by host and day.

Edge cases: a capture without a host or a fetch day is kept with a NULL verdict; entries without
list, pattern, day or a known action are ignored; of several entries of one list, pattern and day the one
with the greatest action name counts (drop over block over allow); repeated rows change nothing; an empty
list keeps every capture; other columns of the captures pass through, those named like the added
ones (``host``, ``verdict``, ``pattern``, ``list_name``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTIONS = ("allow", "block", "drop")
ADDED = ("host", "verdict", "pattern", "list_name")
HOST_PATTERN = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host(url: Column) -> Column:
    """Lower-case host of a URL without user, port or a final dot; NULL without one."""
    found = F.regexp_replace(F.lower(F.regexp_extract(url, HOST_PATTERN, 1)), "\\.+$", "")
    return F.when(found != "", found)


def suffixes(name: Column) -> Column:
    """The host and its parent domains, the most specific first."""
    labels = F.split(name, "\\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda start: F.array_join(F.slice(labels, start, F.size(labels)), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (list_name, pattern, listed_on, action) as active intervals."""
    known = (
        entries.filter(F.lower("action").isin(*ACTIONS))
        .groupBy("list_name", F.lower("pattern").alias("pattern"), "listed_on")
        .agg(F.max(F.lower("action")).alias("action"))
        .filter("list_name is not null and pattern is not null and listed_on is not null")
    )
    order = Window.partitionBy("list_name", "pattern").orderBy("listed_on")
    return (
        known.withColumn("valid_to", F.lead("listed_on").over(order))
        .filter(F.col("action") != "drop")
        .select("list_name", "pattern", "action", F.col("listed_on").alias("valid_from"), "valid_to")
    )


def verdicts(days: DataFrame, active: DataFrame) -> DataFrame:
    """The deciding entry of each (host, day) that has one."""
    asked = days.select(
        "host", "day", F.posexplode(suffixes(F.col("host"))).alias("generality", "suffix")
    )
    matched = asked.join(active, F.col("suffix") == F.col("pattern")).filter(
        (F.col("day") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    )
    rank = F.struct(
        "generality", (F.col("action") != "block").alias("softer"), "list_name", "pattern", "action"
    )
    return (
        matched.groupBy("host", "day")
        .agg(F.min(rank).alias("first"))
        .select(
            F.col("host").alias("of_host"),
            F.col("day").alias("of_day"),
            F.col("first.action").alias("verdict"),
            F.col("first.pattern").alias("pattern"),
            F.col("first.list_name").alias("list_name"),
        )
    )


def judge_captures(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """``captures`` with ``host``, ``verdict`` (``block``, ``allow`` or NULL), ``pattern``, ``list_name``."""
    names = [name for name in captures.columns if name not in ADDED]
    hosted = captures.select(*[F.col(f"`{name}`") for name in names], host(F.col(url)).alias("host"))
    days = (
        hosted.select("host", F.col(day).alias("day"))
        .filter("host is not null and day is not null")
        .distinct()
    )
    decided = verdicts(days, intervals(entries))
    return hosted.join(
        decided, (F.col("host") == F.col("of_host")) & (F.col(day) == F.col("of_day")), "left"
    ).select(*[F.col(f"`{name}`") for name in names], *ADDED)


def kept_captures(judged: DataFrame) -> DataFrame:
    return judged.filter(F.coalesce("verdict", F.lit("")) != "block")
