"""Connected components of links too many for one machine.

Alternating large-star and small-star steps: links are rewired to smaller ids until every
component is a star around its smallest id. Each step is written to the shared folder, so a lost
executor costs one step. A hub's minimum combines on the map side. Links are read once where both of their
ends are needed and no step is repeated to see that nothing changes, as every plan is held by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def _two_links(one: tuple, other: tuple) -> Column:
    """Both links, (a, b) each, in two rows."""
    return F.explode(F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in (one, other)]))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(_two_links(("a", "b"), ("b", "a")).alias("link")).select("link.*")


def _rewired(neighbours: DataFrame, larger_only: bool) -> DataFrame:
    least = neighbours.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("least"))
    least = least.select("hub", F.least("hub", "least").alias("least"))
    joined = neighbours.join(least, F.col("a") == F.col("hub"))
    if larger_only:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.select(_two_links(("b", "least"), ("a", "least")).alias("link")).select("link.*")


def _are_stars(links: DataFrame) -> bool:
    """Whether every a of the links (a > b) has one b only, which is no a: the steps change nothing then."""
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("id"), F.lit(1).alias("links"), F.lit(0).alias("centre")),
                F.struct(F.col("b").alias("id"), F.lit(0).alias("links"), F.lit(1).alias("centre")),
            )
        ).alias("end")
    ).select("end.*")
    counted = ends.groupBy("id").agg(F.sum("links").alias("links"), F.max("centre").alias("centre"))
    return counted.filter("links > 1 or links = 1 and centre = 1").first() is None


def connected_components(links: DataFrame, stage) -> DataFrame:
    """(id, root) for every id that occurs in ``links`` (a, b); root is the smallest id."""
    current = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "links",
    )
    for _ in range(MAX_ROUNDS):
        if _are_stars(current):
            break
        large = _rewired(_both_ways(current), larger_only=True).distinct()
        small = _rewired(large, larger_only=False).filter("a <> b").distinct()
        current = stage(small, "links")
    else:
        raise RuntimeError("components did not settle")
    named = current.select(_two_links(("a", "b"), ("b", "b")).alias("link"))
    return stage(named.select(F.col("link.a").alias("id"), F.col("link.b").alias("root")).distinct(), "roots")
