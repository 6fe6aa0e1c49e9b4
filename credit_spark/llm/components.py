"""Connected components of a link table, without gathering it anywhere.

Alternating large-star and small-star steps: each points nodes at the least
label in their neighbourhood until the links form stars. Every step is a
grouping with partial aggregation and a join; each round is written to the
shared folder, so that the plan stays short and executors may be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low"))) \
        .select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = both.groupBy("node").agg(F.min("other").alias("least")) \
        .select("node", F.least("node", "least").alias("least"))
    return (both.where(F.col("other") > F.col("node")).join(least, "node")
            .select(F.col("other").alias("high"), F.col("least").alias("low")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(least, "high").where(F.col("low") != F.col("least")) \
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
    return least.select("high", F.col("least").alias("low")).unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """Least reachable node of every linked node: columns ``node``, ``label``.

    ``links`` has long columns ``high`` > ``low``; repeated rows don't
    matter, and an empty table gives no rows. The rounds needed grow with
    the logarithm of the node count; there is no limit to them.
    """
    now = stored(links.select("high", "low").distinct(), "links")
    print_of = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")))
    before = now.agg(print_of.alias("p")).first().p
    while before[0]:
        now = stored(_small_star(_large_star(now)), "links")
        after = now.agg(print_of.alias("p")).first().p
        if after == before:
            break
        before = after
    return now.select(F.col("high").alias("node"), F.col("low").alias("label"))
