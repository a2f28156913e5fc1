"""Node and edge tables: dead ends, bounded upstream search, group members and governance checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dead_ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with something coming in and nothing going out."""
    coming = edges.select(F.col("dst").alias("id"))
    going = edges.select(F.col("src").alias("id"))
    return nodes.join(coming, "id", "left_semi").join(going, "id", "left_anti")


def upstream_within(starts: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """(start, id, hops): nodes that reach a start by at most so many edges, each with its least number."""
    step = edges.select(F.col("dst").alias("id"), F.col("src").alias("_up"))
    front = starts.select(F.col("id").alias("start"), F.col("id")).distinct()
    seen = front.withColumn("hops", F.lit(0))
    for k in range(1, hops + 1):
        front = front.join(step, "id").select("start", F.col("_up").alias("id")).distinct().join(seen.select("start", "id"), ["start", "id"], "left_anti")
        seen = seen.unionByName(front.withColumn("hops", F.lit(k)))
    return seen.where("hops > 0")


def without_upstream(starts: DataFrame, nodes: DataFrame, edges: DataFrame, wanted: Column, hops: int = 3) -> DataFrame:
    """Starts that no wanted node reaches within so many edges."""
    good = upstream_within(starts, edges, hops).join(nodes.where(wanted).select("id"), "id", "left_semi")
    return starts.join(good.select(F.col("start").alias("id")), "id", "left_anti")


def members_of_groups(groups: DataFrame, membership: DataFrame) -> DataFrame:
    """Groups with their sorted distinct members; a group without members has none."""
    joined = groups.join(membership.select(F.col("group_id"), F.col("user_id").alias("_u")), "group_id", "left")
    return joined.groupBy(*groups.columns).agg(F.sort_array(F.collect_set("_u")).alias("members"))


def fellows(membership: DataFrame, user: object) -> DataFrame:
    """All members of the groups that a user is in."""
    own = membership.where(F.col("user_id") == user).select("group_id")
    return membership.join(own, "group_id", "left_semi")


def over_cap(settings: DataFrame, cap: int) -> DataFrame:
    """Components with more tasks than a cap."""
    return settings.where(F.col("tasks") > cap).withColumn("rule", F.lit("task_cap"))


def over_share(settings: DataFrame, pool: int, percent: int) -> DataFrame:
    """Components with more tasks than their share of a pool: floor(pool * percent / 100), at least 1."""
    return settings.where(F.col("tasks") > max(1, pool * percent // 100)).withColumn("rule", F.lit("pool_share"))


def unscheduled(settings: DataFrame, kinds: str) -> DataFrame:
    """Components whose type matches and whose period is zero."""
    return settings.where(F.col("type").rlike(kinds) & (F.col("period_s") == 0)).withColumn("rule", F.lit("zero_schedule"))


def pool_over_cores(pools: DataFrame, factor: int) -> DataFrame:
    """Pools of more threads than factor times cores."""
    return pools.where(F.col("threads") > factor * F.col("cores")).withColumn("rule", F.lit("pool_ceiling"))
