"""Group -> users registry.

The registry is kept in long form ``(grp, user, pos)`` -- one row per member
with its first-seen position -- so adding or removing users is an anti-join and
a union, and no group is ever gathered into one row during processing. The list
operations of Q6 become joins on that form: append-unique is an anti-join plus a
union, list difference is an anti-join, membership is a semi-join. Empty
groups are kept as a row with a NULL user. ``export_registry`` builds the
``{group: [users]}`` listing only for the final export (K8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed

REGISTRY_SCHEMA = "grp string, user string, pos bigint"


def distinct_groups(df: DataFrame, col: str = "Investigator_Folder") -> DataFrame:
    """Distinct trimmed non-empty group names; the header word itself is never a group."""
    g = F.trim(F.col(col))
    return (df.select(g.alias("grp")).filter((F.col("grp") != "") & (F.col("grp") != fixed.GROUP_HEADER_WORD))
              .distinct())


def register_groups(registry: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups that are absent are added with an empty list."""
    new = groups.select("grp").distinct().join(registry.select("grp").distinct(), "grp", "left_anti")
    return registry.unionByName(new.select("grp", F.lit(None).cast("string").alias("user"),
                                           F.lit(None).cast("bigint").alias("pos")))


def add_users(registry: DataFrame, additions: DataFrame) -> DataFrame:
    """U4: ``additions(grp, user, pos)``; groups are created when absent; users not yet in the
    group are appended after the existing ones in their given order (first occurrence kept)."""
    adds = (additions.filter(F.col("user").isNotNull() & (F.trim("user") != ""))
                     .withColumn("user", F.trim("user"))
                     .groupBy("grp", "user").agg(F.min("pos").alias("pos")))
    members = registry.filter(F.col("user").isNotNull())
    fresh = adds.join(members.select("grp", "user"), ["grp", "user"], "left_anti")
    offset = members.groupBy("grp").agg(F.max("pos").alias("_base"))
    placed = (fresh.join(offset, "grp", "left")
                   .select("grp", "user", (F.coalesce("_base", F.lit(0)) + F.col("pos") + 1).alias("pos")))
    groups = registry.select("grp").unionByName(additions.select("grp")).distinct()
    empty = (groups.join(members.select("grp").unionByName(placed.select("grp")).distinct(), "grp", "left_anti")
                   .select("grp", F.lit(None).cast("string").alias("user"), F.lit(None).cast("bigint").alias("pos")))
    return members.unionByName(placed).unionByName(empty)


def remove_users(registry: DataFrame, removals: DataFrame) -> DataFrame:
    """Users removed from their group; the group stays even when emptied; unknown groups
    are ignored. Only the named users go (ledger L-14: no other de-duplication)."""
    rm = removals.select("grp", F.trim("user").alias("user")).distinct()
    members = registry.filter(F.col("user").isNotNull())
    kept = members.join(rm, ["grp", "user"], "left_anti")
    groups = registry.select("grp").distinct()
    emptied = (groups.join(kept.select("grp").distinct(), "grp", "left_anti")
                     .select("grp", F.lit(None).cast("string").alias("user"), F.lit(None).cast("bigint").alias("pos")))
    return kept.unionByName(emptied)


def export_registry(registry: DataFrame) -> DataFrame:
    """K8: one row per group with its users in first-seen order joined by ', ' (export only)."""
    return (registry.groupBy("grp")
                    .agg(F.array_sort(F.collect_list(F.when(F.col("user").isNotNull(), F.struct("pos", "user"))))
                         .alias("_m"))
                    .select("grp", F.transform("_m", lambda m: m["user"]).alias("users"))
                    .withColumn("users_text", F.array_join("users", ", ")))
