"""Deterministic preprocessing: one row per key, who counts, noise, budgets and pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivox.functions.text import RULES_VERSION, noise_rule


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key: the first in a total order, so that the same data give the same row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def eligible(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Comments with ``author_key``, ``noise_rule``, ``countable`` and ``rule_version``.

    A comment counts if its author is known and is not the video's own, and no noise rule holds. Both levels count, and
    popularity is not read. Comments that do not count stay as context.
    """
    # a video that came more than once is one video
    own = videos.groupBy("platform", "video_id").agg(F.min("author_id").alias("_owner"))
    joined = comments.drop("like_count").join(own, ["platform", "video_id"], "left")
    known = F.col("author_id").isNotNull() & ~F.col("author_id").eqNullSafe(F.col("_owner")) & F.col("level").isin(1, 2)
    return (
        joined.withColumn("noise_rule", noise_rule(F.col("text")))
        .withColumn("countable", known & F.col("noise_rule").isNull())
        .withColumn("author_key", F.when(F.col("author_id").isNotNull(), F.concat_ws("\u0001", "platform", "author_id")))
        .withColumn("rule_version", F.lit(RULES_VERSION))
        .drop("_owner")
    )


def unprocessed(df: DataFrame, fingerprints: DataFrame, kind: str, id_column: str) -> DataFrame:
    """Rows whose id has no fingerprint yet."""
    seen = fingerprints.where(F.col("kind") == kind).select("platform", F.col("id").alias(id_column))
    return df.join(seen, ["platform", id_column], "left_anti")


def in_pool(df: DataFrame, pool: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is in today's pool; the others are not visited again."""
    return df.join(pool.select(*keys), keys, "left_semi")


def within_budget(videos: DataFrame, comments: DataFrame, max_videos: int, max_comments: int, per_video: int, first: list[Column | str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(videos, comments, flag)`` of a run: videos in (platform, hot rank) order up to either limit, and of a video's
    comments the first by ``first`` (their ids).

    The flag has one row, ``budget_exhausted``. A run has a few thousand rows, so one ordered window serves; the running
    count is over one row for each video, not over comments.
    """
    first = first or ["comment_id"]
    kept = top_per_group(comments, ["platform", "video_id"], first, per_video)
    sizes = kept.groupBy("platform", "video_id").agg(F.count("*").alias("_c"))
    order = Window.orderBy("platform", F.col("hot_rank").asc_nulls_last(), "video_id")
    ranked = videos.join(sizes, ["platform", "video_id"], "left").withColumn("_c", F.coalesce("_c", F.lit(0)))
    ranked = ranked.withColumn("_v", F.row_number().over(order)).withColumn("_before", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c"))
    inside = ranked.where((F.col("_v") <= max_videos) & (F.col("_before") < max_comments))
    left = kept.join(inside.select("platform", "video_id", "_before"), ["platform", "video_id"])
    place = F.row_number().over(Window.partitionBy("platform", "video_id").orderBy(*first))
    taken = left.withColumn("_p", place).where(F.col("_before") + F.col("_p") <= max_comments).drop("_p", "_before")
    flag = ranked.agg((F.coalesce(F.max("_v"), F.lit(0)) > max_videos).alias("_a"), (F.coalesce(F.sum("_c"), F.lit(0)) > max_comments).alias("_b"))
    return inside.drop("_c", "_v", "_before"), taken, flag.select((F.col("_a") | F.col("_b")).alias("budget_exhausted"))


def with_parent(comments: DataFrame) -> DataFrame:
    """Replies with the text and author of the comment they answer, null for first-level ones."""
    parent = comments.select("platform", F.col("comment_id").alias("parent_comment_id"), F.col("text").alias("parent_text"), F.col("author_id").alias("parent_author_id"))
    return comments.join(parent, ["platform", "parent_comment_id"], "left")
