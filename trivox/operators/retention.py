"""Fingerprints that stay, raw rows that go after ten days unless evidence cites them."""

from __future__ import annotations

from datetime import timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivox.functions.text import RETENTION_DAYS, author_hash, content_hash, expired


def fingerprints(comments: DataFrame, salt: str, outcome: str = "processed") -> DataFrame:
    """What stays of comments: hashes, first and last time, outcome. No text that can be read."""
    made = comments.select(
        "platform", F.lit("comment").alias("kind"), F.col("comment_id").alias("id"), author_hash(F.col("platform"), F.col("author_id"), salt).alias("author_hash"),
        content_hash(F.col("text")).alias("content_hash"), F.col("first_ingested_at").alias("at"),
    )
    return made.groupBy("platform", "kind", "id").agg(
        F.min_by("author_hash", "at").alias("author_hash"), F.max_by("content_hash", "at").alias("content_hash"), F.min("at").alias("first_seen"), F.max("at").alias("last_seen"),
        F.lit(outcome).alias("outcome"), F.lit(None).cast("string").alias("cursor"),
    )


def position(at, comment_id):
    """Where a comment stands in its video, as text that sorts: its time, then its id. Null without a time."""
    return F.when(at.isNotNull(), F.concat_ws("|", F.lpad(F.unix_micros(at.cast("timestamp")).cast("string"), 20, "0"), comment_id))


def cursors(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Fingerprints of videos, with the cursor up to which their comments were taken: what a crawl goes on behind."""
    last = comments.groupBy("platform", F.col("video_id").alias("id")).agg(F.max(position(F.col("commented_at"), F.col("comment_id"))).alias("cursor"), F.min("first_ingested_at").alias("a"), F.max("first_ingested_at").alias("b"))
    seen = videos.groupBy("platform", F.col("video_id").alias("id")).agg(F.min("first_ingested_at").alias("a"), F.max("first_ingested_at").alias("b"), F.lit(None).cast("string").alias("cursor"))
    both = last.unionByName(seen).groupBy("platform", "id").agg(F.min("a").alias("first_seen"), F.max("b").alias("last_seen"), F.max("cursor").alias("cursor"))
    none = F.lit(None).cast("string")
    return both.select("platform", F.lit("video").alias("kind"), "id", none.alias("author_hash"), none.alias("content_hash"), "first_seen", "last_seen", F.lit("fetched").alias("outcome"), "cursor")


#: Outcomes in the order in which they follow each other.
OUTCOMES = ("fetched", "processed")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """One fingerprint for each id: first time of all, the rest from the latest."""
    return latest(old.unionByName(new))


def latest(both: DataFrame) -> DataFrame:
    """One fingerprint for each id of a table that is only added to. Of rows of one time the further outcome counts, and
    the furthest cursor of all."""
    order = F.struct("last_seen", F.coalesce(F.array_position(F.array(*map(F.lit, OUTCOMES)), F.col("outcome")), F.lit(0)))
    last = lambda c: F.max_by(c, order).alias(c)
    made = both.groupBy("platform", "kind", "id").agg(last("author_hash"), last("content_hash"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen_"), last("outcome"), F.max("cursor").alias("cursor"))
    return made.withColumnRenamed("last_seen_", "last_seen").select(*both.columns)


def purge(rows: DataFrame, evidence: DataFrame, keys: list[str], now, days: int = RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """``(kept, gone)``: gone are rows older than ``days`` days that no evidence cites by ``keys``."""
    cited = evidence.select(*keys).distinct().withColumn("_cited", F.lit(True))
    marked = rows.join(cited, keys, "left")
    going = expired(F.col("first_ingested_at"), F.lit(now)) if days == RETENTION_DAYS else expired(F.col("first_ingested_at"), F.lit(now), days)
    going = F.coalesce(going, F.lit(False)) & F.col("_cited").isNull()
    return marked.where(~going).drop("_cited"), marked.where(going).drop("_cited")


def purge_parts(changes, name: str, evidence: DataFrame, keys: list[str], now) -> int:
    """Replaces the parts of a raw table that hold expired days by what ``purge`` keeps of them; how many rows went.

    Younger days are not read. Nothing to purge writes nothing, and a fault before the commit leaves all as it was, so the
    next cycle purges the same rows again. The old files go with the store's ``vacuum``.
    """
    last = int(now.replace(tzinfo=now.tzinfo or timezone.utc).timestamp() // 86_400) - RETENTION_DAYS
    old = [p for p in changes.parts(name) if p[1] is not None and p[1] <= last]
    if not old:
        return 0
    kept, gone = purge(changes.store.read(name, parts=old), evidence, keys, now)
    n = gone.count()
    if n:
        changes.swap(name, old, kept)
    return n


def live(rows: DataFrame, now, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows inside the window, those that the gate may count."""
    return rows.where(~expired(F.col("first_ingested_at"), F.lit(now), days))
