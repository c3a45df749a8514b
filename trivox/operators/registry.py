"""Known opportunities: candidates for the same one, evidence that is added, duplicates that lead to a primary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trivox.functions.lineage import cut


def exact_groups(df: DataFrame, digest: str, key: str, source: str) -> DataFrame:
    """Digests that occur in two sources or more, with the smallest key."""
    return df.groupBy(digest, source).agg(F.min(key).alias("_k"), F.count("*").alias("_n")).groupBy(digest).agg(F.count(source).alias("sources"), F.sum("_n").alias("n_rows"), F.min("_k").alias("first_key")).where("sources >= 2")


def candidate_pairs(new: DataFrame, known: DataFrame, block: list[str]) -> DataFrame:
    """Pairs to be judged: equal blocking columns, such as problem and solution classes. Lexical likeness merges nothing."""
    return new.alias("n").join(known.select(*block, F.col("opportunity_id").alias("known_id")), block)


def routed(new: DataFrame, verdicts: DataFrame) -> DataFrame:
    """New opportunities with ``primary_id``: the smallest known one that a verdict calls both the same problem and the
    same solution direction, or their own."""
    same = verdicts.where("same_problem and same_solution").groupBy("opportunity_id").agg(F.min("known_id").alias("primary_id"))
    return new.join(same, "opportunity_id", "left").withColumn("primary_id", F.coalesce("primary_id", "opportunity_id"))


def merged_evidence(known: DataFrame, new: DataFrame, routes: DataFrame) -> DataFrame:
    """Evidence of both, each new row under its primary, one row for each (opportunity, platform, comment); rows that were
    there stay as they are."""
    moved = new.join(routes.select("opportunity_id", "primary_id"), "opportunity_id").withColumn("opportunity_id", F.col("primary_id")).select(*known.columns)
    both = known.withColumn("_new", F.lit(0)).unionByName(moved.withColumn("_new", F.lit(1)))
    w = Window.partitionBy("opportunity_id", "platform", "comment_id").orderBy("_new", "video_id")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_new")


def opportunity_ids(clusters: DataFrame) -> DataFrame:
    """Clusters with ``opportunity_id``, which follows from platform, video and cluster: a run that is repeated makes the
    same opportunities and not new ones."""
    return clusters.withColumn("opportunity_id", F.sha2(F.concat_ws("\u0001", "platform", "video_id", "cluster_id"), 256))


def merged_by_hand(wanted: DataFrame, relations: DataFrame, opportunities: DataFrame, at) -> tuple[DataFrame, DataFrame]:
    """``(relations, audit)`` to append for ``wanted(from_id, to_id, actor)``: one opportunity declared a duplicate.

    Both must exist and differ; one that already leads elsewhere stays as it is, and of several wishes for one the
    smallest target counts. Nothing is deleted: the relation is the trace, and ``primaries`` follows it.
    """
    ids = opportunities.select("opportunity_id").distinct()
    known = relations.where("type = 'duplicate'").select("from_id").distinct()
    one = wanted.where("from_id <> to_id").groupBy("from_id").agg(F.min(F.struct("to_id", "actor")).alias("_w")).select("from_id", "_w.*")
    good = one.join(ids.withColumnRenamed("opportunity_id", "from_id"), "from_id", "left_semi").join(ids.withColumnRenamed("opportunity_id", "to_id"), "to_id", "left_semi").join(known, "from_id", "left_anti")
    made = good.select("from_id", "to_id", F.lit("duplicate").alias("type"), F.lit(at).alias("at"))
    name = F.sha2(F.concat_ws("\u0001", F.lit("merge"), "from_id", "to_id"), 256)
    audit = good.select(name.alias("event_id"), F.lit(at).alias("at"), "actor", F.lit("merge.duplicate").alias("action"), F.col("from_id").alias("object_id"), F.lit(None).cast("string").alias("before"), F.col("to_id").alias("after"))
    return made, audit


def primaries(relations: DataFrame, rounds: int = 32) -> DataFrame:
    """``(from_id, primary_id)``: where each duplicate leads in the end.

    Chains are followed by doubling until nothing moves, so a round halves what is left of the longest one; each ends in
    a checkpoint. Of several relations of one duplicate the smallest target counts. A chain that still moves after
    ``rounds`` leads round in a circle and is refused.
    """
    at = cut(relations.where("type = 'duplicate'").groupBy("from_id").agg(F.min("to_id").alias("primary_id")))
    for _ in range(rounds):
        on = at.select(F.col("from_id").alias("primary_id"), F.col("primary_id").alias("_p"))
        moved = cut(at.join(on, "primary_id", "left").select("from_id", F.coalesce("_p", "primary_id").alias("primary_id"), F.col("_p").isNotNull().alias("_moved")))
        at = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return at
    raise ValueError("duplicates lead round in a circle")


def with_evidence(opportunities: DataFrame, evidence: DataFrame, videos: DataFrame) -> DataFrame:
    """Each opportunity with its evidence in context; those whose raw video is gone keep what the evidence has."""
    shown = evidence.join(videos.select("platform", "video_id", "title", "url"), ["platform", "video_id"], "left")
    rows = shown.groupBy("opportunity_id").agg(F.sort_array(F.collect_list(F.struct("platform", "video_id", "comment_id", "anon_author", "text", "title", "url"))).alias("evidence"), F.count_distinct("anon_author").alias("users"))
    return opportunities.join(rows, "opportunity_id", "left")
