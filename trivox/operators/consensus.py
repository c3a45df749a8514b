"""The consensus gate: at least three different people under one item, exactly counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trivox.functions.lineage import cut

PEOPLE = 3


def people(rows: DataFrame, group: list[str], person: str) -> DataFrame:
    """``(*group, users, n_rows)``: different people and rows. Rows without a person do not count as people.

    People are made distinct first, so a hot group's rows are spread over its people before they meet.
    """
    each = rows.groupBy(*group, person).agg(F.count("*").alias("_c"))
    return each.groupBy(*group).agg(F.count(person).alias("users"), F.sum("_c").alias("n_rows"))


def gate(rows: DataFrame, group: list[str], person: str, least: int = PEOPLE) -> DataFrame:
    """Groups with ``least`` people or more. The group holds the item, so people are never pooled across items."""
    return people(rows, group, person).where(F.col("users") >= least)


def clusters(members: DataFrame, comments: DataFrame) -> DataFrame:
    """``(platform, video_id, cluster_id, users, passed)`` of every cluster that a judgement made.

    ``members`` are stored judgements; one that is not stable, or says nothing, fails. ``comments`` are those within the
    retention window with ``countable`` and ``author_key``; a comment may be in several clusters.
    """
    group = ["platform", "video_id", "cluster_id"]
    # a comment that came more than once counts by its smallest row, whichever was read first
    fact = F.struct("video_id", "countable", "author_key")
    facts = comments.groupBy("platform", "comment_id").agg(F.min(fact).alias("_f")).select("platform", "comment_id", "_f.*")
    joined = members.join(facts, ["platform", "video_id", "comment_id"], "left")
    person = F.when(F.coalesce("countable", F.lit(False)), F.col("author_key"))
    each = joined.withColumn("_person", person).groupBy(*group, "_person").agg(F.min(F.coalesce("stable", F.lit(False))).alias("_stable"))
    made = each.groupBy(*group).agg(F.count("_person").alias("users"), F.min("_stable").alias("_stable"))
    return made.select(*group, "users", ((F.col("users") >= PEOPLE) & F.col("_stable")).alias("passed"))


def carried(new: DataFrame, known: DataFrame, same: DataFrame, live: DataFrame) -> DataFrame:
    """Members of clusters after a run: new comments join a suspected cluster of the same video that is still known.

    ``same(platform, video_id, cluster_id, known_id)`` are stored judgements that a new cluster is an older one's need;
    the smallest such id counts. Members of ``known`` stay while their comments are in ``live``, so a third person counts
    within the retention window and not behind it. One row for each cluster and comment; it is stable if all rows are.
    """
    item = ["platform", "video_id"]
    ids = known.select(*item, F.col("cluster_id").alias("known_id")).distinct()
    route = same.join(ids, [*item, "known_id"], "left_semi").groupBy(*item, "cluster_id").agg(F.min("known_id").alias("_to"))
    moved = new.join(route, [*item, "cluster_id"], "left").withColumn("cluster_id", F.coalesce("_to", "cluster_id")).select(*new.columns)
    kept = known.join(live.select(*item, "comment_id"), [*item, "comment_id"], "left_semi").select(*new.columns)
    rest = [c for c in new.columns if c not in (*item, "cluster_id", "comment_id", "stable")]
    stable = F.min(F.coalesce("stable", F.lit(False))).alias("stable")
    return kept.unionByName(moved).groupBy(*item, "cluster_id", "comment_id").agg(stable, *[F.max(c).alias(c) for c in rest]).select(*new.columns)


def first_of_each(rows: DataFrame, group: list[str], person: str, order: list[str]) -> DataFrame:
    """Each known person's first row in each group: all rows that may be evidence, dealt out by group and person."""
    own = Window.partitionBy(*group, person).orderBy(*order)
    return rows.where(F.col(person).isNotNull()).withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")


def evidence(rows: DataFrame, group: list[str], person: str, order: list[str], k: int = PEOPLE) -> DataFrame:
    """The first ``k`` rows of each group by different people: each person's first row, then the first of those."""
    first = first_of_each(rows, group, person, order)
    return first.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("place") <= k)


def gated_evidence(rows: DataFrame, group: list[str], person: str, order: list[str], k: int = PEOPLE, least: int = PEOPLE) -> DataFrame:
    """``(*group, person, *order, place, users)``: each known person's first row in the groups that pass the gate, the
    first ``k`` of them. ``order`` tells rows apart.

    One aggregation finds the first rows, partly before the shuffle. Of these each task passes on the first ``k`` of a
    group and the number of its people, so a group that everybody is in is a few rows where it meets.
    """
    first = rows.where(F.col(person).isNotNull()).groupBy(*group, person).agg(F.min(F.struct(*order)).alias("_f"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_f"))
    top = first.withColumn("place", place).where(F.col("place") <= k)
    users = first.groupBy(*group).agg(F.count("*").alias("users")).where(F.col("users") >= least)
    return top.join(users, group).select(*group, person, *[F.col("_f")[o].alias(o) for o in order], "place", "users")


def cited(rows: DataFrame, group: list[str], person: str, order: list[str], least: int = PEOPLE) -> DataFrame:
    """``(*group, person, *order)``: each known person's first row in the groups that pass the gate, all of them: what
    evidence may cite. No order among people is needed, so no group meets in one place."""
    first = rows.where(F.col(person).isNotNull()).groupBy(*group, person).agg(F.min(F.struct(*order)).alias("_f"))
    users = first.groupBy(*group).agg(F.count("*").alias("_u")).where(F.col("_u") >= least)
    return first.join(users, group, "left_semi").select(*group, person, *[F.col("_f")[o].alias(o) for o in order])


def reached(rows: DataFrame, group: list[str], person: str, at: str, least: int = PEOPLE) -> DataFrame:
    """``(*group, reached_at)``: when each group first had ``least`` people, as rows add up over days."""
    seen = rows.where(F.col(person).isNotNull()).groupBy(*group, person).agg(F.min(at).alias("reached_at"))
    w = Window.partitionBy(*group).orderBy("reached_at", person)
    return seen.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == least).select(*group, "reached_at")


def collected(found: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Evidence rows of a group as one ordered array; a group has few, as ``evidence`` bounds them."""
    return found.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("place", *columns))).alias("evidence"))


_ITEM = ["platform", "video_id"]
_SAME = "platform string, video_id string, cluster_id string, known_id string"


def _signed(members: DataFrame) -> DataFrame:
    """Clusters with ``sign``, which tells them apart by their comments and not by their numbers."""
    comment = F.col("comment_id")
    return members.groupBy(*_ITEM, "cluster_id").agg(F.struct(F.min(comment).alias("first"), F.count("*").alias("n"), F.sum(F.xxhash64(comment).cast("decimal(38,0)")).alias("all")).alias("sign"))


def assigned(new: DataFrame, known: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """``(platform, video_id, cluster_id, known_id)``: which older cluster of the same video each new one is.

    A new cluster may be one that it shares comments with, or that a stored verdict ``(platform, video_id, cluster_id,
    known_id)`` calls the same need. Each is assigned once at most, on both sides, the pair with the most shared comments
    first, then the smaller known id, then the new cluster's comments: a total order, which a new numbering of clusters
    doesn't change. Pairs that are the best of both their clusters are taken together, round by round, until none is left.
    """
    met = new.select(*_ITEM, "cluster_id", "comment_id").distinct().join(known.select(*_ITEM, F.col("cluster_id").alias("known_id"), "comment_id").distinct(), [*_ITEM, "comment_id"])
    edges = met.groupBy(*_ITEM, "cluster_id", "known_id").agg(F.count("*").alias("shared"))
    if verdicts is not None:
        there = known.select(*_ITEM, F.col("cluster_id").alias("known_id")).distinct()
        told = verdicts.select(*_ITEM, "cluster_id", "known_id").distinct().join(there, [*_ITEM, "known_id"], "left_semi")
        edges = edges.unionByName(told.withColumn("shared", F.lit(0).cast("long"))).groupBy(*_ITEM, "cluster_id", "known_id").agg(F.max("shared").alias("shared"))
    order = F.struct((-F.col("shared")).alias("less"), "known_id", "sign", "cluster_id").alias("order")
    left = cut(edges.join(_signed(new), [*_ITEM, "cluster_id"]).select(*_ITEM, "cluster_id", "known_id", order))
    done: list[DataFrame] = []
    while not left.isEmpty():
        best = lambda side: left.groupBy(*_ITEM, side).agg(F.min("order").alias("order"))  # noqa: B023, E731
        taken = cut(best("cluster_id").join(best("known_id"), [*_ITEM, "order"]).select(*_ITEM, "cluster_id", "known_id"))
        done.append(taken)
        left = cut(left.join(taken, [*_ITEM, "cluster_id"], "left_anti").join(taken, [*_ITEM, "known_id"], "left_anti").select(*left.columns))
    return reduce(DataFrame.unionByName, done) if done else new.sparkSession.createDataFrame([], _SAME)


def identified(new: DataFrame, known: DataFrame, live: DataFrame, run: str, verdicts: DataFrame | None = None) -> DataFrame:
    """Members of all clusters after a run, under ids that last: ``new`` ones numbered anew, ``known`` with their ids.

    A new cluster gets the id of the older one that it is ``assigned`` to, or one minted from its comments and the run,
    which nothing changes later. A comment that was judged again is where the newer judgement puts it; the others stay
    while they are in ``live``.
    """
    name = F.sha2(F.concat_ws("\u0001", *_ITEM, F.col("sign.first"), F.col("sign.n").cast("string"), F.col("sign.all").cast("string"), F.lit(run)), 256)
    minted = _signed(new).select(*_ITEM, "cluster_id", name.alias("minted"))
    same = assigned(new, known, verdicts).join(minted, [*_ITEM, "cluster_id"]).select(*_ITEM, F.col("minted").alias("cluster_id"), "known_id")
    named = new.join(minted, [*_ITEM, "cluster_id"]).withColumn("cluster_id", F.col("minted")).select(*new.columns)
    untouched = live.join(new.select(*_ITEM, "comment_id"), [*_ITEM, "comment_id"], "left_anti")
    return carried(named, known.select(*new.columns), same, untouched)
