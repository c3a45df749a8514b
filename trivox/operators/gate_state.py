"""The consensus gate from a small state that deltas are merged into, equal to counting the whole window again.

Whether a group has ``least`` people inside a window depends only on the people seen last: each person's last time, and of
these the ``least`` latest. So a group's state has that many rows however many people it has, states merge in any order,
and what is older than the window can go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trivox.functions.text import RETENTION_DAYS, expired
from trivox.operators.consensus import PEOPLE
from trivox.sources.store import Store


def _latest(rows: DataFrame, group: list[str], least: int) -> DataFrame:
    each = rows.groupBy(*group, "person").agg(F.max("last_at").alias("last_at"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("last_at"), "person"))
    return each.withColumn("_n", place).where(F.col("_n") <= least).drop("_n")


def state_of(rows: DataFrame, group: list[str], person: str, at: str, least: int = PEOPLE) -> DataFrame:
    """``(*group, person, last_at)``: the state that some rows make. Rows without a person or a time do not count."""
    known = rows.where(F.col(person).isNotNull() & F.col(at).isNotNull())
    return _latest(known.select(*group, F.col(person).cast("string").alias("person"), F.col(at).alias("last_at")), group, least)


def merged(state: DataFrame, delta: DataFrame, group: list[str], now=None, days: int = RETENTION_DAYS, least: int = PEOPLE) -> DataFrame:
    """The state of both; with ``now`` without what is behind the window and so can never count again."""
    both = state.unionByName(delta.select(*state.columns))
    if now is not None:
        both = both.where(~expired(F.col("last_at"), F.lit(now), days))
    return _latest(both, group, least)


def without(state: DataFrame, groups: DataFrame, group: list[str]) -> DataFrame:
    """The state but for some groups, such as clusters that were judged anew and whose rows are merged again."""
    return state.join(groups.select(*group).distinct(), group, "left_anti")


def passing(state: DataFrame, group: list[str], now, days: int = RETENTION_DAYS, least: int = PEOPLE) -> DataFrame:
    """The groups that have ``least`` people inside the window that ends at ``now``."""
    inside = state.where(~expired(F.col("last_at"), F.lit(now), days))
    return inside.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select(*group)


def gate_batches(store: Store, stream: str, least: int = PEOPLE, days: int = RETENTION_DAYS):
    """A ``foreachBatch`` function that merges batches of ``(platform, video_id, cluster_id, person, at)`` into the stored
    state, each once: the state and the batch's mark are one commit. What is behind the newest time seen goes."""
    group = ["platform", "video_id", "cluster_id"]

    def run(batch: DataFrame, number: int) -> None:
        changes = store.changes()
        if changes.base.marks.get(stream, -1) >= number:
            return
        state, delta = changes.read("gate_state"), state_of(batch, group, "person", "at", least)
        newest = state.select("last_at").unionByName(delta.select("last_at")).agg(F.max("last_at")).first()[0]
        changes.put("gate_state", merged(state, delta, group, newest, days, least))
        changes.mark(stream, number)
        changes.commit()

    return run
