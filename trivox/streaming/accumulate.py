"""The gate over a stream of comments, exact and within the retention window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trivox.functions.text import RETENTION_DAYS
from trivox.operators.consensus import PEOPLE

_DAY_US = 86_400_000_000


def latest_people(known: dict[str, int], rows: pd.DataFrame, least: int, window_us: int) -> dict[str, int]:
    """The last times of the ``least`` people seen last, without those more than a window behind the newest.

    Whether ``least`` people are inside a window that ends now depends on nobody else, so a group's state stays small
    however many people it has.
    """
    last = rows.groupby("_person")["_us"].max()
    both = known | {p: max(int(t), known.get(p, int(t))) for p, t in last.items()}
    newest = max(both.values())
    inside = sorted(((t, p) for p, t in both.items() if t >= newest - window_us), reverse=True)
    return {p: t for t, p in inside[:least]}


def gate_stream(comments: DataFrame, group: list[str], person: str, at: str, least: int = PEOPLE, days: int = RETENTION_DAYS, delay: str = "10 days") -> DataFrame:
    """``(*group, users, reached_at)`` of groups, as they come to have ``least`` different people within ``days`` days.

    A person counts by their last row, once, and no longer than the window: three rows of one person over a month are
    one person. ``users`` is ``least``, ``reached_at`` the newest row that was seen when the group passed. A group passes
    once; when all of its people are behind the watermark (``delay``) its state is dropped and it may pass again. Rows
    without a person or a time do not count. The output mode is append.
    """
    window_us = days * _DAY_US
    known = comments.where(F.col(person).isNotNull() & F.col(at).isNotNull()).withColumn("_at", F.col(at).cast("timestamp"))
    rows = known.withWatermark("_at", delay).select(*group, F.col(person).cast("string").alias("_person"), F.unix_micros("_at").alias("_us"), "_at")
    kinds = ", ".join(f"`{c}` {comments.schema[c].dataType.simpleString()}" for c in group)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        people, times, passed = state.get if state.exists else ([], [], False)
        held = dict(zip(people, times, strict=True))
        for rows in frames:
            held = latest_people(held, rows, least, window_us)
            if len(held) >= least and not passed:
                passed = True
                yield pd.DataFrame([(*key, least, max(held.values()))], columns=[*group, "users", "_us"])
        state.update((list(held), list(held.values()), passed))
        state.setTimeoutTimestamp(max(max(held.values()) // 1000 + window_us // 1000, state.getCurrentWatermarkMs() + 1))

    made = rows.groupBy(*group).applyInPandasWithState(step, f"{kinds}, users long, _us long", "people array<string>, times array<long>, passed boolean", "append", GroupStateTimeout.EventTimeTimeout)
    return made.select(*group, "users", F.timestamp_micros("_us").alias("reached_at"))


def once_per_batch(write, done):
    """A ``foreachBatch`` function that writes each batch once: ``done(batch_id)`` says whether it was committed."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not done(batch_id):
            write(batch, batch_id)

    return run
