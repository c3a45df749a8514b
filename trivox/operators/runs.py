"""Running an exploration: one at a time, safe to cancel, bounded attempts, and what the audit must hold."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trivox.sources.schemas import AUDITED


def current_run(runs: DataFrame) -> DataFrame:
    """The run that is under way, one row or none: a second start returns it and starts nothing."""
    return runs.where("status in ('waiting', 'running')").orderBy("started_at", "run_id").limit(1)


def run_steps(steps: Iterable[tuple[str, Callable[[], None]]], cancelled: Callable[[], bool]) -> tuple[list[str], str | None]:
    """Run steps in order; ``(done, stopped_before)``. A cancel takes effect between steps, never inside a write, and what
    was committed stays."""
    done: list[str] = []
    for name, step in steps:
        if cancelled():
            return done, name
        step()
        done.append(name)
    return done, None


def repeated(steps: DataFrame, ledger: DataFrame) -> DataFrame:
    """The steps that a retry of each run repeats, of ``steps(run_id, platform, stage, place)``.

    ``ledger(run_id, platform, stage, state)`` says what a run did. A step that did not end as ``ok`` is repeated, and so
    is every step of a later place than one that is, as it worked on what that one left.
    """
    keys = ["run_id", "platform", "stage"]
    done = ledger.where("state = 'ok'").select(*keys).distinct().withColumn("_ok", F.lit(True))
    joined = steps.join(done, keys, "left")
    first = F.min(F.when(F.col("_ok").isNull(), F.col("place"))).over(Window.partitionBy("run_id"))
    return joined.withColumn("_first", first).where(F.col("_ok").isNull() | (F.col("place") > F.col("_first"))).drop("_ok", "_first")


def attempts(step: Callable[[], None], most: int = 3, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep, unless: type[Exception] | tuple = ()) -> str | None:
    """Try a step ``most`` times, waiting twice as long each time. Null if it went well, else the last error's text.

    An error of the kind ``unless`` is not tried again but raised."""
    error = None
    for i in range(most):
        try:
            step()
            return None
        except unless:
            raise
        except Exception as e:  # noqa: BLE001  any fault of a platform ends as its error text
            error = f"{type(e).__name__}: {e}"
            if i + 1 < most:
                sleep(wait * 2**i)
    return error


def audit_faults(events: DataFrame) -> DataFrame:
    """Audit rows that name no actor or object, or an action that is not audited."""
    kind = F.split("action", r"\.", 2)[0]
    return events.where(F.col("actor").isNull() | F.col("object_id").isNull() | F.col("at").isNull() | ~F.coalesce(kind.isin(*AUDITED), F.lit(False)))


def purge_sizes(rows: DataFrame, cited: DataFrame, keys: list[str], at: str, cutoff: DataFrame) -> DataFrame:
    """One row: ``live``, ``expired`` and ``to_purge`` (expired and not cited); ``cutoff`` has one row and column."""
    marks = cited.select(*keys).distinct().withColumn("_cited", F.lit(True))
    old = F.coalesce(F.col(at) < F.col("cutoff"), F.lit(False))
    # one row
    joined = rows.select(*keys, at).join(F.broadcast(cutoff.toDF("cutoff")), how="cross").join(marks, keys, "left")
    return joined.agg(F.count_if(~old).alias("live"), F.count_if(old).alias("expired"), F.count_if(old & F.col("_cited").isNull()).alias("to_purge"))
