"""``python -m trivox COMMAND BASE`` over a store of tables: ``init``, ``status``, ``inbox``, ``cursors``, ``explore`` and ``schedule``."""

from __future__ import annotations

import argparse
import importlib
import json
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.functions.text import next_due
from trivox.operators import acts, reports, retention, runs, workflow
from trivox.operators.explore import explore
from trivox.sources.landing import Settings
from trivox.sources.schemas import SCHEMAS
from trivox.sources.store import Store


def init(spark: SparkSession, base: str) -> list[str]:
    """Makes the tables that are not there yet, empty, and returns their names; the others stay as they are."""
    changes = Store(spark, base).changes()
    made = [name for name in SCHEMAS if name not in changes.base.tables]
    changes.tables |= {name: [] for name in made}
    if made:
        changes.commit()
    return made


def status(spark: SparkSession, base: str, now: Column | None = None, timezone: str = Settings.timezone) -> dict:
    """The run under way, the last one that succeeded, and whether none did today; no run is caught up."""
    store = Store(spark, base)
    entry = store.entry()
    table = store.read("exploration_run", entry)
    one = lambda df: getattr(df.select("run_id").first(), "run_id", None)
    missed = reports.missed_today(table, F.current_timestamp() if now is None else now, timezone).first()["missed"]
    held = entry.owner if entry.owner is not None and entry.until > store.clock() else None
    return {"under_way": held or one(runs.current_run(table)), "last_success": one(reports.last_success(table)), "missed_today": missed}


def inbox(spark: SparkSession, base: str) -> DataFrame:
    """What nobody has decided on yet, newest first."""
    store = Store(spark, base)
    entry = store.entry()
    stages = workflow.current_stage(store.read("lifecycle_transition", entry))
    return reports.inbox(store.read("opportunity", entry), stages).select("opportunity_id", "title", "summary", "first_found_at")


def cursors(spark: SparkSession, base: str) -> DataFrame:
    """``(platform, video_id, cursor)``: behind what a crawl of a known video goes on."""
    found = retention.latest(Store(spark, base).read("content_fingerprint").where("kind = 'video'"))
    return found.select("platform", F.col("id").alias("video_id"), "cursor").orderBy("platform", "video_id")


def named(what: str) -> Callable:
    """The function that ``module:name`` says."""
    module, name = what.split(":")
    return getattr(importlib.import_module(module), name)


def daily(run: Callable[[datetime], str], settings: Settings, clock: Callable[[], datetime], sleep: Callable[[float], None], days: int | None = None) -> list[str]:
    """Runs once a day at the time of the settings, ``days`` times or for ever. What was missed is not caught up."""
    done: list[str] = []
    while days is None or len(done) < days:
        due = next_due(clock(), settings.schedule, settings.timezone)
        while (left := (due - clock()).total_seconds()) > 0:
            sleep(min(left, 60.0))
        done.append(run(clock()))
    return done


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trivox", description=__doc__)
    parser.add_argument("command", choices=["init", "status", "inbox", "cursors", "explore", "schedule"])
    parser.add_argument("base", help="folder of the tables, any path that Spark reads")
    parser.add_argument("--landing", help="folder of what the platforms' adapters landed")
    parser.add_argument("--settings", help="JSON file of settings, in place of those that the store has")
    parser.add_argument("--cluster", type=named, help="module:function that numbers the texts of one video")
    parser.add_argument("--describe", type=named, help="module:function that describes what texts have in common")
    parser.add_argument("--same", type=named, help="module:function that says whether two opportunities are one")
    parser.add_argument("--retry-of", help="a run whose failed stages are repeated")
    parser.add_argument("--days", type=int, help="how many daily runs, else without an end")
    said = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("trivox").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    settings = Settings.load(said.settings) if said.settings else acts.configured(Store(spark, said.base), None)

    def run(now: datetime) -> str:
        made = explore(spark, said.base, said.landing, settings, uuid.uuid4().hex, now, said.cluster, said.describe, same=said.same, retry_of=said.retry_of)
        print(json.dumps({"at": now.isoformat(), "state": made}), flush=True)
        return made

    if said.command in ("explore", "schedule"):
        if not (said.landing and said.cluster and said.describe):
            parser.error("a run needs --landing, --cluster and --describe")
        clock = lambda: datetime.now(timezone.utc)
        run(clock()) if said.command == "explore" else daily(run, settings, clock, time.sleep, said.days)
    elif said.command in ("inbox", "cursors"):
        for row in {"inbox": inbox, "cursors": cursors}[said.command](spark, said.base).toLocalIterator():
            print(json.dumps(row.asDict(), default=str, ensure_ascii=False))
    else:
        print(json.dumps({"init": init, "status": status}[said.command](spark, said.base), ensure_ascii=False))


if __name__ == "__main__":
    main()
