"""What a person does, as whole commits: the change and its audit row appear together, or nothing does."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivox.operators import registry, workflow
from trivox.sources import files
from trivox.sources.landing import Settings
from trivox.sources.store import Changes, Conflict, Store

#: How often an act is judged again when another writer was first.
TRIES = 5


def acted(store: Store, work: Callable[[Changes], DataFrame | None], tries: int = TRIES) -> DataFrame | None:
    """Commits what ``work`` changes. If another writer changed one of the tables meanwhile, it is judged again by what is
    there now, so a rule that no longer holds refuses it."""
    for i in range(tries):
        changes = store.changes()
        told = work(changes)
        try:
            if changes.tables:
                changes.commit()
            return told
        except Conflict:
            if i + 1 == tries:
                raise
    return None


def _audited(changes: Changes, rows: DataFrame, action: Column, at: Column, before: Column, after: Column, actor: Column, *key: Column | str) -> None:
    """An audit row for each of ``rows``, named by what it is about and the log's version, so it is written once."""
    name = F.sha2(F.concat_ws("\u0001", F.lit(str(changes.base.version)), action, *[F.col(k).cast("string") if isinstance(k, str) else k for k in key]), 256)
    changes.add("audit_event", rows.select(name.alias("event_id"), at.alias("at"), actor.alias("actor"), action.alias("action"), F.col("opportunity_id").alias("object_id"), before.cast("string").alias("before"), after.cast("string").alias("after")))


def progress(changes: Changes) -> DataFrame:
    """``workflow.checklist`` of what the store has."""
    stages = workflow.current_stage(changes.read("lifecycle_transition"))
    return workflow.checklist(stages, changes.read("stage_checklist"), changes.read("stage_conclusion"), workflow.definitions(changes.store.spark))


def moved(store: Store, requests: DataFrame, at) -> DataFrame:
    """Makes the moves of ``requests(opportunity_id, to_stage, reason, actor)`` that the rules allow; the refused ones, with
    ``refused_by``. An end or a return from one is audited as a decision, another move as a change of stage."""
    at = F.lit(at)

    def work(changes: Changes) -> DataFrame:
        before = changes.read("lifecycle_transition")
        taken, refused = workflow.to_append(workflow.checked(requests, before, progress(changes)), at)
        taken = store.spark.createDataFrame(taken.collect(), taken.schema)  # what a person asked for at once
        refused = store.spark.createDataFrame(refused.collect(), refused.schema)
        if not taken.isEmpty():
            changes.add("lifecycle_transition", taken)
            ends = F.col("to_stage").isin(*workflow.ENDS) | F.coalesce(F.col("from_stage").isin(*workflow.ENDS), F.lit(False))
            _audited(changes, taken, F.when(ends, "decision.move").otherwise("stage.move"), at, F.col("from_stage"), F.col("to_stage"), F.col("actor"), "opportunity_id", "seq")
        return refused

    return acted(store, work)


def ticked(store: Store, ticks: DataFrame, at) -> DataFrame:
    """Sets the items of ``ticks(opportunity_id, stage, item_no, done, actor)``; those that are refused, with ``refused_by``:
    no such item, a stage that is not open yet, or an opportunity that has ended. Of several for one item the smallest
    counts. Nothing else is ticked and nobody is moved by it."""
    at, key = F.lit(at), ["opportunity_id", "stage", "item_no"]

    def work(changes: Changes) -> DataFrame:
        now = workflow.current_stage(changes.read("lifecycle_transition")).select("opportunity_id", F.col("stage").alias("_now"))
        order = F.create_map(*[x for i, s in enumerate(workflow.STAGES) for x in (F.lit(s), F.lit(i))])
        one = ticks.groupBy(*key).agg(F.min(F.struct("done", "actor")).alias("_t")).select(*key, "_t.*")
        known = workflow.definitions(store.spark).select("stage", "item_no", F.lit(True).alias("_item"))
        joined = one.join(now, "opportunity_id", "left").join(F.broadcast(known), ["stage", "item_no"], "left")
        why = F.when(F.col("_item").isNull(), "no_item").when(F.col("_now").isNull(), "not_created").when(F.col("_now").isin(*workflow.ENDS), "ended").when(order[F.col("stage")] > order[F.col("_now")], "not_open").when(~F.coalesce(F.col("actor") == "user", F.lit(False)), "not_a_person")
        judged = joined.withColumn("refused_by", why)
        judged = store.spark.createDataFrame(judged.collect(), judged.schema)
        good = judged.where("refused_by is null")
        old = changes.read("stage_checklist")
        new = good.join(old.select(*key, F.col("done").alias("_was")), key, "left").where(~F.col("done").eqNullSafe(F.coalesce("_was", F.lit(False))))
        if not new.isEmpty():
            _audited(changes, new, F.when(F.col("done"), "checklist.tick").otherwise("checklist.untick"), at, F.coalesce("_was", F.lit(False)), F.col("done"), F.col("actor"), *key)
            changes.put("stage_checklist", old.join(new.select(*key), key, "left_anti").unionByName(new.select(*old.columns)))
        return judged.where("refused_by is not null").select(*key, "refused_by")

    return acted(store, work)


def merged(store: Store, wanted: DataFrame, at) -> None:
    """Declares duplicates, ``wanted(from_id, to_id, actor)``: the relation, its audit row, and the evidence of the
    duplicate under the primary as well. Nothing is deleted, and no stage changes."""

    def work(changes: Changes) -> None:
        made, audit = registry.merged_by_hand(wanted, changes.read("opportunity_relation"), changes.read("opportunity"), at)
        made = store.spark.createDataFrame(made.collect(), made.schema)
        if made.isEmpty():
            return
        evidence = changes.read("opportunity_evidence")
        changes.add("opportunity_relation", made)
        changes.add("audit_event", audit)
        routes = registry.primaries(changes.read("opportunity_relation")).withColumnRenamed("from_id", "opportunity_id").join(made.select(F.col("from_id").alias("opportunity_id")), "opportunity_id", "left_semi")
        moved = evidence.join(routes, "opportunity_id").withColumn("opportunity_id", F.col("primary_id")).withColumn("is_representative", F.lit(False)).drop("primary_id")
        changes.add("opportunity_evidence", moved.dropDuplicates(["opportunity_id", "platform", "comment_id"]))

    acted(store, work)


def noted(store: Store, changed: DataFrame, at) -> None:
    """Appends the versions that ``changed(note_id, action, text, position)`` makes; what a person wrote is not overwritten."""

    def work(changes: Changes) -> None:
        rows = workflow.note_changes(changes.read("stage_note"), changed, F.lit(at))
        if not rows.isEmpty():
            changes.add("stage_note", rows)

    acted(store, work)


def configured(store: Store, at, actor: str = "user", **said) -> Settings:
    """Writes settings and returns them; a change of the schedule is audited. Limits must be above zero."""
    path = f"{store.base}/_settings"

    def load() -> Settings:
        found = files.names(store.spark, path)
        return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(files.text_of(store.spark, f"{path}/{found[-1]}")).items()}) if found else Settings()

    before = load()
    if not said:
        return before
    after = replace(before, **said)
    if min(after.comments_per_video, after.videos_per_run, after.comments_per_run) <= 0:
        raise ValueError("a limit must be above zero")
    n = len(files.names(store.spark, path))
    if not files.made_once(store.spark, f"{path}/{n:08d}.json", json.dumps(asdict(after))):
        raise Conflict("the settings were changed by another writer")
    if (before.schedule, before.timezone) != (after.schedule, after.timezone):

        def work(changes: Changes) -> None:
            row = (f"schedule-{n}", at, actor, "schedule.change", "schedule", f"{before.schedule} {before.timezone}", f"{after.schedule} {after.timezone}")
            changes.add("audit_event", store.spark.createDataFrame([row], "event_id string, at timestamp, actor string, action string, object_id string, before string, after string"))

        acted(store, work)
    return after
