"""Acts of a person on the store: moves, ticks, merges, notes and settings, each with its audit row."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trivox import __main__ as commands
from trivox.operators import acts, reports, runs, workflow
from trivox.sources import schemas
from trivox.sources.store import Conflict, Store

T0 = datetime(2026, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    commands.init(spark, store.base)
    changes = store.changes()
    of = lambda name, rows: changes.put(name, spark.createDataFrame([tuple(r.get(c.split(" ")[0]) for c in schemas.SCHEMAS[name].split(", ")) for r in rows], schemas.SCHEMAS[name]))
    of("opportunity", [{"opportunity_id": o, "title": o, "first_found_at": T0 + timedelta(days=i)} for i, o in enumerate("pqr")])
    of("lifecycle_transition", [{"opportunity_id": o, "seq": 1, "to_stage": "new", "actor": "system", "at": T0} for o in "pqr"])
    of("opportunity_evidence", [{"opportunity_id": o, "platform": "d", "comment_id": c, "anon_author": c, "text": c, "is_representative": True} for o, c in ("pa", "pb", "qb", "qc")])
    of("stage_note", [{"note_id": "n", "version": 1, "opportunity_id": "p", "stage": "feasibility", "text": "one", "position": 1}])
    changes.commit()
    return store


def ask(store, *rows):
    return store.spark.createDataFrame(rows, "opportunity_id string, to_stage string, reason string, actor string")


def test_moves_and_ticks(spark, store):
    refused = acts.moved(store, ask(store, ("p", "feasibility", None, "user"), ("q", "abandoned", " ", "user"), ("r", "requirements", None, "user")), T0)
    assert {(r.opportunity_id, r.refused_by) for r in refused.collect()} == {("q", "no_reason"), ("r", "not_next")}
    tick = lambda *rows: acts.ticked(store, spark.createDataFrame(rows, "opportunity_id string, stage string, item_no int, done boolean, actor string"), T0)
    later = workflow.STAGES[-1]
    told = tick(("p", "feasibility", 1, True, "user"), ("p", "feasibility", 99, True, "user"), ("p", later, 1, True, "user"), ("x", "feasibility", 1, True, "user"), ("p", "feasibility", 2, True, "system"))
    assert sorted(r.refused_by for r in told.collect()) == ["no_item", "not_a_person", "not_created", "not_open"]
    tick(("p", "feasibility", 1, True, "user"))  # nothing new, no second row
    acts.moved(store, ask(store, ("q", "deferred", "later", "user")), T0)
    acts.moved(store, ask(store, ("q", "new", None, "user")), T0)
    audit = sorted((r.action, r.object_id, r.before, r.after) for r in store.read("audit_event").collect())
    assert audit == [("checklist.tick", "p", "false", "true"), ("decision.move", "q", "deferred", "new"), ("decision.move", "q", "new", "deferred"), ("stage.move", "p", "new", "feasibility")]
    assert runs.audit_faults(store.read("audit_event")).isEmpty()


def test_an_act_is_judged_again(spark, store):
    """Two writers at once: the second sees what the first did, and the rule refuses it."""
    inner = acts.progress

    def first_another(changes):
        acts.progress = inner
        acts.moved(store, ask(store, ("p", "abandoned", "no", "user")), T0)
        return inner(changes)

    acts.progress = first_another
    try:
        refused = acts.moved(store, ask(store, ("p", "feasibility", None, "user")), T0)
    finally:
        acts.progress = inner
    assert [r.refused_by for r in refused.collect()] == ["ended"]
    assert store.read("lifecycle_transition").where("opportunity_id = 'p'").count() == 2


def test_merge_and_notes(spark, store):
    acts.merged(store, spark.createDataFrame([("q", "p", "user"), ("r", "r", "user")], "from_id string, to_id string, actor string"), T0)
    cited = lambda o: {r.comment_id: r.is_representative for r in store.read("opportunity_evidence").where(F.col("opportunity_id") == o).collect()}
    assert cited("p") == {"a": True, "b": True, "c": False} and set(cited("q")) == {"b", "c"}
    assert store.read("audit_event").where("action = 'merge.duplicate'").count() == 1
    change = lambda *rows: spark.createDataFrame(rows, "note_id string, action string, text string, position int")
    acts.noted(store, change(("n", "edit", "two", None)), T0)
    acts.noted(store, change(("n", "edit", "  ", None)), T0)
    assert sorted((r.version, r.text) for r in store.read("stage_note").collect()) == [(1, "one"), (2, "two")]
    page = {r.opportunity_id: r for r in reports.detail(*[store.read(n) for n in ("opportunity", "opportunity_chain", "opportunity_evidence", "lifecycle_transition", "stage_note")]).collect()}
    assert page["p"].users == 3 and page["p"].n_notes == 1 and [e.comment_id for e in page["p"].evidence] == ["a", "b", "c"] and page["r"].users == 0
    assert [m.to_stage for m in page["r"].moves] == ["new"] and page["r"].chain is None


def test_settings(spark, store):
    assert acts.configured(store, T0).videos_per_run == 50
    assert acts.configured(store, T0, videos_per_run=7).videos_per_run == 7 and store.read("audit_event").isEmpty()
    assert acts.configured(store, T0, schedule="21:30", platforms=("douyin",)).videos_per_run == 7
    kept = acts.configured(store, T0)
    assert (kept.schedule, kept.platforms, kept.videos_per_run) == ("21:30", ("douyin",), 7)
    assert [(r.action, r.before, r.after) for r in store.read("audit_event").collect()] == [("schedule.change", "09:00 UTC", "21:30 UTC")]
    with pytest.raises(ValueError):
        acts.configured(store, T0, videos_per_run=0)
    assert issubclass(Conflict, RuntimeError)


def test_lists_are_in_order(spark):
    at = lambda d: T0 + timedelta(days=d)
    found = spark.createDataFrame([("a", at(1)), ("b", at(3)), ("c", at(3)), ("d", at(2)), ("e", at(9))], "opportunity_id string, first_found_at timestamp")
    stages = lambda rows: spark.createDataFrame(rows, "opportunity_id string, stage string, updated_at timestamp, came_from string")
    names = lambda df, key="opportunity_id": [r[key] for r in df.collect()]
    assert names(reports.inbox(found, stages([(o, "new", at(0), None) for o in "abcd"] + [("e", "develop", at(0), None)]))) == ["b", "c", "d", "a"]
    assert names(reports.newest(found, "first_found_at", "opportunity_id", 3)) == ["e", "b", "c"]
    inside = stages([("a", "feasibility", at(1), None), ("b", "feasibility", at(5), None), ("c", "requirements", at(5), None), ("d", "new", at(9), None)])
    assert names(reports.incubating(found, inside)) == ["b", "c", "a"]
    ended = stages([("a", "deferred", at(1), "new"), ("b", "develop", at(2), "decision_ready"), ("c", "abandoned", at(2), "new")])
    moves = spark.createDataFrame([("a", 2, "x", at(4)), ("b", 2, "y", at(6)), ("c", 2, "z", at(6))], "opportunity_id string, seq long, reason string, at timestamp")
    assert names(reports.archive(found, ended, moves)) == ["b", "c", "a"]
    of_runs = spark.createDataFrame([("1", at(1)), ("2", at(2)), ("3", at(2)), ("4", None)], "run_id string, started_at timestamp").withColumns({n: F.lit(0).cast("long") for n in ("videos", "comments", "opportunities")}).withColumns({"status": F.lit("failed"), "ended_at": F.col("started_at")})
    assert names(reports.run_list(of_runs, schemas.empty(spark, "crawl_result"), schemas.empty(spark, "model_invocation")), "run_id") == ["2", "3", "1", "4"]
    notes = spark.createDataFrame([("x", 1, "o", "s", 2, False), ("y", 1, "o", "s", 1, False), ("z", 1, "o", "s", 2, False), ("w", 1, "o", "s", 0, True)], "note_id string, version int, opportunity_id string, stage string, position int, deleted boolean")
    assert names(workflow.note_versions(notes), "note_id") == ["y", "x", "z"]
