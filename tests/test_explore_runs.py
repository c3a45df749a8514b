"""Explorations one after the other: what keeps its identity, what is repeated, what fails alone."""

import json
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from trivox import __main__ as commands
from trivox.operators import admission, semantics
from trivox.operators.explore import explore
from trivox.sources import landing, schemas
from trivox.sources.store import Store

NOW = datetime(2026, 1, 5, 9)
SETTINGS = landing.Settings(salt="pepper", image_input=True)
PLATFORMS = ("douyin", "bilibili")
# workers cannot import this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def said(title="文字", **change):
    chain = [{"seq": 2, "title": "t", "kind": "inference", "body": "b", "basis": "x", "evidence_refs": [], "topics": list(admission.TOPICS[1:])}]
    chain.append({"seq": 1, "title": "u", "kind": "fact", "body": "b", "basis": "x", "evidence_refs": ["1"], "topics": [admission.TOPICS[0]]})
    return json.dumps({n: "文字" for n in admission.REQUIRED} | {"title": title, "acquisition_path": "在原视频评论区回复", "is_software": True, "passes_ops": True, "passes_acq": True, "chain": chain} | change, ensure_ascii=False)


def numbered(order):
    """Equal texts are one need; ``order`` says how they are numbered, which is to change nothing."""
    return lambda texts: [sorted({*texts}, key=order).index(t) for t in texts]


def described(texts):
    return [said(sorted(set(t.split("\n")))[0]) for t in texts]


class World:
    def __init__(self, spark, tmp_path):
        self.spark, self.files = spark, tmp_path / "in"
        self.store = Store(spark, str(tmp_path / "t"))
        commands.init(spark, self.store.base)
        changes = self.store.changes()
        changes.put("platform_account", spark.createDataFrame([(p, "ok", NOW, None) for p in PLATFORMS], schemas.SCHEMAS["platform_account"]))
        changes.commit()
        for p in PLATFORMS:
            for kind in ("video", "comment"):
                (self.files / p / kind).mkdir(parents=True)

    def land(self, name, platform, video, rows, at=NOW - timedelta(hours=2)):
        day = at.isoformat() + "Z"
        clip = {"platform": platform, "video_id": video, "author_id": "o", "title": "一个足够清楚的标题说明", "first_ingested_at": day}
        lines = [{"platform": platform, "video_id": video, "comment_id": i, "level": 1, "author_id": who, "text": text, "commented_at": day, "first_ingested_at": day} for i, who, text in rows]
        for kind, made in (("video", [clip]), ("comment", lines)):
            (self.files / platform / kind / f"{name}.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in made))

    def run(self, name, at=NOW, cluster=numbered(None), **more):
        return explore(self.spark, self.store.base, str(self.files), SETTINGS, name, at, cluster, more.pop("describe", described), **more)

    def ids(self):
        return {r.title: r.opportunity_id for r in self.store.read("opportunity").collect()}

    def cited(self, title):
        return {r.comment_id for r in self.store.read("opportunity_evidence").where(F.col("opportunity_id") == self.ids()[title]).collect()}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def test_identity_over_three_runs(world):
    world.land("a", "douyin", "v", [(f"a{i}", f"u{i}", "想要记账") for i in range(3)])
    assert world.run("r1") == "success_found"
    first = world.ids()
    # more people with another need, which takes the first number, and a fourth with the known one
    world.land("b", "douyin", "v", [(f"b{i}", f"w{i}", "上班打卡软件") for i in range(3)] + [("a3", "u3", "想要记账"), ("a4", "u3", "想要记账")])
    assert world.run("r2", NOW + timedelta(days=1)) == "success_found"
    assert set(world.ids()) == {"想要记账", "上班打卡软件"} and world.ids()["想要记账"] == first["想要记账"]
    assert world.cited("想要记账") == {"a0", "a1", "a2", "a3"} and world.cited("上班打卡软件") == {"b0", "b1", "b2"}
    kept = {r.comment_id: r.is_representative for r in world.store.read("opportunity_evidence").collect()}
    assert kept["a0"] and not kept["a3"]
    last = {r.title: r.last_evidence_at for r in world.store.read("opportunity").collect()}
    assert last["想要记账"] == NOW + timedelta(days=1)
    # the numbers change places; nothing is new
    world.land("c", "douyin", "v", [("c0", "x", "别的什么需求")])
    assert world.run("r3", NOW + timedelta(days=2), numbered(lambda t: [-ord(c) for c in t])) == "success_empty"
    assert set(world.ids()) == {"想要记账", "上班打卡软件"} and world.cited("想要记账") == {"a0", "a1", "a2", "a3"}
    calls = world.store.read("model_invocation").collect()
    assert len(calls) == 2 and all(c.ok and c.model and len(c.input_ids) == 1 for c in calls)
    nodes = world.store.read("opportunity_chain").where(F.col("opportunity_id") == first["想要记账"]).orderBy("seq").collect()
    assert [n.title for n in nodes] == ["u", "t"]
    assert {(r.platform, r.stage) for r in world.store.read("run_step").where("run_id = 'r3' and state = 'ok'").collect()} == {("douyin", "fetch"), ("bilibili", "fetch"), ("*", "cluster"), ("*", "register"), ("*", "purge")}
    # no text of a raw comment is left behind the window, but for what is cited
    assert world.run("r4", NOW + timedelta(days=30)) == "success_empty"
    assert {r.comment_id for r in world.store.read("comment").collect()} == {"a0", "a1", "a2", "a3", "b0", "b1", "b2"}
    assert world.store.read("cluster_member").isEmpty()


def test_a_known_need_gets_the_evidence(world):
    same = lambda texts: [json.dumps({"same_problem": True, "same_solution": "记账" in t}) for t in texts]
    world.land("a", "douyin", "v", [(f"a{i}", f"u{i}", "想要记账") for i in range(3)])
    assert world.run("r1", same=same) == "success_found"
    world.land("a", "bilibili", "w", [(f"b{i}", f"u{i}", "想要记账软件") for i in range(3)])
    assert world.run("r2", same=same) == "success_empty"
    assert set(world.ids()) == {"想要记账"} and world.cited("想要记账") == {"a0", "a1", "a2", "b0", "b1", "b2"}
    relation = world.store.read("opportunity_relation").collect()
    assert [(r.to_id, r.type) for r in relation] == [(world.ids()["想要记账"], "same_need")]
    # later people of the second video go there as well, and nothing is asked again
    n = world.store.read("model_invocation").count()
    world.land("b", "bilibili", "w", [("b9", "u9", "想要记账软件")])
    assert world.run("r3", same=same) == "success_empty"
    assert "b9" in world.cited("想要记账") and world.store.read("model_invocation").count() == n
    assert world.store.read("audit_event").where("action = 'merge.same_need'").count() == 1


def test_a_failed_stage_is_repeated_alone(world):
    def broken(texts):
        raise RuntimeError("no model")

    world.land("a", "douyin", "v", [(f"a{i}", f"u{i}", "想要记账") for i in range(3)])
    assert world.run("r1", describe=broken) == "failed"
    run = world.store.read("exploration_run").first()
    assert "no model" in run.error and run.ended_at > run.started_at
    assert world.store.read("audit_event").where("action = 'fault.run'").count() == 1 and world.store.entry().owner is None
    # the files are gone meanwhile: the retry does not read them
    for f in world.files.rglob("*.json"):
        f.unlink()
    assert world.run("r2", retry_of="r1") == "success_found" and set(world.ids()) == {"想要记账"}
    assert {(r.platform, r.stage) for r in world.store.read("run_step").where("run_id = 'r2'").collect()} == {("*", "register"), ("*", "purge")}


def test_a_file_that_fails_in_the_scan_fails_one_platform(world):
    world.land("a", "douyin", "v", [(f"a{i}", f"u{i}", "想要记账") for i in range(3)])
    (world.files / "bilibili/comment/x.json.gz").write_bytes(b"not a gzip file")
    assert world.run("r1") == "partial_failure" and set(world.ids()) == {"想要记账"}
    assert {r.platform: r.status for r in world.store.read("crawl_result").collect()} == {"douyin": "ok", "bilibili": "failed"}
    found = {r.video_id: r.cursor for r in commands.cursors(world.spark, world.store.base).collect()}
    assert set(found) == {"v"} and found["v"].endswith("|a2")


def test_what_is_beyond_the_budget_waits(world):
    for v in "vw":
        world.land(v, "douyin", v, [(f"{v}{i}", f"u{i}", f"想要记账{v}") for i in range(3)])
    few = landing.Settings(salt="pepper", videos_per_run=1)
    run = lambda name: explore(world.spark, world.store.base, str(world.files), few, name, NOW, numbered(None), described)
    assert run("r1") == "success_found" and len(world.ids()) == 1
    first = world.store.read("exploration_run").first()
    assert first.budget_exhausted and (first.videos, first.comments) == (1, 3)
    assert run("r2") == "success_found" and len(world.ids()) == 2
    assert run("r3") == "success_empty" and world.store.read("model_invocation").count() == 2


def test_context_is_looked_at_or_not_guessed(world):
    day = (NOW - timedelta(hours=1)).isoformat() + "Z"
    world.land("a", "douyin", "v", [(f"a{i}", f"u{i}", "这个求链接") for i in range(3)])
    clip = {"platform": "douyin", "video_id": "v", "author_id": "o", "title": "短", "first_ingested_at": day}
    (world.files / "douyin/video/a.json").write_text(json.dumps(clip, ensure_ascii=False))
    assert world.run("r1") == "success_empty"
    world.land("b", "bilibili", "z", [("z", "u", "一个人的需求")])
    assert world.run("r2", resolve=lambda t: ["true"] * len(t)) == "success_found"


def test_unstable_judgements_fail(spark):
    flip = lambda texts: [0 if i < 2 else 1 for i, _ in enumerate(texts)]
    assert all(n < 0 for n in semantics.judged_twice(flip)(["a", "b", "c", "d", "e"])[2:3])
    assert semantics.judged_twice(semantics.same_text)(["a", "b", "a"]) == [1, 2, 1]


def test_daily(spark):
    at, slept = [datetime(2026, 1, 1, 8, 59, tzinfo=timezone.utc)], []

    def sleep(s):
        slept.append(s)
        at[0] += timedelta(seconds=s)

    def run(now):
        at[0] += timedelta(days=2)  # longer than a day: what was missed is not caught up
        return now.isoformat()

    assert commands.daily(run, SETTINGS, lambda: at[0], sleep, 2) == ["2026-01-01T09:00:00+00:00", "2026-01-04T09:00:00+00:00"]


def test_explore_as_a_command(world, monkeypatch, capsys, tmp_path):
    import types

    module = types.ModuleType("judges")
    module.cluster, module.describe = numbered(None), lambda t: [said() for _ in t]
    monkeypatch.setitem(sys.modules, "judges", module)
    world.land("a", "douyin", "v", [("a", "u", "想要记账")])
    (tmp_path / "s.json").write_text('{"salt": "x"}')
    commands.main(["explore", world.store.base, "--landing", str(world.files), "--settings", str(tmp_path / "s.json"), "--cluster", "judges:cluster", "--describe", "judges:describe"], world.spark)
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["state"] == "success_empty"
    with pytest.raises(SystemExit):
        commands.main(["explore", world.store.base], world.spark)
