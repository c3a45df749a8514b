"""An exploration from landing files to an opportunity, and the rules that the catalog cannot show."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trivox import __main__ as commands
from trivox.functions.text import author_hash
from trivox.operators import admission, consensus, eligibility, reports, retention, runs, semantics, workflow
from trivox.operators.explore import explore
from trivox.sources import landing, schemas
from trivox.sources.store import Store

NOW = datetime(2026, 1, 5, 9)
SETTINGS = landing.Settings(salt="pepper")


def write(path, rows):
    path.mkdir(parents=True)
    (path / "a.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))


def put(store, name, df):
    changes = store.changes()
    changes.put(name, df)
    changes.commit()


def said(**change):
    chain = [{"seq": 1, "title": "t", "kind": "inference", "body": "b", "basis": "x", "evidence_refs": [], "topics": list(admission.TOPICS)}]
    return json.dumps({n: "文字" for n in admission.REQUIRED} | {"acquisition_path": "在原视频评论区回复", "is_software": True, "passes_ops": True, "passes_acq": True, "chain": chain} | change)


def test_explore(spark, tmp_path):
    base, files = str(tmp_path / "tables"), tmp_path / "in"
    commands.init(spark, base)
    day = "2026-01-04T08:00:00Z"
    comment = lambda i, who, text: {"platform": "douyin", "video_id": "v", "comment_id": i, "level": 1, "author_id": who, "text": text, "commented_at": day, "first_ingested_at": day}
    write(files / "douyin/video", [{"platform": "douyin", "video_id": "v", "author_id": "o", "title": "一个足够清楚的标题说明", "first_ingested_at": day}])
    write(files / "douyin/comment", [comment(str(i), who, text) for i, (who, text) in enumerate([("a", "想要记账"), ("b", "想要记账"), ("c", "想要记账"), ("c", "想要记账"), ("d", "想要菜谱"), ("e", "想要菜谱"), ("o", "想要菜谱")])])
    accounts = [("douyin", "ok", NOW, None), ("bilibili", "login_expired", NOW, None)]
    store = Store(spark, base)
    put(store, "platform_account", spark.createDataFrame(accounts, schemas.SCHEMAS["platform_account"]))
    answer = said()
    describe = lambda texts: [answer for _ in texts]
    run = lambda name, at=NOW, **more: explore(spark, base, str(files), SETTINGS, name, at, semantics.same_text, describe, **more)
    assert run("r0", cancelled=lambda: True) == "cancelled"
    assert run("r1") == "partial_failure"
    table = store.read
    assert table("opportunity").count() == 1 and table("lifecycle_transition").first().to_stage == "new"
    cited = table("opportunity_evidence").collect()
    assert sorted(r.comment_id for r in cited) == ["0", "1", "2"] and all(r.is_representative for r in cited)
    assert run("r2") == "partial_failure" and table("opportunity").count() == 1 and table("audit_event").where("action = 'opportunity.create'").count() == 1
    assert {r.run_id: (r.opportunities, r.model_calls) for r in table("exploration_run").collect()} == {"r0": (0, 0), "r1": (1, 1), "r2": (0, 0)}
    assert runs.audit_faults(table("audit_event")).isEmpty()
    held = store.take("another")
    assert run("r3") == "running"
    store.release(held)
    # after the window only what evidence cites is left
    assert run("r4", NOW + timedelta(days=20)) == "partial_failure"
    assert {r.comment_id for r in table("comment").collect()} == {"0", "1", "2"} and retention.latest(table("content_fingerprint").where("kind = 'comment'")).count() == 7


def test_topics(spark):
    node = lambda *topics: {"seq": 1, "title": "t", "kind": "inference", "body": "b", "basis": "x", "evidence_refs": [], "topics": list(topics)}
    every = admission.TOPICS
    rows = [("six on one", [node(every[0])] * 6), ("three on all", [node(*every[:2]), node(*every[2:4]), node(*every[4:])]), ("five", [node(*every[:5])]), ("no title", [node(*every) | {"title": " "}])]
    made = admission.parsed(spark.createDataFrame([(i, said(chain=c)) for i, c in rows], "id string, output string"))
    assert {r.id for r in admission.admitted(made).where("admitted").collect()} == {"three on all"}


def test_rules_of_landing(spark, tmp_path):
    none = schemas.empty(spark, "comment")
    assert landing.platform_union({}, SETTINGS, none).collect() == []
    with pytest.raises(ValueError):
        landing.platform_union({"elsewhere": none}, SETTINGS)
    for name in schemas.SCHEMAS:
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("{}")
        good, bad = landing.read_contract(spark, str(tmp_path / name), name)
        assert (good.count(), bad.count()) == (0, 1)
    frame = spark.createDataFrame([(1, 2, 3, 4, 5)], ["a.b", "apiKey", "access_token", "Client-Secret", "tokens"])
    assert landing.redacted(frame).columns == ["a.b", "tokens"]
    with pytest.raises(ValueError):
        author_hash(F.lit("p"), F.lit("a"), "")
    (tmp_path / "settings.json").write_text('{"platforms": ["douyin"], "salt": "x"}')
    assert landing.Settings.load(str(tmp_path / "settings.json")).platforms == ("douyin",)


def test_one_row_for_a_video_and_a_comment(spark):
    comments = spark.createDataFrame([("p", "v", "1", 1, "a", "text that counts", 0)], "platform string, video_id string, comment_id string, level int, author_id string, text string, like_count long")
    videos = spark.createDataFrame([("p", "v", "o"), ("p", "v", None), ("p", "v", "o")], "platform string, video_id string, author_id string")
    assert eligibility.eligible(comments, videos).count() == 1
    members = spark.createDataFrame([("p", "v", "c", str(i), True) for i in range(3)], "platform string, video_id string, cluster_id string, comment_id string, stable boolean")
    rows = [("p", "v", str(i), True, f"u{i}") for i in range(3)] + [("p", "v", "2", False, "u2")]
    facts = lambda order: spark.createDataFrame(order, "platform string, video_id string, comment_id string, countable boolean, author_key string")
    assert all(not consensus.clusters(members, facts(order)).first().passed for order in (rows, rows[::-1]))


def test_bounded_repair(spark, tmp_path):
    inputs = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    valid = lambda df: df.where("id = 'a' and prompt_version = 'p' or prompt_version = 'p#2'")
    ask = lambda most: semantics.ask_until_valid(inputs, ["id"], "text", lambda t: t, "m", "p", str(tmp_path / f"n{most}"), valid, most)
    assert {(r.id, r.prompt_version) for r in ask(3).collect()} == {("a", "p"), ("b", "p#2")}
    assert {r.id for r in ask(1).collect()} == {"a"}


def test_local_day_in_any_session(spark):
    runs_ = spark.createDataFrame([("1", datetime(2024, 1, 1, 23))], "run_id string, started_at timestamp").withColumn("status", F.lit("success_empty"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        at = F.lit("2024-01-02 03:00:00+00:00").cast("timestamp")
        shifted = runs_.withColumn("started_at", F.lit("2024-01-01 23:00:00+00:00").cast("timestamp"))
        assert not reports.missed_today(shifted, at, "Asia/Shanghai").first().missed and reports.missed_today(shifted, at, "UTC").first().missed
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_entry_stage_has_a_next_action(spark):
    stages = spark.createDataFrame([("i", "interested"), ("n", "new")], "opportunity_id string, stage string")
    none = schemas.empty
    made = workflow.checklist(stages, none(spark, "stage_checklist"), none(spark, "stage_conclusion"), workflow.definitions(spark))
    assert [(r.opportunity_id, r.next_action) for r in made.collect()] == [("i", workflow.NEXT_STAGE)]
