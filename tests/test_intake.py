"""Adapters of different shapes, files that are read once, batches that count once, the gate from a state, photos."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trivox import __main__ as commands
from trivox.operators import gate_state, reports, retention
from trivox.sources import adapters, photos, schemas
from trivox.sources.adapters import Adapter, From
from trivox.sources.store import Store
from trivox.streaming.intake import intake

T0 = datetime(2026, 1, 1)
CLIPS = Adapter("clips", {"comment": {"video_id": "$.aweme.id", "comment_id": From(("$.cid", "$.id")), "author_id": "$.user.uid", "commented_at": From(("$.create_time",), "seconds"), "first_ingested_at": From(("$.seen",), "milliseconds"), "like_count": "$.digg"}}, {"platform": "douyin"})


def test_two_shapes_one_contract(spark):
    plain = [{"platform": "douyin", "video_id": "v", "comment_id": str(i), "level": 1, "author_id": "u", "text": "t", "commented_at": "2026-01-01T00:00:00Z", "first_ingested_at": "2026-01-01T00:00:01Z", "like_count": i} for i in range(3)]
    nested = [{"aweme": {"id": "v"}, ("cid" if i else "id"): i, "level": 1, "user": {"uid": "u", "nick": "n"}, "text": "t", "create_time": 1767225600, "seen": 1767225601000, "digg": i, "parent_comment_id": None} for i in range(3)]
    frame = lambda rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    one, two = (adapters.split(adapters.normalised(frame(rows), "comment", a), "comment") for rows, a in ((plain, adapters.PLAIN), (nested, CLIPS)))
    assert sorted(one[0].collect()) == sorted(two[0].collect()) and one[0].count() == 3 and one[1].isEmpty() and two[1].isEmpty()
    assert one[0].schema == schemas.empty(spark, "comment").schema


def test_reasons(spark):
    good = {"platform": "p", "comment_id": "1", "level": 1}
    rows = ["{broken", "[1]", json.dumps(good), json.dumps(good | {"comment_id": None}), json.dumps(good | {"level": "one"}), json.dumps({"platform": "p", "level": "one"}), json.dumps(good | {"like_count": [1]}), json.dumps(good | {"text": 7})]
    made = adapters.normalised(spark.createDataFrame([(r,) for r in rows], "value string"), "comment")
    assert [r.reason for r in sorted(made.collect(), key=lambda r: rows.index(r.line))] == ["unparsable", "missing:platform", None, "missing:comment_id", "type:level", "missing:comment_id", "type:like_count", None]
    videos = adapters.normalised(spark.createDataFrame([(json.dumps({"platform": "p", "video_id": "v", "platform_tags": ["a"], "engagement": {"likes": 3}}),)], "value string"), "video").first()
    assert (videos.platform_tags, videos.engagement, videos.reason) == (["a"], {"likes": 3}, None)


def test_files_are_read_once(spark, tmp_path):
    store, base = Store(spark, str(tmp_path / "t")), tmp_path / "in"
    commands.init(spark, store.base)

    def land(name, ids, video="v", more=()):
        (base / "douyin/comment").mkdir(parents=True, exist_ok=True)
        rows = [{"aweme": {"id": video}, "cid": i, "level": 1, "user": {"uid": f"u{i}"}, "text": f"t{i}", "create_time": 1767225600 + 60 * i, "seen": 1767225600000} for i in ids]
        (base / "douyin/comment" / name).write_text("\n".join([*map(json.dumps, rows), *more]))

    take = lambda: intake(spark, store, str(base), "douyin", "salt", adapter=CLIPS)
    land("a.json", [1, 2, 3], more=["{broken"])
    assert take() == 4 and store.read("comment").count() == 3
    assert [(r.kind, r.reason, r.line) for r in store.read("quarantine").collect()] == [("comment", "unparsable", "{broken")]
    cursor = lambda: {r.video_id: r.cursor for r in commands.cursors(spark, store.base).collect()}
    first = cursor()
    assert first["v"].endswith("|3")
    # the first file can no longer be read; only the second is
    (base / "douyin/comment/a.json").write_bytes(b"\xff\xfe not the same")
    land("b.json", [3, 4], more=[])
    assert take() == 2 and sorted(r.comment_id for r in store.read("comment").collect()) == ["1", "2", "3", "4"]
    assert cursor()["v"] > first["v"] and take() == 0
    # a late comment behind the cursor is taken in all the same
    land("c.json", [0])
    assert take() == 1 and store.read("comment").count() == 5 and cursor()["v"].endswith("|4")
    seen = retention.latest(store.read("content_fingerprint").where("kind = 'comment'"))
    assert seen.count() == 5 and "text" not in seen.columns


def test_a_batch_played_again(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    batch = spark.createDataFrame([("p", "v", "c", "a", T0)], "platform string, video_id string, cluster_id string, person string, at timestamp")
    sink = gate_state.gate_batches(store, "comments", least=1)
    sink(batch, 0)
    entry = store.entry()
    sink(batch, 0)
    assert store.entry() == entry and entry.marks == {"comments": 0}
    sink(batch.withColumn("person", F.lit("b")).withColumn("at", F.lit(T0 + timedelta(days=11))), 1)
    assert [r.person for r in store.read("gate_state").collect()] == ["b"]


@pytest.mark.parametrize("seed", range(2))
def test_the_gate_from_a_state(spark, seed):
    rng = random.Random(seed)
    group, kinds = ["g"], "g int, who string, at timestamp"
    history = [(rng.randrange(6), rng.choice([None, *"abcdefg"]), T0 + timedelta(hours=rng.randrange(24 * 30))) for _ in range(160)] + [(7, "a", None)]
    state = gate_state.state_of(spark.createDataFrame([], kinds), group, "who", "at")
    for day in range(0, 30, 7):
        now = T0 + timedelta(days=day + 7)
        batch = [r for r in history if r[2] and now - timedelta(days=7) <= r[2] < now]
        delta = gate_state.state_of(spark.createDataFrame(batch, kinds), group, "who", "at")
        merged = gate_state.merged(state, delta, group, now)
        rows = merged.collect()
        state = spark.createDataFrame(rows, merged.schema)
        people = {}
        for g, who, at in history:
            if who and at and now - timedelta(days=10) <= at < now:
                people.setdefault(g, set()).add(who)
        assert {r.g for r in gate_state.passing(state, group, now).collect()} == {g for g, w in people.items() if len(w) >= 3}
        assert max((sum(r.g == g for r in rows) for g in range(8)), default=0) <= 3
    assert gate_state.without(state, spark.createDataFrame([(1,)], "g int"), group).where("g = 1").isEmpty()


def test_photos(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    for name, data in (("a.jpg", b"one"), ("sub/b.PNG", b"one"), ("c.png", b"two"), ("d.txt", b"three")):
        (tmp_path / "p" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "p" / name).write_bytes(data)
    changes = store.changes()
    ids = {r.path.split("/")[-1]: r.photo_id for r in photos.put_photos(changes, photos.read_photos(spark, str(tmp_path / "p"))).collect()}
    assert set(ids) == {"a.jpg", "b.PNG", "c.png"} and ids["a.jpg"] == ids["b.PNG"]
    note = lambda n, version, deleted, *found: (n, version, list(found), deleted)
    kinds = "note_id string, version int, photo_paths array<string>, deleted boolean"
    changes.put("stage_note", spark.createDataFrame([note("x", 1, False, ids["a.jpg"]), note("y", 1, False, ids["a.jpg"], ids["c.png"]), note("y", 2, True, ids["a.jpg"], ids["c.png"])], kinds))
    changes.commit()
    assert store.read("photo").count() == 2
    changes = store.changes()
    assert photos.drop_unreferenced(changes) == 1
    changes.commit()
    assert bytes(store.read("photo").first().content) == b"one"
    again = store.changes()
    again.add("stage_note", spark.createDataFrame([note("x", 2, False)], kinds))
    assert photos.drop_unreferenced(again) == 1 and again.read("photo").isEmpty()
    photos.LARGEST, most = 2, photos.LARGEST
    try:
        with pytest.raises(ValueError):
            photos.read_photos(spark, str(tmp_path / "p"))
    finally:
        photos.LARGEST = most


def test_live_view(spark):
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [("r", "p", "fetch", "running", at(0), None, None), ("r", "p", "fetch", "ok", at(4), 7, None), ("r", "*", "cluster", "running", at(4), None, None), ("q", "*", "cluster", "running", at(1), None, None), ("q", "*", "cluster", "failed", at(1), None, "x")]
    got = {(r.run_id, r.stage): (r.state, r.micros, r.n_rows) for r in reports.live_steps(spark.createDataFrame(rows, schemas.SCHEMAS["run_step"])).collect()}
    assert got == {("r", "fetch"): ("ok", 4_000_000, 7), ("r", "cluster"): ("running", None, None), ("q", "cluster"): ("failed", 0, None)}
