"""Queries that call operators on inputs where rows come out both ways, with SQL that states the rule on its own.

As in the catalog the tables at hand stand in for the engine's own: events are comments, customers videos or opportunities,
orders comments, runs or transitions, line items model calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trivox.functions.text import is_deictic, noise_rule
from trivox.operators import admission, consensus, eligibility, registry, reports, retention, workflow
from trivox.plans.decisions import _MOVES, _moves, _opportunities
from trivox.plans.register import query
from trivox.sources.landing import Settings, platform_union, ready_platforms, redacted
from trivox.sources.schemas import CRAWL_STATES


def _picked(values: tuple, number) -> Column:
    return F.get(F.array(*map(F.lit, values)), number.cast("int"))


_TEXTS = ("😀👍", "哈哈哈", "转发抽三位", "加微信拿优惠券", "私信领取资料", "快来快来快来快来快来快来", "希望有个软件能做这件事", "这个求链接", "同款")


@query("""SELECT p_partkey AS part, ['symbols_only', 'empty_agreement', 'lottery', 'advert', 'diversion', 'bot', NULL, NULL, NULL][1 + p_partkey % 9] AS rule,
p_partkey % 9 >= 7 AS deictic FROM part""")
def noise_and_phrases(t):
    text = _picked(_TEXTS, F.col("p_partkey") % 9)
    return t("part").select(F.col("p_partkey").alias("part"), noise_rule(text).alias("rule"), is_deictic(text).alias("deictic"))


@query("SELECT event_id FROM events WHERE NOT coalesce(value > 20, false)")
def unprocessed_comments(t):
    rows = t("events").select(F.col("event_type").alias("platform"), F.col("event_id").alias("comment_id"), "value")
    kind = F.when(F.col("value") > 20, "comment").otherwise("video")
    return eligibility.unprocessed(rows, rows.select("platform", kind.alias("kind"), F.col("comment_id").alias("id")), "comment", "comment_id").select(F.col("comment_id").alias("event_id"))


@query("""WITH k AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders QUALIFY p <= 5),
n AS (SELECT o_custkey, count(*) AS n FROM k GROUP BY 1),
r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey, c_custkey) AS v, sum(coalesce(n, 0)) OVER (ORDER BY c_nationkey, c_custkey) - coalesce(n, 0) AS before
FROM customer LEFT JOIN n ON o_custkey = c_custkey)
SELECT o_custkey AS video_id, o_orderkey AS comment_id FROM k JOIN r ON c_custkey = o_custkey WHERE v <= 120 AND before < 400 AND before + p <= 400""")
def budget_of_a_run(t):
    videos = t("customer").select(F.lit("p").alias("platform"), F.col("c_custkey").alias("video_id"), F.col("c_nationkey").alias("hot_rank"))
    comments = t("orders").select(F.lit("p").alias("platform"), F.col("o_custkey").alias("video_id"), F.col("o_orderkey").alias("comment_id"))
    return eligibility.within_budget(videos, comments, 120, 400, 5)[1].select("video_id", "comment_id")


@query("""SELECT c.conv_id AS conv_id, c.turn AS turn, p.role AS parent_role FROM conversations c
LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1""")
def reply_in_context(t):
    name = lambda turn: F.concat_ws("-", "conv_id", turn)
    rows = t("conversations").select("conv_id", "turn", F.lit("p").alias("platform"), name(F.col("turn")).alias("comment_id"), name(F.col("turn") - 1).alias("parent_comment_id"), F.col("role").alias("author_id"), "text")
    return eligibility.with_parent(rows).select("conv_id", "turn", F.col("parent_author_id").alias("parent_role"))


@query("""WITH r AS (SELECT l_orderkey - l_orderkey % 4 AS opportunity_id, l_partkey AS comment_id, false AS known FROM lineitem WHERE l_linenumber > 1
UNION ALL SELECT l_orderkey, l_partkey, true FROM lineitem WHERE l_linenumber = 1)
SELECT opportunity_id, comment_id, bool_or(known) AS known FROM r GROUP BY ALL""")
def evidence_of_primary(t):
    rows = t("lineitem").select(
        F.col("l_orderkey").alias("opportunity_id"), F.lit("p").alias("platform"), F.col("l_suppkey").alias("video_id"), F.col("l_partkey").alias("comment_id"),
        (F.col("l_linenumber") == 1).alias("known"),
    )
    routes = rows.select("opportunity_id").distinct().withColumn("primary_id", F.col("opportunity_id") - F.col("opportunity_id") % 4)
    return registry.merged_evidence(rows.where("known"), rows.where("not known"), routes).select("opportunity_id", "comment_id", "known")


@query("SELECT event_id FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM events)")
def live_comments(t):
    now = t("events").agg(F.max("ts").alias("now")).first()["now"]
    return retention.live(t("events").select("event_id", F.col("ts").alias("first_ingested_at")), now).select("event_id")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def enabled_platforms(t):
    of = lambda kind: t("events").where(F.col("event_type") == kind).select("event_id", "event_type")
    return platform_union({"douyin": of("click"), "bilibili": of("view"), "elsewhere": of("error")}, Settings())


@query("""WITH e AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT k AS video_id, event_type AS cluster_id, count(DISTINCT user_id) FILTER (WHERE user_id % 7 <> 0 AND event_id % 5 <> 0) AS users,
count(DISTINCT user_id) FILTER (WHERE user_id % 7 <> 0 AND event_id % 5 <> 0) >= 3 AND bool_and(event_id % 11 <> 0) AS passed FROM e GROUP BY ALL""")
def judged_clusters(t):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = t("events").select(F.lit("p").alias("platform"), k.alias("video_id"), F.col("event_type").alias("cluster_id"), F.col("event_id").alias("comment_id"), "user_id")
    facts = rows.withColumn("countable", F.col("user_id") % 7 != 0).withColumnRenamed("user_id", "author_key")
    # some comments come twice and differ: the smaller row counts
    facts = facts.unionByName(facts.where("comment_id % 5 = 0").withColumn("countable", F.lit(False)))
    made = consensus.clusters(rows.withColumn("stable", F.col("comment_id") % 11 != 0), facts)
    return made.select("video_id", "cluster_id", "users", "passed")


@query("""WITH e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
r AS (SELECT k, CASE WHEN event_id % 2 = 1 AND event_type = 'view' AND k % 2 = 0 AND k IN (SELECT k FROM e WHERE event_type = 'click' AND event_id % 2 = 0) THEN 'click' ELSE event_type END AS c, event_id
FROM e WHERE event_id % 2 = 1 UNION ALL SELECT k, event_type, event_id FROM e WHERE event_id % 2 = 0 AND event_id % 3 <> 0)
SELECT k AS video_id, c AS cluster_id, event_id AS comment_id FROM r""")
def carried_clusters(t):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = t("events").select(F.lit("p").alias("platform"), k.alias("video_id"), F.col("event_type").alias("cluster_id"), F.col("event_id").alias("comment_id"), F.lit(True).alias("stable"))
    new, known = rows.where("comment_id % 2 = 1"), rows.where("comment_id % 2 = 0")
    same = rows.where("video_id % 2 = 0").select("platform", "video_id", F.lit("view").alias("cluster_id"), F.lit("click").alias("known_id")).distinct()
    return consensus.carried(new, known, same, rows.where("comment_id % 3 <> 0")).select("video_id", "cluster_id", "comment_id")


@query(f"""WITH {_MOVES} SELECT opportunity_id, stage FROM s JOIN customer ON c_custkey = opportunity_id WHERE stage NOT IN ('new', 'develop', 'deferred', 'abandoned')
ORDER BY updated_at DESC, opportunity_id LIMIT 3""")
def home_three(t):
    stages = workflow.current_stage(_moves(t))
    progress = stages.select("opportunity_id", "stage", F.lit(0).alias("done"), F.lit(1).alias("total"), F.lit("a").alias("next_action"))
    return reports.home(_opportunities(t), stages, progress).select("opportunity_id", "stage")


@query("""WITH l AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'O') AS ok, count(*) AS n, sum(l_suppkey + l_partkey) AS tokens FROM lineitem GROUP BY 1)
SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey * 60 AS BIGINT) END AS seconds, coalesce(ok, 0) AS platforms_ok, coalesce(n, 0) AS platforms,
CAST(coalesce(tokens, 0) AS BIGINT) AS tokens FROM orders LEFT JOIN l ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F'""")
def table_of_runs(t):
    end = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.make_interval(mins=F.col("o_custkey").cast("int") * 1))
    zero = [F.lit(0).cast("long").alias(n) for n in ("videos", "comments", "opportunities")]
    runs = t("orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), end.alias("ended_at"), F.col("o_orderstatus").alias("status"), *zero)
    results = t("lineitem").select(F.col("l_orderkey").alias("run_id"), F.when(F.col("l_linestatus") == "O", "ok").otherwise("failed").alias("status"))
    calls = t("lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_suppkey").alias("tokens_in"), F.col("l_partkey").alias("tokens_out"))
    return reports.run_list(runs, results, calls).select("run_id", "seconds", "platforms_ok", "platforms", "tokens")


@query("""WITH r AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS ok, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS l FROM orders GROUP BY 1)
SELECT c_custkey AS run_id, coalesce(ok, 0) AS platforms_ok, coalesce(n, 0) AS platforms,
CASE c_nationkey WHEN 0 THEN 'waiting' WHEN 1 THEN 'running' WHEN 2 THEN 'cancelled' ELSE
CASE WHEN n IS NULL THEN 'not_run' WHEN ok = n THEN CASE WHEN c_custkey % 2 = 1 THEN 'success_found' ELSE 'success_empty' END WHEN ok > 0 THEN 'partial_failure' WHEN l > 0 THEN 'login_expired' ELSE 'failed' END END AS status
FROM customer LEFT JOIN r ON o_custkey = c_custkey""")
def nine_states(t):
    runs = t("customer").select(F.col("c_custkey").alias("run_id"), _picked(("waiting", "running", "cancelled"), F.col("c_nationkey")).alias("status"))
    state = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "login_expired").otherwise("failed")
    results = t("orders").select(F.col("o_custkey").alias("run_id"), state.alias("status"))
    return reports.run_states(runs, results, runs.select("run_id", (F.col("run_id") % 2).alias("opportunities")))


@query("""WITH r AS (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1)
SELECT l_returnflag AS model, count(*) AS calls, CAST(sum(l_suppkey) AS BIGINT) AS tokens_in, CAST(sum(l_partkey) AS BIGINT) AS tokens_out FROM lineitem JOIN r ON l_orderkey = o_orderkey GROUP BY 1""")
def tokens_last_run(t):
    runs = t("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"))
    calls = t("lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("model"), F.lit(True).alias("ok"), F.col("l_suppkey").alias("tokens_in"), F.col("l_partkey").alias("tokens_out"))
    return reports.tokens_of_last_run(calls, runs).select("model", "calls", "tokens_in", "tokens_out")


@query("""SELECT p_partkey AS part, CASE WHEN p_partkey % 3 = 2 THEN 5 ELSE 6 - least(6, 1 + p_size % 7) END AS missing, p_partkey % 3 <> 2 AND p_size % 7 >= 5 AS complete FROM part""")
def chain_topics(t):
    """A few nodes that carry several topics may do; six nodes on one topic do not."""
    node = lambda topics: F.struct(F.lit("t").alias("title"), F.lit("inference").alias("kind"), F.lit("b").alias("body"), F.array().cast("array<string>").alias("evidence_refs"), topics.alias("topics"))
    every = F.array(*map(F.lit, admission.TOPICS))
    some = F.slice(every, F.lit(1), 1 + F.col("p_size") % 7)
    one = F.array(*[node(F.slice(every, 1, 1)) for _ in range(6)])
    chain = F.when(F.col("p_partkey") % 3 == 2, one).when(F.col("p_partkey") % 3 == 1, F.array(node(some), node(F.slice(every, 1, 1)))).otherwise(F.array(node(some)))
    return t("part").select(F.col("p_partkey").alias("part"), F.size(admission.topics_missing(chain)).alias("missing"), admission.chain_complete(chain).alias("complete"))


@query(f"""WITH {_MOVES}, r AS (SELECT opportunity_id, stage, seq FROM s WHERE stage IN ('requirements', 'acquisition', 'decision_ready'))
SELECT opportunity_id, seq + 1 AS seq, stage AS from_stage, 'deferred' AS to_stage FROM r""")
def transitions_appended(t):
    moves = _moves(t)
    some = workflow.current_stage(moves).where("stage in ('requirements', 'acquisition', 'decision_ready')").select("opportunity_id")
    ask = lambda to, why: some.select("opportunity_id", F.lit(to).alias("to_stage"), F.lit(why).alias("reason"), F.lit("user").alias("actor"))
    requests = ask("deferred", "later").unionByName(ask("feasibility", "again")).unionByName(ask("abandoned", None))
    progress = workflow.current_stage(moves).select("opportunity_id", "stage", F.lit(False).alias("complete"))
    taken, _ = workflow.to_append(workflow.checked(requests, moves, progress), F.lit("2026-01-01 00:00:00").cast("timestamp"), ["to_stage"])
    return taken.select("opportunity_id", "seq", "from_stage", "to_stage")


@query("""SELECT c_custkey AS from_id, c_custkey % 10 AS to_id FROM customer WHERE c_custkey > 10 AND c_custkey % 10 IN (SELECT c_custkey FROM customer) AND c_custkey % 3 <> 0""")
def merges_by_hand(t):
    ids = t("customer").select(F.col("c_custkey").alias("opportunity_id"))
    wanted = ids.where("opportunity_id > 10 or opportunity_id = 1").select(F.col("opportunity_id").alias("from_id"), (F.col("opportunity_id") % 10).alias("to_id"), F.lit("user").alias("actor"))
    known = ids.where("opportunity_id % 3 = 0").select(F.col("opportunity_id").alias("from_id"), F.lit(1).cast("long").alias("to_id"), F.lit("duplicate").alias("type"))
    made, _ = registry.merged_by_hand(wanted, known, ids, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return made.select("from_id", "to_id")


@query("""SELECT p_partkey AS note_id, 2 AS version, CASE p_partkey % 4 WHEN 0 THEN 'new' ELSE p_name END AS text, CASE p_partkey % 4 WHEN 1 THEN 7 ELSE p_size END AS position, p_partkey % 4 = 2 AS deleted
FROM part WHERE p_partkey % 4 <> 3 AND p_size % 5 <> 0""")
def notes_changed(t):
    key = F.col("p_partkey")
    notes = t("part").select(
        key.alias("note_id"), F.lit(1).alias("version"), F.lit("o").alias("opportunity_id"), F.lit("s").alias("stage"), F.col("p_name").alias("text"), F.col("p_size").alias("position"),
        (F.col("p_size") % 5 == 0).alias("deleted"), F.lit(None).cast("timestamp").alias("updated_at"),
    )
    changes = t("part").select(key.alias("note_id"), _picked(("edit", "move", "delete", "edit"), key % 4).alias("action"), _picked(("new", None, None, " "), key % 4).alias("text"), F.lit(7).alias("position"))
    made = workflow.note_changes(notes, changes, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return made.select("note_id", "version", "text", "position", "deleted")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr') AND source IN ('src1', 'src2')")
def listed_rows(t):
    return reports.listed(t("documents"), lang=["de", "fr"], source=["src1", "src2"], doc_id=[]).select("doc_id", "lang")


@query("""SELECT CAST(s AS VARCHAR) AS platform, s IN (1, 4) AS ready, CASE s WHEN 1 THEN NULL WHEN 4 THEN NULL WHEN 2 THEN 'captcha' ELSE 'login_expired' END AS error_kind FROM range(1, 6) t(s)""")
def logins(t):
    found = t("nation").where("n_nationkey between 1 and 4").select(F.col("n_nationkey").cast("string").alias("platform"), F.col("n_regionkey").alias("checked_at"), _picked(("ok", "captcha", "?", "ok"), F.col("n_nationkey") - 1).alias("login_state"))
    older = found.select("platform", F.lit(-1).alias("checked_at"), F.lit(CRAWL_STATES[4]).alias("login_state"))
    return ready_platforms(found.unionByName(older), Settings(platforms=("1", "2", "3", "4", "5")))


@query("SELECT c_custkey, c_name FROM customer")
def secrets_gone(t):
    c = F.col
    return redacted(t("customer").select("c_custkey", "c_name", c("c_name").alias("apiKey"), c("c_name").alias("access_token"), c("c_name").alias("Client-Secret"), c("c_name").alias("login_session")))
