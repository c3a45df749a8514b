"""Queries over the rules that decide: who counts, what a model's answer is worth, where an opportunity may go.

As in the catalog the tables at hand stand in for the engine's own: events are comments or actions, parts are candidate
opportunities, customers opportunities, their orders transitions or runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivox.operators import admission, eligibility, registry, reports, retention, runs, workflow
from trivox.plans.register import query
from trivox.sources.landing import redacted
from trivox.sources.schemas import AUDITED, assert_no_scores

#: Each customer's orders, by number, as transitions: the first makes the opportunity, the others follow from a remainder.
_PATH = ("new", "interested", "feasibility", "competition", "requirements", "acquisition", "decision_ready", "develop", "deferred", "abandoned")
_LIST = ", ".join(f"'{s}'" for s in _PATH)
_MOVES = f"""t AS (SELECT o_custkey AS opportunity_id, o_orderkey, row_number() OVER w AS seq, o_orderdate AS moved_at, o_orderpriority AS reason,
CASE WHEN row_number() OVER w = 1 THEN 'new' ELSE ([{_LIST}])[1 + o_orderkey % 10] END AS to_stage FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
m AS (SELECT *, lag(to_stage) OVER (PARTITION BY opportunity_id ORDER BY seq) AS from_stage FROM t),
s AS (SELECT opportunity_id, arg_max(to_stage, seq) AS stage, max(seq) AS seq, arg_max(coalesce(from_stage, '-'), seq) AS came_from, max(moved_at) AS updated_at FROM m GROUP BY 1)"""


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _moves(t) -> DataFrame:
    w = Window.partitionBy("opportunity_id").orderBy("o_orderkey")
    rows = t("orders").select(F.col("o_custkey").alias("opportunity_id"), "o_orderkey", F.col("o_orderdate").alias("at"), F.col("o_orderpriority").alias("reason"))
    rows = rows.withColumn("seq", F.row_number().over(w).cast("long"))
    later = F.get(F.array(*map(F.lit, _PATH)), (F.col("o_orderkey") % 10).cast("int"))
    rows = rows.withColumn("to_stage", F.when(F.col("seq") == 1, "new").otherwise(later))
    return rows.withColumn("from_stage", F.lag("to_stage").over(w))


def _opportunities(t) -> DataFrame:
    return t("customer").select(F.col("c_custkey").alias("opportunity_id"), F.col("c_name").alias("title"), F.col("c_nationkey").alias("first_found_at"))


@query("""SELECT event_id, user_id IS NOT NULL AND user_id % 9 <> 0 AND user_id <> k AS countable,
CASE WHEN user_id % 9 <> 0 THEN event_type || chr(1) || CAST(user_id AS VARCHAR) END AS author_key, 'rules-1' AS rule_version
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""")
def eligible_comments(t):
    author = F.when(F.col("user_id") % 9 != 0, F.col("user_id").cast("string"))
    rows = t("events").select(
        F.col("event_type").alias("platform"), _k().alias("video_id"), "event_id", author.alias("author_id"), F.lit("where is a tool for it").alias("text"),
        F.lit(1).alias("level"), F.col("value").alias("like_count"),
    )
    owners = rows.select("platform", "video_id", F.col("video_id").cast("string").alias("author_id")).distinct()
    return eligibility.eligible(rows, owners).select("event_id", "countable", "author_key", "rule_version")


@query("SELECT p_partkey AS part, p_partkey % 4 = 3 AS valid, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a' ELSE p_name END AS title FROM part")
def parsed_answers(t):
    key, said = F.col("p_partkey") % 4, ("summary", "target_user", "scenario", "pain", "current_solution", "software_form", "core_value", "ops_rationale", "acquisition_path")
    full = F.to_json(F.struct(F.col("p_name").alias("title"), *[F.lit("a").alias(n) for n in said], F.when(key == 2, " ").otherwise("a").alias("risks")))
    rows = t("part").select(F.col("p_partkey").alias("part"), F.when(key == 0, "no json").when(key == 1, '{"title": "a"}').otherwise(full).alias("output"))
    return admission.parsed(rows).select("part", "valid", "title")


_REJECT = """CASE WHEN p_size % 7 = 0 THEN 'not_software' WHEN p_size % 5 = 0 THEN 'needs_operations' WHEN p_size % 11 = 0 THEN 'no_operations_rationale' WHEN p_size % 3 = 0 THEN 'no_acquisition'
WHEN p_partkey % 10 = 0 THEN 'generic_acquisition' WHEN p_partkey % 10 = 1 THEN 'missing_pain' WHEN p_partkey % 10 IN (2, 3) THEN 'incomplete_chain' END"""


@query(f"SELECT p_partkey AS part, {_REJECT} AS rejected_by, ({_REJECT}) IS NULL AS admitted FROM part")
def admission_filters(t):
    size, key = F.col("p_size"), F.col("p_partkey") % 10
    node = lambda i, kind, refs: F.struct(F.lit(i).alias("seq"), F.lit("t").alias("title"), F.lit(kind).alias("kind"), F.lit("b").alias("body"), F.lit("c").alias("basis"), refs.alias("evidence_refs"))
    cited, bare = F.array(F.lit("e")), F.array().cast("array<string>")
    whole = F.array(node(1, "fact", cited), *[node(i, "inference", bare) for i in range(2, 7)])
    short, uncited = F.slice(whole, 1, 5), F.array(node(1, "fact", bare), *[node(i, "inference", bare) for i in range(2, 7)])
    made = t("part").select(
        F.col("p_partkey").alias("part"), *[F.lit("a").alias(n) for n in admission.REQUIRED if n not in ("pain", "ops_rationale", "acquisition_path")],
        F.when(key != 1, "a").alias("pain"), F.when(size % 11 == 0, " ").otherwise("a").alias("ops_rationale"), F.when(key == 0, "做SEO").otherwise("a forum of users").alias("acquisition_path"),
        (size % 7 != 0).alias("is_software"), (size % 5 != 0).alias("passes_ops"), (size % 3 != 0).alias("passes_acq"), F.when(key == 2, short).when(key == 3, uncited).otherwise(whole).alias("chain"),
    )
    return assert_no_scores(admission.admitted(made).select("part", "rejected_by", "admitted"))


@query("""WITH c AS (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type, count(DISTINCT user_id) AS users, max(user_id) % 2 = 0 AS lean FROM events GROUP BY ALL)
SELECT k, event_type, users >= 15 AND lean AND k % 3 = 0 AS needs_context,
CASE WHEN users < 15 THEN 'pending' WHEN lean AND k % 3 = 0 AND k % 2 = 0 THEN 'context_insufficient' ELSE 'ready' END AS status FROM c""")
def context_outcome(t):
    rows = t("events").select(F.lit("p").alias("platform"), _k().alias("video_id"), F.col("event_type").alias("cluster_id"), "user_id")
    group = ["platform", "video_id", "cluster_id"]
    made = rows.groupBy(*group).agg((F.count_distinct("user_id") >= 15).alias("passed"), F.when(F.max("user_id") % 2 == 0, "求链接").otherwise("a timer").alias("text"))
    videos = rows.select("platform", "video_id", F.when(F.col("video_id") % 3 == 0, "short").otherwise("a title that tells").alias("title"), F.lit(None).cast("string").alias("description")).distinct()
    marked = admission.needs_context(made.drop("text"), made.drop("passed"), videos)
    found = made.select(*group, (F.col("video_id") % 2 == 1).alias("resolved"))
    return admission.with_outcome(marked, found, True).select(F.col("video_id").alias("k"), F.col("cluster_id").alias("event_type"), "needs_context", "status")


@query(f"WITH {_MOVES} SELECT opportunity_id, c_name AS title FROM s JOIN customer ON c_custkey = opportunity_id WHERE stage = 'new'")
def inbox(t):
    return reports.inbox(_opportunities(t), workflow.current_stage(_moves(t))).select("opportunity_id", "title")


@query(f"WITH {_MOVES} SELECT opportunity_id, c_name AS title, stage FROM s JOIN customer ON c_custkey = opportunity_id WHERE stage NOT IN ('new', 'develop', 'deferred', 'abandoned')")
def incubation_list(t):
    return reports.incubating(_opportunities(t), workflow.current_stage(_moves(t))).select("opportunity_id", "title", "stage")


@query(f"""WITH {_MOVES}, e AS (SELECT opportunity_id, arg_max(reason, seq) AS reason FROM m GROUP BY 1)
SELECT s.opportunity_id AS opportunity_id, stage, nullif(came_from, '-') AS came_from, reason FROM s JOIN customer ON c_custkey = opportunity_id JOIN e ON e.opportunity_id = s.opportunity_id
WHERE stage IN ('develop', 'deferred', 'abandoned')""")
def archive_list(t):
    moves = _moves(t)
    return reports.archive(_opportunities(t), workflow.current_stage(moves), moves).select("opportunity_id", "stage", "came_from", "reason")


def _place(column: str) -> str:
    return f"list_position([{', '.join(repr(s) for s in workflow.STAGES)}], {column})"


@query(f"""WITH {_MOVES}, r AS (SELECT c_custkey AS opportunity_id, ([{_LIST}])[1 + (c_custkey // 3) % 10] AS to_stage,
CASE WHEN c_custkey % 5 = 0 THEN 'system' ELSE 'user' END AS actor, CASE WHEN c_custkey % 3 > 0 THEN 'why' END AS reason, c_custkey % 2 = 0 AS complete FROM customer),
j AS (SELECT r.*, s.stage, nullif(s.came_from, '-') AS came_from, s.seq, {_place('s.stage')} AS here, {_place('r.to_stage')} AS there, r.to_stage IN ('develop', 'deferred', 'abandoned') AS ends
FROM r LEFT JOIN s ON s.opportunity_id = r.opportunity_id),
d AS (SELECT *, CASE WHEN stage IS NULL THEN CASE WHEN to_stage = 'new' AND actor = 'system' THEN NULL ELSE 'not_created' END WHEN actor <> 'user' THEN 'not_a_person'
WHEN stage IN ('develop', 'abandoned') THEN 'ended' WHEN stage = 'deferred' THEN CASE WHEN to_stage = came_from THEN NULL ELSE 'restore_elsewhere' END
WHEN ends AND reason IS NULL THEN 'no_reason' WHEN to_stage = 'develop' AND stage <> 'decision_ready' THEN 'not_ready' WHEN ends THEN NULL WHEN to_stage = 'new' THEN 'not_created'
WHEN there < here THEN NULL WHEN stage IN ('new', 'interested') AND to_stage IN ('interested', 'feasibility') AND there > here THEN NULL WHEN there <> here + 1 THEN 'not_next'
WHEN NOT complete THEN 'incomplete' END AS refused_by FROM j)
SELECT opportunity_id, to_stage, stage AS from_stage, coalesce(seq, 0) + 1 AS seq, refused_by IS NULL AS accepted, refused_by FROM d""")
def transition_rules(t):
    key = F.col("c_custkey")
    asked = F.get(F.array(*map(F.lit, _PATH)), (F.floor(key / 3) % 10).cast("int"))
    requests = t("customer").select(key.alias("opportunity_id"), asked.alias("to_stage"), F.when(key % 3 > 0, "why").alias("reason"), F.when(key % 5 == 0, "system").otherwise("user").alias("actor"))
    moves = _moves(t)
    progress = workflow.current_stage(moves).select("opportunity_id", "stage", (F.col("opportunity_id") % 2 == 0).alias("complete"))
    return workflow.checked(requests, moves, progress).select("opportunity_id", "to_stage", "from_stage", "seq", "accepted", "refused_by")


@query("""SELECT event_type AS platform, CAST(user_id AS VARCHAR) AS id, sha256('salt' || chr(1) || event_type || chr(1) || CAST(user_id AS VARCHAR)) AS author_hash, sha256('a b') AS content_hash,
CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY event_type, user_id""")
def fingerprints_kept(t):
    rows = t("events").select(F.col("event_type").alias("platform"), F.col("user_id").cast("string").alias("comment_id"), F.col("user_id").cast("string").alias("author_id"), F.lit(" a  b ").alias("text"), F.col("ts").alias("first_ingested_at"))
    old, new = rows.where("hour(first_ingested_at) < 12"), rows.where("hour(first_ingested_at) >= 12")
    made = retention.merged(retention.fingerprints(old, "salt"), retention.fingerprints(new, "salt"))
    return made.select("platform", "id", "author_hash", "content_hash", F.to_date("first_seen").alias("first_day"), F.to_date("last_seen").alias("last_day"))


@query("""WITH n AS (SELECT max(ts) AS now FROM events), e AS (SELECT event_id, user_id, ts, event_type = 'error' AS cited FROM events)
SELECT event_id, user_id FROM e, n WHERE NOT (ts < now - INTERVAL 10 DAY) OR user_id IN (SELECT user_id FROM e WHERE cited AND user_id % 4 = 0)""")
def purge_survivors(t):
    now = t("events").agg(F.max("ts").alias("now")).first()["now"]
    rows = t("events").select("event_id", "user_id", "event_type", F.col("ts").alias("first_ingested_at"))
    cited = rows.where("event_type = 'error' and user_id % 4 = 0")
    kept, _ = retention.purge(rows, cited, ["user_id"], now)
    return kept.select("event_id", "user_id")


def _runs(t) -> DataFrame:
    done = F.when(F.col("o_orderstatus") == "F", "success_found").when(F.col("o_orderstatus") == "P", "running").otherwise("failed")
    return t("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("started_by"), F.col("o_orderdate").alias("started_at"), done.alias("status"))


@query("SELECT count(*) FILTER (WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) = DATE '1998-10-03') = 0 AS missed FROM orders")
def missed_today(t):
    return reports.missed_today(_runs(t), F.lit("1998-10-03 12:00:00").cast("timestamp"), "UTC")


@query("SELECT o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 1")
def run_under_way(t):
    return runs.current_run(_runs(t)).select("run_id")


@query("SELECT o_orderpriority AS platform FROM orders WHERE o_custkey = 7 AND o_orderstatus <> 'F'")
def retry_targets(t):
    status = F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed")
    return reports.to_retry(t("orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderpriority").alias("platform"), status.alias("status")), 7)


@query("""SELECT event_id, event_type AS action FROM events WHERE user_id % 13 = 0 OR event_type NOT IN ('click', 'view')""")
def audit_faults(t):
    action = F.when(F.col("event_type").isin("click", "view"), f"{AUDITED[0]}.start").otherwise(F.col("event_type"))
    rows = t("events").select("event_id", "event_type", F.when(F.col("user_id") % 13 != 0, "someone").alias("actor"), F.col("user_id").alias("object_id"), F.col("ts").alias("at"), action.alias("action"))
    return runs.audit_faults(rows).select("event_id", F.col("event_type").alias("action"))


@query("""WITH o AS (SELECT DISTINCT o_custkey AS opportunity_id, l_partkey, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT c_custkey AS opportunity_id, count(l_partkey) AS comments, CASE WHEN count(l_partkey) > 0 THEN count(DISTINCT l_suppkey) END AS users, count(p_name) AS with_title
FROM customer LEFT JOIN o ON opportunity_id = c_custkey LEFT JOIN part ON p_partkey = l_partkey AND p_size % 2 = 0 GROUP BY c_custkey""")
def evidence_detail(t):
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("opportunity_id"))
    part = F.col("l_partkey")
    cited = t("lineitem").join(orders, "l_orderkey").select("opportunity_id", F.lit("p").alias("platform"), part.alias("video_id"), part.alias("comment_id"), F.col("l_suppkey").alias("anon_author"), F.lit("t").alias("text")).distinct()
    videos = t("part").where("p_size % 2 = 0").select(F.lit("p").alias("platform"), F.col("p_partkey").alias("video_id"), F.col("p_name").alias("title"), F.lit("u").alias("url"))
    found = registry.with_evidence(_opportunities(t), cited, videos)
    n: Column = F.coalesce(F.size("evidence"), F.lit(0))
    titled = F.coalesce(F.size(F.filter("evidence", lambda e: e["title"].isNotNull())), F.lit(0))
    return found.select("opportunity_id", F.greatest(n, F.lit(0)).cast("long").alias("comments"), "users", F.greatest(titled, F.lit(0)).cast("long").alias("with_title"))


@query("""SELECT c_custkey AS opportunity_id, coalesce((SELECT min(p_partkey) FROM part WHERE p_size = c_nationkey AND p_partkey % 3 = c_custkey % 3), c_custkey) AS primary_id
FROM customer""")
def merge_routes(t):
    new = t("customer").select(F.col("c_custkey").alias("opportunity_id"), F.col("c_nationkey").alias("problem"), (F.col("c_custkey") % 3).alias("solution"))
    # known ones are one for each problem and solution class, as a registry without duplicates has them
    known = t("part").groupBy(F.col("p_size").alias("problem"), (F.col("p_partkey") % 3).alias("solution")).agg(F.min("p_partkey").alias("opportunity_id"))
    judged = registry.candidate_pairs(new, known, ["problem", "solution"]).select(F.col("n.opportunity_id"), "known_id", F.lit(True).alias("same_problem"), F.lit(True).alias("same_solution"))
    return registry.routed(new, judged).select("opportunity_id", "primary_id")


@query("SELECT c_custkey, c_name FROM customer")
def redacted_rows(t):
    return redacted(t("customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("api_key"), F.col("c_acctbal").alias("Cookie")))
