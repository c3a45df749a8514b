"""The queries over the engine's operators, by name, and SQL that gives the same rows.

The tables at hand have no comments, so others stand in: an event is a comment, its user the author, its ``props.k`` and
week the item, its type the cluster; documents are texts, orders runs, conversations threads. The operators are those
of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivox.functions.text import author_hash, content_hash, is_deictic, noise_rule
from trivox.operators import consensus, eligibility, registry, reports, runs, semantics, workflow
from trivox.plans.register import oracle_sql, queries, query

__all__ = ["oracle_sql", "queries"]

ITEM = ["k", "week"]
GROUP = [*ITEM, "event_type"]
SALT = "salt"

_EV = "ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(date_trunc('week', ts) AS DATE) AS week FROM events)"
_GATE = f"{_EV}, g AS (SELECT k, week, event_type, count(DISTINCT user_id) AS users, count(*) AS n_rows FROM ev GROUP BY ALL)"


def _events(t) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return t("events").select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"), F.date_trunc("week", "ts").cast("date").alias("week"))


def _cutoff(t) -> DataFrame:
    """One row: ten days before the last event."""
    return t("events").agg((F.max("ts") - F.expr("INTERVAL 10 DAYS")).alias("cutoff"))


def _days_back(t, days: int) -> Column:
    """A literal, so that a filter by it reaches the scan: ``days`` days before the last event."""
    from datetime import timedelta

    kind = t("events").schema["ts"].dataType
    last = t("events").agg(F.max("ts")).first()[0]
    at = None if last is None else last - timedelta(days=days)
    # a time without a zone goes as text, which no zone shifts
    return F.lit(str(at) if at and kind.simpleString() == "timestamp_ntz" else at).cast(kind)


@query(f"WITH {_GATE} SELECT * FROM g WHERE users >= 3")
def consensus_gate(t):
    return consensus.gate(_events(t), GROUP, "user_id")


@query(f"WITH {_GATE} SELECT * FROM g WHERE users = 2")
def consensus_near_miss(t):
    return consensus.people(_events(t), GROUP, "user_id").where("users = 2")


@query(f"""WITH {_GATE}, p AS (SELECT event_type, week, count(DISTINCT user_id) AS pooled_users FROM ev GROUP BY ALL)
SELECT p.event_type AS event_type, p.week AS week, count(*) FILTER (WHERE g.users >= 3) AS groups_passing, any_value(p.pooled_users) AS pooled_users
FROM p JOIN g USING (event_type, week) GROUP BY p.event_type, p.week""")
def no_cross_video_pool(t):
    ev = _events(t)
    passing = consensus.people(ev, GROUP, "user_id").groupBy("event_type", "week").agg(F.count_if(F.col("users") >= 3).alias("groups_passing"))
    return passing.join(consensus.people(ev, ["event_type", "week"], "user_id").withColumnRenamed("users", "pooled_users").drop("n_rows"), ["event_type", "week"])


_FIRST = """f AS (SELECT *, row_number() OVER (PARTITION BY k, week, event_type, user_id ORDER BY ts, event_id) AS n FROM ev),
e AS (SELECT *, row_number() OVER (PARTITION BY k, week, event_type ORDER BY ts, event_id) AS place FROM f WHERE n = 1)"""


@query(f"""WITH {_GATE}, {_FIRST} SELECT k, week, event_type, user_id, event_id, CAST(place AS INTEGER) AS place
FROM e JOIN g USING (k, week, event_type) WHERE place <= 3 AND users >= 3""")
def representative_evidence(t):
    return consensus.gated_evidence(_events(t), GROUP, "user_id", ["ts", "event_id"]).select(*GROUP, "user_id", "event_id", "place")


@query(f"""WITH {_GATE}, {_FIRST} SELECT k, week, event_type, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY place) AS event_ids
FROM e JOIN g USING (k, week, event_type) WHERE place <= 3 AND users >= 3 GROUP BY k, week, event_type""")
def evidence_list(t):
    found = consensus.gated_evidence(_events(t), GROUP, "user_id", ["ts", "event_id"])
    rows = consensus.collected(found, GROUP, ["event_id"])
    return rows.select(*GROUP, F.concat_ws(",", F.transform("evidence", lambda e: e["event_id"].cast("string"))).alias("event_ids"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text")
def comment_dedup(t):
    return t("documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


@query(r"SELECT DISTINCT ON (h) doc_id, source, h AS content_hash FROM (SELECT *, sha256(regexp_replace(trim(text), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS h FROM documents) ORDER BY h, doc_id")
def content_hash_dedup(t):
    hashed = t("documents").select("doc_id", "source", content_hash(F.col("text")).alias("content_hash"))
    return eligibility.first_per_key(hashed, ["content_hash"], ["doc_id"])


@query("SELECT sha256(text) AS digest, count(DISTINCT source) AS sources, count(*) AS n_rows, min(doc_id) AS first_key FROM documents GROUP BY text HAVING count(DISTINCT source) >= 2")
def cross_source_duplicates(t):
    return registry.exact_groups(t("documents").select("doc_id", "source", F.sha2("text", 256).alias("digest")), "digest", "doc_id", "source")


@query("SELECT event_id, user_id, event_type FROM events WHERE ts < (SELECT max(ts) - INTERVAL 10 DAY FROM events)")
def retention_expired(t):
    return t("events").where(F.col("ts") < _days_back(t, 10)).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM events)")
def retention_live(t):
    return t("events").where(F.col("ts") >= _days_back(t, 10)).select("event_id", "user_id", "event_type")


@query(f"""WITH {_GATE}, {_FIRST} SELECT event_id, user_id FROM ev WHERE ts < (SELECT max(ts) - INTERVAL 10 DAY FROM events)
AND NOT EXISTS (SELECT 1 FROM e JOIN g USING (k, week, event_type) WHERE g.users >= 3 AND e.event_id = ev.event_id)""")
def purge_unreferenced(t):
    gone = t("events").where(F.col("ts") < _days_back(t, 10)).select("event_id", "user_id")
    cited = consensus.cited(_events(t), GROUP, "user_id", ["ts", "event_id"])
    return gone.join(cited.select("event_id"), "event_id", "left_anti").select("event_id", "user_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def unprocessed_rows(t):
    return t("documents").select("doc_id", "source").join(t("labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def still_in_pool(t):
    return eligibility.in_pool(t("documents").select("doc_id", "source"), t("labels"), ["doc_id"])


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 5")
def cap_per_group(t):
    return eligibility.top_per_group(t("events"), ["event_type"], ["ts", "event_id"], 5).select("event_type", "event_id")


@query("""WITH o AS (SELECT o_orderkey, o_orderdate, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders),
d AS (SELECT o_orderdate, sum(price) AS total FROM o GROUP BY 1), s AS (SELECT *, sum(total) OVER (ORDER BY o_orderdate) - total AS before FROM d),
r AS (SELECT o_orderkey, price, before + sum(price) OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS spent FROM o JOIN s USING (o_orderdate))
SELECT o_orderkey, price, CAST(spent AS BIGINT) AS spent FROM r WHERE spent <= 50000000""")
def run_budget_cut(t):
    from pyspark.sql import Window

    o = t("orders").select("o_orderkey", "o_orderdate", F.floor("o_totalprice").alias("price"))
    # the running sum over all is over one row for each date, the rest is within a date
    days = o.groupBy("o_orderdate").agg(F.sum("price").alias("_p"))
    before = days.select("o_orderdate", (F.sum("_p").over(Window.orderBy("o_orderdate")) - F.col("_p")).alias("_before"))
    spent = F.col("_before") + F.sum("price").over(Window.partitionBy("o_orderdate").orderBy("o_orderkey"))
    return o.join(before, "o_orderdate").withColumn("spent", spent).where("spent <= 50000000").select("o_orderkey", "price", "spent")


@query(f"""WITH {_EV}, f AS (SELECT k, week, event_type, user_id, min(ts) AS seen FROM ev GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY k, week, event_type ORDER BY seen, user_id) AS n FROM f)
SELECT k, week, event_type, CAST(seen AS DATE) AS day FROM n WHERE n = 3""")
def accumulate_days(t):
    return consensus.reached(_events(t), GROUP, "user_id", "ts").select(*GROUP, F.to_date("reached_at").alias("day"))


@query("""SELECT event_type, count(*) AS calls, count(*) FILTER (WHERE value <= 1) AS failures, CAST(sum(user_id) AS BIGINT) AS tokens_in, CAST(sum(event_id) AS BIGINT) AS tokens_out,
CAST(sum(user_id) + sum(event_id) AS BIGINT) AS tokens FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events) GROUP BY event_type""")
def token_usage_7d(t):
    calls = t("events").where(F.col("ts") >= _days_back(t, 7))
    return reports.tokens(calls.select("event_type", "ts", (F.col("value") > 1).alias("ok"), F.col("user_id").alias("tokens_in"), F.col("event_id").alias("tokens_out")), "event_type")


@query("""SELECT o_custkey AS run_id, count(*) FILTER (WHERE o_orderstatus = 'F') AS platforms_ok, count(*) AS platforms,
CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = count(*) THEN CASE WHEN o_custkey % 2 = 1 THEN 'success_found' ELSE 'success_empty' END
WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN 'partial_failure' WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'login_expired' ELSE 'failed' END AS status
FROM orders GROUP BY o_custkey""")
def run_status(t):
    state = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "login_expired").otherwise("failed")
    found = t("customer").select(F.col("c_custkey").alias("run_id"), (F.col("c_custkey") % 2).alias("opportunities"))
    return reports.run_status(t("orders").select(F.col("o_custkey").alias("run_id"), state.alias("status")), found)


@query("""SELECT o_custkey AS run_id, count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS videos, count(*) FILTER (WHERE o_orderpriority LIKE '2%') AS comments,
count(*) FILTER (WHERE o_orderpriority LIKE '3%') AS model_calls, count(*) FILTER (WHERE o_orderpriority LIKE '4%') AS opportunities FROM orders
WHERE substr(o_orderpriority, 1, 1) IN ('1', '2', '3', '4') GROUP BY o_custkey""")
def run_counters(t):
    of = lambda n: t("orders").where(F.col("o_orderpriority").startswith(n)).select(F.col("o_custkey").alias("run_id"))
    return reports.run_counters(of("1"), of("2"), of("3"), of("4"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 3")
def newest_three(t):
    return reports.newest(t("orders"), "o_orderdate", "o_orderkey", 3).select("o_orderkey", "o_custkey")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def current_state(t):
    return workflow.latest(t("events").withColumn("at", F.struct("ts", "event_id")), ["user_id"], "event_type", "at")


@query("SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_event_type FROM events")
def state_history(t):
    return workflow.history(t("events"), ["user_id"], "event_type", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "previous_event_type")


@query("SELECT c.conv_id AS conv_id, c.turn AS turn, c.role AS role, p.role AS parent_role FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1")
def thread_parent(t):
    rows = t("conversations").select("conv_id", "turn", "role", (F.col("turn") - 1).alias("parent"))
    parent = rows.select("conv_id", F.col("turn").alias("parent"), F.col("role").alias("parent_role"))
    return rows.join(parent, ["conv_id", "parent"], "left").select("conv_id", "turn", "role", "parent_role")


_CHECK = """items AS (SELECT row_number() OVER (ORDER BY event_type) AS item_no, event_type AS item FROM (SELECT DISTINCT event_type FROM events)),
made AS (SELECT u.user_id, i.item_no, i.item, EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND e.event_type = i.item AND e.value > 20) AS done
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN items i)"""


def _progress(t) -> DataFrame:
    from pyspark.sql import Window

    kinds = t("events").select("event_type").distinct()
    defs = kinds.select(F.lit("s").alias("stage"), F.row_number().over(Window.orderBy("event_type")).alias("item_no"), F.col("event_type").alias("item"))  # a few types
    users = t("events").select(F.col("user_id").alias("opportunity_id")).distinct().withColumn("stage", F.lit("s"))
    done = t("events").where("value > 20").select(F.col("user_id").alias("opportunity_id"), F.lit("s").alias("stage"), F.col("event_type").alias("item"), F.lit(True).alias("done")).distinct()
    ticks = done.join(F.broadcast(defs), ["stage", "item"])
    said = users.where("opportunity_id % 2 = 0").withColumn("text", F.lit("concluded"))
    return workflow.checklist(users, ticks, said, defs)


@query(f"WITH {_CHECK} SELECT user_id, count(*) FILTER (WHERE done) AS done, count(*) AS total FROM made GROUP BY user_id")
def checklist_progress(t):
    return _progress(t).select(F.col("opportunity_id").alias("user_id"), "done", "total")


@query(f"""WITH {_CHECK} SELECT user_id, coalesce(arg_min(item, item_no) FILTER (WHERE NOT done),
CASE WHEN user_id % 2 = 0 THEN '进入下一阶段' ELSE '填写阶段结论' END) AS next_action FROM made GROUP BY user_id""")
def next_action(t):
    return _progress(t).select(F.col("opportunity_id").alias("user_id"), "next_action")


@query("SELECT doc_id, source FROM documents WHERE contains(lower(text), 'the in') OR contains(lower(source), 'the in')")
def search_text(t):
    return t("documents").where(reports.matches(["text", "source"], "The In")).select("doc_id", "source")


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('de', 'fr') AND source <> 'src0'")
def list_filter(t):
    return t("documents").where(F.col("lang").isin("de", "fr") & (F.col("source") != "src0")).select("doc_id", "lang", "source")


@query(r"SELECT conv_id, turn FROM conversations WHERE regexp_matches(coalesce(text, ''), '^[\p{So}\p{Sk}\p{P}\p{M}\x{200D}\s]*$')")
def noise_filter(t):
    return t("conversations").where(noise_rule(F.col("text")) == "symbols_only").select("conv_id", "turn")


@query("SELECT doc_id, coalesce(regexp_matches(text, '这个|同款|也想要|求链接|怎么做'), false) AS deictic FROM documents")
def deictic_flag(t):
    return t("documents").select("doc_id", is_deictic(F.col("text")).alias("deictic"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN (SELECT min(event_type) FROM events UNION ALL SELECT max(event_type) FROM events)")
def platform_union(t):
    of = lambda pick: t("events").join(F.broadcast(t("events").agg(pick("event_type").alias("event_type"))), "event_type").select("event_id", "event_type")  # noqa: E731  one row
    return of(F.min).unionByName(of(F.max))


@query(r"SELECT event_id, sha256('salt' || chr(1) || event_type || chr(1) || CAST(user_id AS VARCHAR)) AS anon_author FROM events")
def anonymised(t):
    return t("events").select("event_id", author_hash(F.col("event_type"), F.col("user_id").cast("string"), SALT).alias("anon_author"))


@query("SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM events GROUP BY user_id")
def first_last_seen(t):
    return t("events").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))


@query("SELECT user_id, event_id, CAST(date_sub('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS BIGINT) AS seconds FROM events WHERE TRUE QUALIFY seconds IS NOT NULL")
def step_duration(t):
    steps = workflow.history(t("events"), ["user_id"], "ts", ["ts", "event_id"]).where("previous_ts is not null")
    return reports.durations(steps.withColumnsRenamed({"previous_ts": "started_at", "ts": "ended_at"})).select("user_id", "event_id", "seconds")


@query("""WITH r AS (SELECT o_custkey, min(o_orderkey) AS primary_id FROM orders GROUP BY o_custkey)
SELECT primary_id AS opportunity_id, l_partkey AS comment_id, l_suppkey AS author FROM (SELECT r.primary_id, l.l_partkey, l.l_suppkey,
row_number() OVER (PARTITION BY r.primary_id, l.l_partkey ORDER BY l.l_orderkey, l.l_linenumber, l.l_suppkey) AS n
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN r ON r.o_custkey = o.o_custkey) WHERE n = 1""")
def evidence_merge(t):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey")
    routes = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.min("o_orderkey").over(w).alias("opportunity_id"))
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("comment_id"), F.col("l_suppkey").alias("author")).join(routes, "l_orderkey")
    return eligibility.first_per_key(rows, ["opportunity_id", "comment_id"], ["l_orderkey", "l_linenumber", "author"]).select("opportunity_id", "comment_id", "author")


@query("SELECT o_orderkey AS from_id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS primary_id FROM orders QUALIFY o_orderkey <> primary_id")
def duplicate_primary(t):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    chain = t("orders").select(F.col("o_orderkey").alias("from_id"), F.lag("o_orderkey").over(w).alias("to_id"), F.lit("duplicate").alias("type"))
    return registry.primaries(chain.where("to_id is not null"))


@query(f"""WITH {_GATE}, {_FIRST}, c AS (SELECT e.event_id FROM e JOIN g USING (k, week, event_type) WHERE g.users >= 3),
m AS (SELECT max(ts) - INTERVAL 10 DAY AS cutoff FROM events)
SELECT count(*) FILTER (WHERE ts >= cutoff) AS live, count(*) FILTER (WHERE ts < cutoff) AS expired,
count(*) FILTER (WHERE ts < cutoff AND event_id NOT IN (SELECT event_id FROM c)) AS to_purge FROM ev, m""")
def purge_preview(t):
    cited = consensus.cited(_events(t), GROUP, "user_id", ["ts", "event_id"])
    return runs.purge_sizes(t("events"), cited, ["event_id"], "ts", _cutoff(t))


@query("SELECT o_orderkey AS run_id, o_custkey AS started_by FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def latest_success(t):
    done = F.when(F.col("o_orderstatus") == "F", "success_found").otherwise("failed")
    made = t("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("started_by"), F.col("o_orderdate").alias("started_at"), done.alias("status"))
    return reports.last_success(made).select("run_id", "started_by")


@query("""SELECT o_orderkey AS run_id, o_orderstatus AS status, lag(o_orderkey) OVER w AS retry_of, lag(o_orderstatus) OVER w AS original_status
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def retry_status(t):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    made = t("orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status"), F.lag("o_orderkey").over(w).alias("retry_of"))
    return reports.with_retries(made).select("run_id", "status", "retry_of", "original_status")


@query("""SELECT note_id, l_orderkey, l_linenumber FROM (SELECT l_partkey AS note_id, l_orderkey, l_linenumber, l_returnflag,
row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1 AND l_returnflag <> 'R'""")
def note_latest(t):
    made = t("lineitem").select(
        F.col("l_partkey").alias("note_id"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("version"), (F.col("l_returnflag") == "R").alias("deleted"),
        F.lit("o").alias("opportunity_id"), F.lit("s").alias("stage"), F.lit(0).alias("position"), "l_orderkey", "l_linenumber",
    )
    return workflow.note_versions(made).select("note_id", "l_orderkey", "l_linenumber")


@query("""SELECT k, week, event_id, CAST(dense_rank() OVER (PARTITION BY k, week ORDER BY event_type) AS INTEGER) AS cluster FROM
(SELECT *, row_number() OVER (PARTITION BY k, week ORDER BY ts, event_id) AS n FROM (WITH """ + _EV + """ SELECT * FROM ev)) WHERE n <= 200""")
def clusters_in_item(t):
    return semantics.clusters_by_item(_events(t), ITEM, "event_id", "event_type", semantics.same_text, ["ts", "event_id"])


import trivox.plans.decisions  # noqa: E402,F401  registers its queries after those above
import trivox.plans.state  # noqa: E402,F401
import trivox.plans.views  # noqa: E402,F401
