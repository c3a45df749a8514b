"""Queries over what lasts from run to run: identities, states, cursors, retries, adapters and candidates.

As in the catalog events are comments and line items steps of runs; a video is what an event's ``k`` names.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trivox.operators import consensus, gate_state, reports, retention, runs, similar
from trivox.plans.register import query
from trivox.sources import adapters
from trivox.sources.adapters import Adapter, From

def _k():
    return F.get_json_object("props", "$.k").cast("int")


_E = "e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


@query(f"""WITH RECURSIVE {_E}, m AS (SELECT k, 'n' || CAST(user_id % 3 AS VARCHAR) AS c, event_type AS t, event_id FROM e),
f AS (SELECT k, c, min(event_id) AS first FROM m GROUP BY ALL),
o AS (SELECT k, c, t, CAST(row_number() OVER (PARTITION BY k ORDER BY s DESC, t, first) AS INTEGER) AS i
FROM (SELECT k, c, t, count(*) AS s FROM m WHERE event_id % 3 <> 0 GROUP BY ALL) JOIN f USING (k, c)),
g AS (SELECT DISTINCT k, 0 AS i, CAST([] AS VARCHAR[]) AS uc, CAST([] AS VARCHAR[]) AS ut FROM o UNION ALL
SELECT g.k, o.i, CASE WHEN list_contains(uc, c) OR list_contains(ut, t) THEN uc ELSE list_append(uc, c) END,
CASE WHEN list_contains(uc, c) OR list_contains(ut, t) THEN ut ELSE list_append(ut, t) END FROM g JOIN o ON o.k = g.k AND o.i = g.i + 1)
SELECT o.k AS video_id, c AS cluster_id, t AS known_id FROM o JOIN g ON g.k = o.k AND g.i = o.i - 1 WHERE NOT list_contains(uc, c) AND NOT list_contains(ut, t)""")
def cluster_identity(t):
    """Which older cluster each new one is; some of the new ones' comments are in no older cluster."""
    rows = t("events").select(F.lit("p").alias("platform"), _k().alias("video_id"), F.concat(F.lit("n"), (F.col("user_id") % 3).cast("string")).alias("n"), F.col("event_type").alias("k"), F.col("event_id").alias("comment_id"))
    new, known = rows.withColumnRenamed("n", "cluster_id"), rows.where("comment_id % 3 <> 0").withColumnRenamed("k", "cluster_id")
    return consensus.assigned(new, known).select("video_id", "cluster_id", "known_id")


@query(f"""WITH {_E} SELECT k AS video_id, event_type AS cluster_id FROM e WHERE ts >= (SELECT max(ts) - INTERVAL 10 DAY FROM events)
GROUP BY ALL HAVING count(DISTINCT user_id) >= 3""")
def gate_by_deltas(t):
    """Three deltas, merged one after the other, against counting everybody at once."""
    group = ["video_id", "cluster_id"]
    rows = t("events").select(_k().alias("video_id"), F.col("event_type").alias("cluster_id"), "user_id", "ts", "event_id")
    # one row
    now = rows.agg(F.max("ts")).first()[0]
    parts = [gate_state.state_of(rows.where(F.col("event_id") % 3 == i), group, "user_id", "ts") for i in range(3)]
    state = gate_state.merged(gate_state.merged(parts[0], parts[1], group), parts[2], group, now)
    return gate_state.passing(state, group, now)


@query("""WITH r AS (SELECT l_orderkey, string_agg(DISTINCT lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), ',' ORDER BY lpad(CAST(l_suppkey AS VARCHAR), 8, '0')) AS s, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1),
d AS (SELECT DISTINCT s, n FROM r), x AS (SELECT s, n, unnest(string_split(s, ',')) AS token FROM d),
p AS (SELECT a.s AS left_set, b.s AS right_set, count(*) AS shared, any_value(a.n + b.n) AS sizes FROM x a JOIN x b ON a.token = b.token AND a.s < b.s GROUP BY ALL)
SELECT left_set, right_set, CAST(shared AS INTEGER) AS shared, CAST(sizes - shared AS INTEGER) AS either FROM p WHERE 10 * shared >= 6 * (sizes - shared)""")
def similar_sets(t):
    """Pairs of different sets, of suppliers of an order, with a Jaccard index of 0.6 or more."""
    token = F.lpad(F.col("l_suppkey").cast("string"), 8, "0")
    # plain rows are dealt by order; a name holds its tokens
    named = t("lineitem").select("l_orderkey", token.alias("token")).repartition("l_orderkey").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("token")), ",").alias("set"))
    return similar.similar_sets(named.where("set <> ''").select("set").distinct(), least=(6, 10), told=lambda s: F.split(s, ","))


_SHAPES = Adapter("events", {"comment": {"comment_id": From(("$.id", "$.meta.id")), "video_id": "$.video.k", "author_id": "$.user", "text": "$.kind", "first_ingested_at": From(("$.at",), "microseconds"), "commented_at": "$.said"}}, {"platform": "douyin"})


@query(f"""WITH {_E} SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS comment_id,
CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END AS video_id, CASE WHEN event_id % 13 <> 0 AND event_id % 11 <> 0 THEN CAST(1 + event_id % 2 AS INTEGER) END AS level,
CASE WHEN event_id % 13 <> 0 THEN ts END AS first_ingested_at,
CASE WHEN event_id % 13 = 0 THEN 'unparsable' WHEN event_id % 7 = 0 THEN 'missing:comment_id' WHEN event_id % 11 = 0 THEN 'type:level' END AS reason FROM e""")
def adapter_rows(t):
    """Two shapes of JSON in the contract's columns, and why some rows do not fit."""
    c, text = F.col, lambda x: F.col(x).cast("string")
    number = F.when(c("event_id") % 7 != 0, c("event_id"))
    level = F.when(c("event_id") % 11 == 0, F.lit('"x"')).otherwise((1 + c("event_id") % 2).cast("string"))
    tail = F.concat(F.lit(', "video": {"k": '), _k().cast("string"), F.lit('}, "user": "'), text("user_id"), F.lit('", "level": '), level, F.lit(', "at": '), F.unix_micros(c("ts").cast("timestamp")).cast("string"), F.lit("}"))
    head = F.when(number.isNull(), F.lit('{"id": null')).when(c("event_id") % 2 == 0, F.concat(F.lit('{"id": '), number.cast("string"))).otherwise(F.concat(F.lit('{"meta": {"id": "'), number.cast("string"), F.lit('"}')))
    line = F.when(c("event_id") % 13 == 0, F.concat(F.lit("{broken "), text("event_id"))).otherwise(F.concat(head, F.lit(', "n": '), text("event_id"), tail))
    made = adapters.normalised(t("events").select(line.alias("value")), "comment", _SHAPES)
    number = F.coalesce(F.regexp_extract("line", r'"n": (\d+)', 1).try_cast("long"), F.regexp_extract("line", r"broken (\d+)", 1).try_cast("long"))
    return made.select(number.alias("event_id"), "comment_id", "video_id", "level", c("first_ingested_at").cast("timestamp_ntz").alias("first_ingested_at"), "reason")


@query("""SELECT run_id, stage FROM (SELECT *,
min(CASE WHEN NOT ok THEN stage END) OVER (PARTITION BY run_id) AS first FROM (SELECT l_orderkey AS run_id, l_linenumber AS stage, bool_or(l_linestatus = 'O') AS ok FROM lineitem GROUP BY ALL)) WHERE NOT ok OR stage > first""")
def retry_steps(t):
    """What a retry of each run repeats: what failed, and what worked on its result."""
    rows = t("lineitem").select(F.col("l_orderkey").alias("run_id"), F.lit("*").alias("platform"), F.col("l_linenumber").alias("stage"), F.when(F.col("l_linestatus") == "O", "ok").otherwise("failed").alias("state"))
    return runs.repeated(rows.drop("state").distinct().withColumn("place", F.col("stage")), rows).select("run_id", "stage")


@query(f"""WITH {_E} SELECT k AS video_id, max(lpad(CAST(epoch_us(ts) AS VARCHAR), 20, '0') || '|' || CAST(event_id AS VARCHAR)) AS cursor, min(ts) AS first_seen, max(ts) AS last_seen FROM e WHERE event_id % 5 <> 0 OR event_id % 3 <> 1 GROUP BY k""")
def video_cursors(t):
    """How far the comments of each video were taken, from two fetches that overlap."""
    rows = t("events").select(F.lit("p").alias("platform"), _k().alias("video_id"), F.col("event_id").cast("string").alias("comment_id"), F.col("ts").alias("commented_at"), F.col("ts").alias("first_ingested_at"))
    early, late = rows.where("cast(comment_id as long) % 5 <> 0"), rows.where("cast(comment_id as long) % 3 <> 1")
    made = [retention.cursors(part.select("platform", "video_id", "first_ingested_at"), part) for part in (early, late)]
    return retention.latest(made[0].unionByName(made[1])).select(F.col("id").alias("video_id"), "cursor", "first_seen", "last_seen")


@query("""WITH s AS (SELECT user_id AS run_id, event_type AS stage, CASE WHEN event_id % 3 = 0 THEN 'running' WHEN event_id % 3 = 1 THEN 'ok' ELSE 'failed' END AS state, ts, CAST(floor(value) AS BIGINT) AS n FROM events)
SELECT run_id, stage, arg_max(state, ts) AS state, CASE WHEN arg_max(state, ts) <> 'running' THEN epoch_us(max(ts)) - epoch_us(min(ts) FILTER (WHERE state = 'running')) END AS micros,
arg_max(n, ts) AS n_rows FROM s GROUP BY run_id, stage""")
def live_stages(t):
    """How far each stage of each run is, from the rows of a ledger."""
    state = F.when(F.col("event_id") % 3 == 0, "running").when(F.col("event_id") % 3 == 1, "ok").otherwise("failed")
    steps = t("events").select(F.col("user_id").alias("run_id"), F.lit("*").alias("platform"), F.col("event_type").alias("stage"), state.alias("state"), F.col("ts").cast("timestamp").alias("at"), F.floor("value").alias("n_rows"))
    made = reports.live_steps(steps)
    return made.select("run_id", "stage", "state", F.col("micros"), "n_rows")


@query("""WITH e AS (SELECT l_orderkey AS o, count(*) AS n_evidence, count(DISTINCT l_suppkey) AS users, min(CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END) AS first FROM lineitem GROUP BY 1),
v AS (SELECT o_custkey AS o, o_orderkey AS note, arg_max(o_orderstatus, o_orderdate) AS s FROM orders GROUP BY ALL)
SELECT o_orderkey AS opportunity_id, coalesce(e.n_evidence, 0) AS n_evidence, coalesce(users, 0) AS users, first = 0 AS representative_first, coalesce(c.n, 0) AS n_notes FROM orders
LEFT JOIN e ON e.o = o_orderkey LEFT JOIN (SELECT o, count(*) AS n FROM v WHERE s <> 'F' GROUP BY 1) c ON c.o = o_orderkey""")
def pages_of_opportunities(t):
    """Each opportunity's page: its evidence, representative rows first, its people and its notes that were not deleted."""
    c = F.col
    found = t("orders").select(c("o_orderkey").alias("opportunity_id"))
    none = lambda kinds: t("orders").sparkSession.createDataFrame([], kinds)
    chain = none("opportunity_id long, seq int, title string, kind string, body string, evidence_refs array<string>")
    moves = none("opportunity_id long, seq long, from_stage string, to_stage string, reason string, at timestamp")
    evidence = t("lineitem").select(c("l_orderkey").alias("opportunity_id"), F.lit("p").alias("platform"), c("l_partkey").alias("video_id"), c("l_linenumber").alias("comment_id"), c("l_suppkey").alias("anon_author"), F.lit("t").alias("text"), (c("l_linenumber") == 1).alias("is_representative"))
    notes = t("orders").select(c("o_custkey").alias("opportunity_id"), c("o_orderkey").alias("note_id"), c("o_orderdate").alias("version"), (c("o_orderstatus") == "F").alias("deleted"))
    made = reports.detail(found, chain, evidence, moves, notes)
    return made.select("opportunity_id", F.coalesce(F.size("evidence").cast("long"), F.lit(0)).alias("n_evidence"), "users", (F.get("evidence", F.lit(0))["place"] == 0).alias("representative_first"), "n_notes")
