"""Read queries: home, lists, search, runs and tokens. Reading changes nothing, and nothing is graded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, at: str, key: str, n: int) -> DataFrame:
    """The ``n`` newest rows; equal times go by key."""
    return df.orderBy(F.desc(at), key).limit(n)


def inbox(opportunities: DataFrame, stages: DataFrame) -> DataFrame:
    """All that are still new, newest first."""
    return opportunities.join(stages.where("stage = 'new'").select("opportunity_id"), "opportunity_id", "left_semi").orderBy(F.desc("first_found_at"), "opportunity_id")


def incubating(opportunities: DataFrame, stages: DataFrame) -> DataFrame:
    """Those in a stage of a person's, last updated first."""
    inside = stages.where("stage not in ('new', 'develop', 'deferred', 'abandoned')")
    return opportunities.join(inside.select("opportunity_id", "stage", "updated_at"), "opportunity_id").orderBy(F.desc("updated_at"), "opportunity_id")


def home(opportunities: DataFrame, stages: DataFrame, progress: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` opportunities of a person's that were updated last, with what to do next in each."""
    rows = incubating(opportunities, stages).join(progress.select("opportunity_id", "stage", "done", "total", "next_action"), ["opportunity_id", "stage"], "left")
    return newest(rows, "updated_at", "opportunity_id", n)


def listed(df: DataFrame, **wanted: list) -> DataFrame:
    """Rows whose columns have one of the wanted values; a column without wishes, or with none, lets all rows by."""
    for name, values in wanted.items():
        if values:
            df = df.where(F.col(name).isin(*values))
    return df


def archive(opportunities: DataFrame, stages: DataFrame, transitions: DataFrame) -> DataFrame:
    """Those that ended, with the stage before and the reason, last ended first."""
    last = transitions.groupBy("opportunity_id").agg(F.max_by("reason", "seq").alias("reason"), F.max("at").alias("ended_at"))
    ended = stages.where("stage in ('develop', 'deferred', 'abandoned')").select("opportunity_id", "stage", "came_from")
    return opportunities.join(ended, "opportunity_id").join(last, "opportunity_id").orderBy(F.desc("ended_at"), "opportunity_id")


def matches(columns: list[str], words: str) -> Column:
    """Whether one of the columns contains ``words``, whatever the case; blank words match all."""
    found = F.lit(words.strip() == "")
    for c in columns:
        found = found | F.coalesce(F.lower(F.col(c)).contains(words.strip().lower()), F.lit(False))
    return found


def tokens(calls: DataFrame, by: str, since: Column | None = None) -> DataFrame:
    """Tokens in, out and both by ``by``, from calls since a time."""
    rows = calls if since is None else calls.where(F.col("at") >= since)
    return rows.groupBy(by).agg(F.count("*").alias("calls"), F.count_if(~F.col("ok")).alias("failures"), F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out")).withColumn("tokens", F.col("tokens_in") + F.col("tokens_out"))


def run_status(results: DataFrame, found: DataFrame) -> DataFrame:
    """``(run_id, platforms_ok, platforms, status)`` from the platforms' results and the number of opportunities.

    All platforms fine: success, with or without finds; hitting a budget is no failure. Some fine: partial failure. None:
    login_expired if a login was, else failed.
    """
    by_run = results.groupBy("run_id").agg(F.count_if(F.col("status") == "ok").alias("platforms_ok"), F.count("*").alias("platforms"), F.count_if(F.col("status") == "login_expired").alias("_l"))
    n = F.coalesce("opportunities", F.lit(0))
    status = F.when(F.col("platforms_ok") == F.col("platforms"), F.when(n > 0, "success_found").otherwise("success_empty")).when(F.col("platforms_ok") > 0, "partial_failure").when(F.col("_l") > 0, "login_expired").otherwise("failed")
    return by_run.join(found.select("run_id", "opportunities"), "run_id", "left").withColumn("status", status).select("run_id", "platforms_ok", "platforms", "status")


def run_states(runs: DataFrame, results: DataFrame, found: DataFrame) -> DataFrame:
    """``(run_id, platforms_ok, platforms, status)`` of every run in one of the nine states.

    A run that waits, is under way or was cancelled says so itself; one with results has the state that follows from
    them; one without any was not run.
    """
    made = run_status(results, found).withColumnRenamed("status", "_made")
    own = F.when(F.col("status").isin("waiting", "running", "cancelled"), F.col("status"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return runs.select("run_id", "status").join(made, "run_id", "left").select("run_id", zero("platforms_ok"), zero("platforms"), F.coalesce(own, F.col("_made"), F.lit("not_run")).alias("status"))


def run_list(runs: DataFrame, results: DataFrame, calls: DataFrame, status: str | None = None, day: Column | None = None) -> DataFrame:
    """The table of runs, last started first: start, state, seconds, platforms, videos, comments, tokens, opportunities.

    ``status`` and ``day`` (a date of the session's zone) choose among them. A run that goes on has no seconds.
    """
    chosen = runs if status is None else runs.where(F.col("status") == status)
    chosen = chosen if day is None else chosen.where(F.to_date("started_at") == day)
    ok = results.groupBy("run_id").agg(F.count_if(F.col("status") == "ok").alias("platforms_ok"), F.count("*").alias("platforms"))
    used = calls.groupBy("run_id").agg(F.sum(F.coalesce("tokens_in", F.lit(0)) + F.coalesce("tokens_out", F.lit(0))).alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = chosen.join(ok, "run_id", "left").join(used, "run_id", "left")
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    made = rows.select("run_id", "started_at", "status", seconds.alias("seconds"), *map(zero, ("platforms_ok", "platforms", "videos", "comments", "tokens", "opportunities")))
    return made.orderBy(F.desc_nulls_last("started_at"), "run_id")


def tokens_of_last_run(calls: DataFrame, runs: DataFrame) -> DataFrame:
    """Tokens by model of the run that started last, whatever became of it."""
    last = newest(runs.where("started_at is not null"), "started_at", "run_id", 1).select("run_id")
    return tokens(calls.join(last, "run_id", "left_semi"), "model")


def run_counters(videos: DataFrame, comments: DataFrame, calls: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Rows of each kind by run; a run without rows of a kind has 0."""
    kinds = {"videos": videos, "comments": comments, "model_calls": calls, "opportunities": opportunities}
    rows = None
    for name, df in kinds.items():
        one = df.groupBy("run_id").agg(F.count("*").alias("_n")).withColumn("_kind", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    total = lambda k: F.coalesce(F.sum(F.when(F.col("_kind") == k, F.col("_n"))), F.lit(0)).alias(k)
    return rows.groupBy("run_id").agg(*map(total, kinds))


def to_retry(results: DataFrame, run_id: str) -> DataFrame:
    """The platforms of a run that did not succeed: what a linked retry visits."""
    return results.where((F.col("run_id") == run_id) & (F.coalesce("status", F.lit("")) != "ok")).select("platform")


def with_retries(runs: DataFrame) -> DataFrame:
    """Each run with the status of the run that it repeats."""
    first = runs.select(F.col("run_id").alias("retry_of"), F.col("status").alias("original_status"))
    return runs.join(first, "retry_of", "left")


def last_success(runs: DataFrame) -> DataFrame:
    return newest(runs.where("status in ('success_empty', 'success_found')"), "started_at", "run_id", 1)


def missed_today(runs: DataFrame, now: Column, timezone: str) -> DataFrame:
    """One row: whether no run succeeded on the local day of ``now``. Nothing is caught up."""
    from trivox.functions.text import ran_today

    return runs.where("status in ('success_empty', 'success_found')").agg((F.count_if(ran_today(F.col("started_at"), now, timezone)) == 0).alias("missed"))


def durations(steps: DataFrame) -> DataFrame:
    return steps.withColumn("seconds", F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")))


def live_steps(steps: DataFrame) -> DataFrame:
    """``(run_id, platform, stage, state, micros, n_rows)``: how far each stage is, from a ledger that grows while a run
    goes on. A stage that has ended is no longer running; microseconds are those until its end, null before it."""
    made = steps.groupBy("run_id", "platform", "stage").agg(F.min(F.when(F.col("state") == "running", F.col("at"))).alias("_from"), F.max_by(F.struct("state", "at", "n_rows"), F.struct("at", F.col("state") != "running")).alias("_l"))
    micros = F.when(F.col("_l.state") != "running", F.unix_micros("_l.at") - F.unix_micros("_from"))
    return made.select("run_id", "platform", "stage", F.col("_l.state").alias("state"), micros.alias("micros"), F.col("_l.n_rows").alias("n_rows"))


def detail(opportunities: DataFrame, chain: DataFrame, evidence: DataFrame, transitions: DataFrame, notes: DataFrame) -> DataFrame:
    """Each opportunity as its page shows it: the nodes of its chain in their order, the evidence with the representative
    rows first, the moves it made and how many notes it has. Nothing of it grades the need."""
    rows = lambda df, columns, name: df.groupBy("opportunity_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
    shown = evidence.withColumn("place", F.when(F.col("is_representative"), 0).otherwise(1))
    users = evidence.groupBy("opportunity_id").agg(F.count_distinct("anon_author").alias("users"))
    alive = notes.groupBy("opportunity_id", "note_id").agg(F.max_by("deleted", "version").alias("_gone")).where(~F.coalesce("_gone", F.lit(False)))
    joined = opportunities.join(rows(chain, ["seq", "title", "kind", "body", "evidence_refs"], "chain"), "opportunity_id", "left")
    joined = joined.join(rows(shown, ["place", "platform", "video_id", "comment_id", "anon_author", "text"], "evidence"), "opportunity_id", "left")
    joined = joined.join(rows(transitions, ["seq", "from_stage", "to_stage", "reason", "at"], "moves"), "opportunity_id", "left").join(users, "opportunity_id", "left")
    counted = alive.groupBy("opportunity_id").agg(F.count("*").alias("n_notes"))
    return joined.join(counted, "opportunity_id", "left").withColumn("n_notes", F.coalesce("n_notes", F.lit(0).cast("long"))).withColumn("users", F.coalesce("users", F.lit(0).cast("long")))
