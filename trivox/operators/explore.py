"""One exploration from landing files to registered opportunities, over a store of tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.functions.text import RULES_VERSION, author_hash
from trivox.operators import admission, consensus, eligibility, registry, retention, runs, semantics, similar
from trivox.sources import files
from trivox.sources.adapters import PLAIN, Adapter
from trivox.sources.landing import Settings, ready_platforms
from trivox.sources.schemas import SCHEMAS
from trivox.sources.store import Changes, Fenced, Store
from trivox.streaming.intake import intake

GROUP = ["platform", "video_id", "cluster_id"]
#: The stages behind the platforms' own fetches, in order; each works on what the one before left.
STAGES = ("cluster", "register", "purge")
MODEL, PROMPT = "model", "p1"
#: What of an opportunity tells whether another one may be the same.
TOLD = ("title", "target_user", "scenario", "pain", "core_value")
ALL = "*"


def explore(
    spark: SparkSession, base: str, landing: str, settings: Settings, run_id: str, now: datetime, cluster: Callable[[list[str]], list[int]], describe: Callable[[list[str]], list[str]],
    cancelled: Callable[[], bool] = lambda: False, same: Callable[[list[str]], list[str]] | None = None, resolve: Callable[[list[str]], list[str]] | None = None, retry_of: str | None = None, store: Store | None = None,
    adapters: dict[str, Adapter] | None = None,
) -> str:
    """Runs one exploration and returns the state that it ended in; ``running`` if another one is under way.

    ``landing`` has a folder ``<platform>/video`` and ``<platform>/comment`` of JSON lines for each platform, in the shape
    that its adapter names; files that an earlier run took in are not read again. A platform without a valid login, or
    whose files cannot be read to the end, fails alone. All rows are kept; as many videos as
    the settings allow are judged, those with comments that no run has looked at yet. Their live comments are clustered by
    ``cluster`` inside the video, and clusters keep their ids from run to run. What three people need is described by
    ``describe``; ``same`` says, of the texts of a new and a known opportunity, whether problem and direction are the same
    (JSON ``{"same_problem": true, "same_solution": true}``), and if so the evidence goes to the known one. What passes all
    filters becomes an opportunity. ``resolve`` looks at clusters that need context (``true`` or not), if images can be
    read. Each stage is one commit with its row in the ledger; a run that lost its lease changes nothing any more, and a
    retry (``retry_of``) repeats what failed and what follows from it. A cancel takes effect between stages. A model that
    raises ends the run as failed, with its error.
    """
    store = store or Store(spark, base)
    lease = store.take(run_id)
    if lease is None:
        return "running"
    try:
        return Exploration(spark, store, lease, landing, settings, run_id, now, cluster, describe, cancelled, same, resolve, retry_of, adapters).run()
    finally:
        store.release(lease)


class Exploration:
    def __init__(self, spark, store, lease, landing, settings, run_id, now, cluster, describe, cancelled, same, resolve, retry_of, adapters=None):
        self.spark, self.store, self.lease, self.landing, self.settings = spark, store, lease, landing, settings
        self.run_id, self.now, self.judge, self.describe, self.cancelled = run_id, now, cluster, describe, cancelled
        self.same, self.resolve, self.retry_of, self.adapters = same, resolve, retry_of, adapters or {}
        self.began, self.at = time.monotonic(), F.lit(now)
        self.videos = self.comments = self.calls = self.made = 0
        self.exhausted, self.rows = False, {}
        self.scratch = f"{store.base}/_scratch/{run_id}"

    def stage(self, name: str, platform: str, work: Callable[[Changes], None], before: Callable[[], None] = lambda: None, after: Callable[[], None] = lambda: None) -> None:
        """One stage: its changes and its row of the ledger in one commit; that it runs, or failed, is one of its own."""
        self.noted(self.store.changes(self.lease), platform, name, "running")
        try:
            before()
            changes = self.store.changes(self.lease)
            work(changes)
            self.noted(changes, platform, name, "ok", self.rows.get((platform, name)))
            after()
        except Fenced:
            raise
        except Exception as e:
            self.noted(self.store.changes(self.lease), platform, name, "failed", None, f"{type(e).__name__}: {e}"[:2000])
            raise

    def noted(self, changes: Changes, platform: str, name: str, state: str, n_rows: int | None = None, error: str | None = None) -> None:
        at = self.now + timedelta(seconds=time.monotonic() - self.began)
        changes.add("run_step", self.spark.createDataFrame([(self.run_id, platform, name, state, at, n_rows, error)], SCHEMAS["run_step"]), ())
        changes.commit()

    def todo(self, platforms: list[str]) -> set[tuple[str, str]]:
        """What this run does: all, or of a retry what is to be repeated."""
        steps = [(p, "fetch", 0) for p in platforms] + [(ALL, s, i) for i, s in enumerate(STAGES, 1)]
        if self.retry_of is None:
            return {s[:2] for s in steps}
        table = self.spark.createDataFrame([(self.retry_of, *s) for s in steps], "run_id string, platform string, stage string, place int")
        return {(r["platform"], r["stage"]) for r in runs.repeated(table, self.store.read("run_step")).collect()}

    def run(self) -> str:
        for left in files.names(self.spark, f"{self.store.base}/_scratch"):
            if left != self.run_id:  # of a run that was broken off: the lease is ours
                files.removed(self.spark, f"{self.store.base}/_scratch/{left}")
        state, error, stopped = {}, None, None
        try:
            # a row for each platform
            ready = {r["platform"]: None if r["ready"] else r["error_kind"] for r in ready_platforms(self.store.read("platform_account"), self.settings).collect()}
            todo, state = self.todo(list(ready)), dict(ready)
            steps = [("fetch", lambda: state.update(self.fetched(state, todo)))]
            works = {"cluster": self.clustered, "register": self.registered, "purge": self.purged}
            after = {"purge": lambda: (self.store.vacuum(), files.removed(self.spark, self.scratch))}
            steps += [(s, lambda s=s: self.stage(s, ALL, works[s], after=after.get(s, lambda: None))) for s in STAGES if (ALL, s) in todo]
            _, stopped = runs.run_steps(steps, self.cancelled)
        except Fenced:
            raise
        except Exception as e:  # noqa: BLE001  whatever a model or a file does ends as the run's error
            error = f"{type(e).__name__}: {e}"[:2000]
        return self.ended(state, stopped, error)

    def ended(self, state: dict, stopped: str | None, error: str | None) -> str:
        ok, expired = sum(f is None for f in state.values()), any(f == "login_expired" for f in state.values())
        whole = "success_found" if self.made else "success_empty"
        end = "failed" if error else "cancelled" if stopped else whole if ok == len(state) else "partial_failure" if ok else "login_expired" if expired else "failed"
        changes = self.store.changes(self.lease)
        results = [(self.run_id, p, "ok" if f is None else f if f == "login_expired" else "failed", f) for p, f in state.items()]
        changes.add("crawl_result", self.spark.createDataFrame(results, SCHEMAS["crawl_result"]))
        over = self.now + timedelta(seconds=time.monotonic() - self.began)
        row = (self.run_id, self.retry_of, self.now, over, end, self.videos, self.comments, self.calls, self.made, self.exhausted, error)
        changes.add("exploration_run", self.spark.createDataFrame([row], SCHEMAS["exploration_run"]))
        faults = [(f"fault-{self.run_id}-{o}", self.now, "system", "fault.run" if o == ALL else "fault.platform", o if o != ALL else self.run_id, None, what) for o, what in [*state.items(), (ALL, error)] if what]
        changes.add("audit_event", self.spark.createDataFrame(faults, SCHEMAS["audit_event"]))
        changes.commit()
        return end

    def fetched(self, state: dict, todo: set) -> dict:
        """Takes in what the ready platforms landed, each in a commit of its own; the faults of those that failed."""
        found = {}
        for platform, fault in state.items():
            if fault is not None or (platform, "fetch") not in todo:
                continue

            def take(platform: str = platform) -> None:
                self.rows[platform, "fetch"] = intake(self.spark, self.store, self.landing, platform, self.settings.salt, self.lease, self.adapters.get(platform, PLAIN))

            # the scan itself is tried, so that a file that cannot be read to its end is this platform's fault alone
            found[platform] = "failed" if runs.attempts(lambda t=take, p=platform: self.stage("fetch", p, lambda _: None, before=t), 2, 0.0, unless=Fenced) else None
        return found

    def clustered(self, changes: Changes) -> None:
        live, clips = retention.live(changes.read("comment"), self.now), changes.read("video")
        prints = retention.latest(changes.read("content_fingerprint").where("kind = 'comment'"))
        seen = prints.where("outcome = 'processed'").select("platform", F.col("id").alias("comment_id"), F.lit(1).alias("seen"))
        marked = live.join(seen, ["platform", "comment_id"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
        fresh = marked.where("seen = 0").select("platform", "video_id").distinct()
        some = self.settings
        videos, comments, flag = eligibility.within_budget(
            clips.join(fresh, ["platform", "video_id"], "left_semi"), marked.join(fresh, ["platform", "video_id"], "left_semi"),
            some.videos_per_run, some.comments_per_run, some.comments_per_video, ["seen", "first_ingested_at", "comment_id"],
        )
        # what this run looks at, written down: a run has a few thousand rows
        comments.write.mode("overwrite").parquet(f"{self.scratch}/looked")
        looked = self.spark.read.parquet(f"{self.scratch}/looked")
        self.exhausted, self.videos, self.comments = flag.first()["budget_exhausted"], videos.count(), looked.count()
        self.rows[ALL, "cluster"] = self.comments
        if not self.comments:
            return  # nothing that no run has looked at: all clusters stay as they are
        counted = eligibility.eligible(looked, clips).where("countable")
        numbered = semantics.clusters_by_item(counted, ["platform", "video_id"], "comment_id", "text", semantics.judged_twice(self.judge), ["first_ingested_at", "comment_id"], some.comments_per_video)
        number = F.col("cluster")
        columns = [number.cast("string").alias("cluster_id"), "comment_id", (number >= 0).alias("stable"), F.lit(PROMPT).alias("prompt_version"), F.lit(RULES_VERSION).alias("rule_version")]
        numbered.select("platform", "video_id", *columns).write.mode("overwrite").parquet(f"{self.scratch}/numbered")
        new = self.spark.read.parquet(f"{self.scratch}/numbered")
        changes.put("cluster_member", consensus.identified(new, changes.read("cluster_member"), live, self.run_id))
        changes.add("content_fingerprint", retention.fingerprints(looked, some.salt, "processed"), ())

    def registered(self, changes: Changes) -> None:
        live, clips, members = retention.live(changes.read("comment"), self.now), changes.read("video"), changes.read("cluster_member")
        ready = eligibility.eligible(live, clips)
        told = members.join(ready.select("platform", "comment_id", "text", "author_id", "commented_at", "countable"), ["platform", "comment_id"])
        passed = admission.needs_context(consensus.clusters(members, ready), told, clips)
        passed = admission.able(True, self.settings.image_input and self.resolve is not None, passed)
        good = registry.opportunity_ids(admission.with_outcome(passed, self.resolved(passed, told), self.settings.image_input).where("status = 'ready'"))
        # comments of the clusters that passed, written down: what follows reads them several times
        rows = self.written("passed", told.join(good.select(*GROUP, "opportunity_id"), GROUP))
        known, relations = changes.read("opportunity"), changes.read("opportunity_relation")
        routed = relations.where("type = 'same_need'").select(F.col("from_id").alias("opportunity_id"), F.col("to_id").alias("primary_id"))
        # the comments of one video at most, which a budget bounds
        texts = rows.groupBy("opportunity_id").agg(F.array_join(F.sort_array(F.collect_list("text")), "\n").alias("text"))
        texts = texts.join(known, "opportunity_id", "left_anti").join(routed, "opportunity_id", "left_anti")
        none = self.spark.createDataFrame([], "opportunity_id string, primary_id string")
        born, moved = (None, none) if texts.isEmpty() else self.described(changes, texts, known)
        self.evidenced(changes, rows, known if born is None else known.select("opportunity_id").unionByName(born.select("opportunity_id")), routed.unionByName(moved), known)
        if born is not None and not born.isEmpty():
            self.bear(changes, born)

    def written(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.scratch}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def described(self, changes: Changes, texts: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(born, moved)``: admitted opportunities that are new, and the way of those that a known one stands for."""
        path = f"{self.scratch}/answers"
        answers = semantics.ask_until_valid(texts, ["opportunity_id"], "text", self.describe, MODEL, PROMPT, path, lambda df: admission.parsed(df).where("valid"))
        self.invoked(changes, path, "opportunity_id", admission.parsed)
        new = self.written("new", admission.admitted(answers).where("admitted"))
        moved = self.judged_same(changes, new, known)
        if self.same is not None:
            moved = self.written("moved", moved)
            changes.add("opportunity_relation", moved.select(F.col("opportunity_id").alias("from_id"), F.col("primary_id").alias("to_id"), F.lit("same_need").alias("type"), self.at.alias("at")))
            changes.add("audit_event", self.event(moved, "merge.same_need", F.col("primary_id")))
        return new.join(moved, "opportunity_id", "left_anti"), moved

    def event(self, df: DataFrame, kind: str, after) -> DataFrame:
        return df.select(F.concat(F.lit(f"{kind}-"), "opportunity_id").alias("event_id"), self.at.alias("at"), F.lit("system").alias("actor"), F.lit(kind).alias("action"), F.col("opportunity_id").alias("object_id"), after.alias("after"))

    def bear(self, changes: Changes, born: DataFrame) -> None:
        """New opportunities, in the first stage."""
        changes.add("opportunity", born.withColumns({"first_found_at": self.at, "last_evidence_at": self.at, "rule_version": F.lit(RULES_VERSION)}))
        chain = born.select("opportunity_id", F.posexplode(admission.ordered_chain(F.col("chain"))).alias("_at", "c"))
        changes.add("opportunity_chain", chain.select("opportunity_id", F.col("_at").alias("seq"), *[F.col(f"c.{n}") for n in ("title", "kind", "body", "basis", "evidence_refs", "topics")]))
        changes.add("lifecycle_transition", born.select("opportunity_id", F.lit(1).alias("seq"), F.lit("new").alias("to_stage"), F.lit("system").alias("actor"), self.at.alias("at")))
        changes.add("audit_event", self.event(born, "opportunity.create", F.lit(None).cast("string")))
        self.rows[ALL, "register"] = self.made = born.count()

    def evidenced(self, changes: Changes, rows: DataFrame, there: DataFrame, routed: DataFrame, known: DataFrame) -> None:
        """Adds the first comment of each new person to the opportunity that a cluster leads to: its own, or the one that
        has the need, and from there to the one that a person merged it into. What is there stays as it is."""
        primary = F.coalesce("primary_id", "opportunity_id")
        led = rows.where("countable").join(routed, "opportunity_id", "left").withColumn("opportunity_id", primary).drop("primary_id")
        if not changes.read("opportunity_relation").where("type = 'duplicate'").isEmpty():
            final = registry.primaries(changes.read("opportunity_relation")).withColumnRenamed("from_id", "opportunity_id")
            led = led.join(final, "opportunity_id", "left").withColumn("opportunity_id", primary).drop("primary_id")
        led = led.join(there.select("opportunity_id"), "opportunity_id", "left_semi").withColumn("anon_author", author_hash(F.col("platform"), F.col("author_id"), self.settings.salt))
        old = changes.read("opportunity_evidence")
        fresh = led.dropDuplicates(["opportunity_id", "platform", "comment_id"]).join(old.select("opportunity_id", "anon_author"), ["opportunity_id", "anon_author"], "left_anti")
        first = consensus.evidence(fresh, ["opportunity_id"], "anon_author", ["commented_at", "platform", "comment_id"], 1 << 30)
        own = old.select("opportunity_id").distinct().withColumn("_old", F.lit(True))
        representative = F.col("_old").isNull() & (F.col("place") <= consensus.PEOPLE)
        added = self.written("evidence", first.join(own, "opportunity_id", "left").withColumn("is_representative", representative))
        if added.isEmpty():
            return
        changes.add("opportunity_evidence", added)
        grown = added.select("opportunity_id").distinct().withColumn("_grown", F.lit(True))
        if not known.join(grown, "opportunity_id", "left_semi").isEmpty():
            later = F.when(F.col("_grown"), self.at).otherwise(F.col("last_evidence_at"))
            changes.put("opportunity", known.join(grown, "opportunity_id", "left").withColumn("last_evidence_at", later))

    def resolved(self, passed: DataFrame, told: DataFrame) -> DataFrame:
        """``(platform, video_id, cluster_id, resolved)`` of clusters that need context and could be looked at."""
        wanted = passed.where("needs_context and can_run").select(*GROUP)
        if self.resolve is None:
            return wanted.withColumn("resolved", F.lit(False)).limit(0)
        texts = told.join(wanted, GROUP).groupBy(*GROUP).agg(F.array_join(F.sort_array(F.collect_list("text")), "\n").alias("text"))
        kinds = "platform string, video_id string, cluster_id string, model string, prompt_version string, output string"
        path = f"{self.scratch}/context"
        semantics.ask(texts, self.spark.createDataFrame([], kinds), GROUP, "text", self.resolve, MODEL, PROMPT).write.mode("ignore").parquet(path)
        return self.spark.read.schema(kinds).parquet(path).select(*GROUP, (F.lower("output") == "true").alias("resolved"))

    def judged_same(self, changes: Changes, new: DataFrame, known: DataFrame) -> DataFrame:
        """``(opportunity_id, primary_id)`` of new opportunities that a verdict calls a known one's need.

        Likeness only says which pairs are worth a verdict; nothing is merged by it. Verdicts are stored, so a pair is
        judged once.
        """
        none = self.spark.createDataFrame([], "opportunity_id string, primary_id string")
        if self.same is None:
            return none
        text = F.concat_ws(" ", *TOLD)
        pairs = similar.candidates(new.select("opportunity_id", text.alias("text")), known.select("opportunity_id", text.alias("text")), "opportunity_id", "text")
        verdicts = changes.read("need_verdict")
        open_ = pairs.select(F.col("left_id").alias("opportunity_id"), F.col("right_id").alias("known_id")).join(verdicts, ["opportunity_id", "known_id"], "left_anti")
        of = lambda df, n: df.select(F.col("opportunity_id").alias(n), text.alias(f"_{n}"))
        texts = open_.join(of(new, "opportunity_id"), "opportunity_id").join(of(known, "known_id"), "known_id").withColumn("text", F.concat_ws("\n\n", "_opportunity_id", "_known_id"))
        keys, answer, path = ["opportunity_id", "known_id"], "same_problem boolean, same_solution boolean", f"{self.scratch}/verdicts"
        told = lambda df: df.withColumn("_v", F.from_json("output", answer)).withColumn("valid", F.col("_v.same_problem").isNotNull() & F.col("_v.same_solution").isNotNull())
        found = semantics.ask_until_valid(texts, keys, "text", self.same, MODEL, "same-1", path, lambda df: told(df).where("valid"))
        self.invoked(changes, path, "known_id", told)
        changes.add("need_verdict", found.select(*keys, "_v.same_problem", "_v.same_solution", self.at.alias("at")))
        routes = registry.routed(new.select("opportunity_id"), changes.read("need_verdict").join(known.select(F.col("opportunity_id").alias("known_id")), "known_id", "left_semi"))
        return none.unionByName(routes.where("primary_id <> opportunity_id").select("opportunity_id", "primary_id"))

    def invoked(self, changes: Changes, path: str, key: str, judged: Callable[[DataFrame], DataFrame]) -> None:
        """A row for each call of the model below ``path``, those without a valid answer too."""
        calls = self.spark.read.option("basePath", path).parquet(f"{path}/*")
        whole = judged(calls)
        name = F.sha2(F.concat_ws("\u0001", F.lit(self.run_id), "opportunity_id", key, "prompt_version"), 256)
        rows = whole.select(
            name.alias("invocation_id"), F.lit(self.run_id).alias("run_id"), self.at.alias("at"), "model", "prompt_version", F.array_distinct(F.array("opportunity_id", key)).alias("input_ids"),
            F.coalesce("valid", F.lit(False)).alias("ok"), F.when(~F.coalesce("valid", F.lit(False)), F.lit("invalid_answer")).alias("error"),
        )
        changes.add("model_invocation", rows)
        self.calls += calls.count()

    def purged(self, changes: Changes) -> None:
        evidence = changes.read("opportunity_evidence")
        gone = {"comment": ["platform", "comment_id"], "video": ["platform", "video_id"]}
        n = sum(retention.purge_parts(changes, name, evidence, keys, self.now) for name, keys in gone.items())
        live = retention.live(changes.read("comment"), self.now)
        members = changes.read("cluster_member")
        if not members.join(live, ["platform", "video_id", "comment_id"], "left_anti").isEmpty():
            changes.put("cluster_member", members.join(live.select("platform", "video_id", "comment_id"), ["platform", "video_id", "comment_id"], "left_semi"))
        if n:
            row = (f"purge-{self.run_id}", self.now, "system", "purge.raw", self.run_id, None, str(n))
            changes.add("audit_event", self.spark.createDataFrame([row], SCHEMAS["audit_event"]))
