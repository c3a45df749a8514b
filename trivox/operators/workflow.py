"""The human workflow: stages, transitions and their rules, checklists, notes. Only people move an opportunity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("new", "interested", "feasibility", "competition", "requirements", "acquisition", "decision_ready")
ENDS = ("develop", "deferred", "abandoned")

# The checklist items of each stage.
CHECKLIST = {
    "feasibility": (
        "原始评论是否代表一个可复现的真实场景", "问题是否适合由软件解决", "软件是否可以独立交付核心价值", "是否存在难以获取的数据、平台权限或外部资源",
        "是否存在关键技术或合规阻碍", "是否仍然满足“不依赖重运营”", "可行性阶段结论已填写",
    ),
    "competition": ("已记录直接竞品", "已记录间接替代方案", "已整理现有方案的主要缺陷", "已找到可切入的细分场景或差异点", "已判断市场拥挤程度", "CA 阶段结论已填写"),
    "requirements": (
        "已定义目标用户", "已定义核心使用场景", "已定义用户希望获得的结果", "已列出 MVP 必须具备的功能", "已列出 MVP 明确不做的功能", "已记录关键假设和验证方法", "需求分析阶段结论已填写",
    ),
    "acquisition": (
        "已记录原始需求来源", "已定义第一批可触达用户", "已选择首批获客渠道", "已定义适合发布的内容或演示角度", "已定义首轮需求验证动作", "已确认方案仍然属于自然获客", "获客阶段结论已填写",
    ),
    "decision_ready": ("四个阶段的结论均已完成", "关键风险和未验证假设已列出", "已做出“决定开发、暂缓或放弃”的选择"),
}
# The next actions shown when no item is open.
WRITE_CONCLUSION, NEXT_STAGE, DECIDE = "填写阶段结论", "进入下一阶段", "做出决定"


def latest(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The value of each key's last row."""
    return df.groupBy(*key).agg(F.max_by(value, order).alias(value))


def history(df: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    """Each row with the value before it, null for the first."""
    return df.withColumn(f"previous_{value}", F.lag(value).over(Window.partitionBy(*key).orderBy(*order)))


def current_stage(transitions: DataFrame) -> DataFrame:
    return transitions.groupBy("opportunity_id").agg(F.max_by("to_stage", "seq").alias("stage"), F.max("seq").alias("seq"), F.max_by("from_stage", "seq").alias("came_from"), F.max("at").alias("updated_at"))


def checked(requests: DataFrame, transitions: DataFrame, progress: DataFrame) -> DataFrame:
    """Requests ``(opportunity_id, to_stage, reason, actor)`` with ``accepted`` and ``refused_by``; nothing is written.

    Only the system makes an opportunity, as new; all else is a person's. A stage opens when the one before is complete
    (items ticked, conclusion written); going back is always open. Ends need a reason; to decide for development also
    needs the last stage. Only a deferred opportunity comes back, to the stage that it left.
    """
    now = current_stage(transitions).select("opportunity_id", "stage", "came_from", "seq")
    joined = requests.join(now, "opportunity_id", "left")
    done = progress.select("opportunity_id", "stage", "complete")
    joined = joined.join(done, ["opportunity_id", "stage"], "left")
    order = F.create_map(*[x for i, s in enumerate(STAGES) for x in (F.lit(s), F.lit(i))])
    here, there = order[F.col("stage")], order[F.col("to_stage")]
    ends = F.col("to_stage").isin(*ENDS)
    no_reason = ~F.coalesce(F.length(F.trim("reason")) > 0, F.lit(False))
    # the entry stage has no checklist, and may be left for the first one with a checklist
    first = F.col("stage").isin("new", "interested") & F.col("to_stage").isin("interested", "feasibility") & (there > here)
    refused = (
        F.when(F.col("to_stage").isNull() | ~F.col("to_stage").isin(*STAGES, *ENDS), "unknown_stage")
        .when(F.col("stage").isNull(), F.when((F.col("to_stage") == "new") & (F.col("actor") == "system"), None).otherwise("not_created"))
        .when(~F.coalesce(F.col("actor") == "user", F.lit(False)), "not_a_person")
        .when(F.col("stage").isin("develop", "abandoned"), "ended")
        .when(F.col("stage") == "deferred", F.when(F.col("to_stage") == F.col("came_from"), None).otherwise("restore_elsewhere"))
        .when(ends & no_reason, "no_reason")
        .when((F.col("to_stage") == "develop") & (F.col("stage") != "decision_ready"), "not_ready")
        .when(ends, None)
        .when(F.col("to_stage") == "new", "not_created")
        .when(there < here, None)
        .when(first, None)
        .when(there != here + 1, "not_next")
        .when(~F.coalesce("complete", F.lit(False)), "incomplete")
    )
    return joined.withColumn("refused_by", refused).withColumn("accepted", F.col("refused_by").isNull()).select(*requests.columns, F.col("stage").alias("from_stage"), (F.coalesce("seq", F.lit(0)) + 1).alias("seq"), "accepted", "refused_by")


def to_append(asked: DataFrame, at: Column, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(transitions, refused)`` of what ``checked`` gave: rows to append, and the requests that change nothing.

    Of several requests for one opportunity that would be accepted the first by ``order`` (all columns without it) is;
    the others are refused as ``superseded``, as they were judged by a stage that is left.
    """
    first = F.row_number().over(Window.partitionBy("opportunity_id", "accepted").orderBy(*(order or []), *asked.columns))
    ranked = asked.withColumn("_n", first)
    late = F.col("accepted") & (F.col("_n") > 1)
    made = ranked.withColumn("refused_by", F.when(late, "superseded").otherwise(F.col("refused_by"))).withColumn("accepted", F.col("accepted") & ~late).drop("_n")
    taken = made.where("accepted").select("opportunity_id", F.col("seq").cast("long").alias("seq"), "from_stage", "to_stage", "reason", "actor", at.alias("at"))
    return taken, made.where("not accepted")


def definitions(spark) -> DataFrame:
    """The fixed items, 30 in five stages."""
    rows = [(stage, i, item) for stage, items in CHECKLIST.items() for i, item in enumerate(items, 1)]
    return spark.createDataFrame(rows, "stage string, item_no int, item string")


def checklist(stages: DataFrame, ticks: DataFrame, conclusions: DataFrame, defs: DataFrame) -> DataFrame:
    """``(opportunity_id, stage, done, total, first_open, concluded, complete, next_action)`` of the current stages."""
    items = stages.select("opportunity_id", "stage").join(F.broadcast(defs), "stage")  # 30 rows
    marked = items.join(ticks.select("opportunity_id", "stage", "item_no", "done"), ["opportunity_id", "stage", "item_no"], "left").withColumn("done", F.coalesce("done", F.lit(False)))
    open_item = F.when(~F.col("done"), F.struct("item_no", "item"))
    made = marked.groupBy("opportunity_id", "stage").agg(F.count_if("done").alias("done"), F.count("*").alias("total"), F.min(open_item)["item"].alias("first_open"))
    said = conclusions.select("opportunity_id", "stage", (F.length(F.trim("text")) > 0).alias("concluded"))
    # the entry stage has no items: what is left is to go on
    entry = stages.where("stage = 'interested'").select("opportunity_id", "stage", F.lit(0).cast("long").alias("done"), F.lit(0).cast("long").alias("total"), F.lit(None).cast("string").alias("first_open"))
    made = made.unionByName(entry).join(said, ["opportunity_id", "stage"], "left").withColumn("concluded", F.coalesce("concluded", F.lit(False)) | (F.col("total") == 0))
    action = F.coalesce("first_open", F.when(~F.col("concluded"), WRITE_CONCLUSION).when(F.col("stage") == STAGES[-1], DECIDE).otherwise(NEXT_STAGE))
    return made.withColumn("complete", (F.col("done") == F.col("total")) & F.col("concluded")).withColumn("next_action", action)


def note_versions(notes: DataFrame) -> DataFrame:
    """The last version of each note that is not deleted, in the order of the person."""
    w = Window.partitionBy("note_id").orderBy(F.desc("version"))
    last = notes.withColumn("_n", F.row_number().over(w)).where("_n = 1 and not coalesce(deleted, false)").drop("_n")
    return last.orderBy("opportunity_id", "stage", "position", "note_id")


def note_changes(notes: DataFrame, changes: DataFrame, at: Column) -> DataFrame:
    """Note versions to append: ``changes(note_id, action, text, position)`` on the last versions of notes.

    ``edit`` sets the text, ``move`` the position, ``delete`` marks the note, which keeps its versions. Of several changes
    of a note in one batch the smallest by (action, position, text) counts; a change of an unknown or deleted note, or an
    edit to a blank text, makes nothing.
    """
    last = note_versions(notes)
    one = changes.groupBy("note_id").agg(F.min(F.struct("action", "position", "text")).alias("_c"))
    joined = last.join(one, "note_id").where("_c.action in ('move', 'delete') or (_c.action = 'edit' and length(trim(_c.text)) > 0)")
    action = F.col("_c.action")
    made = (
        joined.withColumn("version", F.col("version") + 1)
        .withColumn("text", F.when(action == "edit", F.col("_c.text")).otherwise(F.col("text")))
        .withColumn("position", F.when(action == "move", F.coalesce("_c.position", "position")).otherwise(F.col("position")))
        .withColumn("deleted", action == "delete")
        .withColumn("updated_at", at)
    )
    return made.select(*notes.columns)


def valid_note() -> Column:
    """Text, and at most one link and one photo."""
    few = lambda c: F.coalesce(F.size(c) <= 1, F.lit(True)) | (F.size(c) < 0)
    return F.coalesce(F.length(F.trim("text")) > 0, F.lit(False)) & few("links") & few("photo_paths")
