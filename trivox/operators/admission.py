"""From a cluster that passed to an admitted opportunity: context, model output, hard filters, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivox.functions.text import filled, is_deictic, is_generic_path

CHAIN = "array<struct<seq:int,title:string,kind:string,body:string,basis:string,evidence_refs:array<string>,topics:array<string>>>"
CANDIDATE = f"title string, summary string, target_user string, scenario string, pain string, current_solution string, software_form string, core_value string, ops_rationale string, acquisition_path string, risks string, is_software boolean, passes_ops boolean, passes_acq boolean, chain {CHAIN}"
REQUIRED = ("title", "summary", "target_user", "scenario", "pain", "current_solution", "software_form", "core_value", "ops_rationale", "acquisition_path", "risks")
KINDS = ("fact", "inference")
# What a chain must cover.
TOPICS = ("原始场景", "三位不同用户的共同需求", "需求抽象", "软件机会", "不依赖重运营的理由", "自然获客路径")


def parsed(outputs: DataFrame, raw: str = "output") -> DataFrame:
    """Model output by schema. ``valid`` is false where it does not parse or a required field is blank; such rows are
    asked for again, in bounded number, by whoever calls the model."""
    made = outputs.withColumn("_c", F.from_json(F.col(raw), CANDIDATE))
    valid = F.col("_c").isNotNull()
    for name in REQUIRED:
        valid = valid & filled(F.col(f"_c.{name}"))
    return made.withColumn("valid", valid).select(*outputs.columns, "valid", "_c.*")


def to_ask(inputs: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without a stored answer under the same keys (ids, model, prompt version)."""
    return inputs.join(asked.select(*keys), keys, "left_anti")


def needs_context(clusters: DataFrame, members: DataFrame, videos: DataFrame, unclear: Column | None = None, least_title: int = 8) -> DataFrame:
    """Clusters with ``needs_context``: passed, and leaning on context, and title and description too short to tell.

    ``unclear`` is a stored judgement that the object is not clear, beside the phrases. Members have their ``text``.
    """
    group = ["platform", "video_id", "cluster_id"]
    lean = members.groupBy(*group).agg(F.max(is_deictic(F.col("text"))).alias("_lean"))
    about = F.length(F.trim(F.concat_ws("", "title", "description")))
    joined = clusters.join(lean, group, "left").join(videos.select("platform", "video_id", "title", "description"), ["platform", "video_id"], "left")
    leans = F.coalesce("_lean", F.lit(False)) | (F.lit(False) if unclear is None else F.coalesce(unclear, F.lit(False)))
    return joined.withColumn("needs_context", F.col("passed") & leans & (F.coalesce(about, F.lit(0)) < least_title)).drop("_lean", "title", "description")


def with_outcome(clusters: DataFrame, context: DataFrame, image_input: bool) -> DataFrame:
    """``status``: pending, ready, or context_insufficient where context was needed and is not there; never a guess."""
    joined = clusters.join(context.select("platform", "video_id", "cluster_id", F.col("resolved").alias("_r")), ["platform", "video_id", "cluster_id"], "left")
    resolved = F.coalesce("_r", F.lit(False)) & F.lit(image_input)
    status = F.when(~F.col("passed"), "pending").when(F.col("needs_context") & ~resolved, "context_insufficient").otherwise("ready")
    return joined.withColumn("status", status).drop("_r")


def admitted(candidates: DataFrame) -> DataFrame:
    """Candidates with ``admitted`` and ``rejected_by`` (null, or the first rule that fails, in order)."""
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    by = (
        F.when(no("is_software"), "not_software")
        .when(no("passes_ops"), "needs_operations")
        .when(~filled(F.col("ops_rationale")), "no_operations_rationale")
        .when(no("passes_acq"), "no_acquisition")
        .when(is_generic_path(F.col("acquisition_path")), "generic_acquisition")
    )
    for name in REQUIRED:
        by = by.when(~filled(F.col(name)), f"missing_{name}")
    named = "topics" in candidates.schema["chain"].dataType.elementType.names
    by = by.when(~chain_complete(F.col("chain"), named), "incomplete_chain")
    return candidates.withColumn("rejected_by", by).withColumn("admitted", F.col("rejected_by").isNull())


def topics_missing(chain: Column) -> Column:
    """The topics that no node of a chain names, in their order; a node may carry several, and any number of nodes do."""
    named = F.flatten(F.transform(chain, lambda n: F.coalesce(n["topics"], F.array().cast("array<string>"))))
    return F.array_except(F.array(*map(F.lit, TOPICS)), F.coalesce(named, F.array().cast("array<string>")))


def chain_complete(chain: Column, topics: bool = True) -> Column:
    """Whether a chain covers its topics, each node is a fact or an inference with a title and a text, and facts name
    evidence.

    Nodes say which topics they carry. An answer whose nodes name none, as of prompts that did not ask for it, cannot be
    held to them and must have a node for each. ``topics`` is whether the nodes have that field at all.
    """
    nodes = F.forall(chain, lambda n: n["kind"].isin(*KINDS) & filled(n["title"]) & filled(n["body"]) & ((n["kind"] != "fact") | (F.size(n["evidence_refs"]) > 0)))
    enough = F.size(chain) >= len(TOPICS)
    if topics:
        silent = ~F.exists(chain, lambda n: F.coalesce(F.size(n["topics"]) > 0, F.lit(False)))
        enough = F.when(silent, enough).otherwise(F.size(topics_missing(chain)) == 0)
    return F.coalesce(enough & nodes, F.lit(False))


def able(text_input: bool, image_input: bool, clusters: DataFrame) -> DataFrame:
    """Clusters with ``can_run``: a model that reads text is needed for all, one that reads images for those in need of
    context; without it they end as context_insufficient and not as a guess."""
    return clusters.withColumn("can_run", F.lit(text_input) & (~F.coalesce("needs_context", F.lit(False)) | F.lit(image_input)))


def ordered_chain(chain: Column) -> Column:
    return F.array_sort(chain)
