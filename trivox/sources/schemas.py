"""Explicit schemas of the tables, and checks of keys and enumerations. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLATFORMS = ("douyin", "bilibili")

SCHEMAS = {
    "platform_account": "platform string, login_state string, checked_at timestamp, last_error string",
    "video": "platform string, video_id string, author_id string, title string, description string, platform_tags array<string>, url string, published_at timestamp, first_ingested_at timestamp, engagement map<string,bigint>, hot_rank int",
    "comment": "platform string, video_id string, comment_id string, parent_comment_id string, level int, author_id string, text string, commented_at timestamp, first_ingested_at timestamp, like_count bigint",
    "cluster_member": "platform string, video_id string, cluster_id string, comment_id string, stable boolean, prompt_version string, rule_version string",
    "opportunity": "opportunity_id string, title string, summary string, target_user string, scenario string, pain string, current_solution string, software_form string, core_value string, ops_rationale string, acquisition_path string, risks string, first_found_at timestamp, last_evidence_at timestamp, model string, prompt_version string, rule_version string",
    "opportunity_evidence": "opportunity_id string, platform string, video_id string, comment_id string, anon_author string, text string, is_representative boolean",
    "opportunity_relation": "from_id string, to_id string, type string, at timestamp",
    "lifecycle_transition": "opportunity_id string, seq bigint, from_stage string, to_stage string, reason string, actor string, at timestamp",
    "stage_checklist": "opportunity_id string, stage string, item_no int, done boolean",
    "stage_conclusion": "opportunity_id string, stage string, text string",
    "stage_note": "note_id string, version int, opportunity_id string, stage string, text string, links array<string>, photo_paths array<string>, position int, deleted boolean, created_at timestamp, updated_at timestamp",
    "exploration_run": "run_id string, retry_of string, started_at timestamp, ended_at timestamp, status string, videos bigint, comments bigint, model_calls bigint, opportunities bigint, budget_exhausted boolean, error string",
    "crawl_result": "run_id string, platform string, status string, error_kind string",
    "model_invocation": "invocation_id string, run_id string, at timestamp, model string, prompt_version string, input_ids array<string>, tokens_in bigint, tokens_out bigint, ok boolean, error string",
    "content_fingerprint": "platform string, kind string, id string, author_hash string, content_hash string, first_seen timestamp, last_seen timestamp, outcome string, cursor string",
    "run_step": "run_id string, platform string, stage string, state string, at timestamp, n_rows bigint, error string",
    "quarantine": "platform string, kind string, reason string, line string, at timestamp",
    "gate_state": "platform string, video_id string, cluster_id string, person string, last_at timestamp",
    "photo": "photo_id string, length bigint, content binary",
    "opportunity_chain": "opportunity_id string, seq int, title string, kind string, body string, basis string, evidence_refs array<string>, topics array<string>",
    "need_verdict": "opportunity_id string, known_id string, same_problem boolean, same_solution boolean, at timestamp",
    "audit_event": "event_id string, at timestamp, actor string, action string, object_id string, before string, after string",
}

KEYS = {
    "video": ("platform", "video_id"), "comment": ("platform", "comment_id"), "cluster_member": ("platform", "video_id", "cluster_id", "comment_id"),
    "opportunity": ("opportunity_id",), "opportunity_evidence": ("opportunity_id", "platform", "comment_id"), "content_fingerprint": ("platform", "kind", "id"),
    "lifecycle_transition": ("opportunity_id", "seq"), "stage_note": ("note_id", "version"), "exploration_run": ("run_id",), "crawl_result": ("run_id", "platform"),
    "platform_account": ("platform",), "opportunity_relation": ("from_id", "to_id"), "stage_checklist": ("opportunity_id", "stage", "item_no"), "stage_conclusion": ("opportunity_id", "stage"),
    "model_invocation": ("invocation_id",), "run_step": ("run_id", "platform", "stage", "state"), "quarantine": ("platform", "kind", "line"), "gate_state": ("platform", "video_id", "cluster_id", "person"), "photo": ("photo_id",), "opportunity_chain": ("opportunity_id", "seq"), "need_verdict": ("opportunity_id", "known_id"), "audit_event": ("event_id",),
}

CRAWL_STATES = ("ok", "login_expired", "captcha", "rate_limited", "structure_changed", "failed")
STEP_STATES = ("running", "ok", "failed")
RUN_STATES = ("not_run", "waiting", "running", "success_empty", "success_found", "partial_failure", "failed", "cancelled", "login_expired")
#: Kinds of actions that are audited: an opportunity made, a merge, a change of stage, an end or a restoring, a checklist
#: item, a tag, the schedule, a purge, a fault of a model or a platform.
AUDITED = ("opportunity", "merge", "stage", "decision", "checklist", "tag", "schedule", "purge", "fault")
#: Columns that no result may have: strength, rank and score of needs are not part of the model.
FORBIDDEN = ("strength", "rank", "score", "heat")


def empty(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def keyed(name: str) -> Column:
    """Whether a row has all parts of its key."""
    ok = F.lit(True)
    for column in KEYS[name]:
        ok = ok & F.col(column).isNotNull()
    return ok


def assert_no_scores(df: DataFrame) -> DataFrame:
    if bad := [c for c in df.columns if any(part in FORBIDDEN for part in c.lower().split("_"))]:
        raise ValueError(f"results must not grade needs: {bad}")
    return df
