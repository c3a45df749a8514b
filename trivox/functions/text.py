"""Scalar rules on text, ids and times, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Version of the deterministic rules, stamped on each result.
RULES_VERSION = "rules-1"
#: Days for which raw rows are kept.
RETENTION_DAYS = 10

# Phrases that point at something outside the comment.
DEICTIC = ("这个", "同款", "也想要", "求链接", "怎么做")
# Acquisition paths too general to count.
GENERIC_PATHS = ("投广告", "做SEO", "做 SEO", "发社交媒体")
#: Noise by rule: (rule id, pattern). First match names the rule.
NOISE_RULES = (
    ("symbols_only", r"^[\p{So}\p{Sk}\p{P}\p{M}\x{200D}\s]*$"),
    ("empty_agreement", r"^(?:哈+|赞+|顶+|支持|好的?|666+|\+1|ok|OK|lol)[!！。.~～\s]*$"),
    ("lottery", r"抽奖|转发抽|中奖名单"),
    ("advert", r"加(?:我)?微信|优惠券|代理加盟|限时特价"),
    ("diversion", r"私信领取|主页有链接|进群领"),
    ("bot", r"^(.{2,20}?)\1{4,}$"),
)


def noise_rule(text: Column) -> Column:
    """The id of the first noise rule that a text meets, or null. A null text is noise by ``symbols_only``."""
    value = F.coalesce(text, F.lit(""))
    found = F.lit(None).cast("string")
    for name, pattern in reversed(NOISE_RULES):
        found = F.when(value.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def is_deictic(text: Column) -> Column:
    """Whether a text leans on the item's context to say what it wants."""
    return F.coalesce(text.rlike("|".join(DEICTIC)), F.lit(False))


def is_generic_path(path: Column) -> Column:
    """Whether an acquisition path is blank or one of the phrases without an audience or an angle."""
    plain = F.regexp_replace(F.trim(F.coalesce(path, F.lit(""))), r"[。.!！\s]+$", "")
    return (plain == "") | plain.isin(*GENERIC_PATHS)


def filled(text: Column) -> Column:
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))


def content_hash(text: Column) -> Column:
    """SHA-256 of the text with blanks at its ends and runs of blanks evened out; null stays null."""
    return F.sha2(F.regexp_replace(F.trim(text), r"\s+", " "), 256)


def author_hash(platform: Column, author: Column, salt: str) -> Column:
    """An author's anonymous, stable name; null where the author is not known. Without a salt it could be guessed."""
    if not salt:
        raise ValueError("author hashes need a salt")
    return F.when(author.isNotNull(), F.sha2(F.concat_ws("\u0001", F.lit(salt), platform, author), 256))


def expired(ingested: Column, now: Column, days: int = RETENTION_DAYS) -> Column:
    """Whether a row came in more than ``days`` days before ``now``."""
    return ingested < now - F.make_interval(days=F.lit(days))


def ran_today(started: Column, now: Column, timezone: str) -> Column:
    """Whether a start falls on the local day of ``now``, whatever the session's time zone."""
    local = lambda t: F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(t, F.current_timezone()), F.lit(timezone)))
    return local(started) == local(now)


def next_due(now, at: str = "09:00", timezone: str = "UTC"):
    """The next moment of a daily schedule after ``now`` (an aware datetime)."""
    from datetime import timedelta
    from zoneinfo import ZoneInfo

    hour, minute = map(int, at.split(":"))
    local = now.astimezone(ZoneInfo(timezone))
    due = local.replace(hour=hour, minute=minute, second=0, microsecond=0)
    return due if due > local else due + timedelta(days=1)
