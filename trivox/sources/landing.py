"""Reading landing files into the contract, settings and logins. Tables are written through ``store``."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.sources.schemas import CRAWL_STATES, PLATFORMS, SCHEMAS, keyed

#: A column is secret if its name, lowered and without signs, contains one of these.
SECRET = ("apikey", "cookie", "secret", "password", "passwd", "session", "accesstoken", "refreshtoken", "authtoken", "bearer", "credential", "privatekey")


@dataclass(frozen=True)
class Settings:
    """What a user sets; limits are per run."""

    platforms: tuple[str, ...] = PLATFORMS
    comments_per_video: int = 200
    videos_per_run: int = 50
    comments_per_run: int = 5_000
    schedule: str = "09:00"
    timezone: str = "UTC"
    image_input: bool = False
    salt: str = field(default="", repr=False)

    @classmethod
    def load(cls, path: str) -> Settings:
        """Settings from a JSON file; unknown names are refused."""
        import json

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in said.items()})


def read_contract(spark: SparkSession, path: str, name: str, kind: str = "json") -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of one landing folder: rows that meet the schema and have their key, and the others raw."""
    if kind == "parquet":
        raw = spark.read.schema(SCHEMAS[name]).parquet(path).withColumn("_bad", F.lit(None).cast("string"))
    else:
        raw = spark.read.schema(SCHEMAS[name] + ", _bad string").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").format(kind).load(path)
    # a query over the corrupt-record column alone is refused, so it is kept beside the others
    good = F.col("_bad").isNull() & keyed(name)
    return raw.where(good).drop("_bad"), raw.where(~good)


def platform_union(frames: dict[str, DataFrame], settings: Settings, none: DataFrame | None = None) -> DataFrame:
    """Rows of the enabled platforms that could be read; a platform that failed is simply not among the frames.

    ``none`` is an empty frame of the schema, for the case that no platform is left; without it that is refused.
    """
    used = [df for name, df in frames.items() if name in settings.platforms]
    if not used and none is None:
        raise ValueError("no platform is left, and no empty frame says what its rows would be")
    return reduce(DataFrame.unionByName, used) if used else none


def ready_platforms(accounts: DataFrame, settings: Settings) -> DataFrame:
    """``(platform, ready, error_kind)`` of the enabled platforms: only one whose login was found valid is visited.

    A login that expired, or of which nothing is known, needs a person; the other platforms go on.
    """
    last = accounts.groupBy("platform").agg(F.max_by("login_state", F.struct("checked_at", "login_state")).alias("login_state"))
    named = accounts.sparkSession.createDataFrame([(p,) for p in settings.platforms], "platform string").join(last, "platform", "left")
    ready = F.coalesce(F.col("login_state") == "ok", F.lit(False))
    kind = F.when(ready, None).when(F.col("login_state").isin(*[s for s in CRAWL_STATES if s != "ok"]), F.col("login_state")).otherwise("login_expired")
    return named.select("platform", ready.alias("ready"), kind.alias("error_kind"))


def redacted(df: DataFrame) -> DataFrame:
    """Without the columns that hold secrets."""
    plain = lambda c: "".join(x for x in c.lower() if x.isalnum())
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not any(s in plain(c) for s in SECRET)])
