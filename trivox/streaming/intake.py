"""Taking in what adapters land: only files that no earlier run has read, each batch once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.operators import eligibility, retention
from trivox.sources.adapters import PLAIN, Adapter, normalised, split
from trivox.sources.store import Changes, Lease, Store

KINDS = ("video", "comment")


def taken_in(changes: Changes, videos: DataFrame, comments: DataFrame, salt: str) -> None:
    """Adds videos and comments that are not there and have no fingerprint yet, and the fingerprints of all of them; a
    video's has the cursor of its comments. Of rows with one key the first in a total order counts."""
    videos = eligibility.first_per_key(videos, ["platform", "video_id"], ["first_ingested_at", "title", "url"])
    comments = eligibility.first_per_key(comments, ["platform", "comment_id"], ["first_ingested_at", "video_id", "text"])
    changes.add("video", videos)
    changes.add("comment", eligibility.unprocessed(comments, changes.read("content_fingerprint"), "comment", "comment_id"), ())
    both = [retention.fingerprints(comments, salt, "fetched"), retention.cursors(videos, comments)]
    changes.add("content_fingerprint", reduce(DataFrame.unionByName, both), ())


def intake(spark: SparkSession, store: Store, landing: str, platform: str, salt: str, lease: Lease | None = None, adapter: Adapter = PLAIN) -> int:
    """Takes in the new files below ``landing/<platform>/{video,comment}``, lines of JSON, and returns how many rows came.

    The stream's checkpoint knows the files that were read, and the store's mark the batches that were committed: a batch
    that is played again after a crash between the two changes nothing. Rows of another platform, and rows that do not meet
    the contract, go to the quarantine with a reason. Whatever is there when it starts is taken in, then it ends.
    """
    stream, seen = f"{platform}/landing", [0]

    def sink(batch: DataFrame, number: int) -> None:
        changes = store.changes(lease)
        if changes.base.marks.get(stream, -1) >= number:
            return
        rows, faults = {}, []
        lines = batch.persist()
        try:
            for kind in KINDS:
                made, bad = split(normalised(lines.where(F.col("kind") == kind), kind, adapter), kind)
                rows[kind] = made.where(F.col("platform") == platform)
                strange = made.where(F.col("platform") != platform).select(F.lit(kind).alias("kind"), F.lit("platform").alias("reason"), F.to_json(F.struct(*made.columns)).alias("line"))
                faults += [bad, strange]
            taken_in(changes, rows["video"], rows["comment"], salt)
            changes.add("quarantine", reduce(DataFrame.unionByName, faults).select(F.lit(platform).alias("platform"), "kind", "reason", "line", F.current_timestamp().alias("at")), ())
            changes.mark(stream, number)
            changes.commit()
            seen[0] += lines.count()
        finally:
            lines.unpersist()

    # lines of both kinds in one stream; a file that is gone when its batch is played again is not waited for
    files = spark.readStream.format("text").option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true").load(f"{landing}/{platform}")
    kind = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    lines = files.select("value", kind.alias("kind")).where(F.trim("value") != "")
    query = lines.writeStream.foreachBatch(sink).option("checkpointLocation", f"{store.base}/_intake/{platform}").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return seen[0]
