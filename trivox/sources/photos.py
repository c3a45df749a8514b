"""Photos of notes by what they hold: the same photo is kept once, and as long as a note has it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivox.sources.store import Changes

#: The most that a photo may have, in bytes.
LARGEST = 20 << 20
_KINDS = ("jpg", "jpeg", "png", "webp", "gif")


def read_photos(spark, path: str) -> DataFrame:
    """``(path, photo_id, length, content)`` of the image files below ``path``; the id is the SHA-256 of the content.

    Files of other kinds are passed over, those that are too large are refused before they are read.
    """
    # reading sizes alone does not read the files
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    image = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*_KINDS)
    large = files.where(image & (F.col("length") > LARGEST)).select("path").head(1)
    if large:
        raise ValueError(f"{large[0]['path']} is larger than {LARGEST} bytes")
    return files.where(image).select("path", F.sha2("content", 256).alias("photo_id"), "length", "content")


def put_photos(changes: Changes, photos: DataFrame) -> DataFrame:
    """Keeps photos that are not there yet, and returns ``(path, photo_id)``: what a note's ``photo_paths`` then names."""
    once = photos.dropDuplicates(["photo_id"])
    changes.add("photo", once.select("photo_id", "length", "content"))
    return photos.select("path", "photo_id")


def unreferenced(changes: Changes) -> DataFrame:
    """Ids of photos that no note has in its newest version; one that was deleted has none."""
    notes = changes.read("stage_note").groupBy("note_id").agg(F.max_by(F.struct("photo_paths", "deleted"), "version").alias("n"))
    used = notes.where(~F.coalesce("n.deleted", F.lit(False))).select(F.explode("n.photo_paths").alias("photo_id")).distinct()
    return changes.read("photo").select("photo_id").join(used, "photo_id", "left_anti")


def drop_unreferenced(changes: Changes) -> int:
    """Takes photos out that no note has any more; their bytes go with the store's ``vacuum``. How many went."""
    gone = unreferenced(changes)
    n = gone.count()
    if n:
        changes.put("photo", changes.read("photo").join(gone, "photo_id", "left_anti"))
    return n
