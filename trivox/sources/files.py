"""Small files through Spark's file systems: read whole, listed, removed, and made by one of many who try."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing if there is no such folder."""
    path, fs = _at(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def text_of(spark: SparkSession, file: str) -> str:
    path, fs = _at(spark, file)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def removed(spark: SparkSession, path: str) -> None:
    """Removes a file or folder with all in it; one that is not there is no fault."""
    found, fs = _at(spark, path)
    fs.delete(found, True)


def made_once(spark: SparkSession, file: str, text: str) -> bool:
    """Makes ``file`` with ``text``: true for one of all who try, and nobody sees a part of it.

    The text is written beside and given its name in one step that fails where the name is taken: a hard link on a local
    disk, where a rename would overwrite, and a rename without overwriting elsewhere.
    """
    jvm = spark.sparkContext._jvm
    path, fs = _at(spark, file)
    fs.mkdirs(path.getParent())
    beside, _ = _at(spark, f"{path.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            place = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(place(path), place(beside))
        else:
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(beside, path, plain)
    except Exception as e:
        if fs.exists(path):
            return False
        raise e
    finally:
        fs.delete(beside, False)
    return True
