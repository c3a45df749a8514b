"""Cutting the lineage of iterated tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` behind a reliable checkpoint, so that an iterated plan doesn't grow with its rounds.

    The folder is the one that the cluster names in ``spark.checkpoint.dir``. A session on one machine may do without and
    gets a temporary one; a cluster is refused, as its machines' own folders are lost with them.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)
