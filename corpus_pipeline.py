"""The corpus pipeline: language ID, line dedup, near-dedup, mixing, tokens. Each stage works on all that is left."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivox.llm import bpe, langid, linededup, mixing, simhash
from trivox.llm.common import shared_folder

OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage: Callable) -> Callable:
    """The stage with columns that are not its own under names that clash with nothing; they get theirs back."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        made = stage(spark, docs.toDF(*[n if n in OWN else f"__{i}" for i, n in enumerate(names)]), sf_dir)
        return made.toDF(*names)

    return run


@_apart
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those that no profile comes about as close to as to labelled rows of their size.

    Null and empty texts have no letter. Rows that repeat and rows with null keys are judged like any other; without
    labelled rows nothing is known and all rows go. An empty table gives no rows; other columns may have any name.
    """
    profiles = langid.learn(docs)
    return langid.known_language(docs, profiles, least=langid.bounds(docs, profiles))


@_apart
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes later occurrences of three-line windows out of the texts; ``n_chars`` follows. All rows stay.

    Rows equal in key and text are one document. Null texts stay null, with a null ``n_chars``; a text that is covered
    whole is empty. An empty table gives no rows; other columns may have any name.
    """
    made = linededup.drop_repeated_windows(docs)
    n_chars = F.char_length("text").cast("long")
    return made.select(*[n_chars.alias(n) if n == "n_chars" else n for n in docs.columns])


@_apart
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each group of texts linked by a Jaccard index of 0.8 over five words.

    Texts without words, null ones too, are copies of each other. Rows with equal ids and texts that are not linked all
    stay, of rows that repeat one, and all rows without an id. An empty table gives no rows; other columns may have any
    name.
    """
    return simhash.representatives(docs)


@_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts all rows in the order of the mix: the files it writes, by name and row, are the schedule.

    The null source is a source; null ids, null and empty texts and rows that repeat have places like any other. An empty
    table gives no rows; other columns may have any name.
    """
    return mixing.in_mixed_order(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)`` of each row, in the order of the mix.

    That is the order of the files that the stage before wrote and of the rows in them; what this stage writes is dealt
    and sorted by it, so the files of the result, by name and row, are the schedule. Rows that come from no file, or from
    one without a part number, have no such order. Null texts are empty and have no ids; rows that repeat are encoded as often; an empty table gives no
    rows; other columns are left out.
    """
    out = ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    try:
        number = F.regexp_extract(docs["_metadata"]["file_name"], r"^part-(\d+)", 1).try_cast("long")
        row = docs["_metadata"]["row_index"]
    except AnalysisException:  # not read from files
        return bpe.tokenized(docs).select(*out)
    made = bpe.tokenized(docs.select(F.struct("doc_id", number.alias("file"), row.alias("row")).alias("k"), "text"), key="k")
    order = ["k.file", "k.row"]
    return made.repartitionByRange(*order).sortWithinPartitions(*order).select("k.doc_id", *out[1:])


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Rank-order profiles, SimHash and byte-pair merges are beyond SQL; the stages are held against brute force in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again.

    A run of a ``name`` that was broken off goes on behind the last stage that it has written whole. A stage's result is
    removed when the next one's is written; that of the last one stays and is returned.
    """
    at = f"{shared_folder(spark)}/pipeline-{name or uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = lambda stage, file="": jvm.org.apache.hadoop.fs.Path(f"{at}/{stage}/{file}")
    files = path(STAGES[0][0]).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [i for i, (stage, _) in enumerate(STAGES) if files.exists(path(stage, "_SUCCESS"))]
    first = max(done, default=-1) + 1
    docs = spark.read.parquet(f"{at}/{STAGES[first - 1][0]}" if first else f"{sf_dir}/documents.parquet")
    for i, (stage, made) in enumerate(STAGES[first:], first):
        made(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{at}/{stage}")
        docs = spark.read.parquet(f"{at}/{stage}")
        if i:
            files.delete(path(STAGES[i - 1][0]), True)
    return docs
