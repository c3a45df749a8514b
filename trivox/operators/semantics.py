"""The language model as a source of rows: each input is asked once, answers are stored, clusters stay inside an item."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivox.operators.admission import to_ask
from trivox.operators.eligibility import top_per_group

#: Comments of an item that one judgement sees at most.
PER_ITEM = 200
VERSIONS = ("model", "prompt_version")


def ask(inputs: DataFrame, stored: DataFrame, keys: list[str], text: str, model: Callable[[list[str]], list[str]], name: str, prompt_version: str) -> DataFrame:
    """``(*keys, model, prompt_version, output)`` for the inputs without a stored answer of this model and prompt.

    Inputs that repeat are asked once. The result is to be written before it is used, since a Python function in a plan
    may run again; ``stored`` is then the union of what was written. Rows with a null key are passed over.
    """
    versioned = inputs.select(*keys, F.col(text).alias("_text")).dropna(subset=keys).withColumns({"model": F.lit(name), "prompt_version": F.lit(prompt_version)})
    once = versioned.groupBy(*keys, *VERSIONS).agg(F.min("_text").alias("_text"))
    open_ = to_ask(once, stored, [*keys, *VERSIONS])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.drop(columns="_text").assign(output=model(frame["_text"].tolist()))

    kinds = ", ".join(f"`{c}` {open_.schema[c].dataType.simpleString()}" for c in [*keys, *VERSIONS])
    return open_.mapInPandas(work, f"{kinds}, output string")


def ask_until_valid(inputs: DataFrame, keys: list[str], text: str, model: Callable[[list[str]], list[str]], name: str, prompt_version: str, path: str, valid: Callable[[DataFrame], DataFrame], most: int = 3) -> DataFrame:
    """``(*keys, model, prompt_version, output)`` of the inputs whose answers meet ``valid``, asked ``most`` times at most.

    Each attempt is written below ``path`` under its number before it is judged, and is part of the prompt version, so
    only inputs without a valid answer are asked again and a run that is repeated asks nothing twice.
    """
    spark, found = inputs.sparkSession, None
    for i in range(1, most + 1):
        version = prompt_version if i == 1 else f"{prompt_version}#{i}"
        left = inputs if found is None else to_ask(inputs, found, keys)
        kinds = ", ".join(f"`{c}` {inputs.schema[c].dataType.simpleString()}" for c in keys)
        schema = f"{kinds}, model string, prompt_version string, output string"
        at = f"{path}/attempt={i}"
        ask(left, spark.createDataFrame([], schema), keys, text, model, name, version).write.mode("ignore").parquet(at)
        good = valid(spark.read.schema(schema).parquet(at))
        found = good if found is None else found.unionByName(good)
        if to_ask(inputs.dropna(subset=keys), found, keys).isEmpty():
            break
    return found


def clusters_by_item(comments: DataFrame, item: list[str], key: str, text: str, judge: Callable[[list[str]], list[int]], order: list[str], most: int = PER_ITEM) -> DataFrame:
    """``(*item, key, cluster)``: ``judge`` numbers the texts of one item; it never sees two items together.

    An item has its first ``most`` comments, the budget of a run, so a task holds few rows whatever the item.
    """
    bounded = top_per_group(comments, item, order, most)
    kinds = ", ".join(f"`{c}` {bounded.schema[c].dataType.simpleString()}" for c in [*item, key])

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        return frame[[*item, key]].assign(cluster=judge(frame[text].tolist()))

    columns = list(dict.fromkeys([*item, key, text, *order]))
    return bounded.select(*columns).groupBy(*item).applyInPandas(work, f"{kinds}, cluster int")


def judged_twice(judge: Callable[[list[str]], list[int]]) -> Callable[[list[str]], list[int]]:
    """``judge`` asked a second time with the texts the other way round; a cluster that does not come out the same gets a
    negative number, as its judgement is not stable."""

    def run(texts: list[str]) -> list[int]:
        first, second = judge(texts), judge(texts[::-1])[::-1]
        of_first: dict[int, set[int]] = {}
        of_second: dict[int, set[int]] = {}
        for a, b in zip(first, second, strict=True):
            of_first.setdefault(a, set()).add(b)
            of_second.setdefault(b, set()).add(a)
        return [a if of_second[b] == {a} and of_first[a] == {b} else -1 - abs(a) for a, b in zip(first, second, strict=True)]

    return run


def same_text(texts: list[str]) -> list[int]:
    """A stand-in for the model in tests: equal texts are one need; needs are numbered in their order."""
    number = {t: i for i, t in enumerate(sorted({t or "" for t in texts}), 1)}
    return [number[t or ""] for t in texts]
