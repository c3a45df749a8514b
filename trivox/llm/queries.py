"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trivox.llm.bpe import op7_bpe
from trivox.llm.divergence import OP13_SQL, op13_divergence
from trivox.llm.embeddings import OP8_SQL, op8_embeddings
from trivox.llm.filteraudit import OP12_SQL, op12_filteraudit
from trivox.llm.langid import op3_langid
from trivox.llm.linededup import OP6_SQL, op6_linededup
from trivox.llm.mixing import op10_mixing
from trivox.llm.quality import op5_quality
from trivox.llm.simhash import op1_simhash
from trivox.llm.syncmers import op9_syncmers
from trivox.llm.tokencounts import op2_tokencounts
from trivox.llm.toxicity import op4_toxicity
from trivox.llm.winnowing import OP11_SQL, op11_winnowing


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_tokencounts, op3_langid, op4_toxicity, op5_quality, op6_linededup, op7_bpe, op8_embeddings, op9_syncmers, op10_mixing, op11_winnowing, op12_filteraudit, op13_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op6_linededup": OP6_SQL, "op8_embeddings": OP8_SQL, "op11_winnowing": OP11_SQL, "op12_filteraudit": OP12_SQL, "op13_divergence": OP13_SQL}
