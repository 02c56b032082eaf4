"""Token counts with a shortcut for whole tokens.

Which vocabulary strings encode alone as one token is proved once, on the driver, by
encoding each of them. In the tasks a pre-token among them counts as one; only the
rest is merged, each distinct string once per task and bounded cache.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from opinionlens.llm.common import add_from_text, utf8
from opinionlens.llm.pieces import SPACE, PieceModel, pre_tokens, read_model

LIMIT = 4096
# Distinct pre-tokens whose count a task remembers before it starts afresh.
CACHE_SIZE = 300_000


def whole_tokens(model: PieceModel) -> frozenset[str]:
    """Vocabulary strings that can be a pre-token and encode alone as a single token."""
    candidates = [p for p in model.ids if p.startswith(SPACE)]
    encoded = model.encode_pre_tokens(candidates)
    return frozenset(p for p, ids in zip(candidates, encoded) if ids == [model.ids[p]])


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of each whole text.

    A null or empty text has no token. Rows, repeats included, are counted one by one;
    ids do not matter. Columns of these three names in the input are replaced.
    """
    content = read_model(model_path)
    single = whole_tokens(PieceModel(content))
    shipped = docs.sparkSession.sparkContext.broadcast((content, single))

    def factory():
        content, single = shipped.value
        model, known = PieceModel(content), dict.fromkeys(single, 1)
        at_least = len(known)

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            nonlocal known
            if len(known) > at_least + CACHE_SIZE:
                known = dict.fromkeys(single, 1)
            split = [pre_tokens(t) if t else [] for t in column.to_pylist()]
            rest = list({t for tokens in split for t in tokens if t not in known})
            known.update(zip(rest, map(len, model.encode_pre_tokens(rest))))
            counts = np.fromiter((sum(map(known.__getitem__, tokens)) for tokens in split), np.int64, len(split))
            _, offsets = utf8(column)
            return [pa.array(np.diff(offsets)), pa.array(counts)]

        return compute

    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    counted = add_from_text(docs.drop("over_limit"), fields, factory, text)
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit).cast("long"))
