"""Token counts by rank-synchronous array merging (see bpe.count_by_merging)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.bpe import Memory, count_by_merging, encoded, pretokens, vocabulary_path
from quadrangle.llm.common import lean


def token_counts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null texts count as empty: 0 bytes, 0 tokens. No token is added, nothing is
    truncated; the string of a special token inside a text is one token. No
    shuffle: each task counts its own rows.
    """
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in batches:
            words, index, begins = encoded(batch)
            per_word = np.asarray(memory.known(words, lambda new: count_by_merging(path, new).tolist()), np.int64)
            total = np.concatenate([[0], np.cumsum(per_word[index])])
            n = total[begins[1:]] - total[begins[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), *pretokens(F.col(text_col)))
    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(lean(count), f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
