"""Token counts: lengths only, from batch encoding in Arrow functions.

Work is dealt by bytes, not by rows: a task cuts its Arrow batches into slices
of about 2 MB. A text is cut at white space, where the tokenizer never joins
anything, so a very long text is no longer one call to the library.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each.
Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattspan.functions.columns import qcol
from wattspan.llm.encode import default_path, encoder
from wattspan.llm.frames import by_slice, texts

CONTEXT_TOKENS = 2048


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = CONTEXT_TOKENS) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    path = path or default_path()

    def count(batch, lo, hi, data, off):
        n = encoder(path).lengths(data, off)
        return {
            "_id": batch.column("_id").slice(lo, hi - lo), "n_bytes": np.diff(off), "n_tokens": n,
            "over_limit": pa.array(n > limit),
        }

    out = by_slice(texts(docs, id_col, text_col), count, "_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", keep=True)
    return out.select(qcol("_id").alias(id_col), "n_bytes", "n_tokens", "over_limit")
