"""Token counts by rank-synchronous array merging.

Pre-tokens of many documents are held as one ragged array: symbols end to end, and the length of each sequence.  In every round
each sequence applies its lowest-rank pair (the leftmost of equals), all sequences at the same time; sequences without a pair
leave.  What survives is counted.  The count of a pre-token is kept in the worker, so a frequent one is merged once.

Defined results: a null or empty text has no bytes and no tokens; null ids and repeated rows are ordinary rows, one result
each; texts of any length are read whole; other columns of the input are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, id_and_text, text_groups
from .piece_model import encode_words, load

_caches: dict[str, WordCache] = {}


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, with a SentencePiece BPE model; no shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        counts = _caches.setdefault(model_path, WordCache(lambda words: encode_words(model, words)[1].tolist()))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for _, texts in text_groups(batch):
                words = [model.split(t) for t in texts]
                known = counts.ready(words)
                n_bytes += [len(t.encode()) for t in texts]
                n_tokens += [sum(map(known.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = id_and_text(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
