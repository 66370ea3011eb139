"""SentencePiece BPE encoding and decoding by vectorised merge rounds over flat numpy arrays (see ``piece_model``).

Defined results: a null or empty text encodes to no ids and decodes to the empty text; null ids and repeated rows are ordinary
rows, one result each; texts of any length are read whole; other columns of the input are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordCache, id_and_text, text_groups
from .piece_model import PieceModel, decode_ids, encode_words, load

_caches: dict[str, WordCache] = {}


def encoded(model: PieceModel, words: list[str]) -> list[tuple[int, bytes, bytes]]:
    """Of each pre-token: number of ids, the ids as unsigned 16- or 32-bit numbers, and the bytes they decode to."""
    ids, sizes = encode_words(model, words)
    ends = np.cumsum(sizes).tolist()
    kind = np.uint16 if model.size <= 1 << 16 else np.uint32
    narrow, raw = ids.astype(kind).tobytes(), decode_ids(model, ids)
    width, raw_ends = kind().itemsize, np.cumsum(model.raw_length[ids])
    out, begin, raw_begin = [], 0, 0
    for end in ends:
        raw_end = int(raw_ends[end - 1])
        out.append((end - begin, narrow[begin * width : end * width], raw[raw_begin:raw_end]))
        begin, raw_begin = end, raw_end
    return out


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """Text of one document's ids; of the space mark that encoding put in front, nothing remains."""
    raw = decode_ids(model, ids)
    return raw[1 if model.dummy_prefix and raw[:1] == b" " else 0 :].decode("utf-8", "replace")


def _cache(model_path: str) -> tuple[PieceModel, WordCache]:
    model = load(model_path)
    return model, _caches.setdefault(model_path, WordCache(lambda words: encoded(model, words), limit=500_000))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of every text as an array; no shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = _cache(model_path)
        kind = np.uint16 if model.size <= 1 << 16 else np.uint32
        for batch in batches:
            for first, texts in text_groups(batch):
                words = [model.split(t) for t in texts]
                known = cache.ready(words)
                found = [np.frombuffer(b"".join([known[x][1] for x in w]), kind) for w in words]
                ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))
                ids = batch.column("doc_id").slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, lists], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids, and of the text decoded from those ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = _cache(model_path)
        kind = np.uint16 if model.size <= 1 << 16 else np.uint32
        decimal = [str(i) for i in range(model.size)]
        for batch in batches:
            n_tokens, ids_hash, text_hash = [], [], []
            for _, texts in text_groups(batch):
                split = [model.split(t) for t in texts]
                known = cache.ready(split)
                for words in split:
                    found = [known[w] for w in words]
                    ids = np.frombuffer(b"".join([x[1] for x in found]), kind)
                    raw = b"".join([x[2] for x in found])
                    raw = raw[1 if raw[:1] == b" " else 0 :]
                    n_tokens.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
