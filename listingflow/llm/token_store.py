"""A file format for token ids with random access: directly addressable codes.

An id is cut into 8-bit chunks, the lowest first.  Level k holds the k-th chunks, end to end, of all ids that have one, and a
bitmap that says for each whether the id continues on the next level; a rank directory counts the continuing ids before every
512th bit.  The place of an id on the next level is the rank of its bit, so any id, and any range of ids, is read without
decoding what stands before it.

A store is a Parquet table of shards in ascending order of document id.  A shard row names its documents and their lengths and
holds the codes of their ids, so Spark's own commit keeps a store whole when tasks are lost or run twice.

Defined results: a null text is empty; rows with a null id come first; rows that agree in id follow each other in the order of
their text's hash, so repeated rows are stored once each; a text of any length is one document of one shard; other columns of
the input are not read; an empty table gives a store without shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_and_text, sent_if_small, stored
from .library_tokens import ByteLevelTokens, load
from .words import text_slices

_MAGIC = b"DAC1"
_BLOCK = 512  # bits of a bitmap per entry of its rank directory
SHARDS = "part int, first_token long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, codes binary"


def encode_codes(ids: np.ndarray) -> bytes:
    """The codes of some ids: magic, number of levels, then each level's size, chunks, bitmap and rank directory."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        counts = np.bitwise_count(bits).reshape(-1, _BLOCK // 8).sum(1, dtype=np.int64)
        ranks = (np.cumsum(counts) - counts).astype("<u8")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8), bits, ranks))
        if not more.any():
            break
        rest = rest[more] >> 8
    parts = [_MAGIC, struct.pack("<I", len(levels))]
    for n, chunks, bits, ranks in levels:
        parts += [struct.pack("<Q", n), chunks.tobytes(), bits.tobytes(), ranks.tobytes()]
    return b"".join(parts)


class Codes:
    """Random access to the ids in ``encode_codes``'s bytes."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a block of token codes")
        (n_levels,), at = struct.unpack_from("<I", data, 4), 8
        self.levels = []
        for _ in range(n_levels):
            (n,), at = struct.unpack_from("<Q", data, at), at + 8
            blocks = -(-n // _BLOCK)
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, blocks * _BLOCK // 8, at + n)
            ranks = np.frombuffer(data, "<u8", blocks, at + n + len(bits)).astype(np.int64)
            at += n + len(bits) + 8 * blocks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, position: int) -> int:
        """Continuing ids before a position of a level."""
        block = position // _BLOCK
        if block == len(ranks):  # the end of a level whose last block is full
            return int(ranks[-1]) + int(np.bitwise_count(bits[-(_BLOCK // 8) :]).sum(dtype=np.int64)) if block else 0
        byte = position // 8
        inside = int(np.bitwise_count(bits[block * (_BLOCK // 8) : byte]).sum(dtype=np.int64))
        return int(ranks[block]) + inside + (int(bits[byte]) & ((1 << position % 8) - 1)).bit_count()

    def __getitem__(self, position: int) -> int:
        """One id: one chunk, one bit and one rank per level."""
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[position]) << 8 * k
            if not bits[position // 8] >> position % 8 & 1:
                break
            position = self._rank(bits, ranks, position)
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end``: a range of ids is a range on every level."""
        out = np.zeros(end - start, np.uint32)
        where = np.arange(end - start)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            if start == end:
                break
            out[where] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * k)
            first = start // 8
            flags = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")[start - 8 * first : end - 8 * first]
            where = where[flags.astype(bool)]
            start = self._rank(bits, ranks, start)
            end = start + len(where)
        return out


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = 0,
    shard_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encodes every text with a byte-level tokenizer and writes the store; ``end_id`` is appended to each document.

    A shard ends with the document that brings it to ``shard_tokens``.
    """

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = load(ByteLevelTokens, tokenizer), TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], np.uint32)
        ids, lengths, held, size, first = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            codes = encode_codes(np.concatenate(held))
            row = {"part": part, "first_token": first, "n_tokens": size, "doc_ids": ids, "doc_tokens": lengths, "codes": codes}
            return pa.RecordBatch.from_pylist([row], _arrow_schema())

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for row, texts in text_slices(batch):
                for doc_id, found in zip(doc_ids[row : row + len(texts)], tokens.encode(texts), strict=True):
                    held += [found, end]
                    ids.append(doc_id), lengths.append(len(found) + len(end))
                    size += lengths[-1]
                    if size >= shard_tokens:
                        yield shard()
                        first += size
                        ids, lengths, held, size = [], [], [], 0
        if ids:
            yield shard()

    ordered = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(shards, SHARDS).write.option("compression", "zstd").parquet(folder)


def _arrow_schema() -> pa.Schema:
    long = pa.int64()
    kinds = [pa.int32(), long, long, pa.list_(long), pa.list_(long), pa.binary()]
    return pa.schema(list(zip("part first_token n_tokens doc_ids doc_tokens codes".split(), kinds, strict=True)))


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(folder)


def directory(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the ids read back out of the codes.

    ``start`` counts the ids of all documents before it in the store.  Parts are as many as the writing tasks, so the one window
    that adds them up sees a row per task.
    """

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                ends = np.cumsum([0, *row["doc_tokens"]]).tolist()
                ids = codes.slice(0, len(codes)).astype("<u4")
                starts = [row["first_token"] + at for at in ends[:-1]]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                columns = [[row["part"]] * len(sums), row["doc_ids"], starts, row["doc_tokens"], sums]
                kinds = [pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"],
                )

    docs = shards.mapInArrow(described, "part int, doc_id long, start_in_part long, n_tokens long, ids_crc32 long")
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("start_in_part")).alias("start")
    return docs.join(parts, "part").select("doc_id", start, "n_tokens", "ids_crc32")


def tokens(shards: DataFrame, wanted: DataFrame, most_parts: int = 1_000) -> DataFrame:
    """``doc_id, begin, ids``: some ids of some documents, for every row ``doc_id, begin, end`` of ``wanted``.

    ``begin`` counts from 0 within the document, ``end`` is exclusive; a range that reaches past a document's last id ends there.
    The codes' column is left unread but for the shards that hold a wanted document (files of other parts are skipped while these
    are at most ``most_parts``), and in a shard only the wanted ids are decoded.  Ids of documents that the store does not have
    give no row, null ids match nothing, and an id that the store has repeatedly gives a row for each.
    """

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                ends = np.cumsum([0, *row["doc_tokens"]])
                columns = [[row["part"]] * n, [row["first_token"]] * n, row["doc_ids"], ends[:-1], row["doc_tokens"]]
                kinds = [pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "first_token", "doc_id", "at", "n"])

    where = shards.select("part", "first_token", "doc_ids", "doc_tokens").mapInArrow(places, "part int, first_token long, doc_id long, at long, n long")
    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("begin").cast("long").alias("begin"), F.col("end").cast("long").alias("end"))
    end = F.greatest(F.least("end", "n"), F.col("begin"))
    one = F.struct("doc_id", "begin", (F.col("at") + F.col("begin")).alias("low"), (F.col("at") + end).alias("high"))
    met = where.join(asked, "doc_id").where("begin between 0 and n").groupBy("part", "first_token").agg(F.collect_list(one).alias("ranges"))
    met = stored(met, "ranges")
    parts = [r.part for r in met.select("part").distinct().limit(most_parts + 1).collect()]
    held = shards.select("part", "first_token", "codes")
    held = held.where(F.col("part").isin(parts)) if len(parts) <= most_parts else held

    def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, ranges in zip(batch.column("codes"), batch.column("ranges").to_pylist(), strict=True):
                held = Codes(codes.as_py())
                found = [held.slice(r["low"], r["high"]).astype(np.int64) for r in ranges]
                columns = [pa.array([r[k] for r in ranges], pa.int64()) for k in ("doc_id", "begin")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int64()))], ["doc_id", "begin", "ids"])

    return held.join(sent_if_small(met, 10_000), ["part", "first_token"]).select("codes", "ranges").mapInArrow(sliced, "doc_id long, begin long, ids array<long>")
