"""Document quality: histogram gradient-boosted trees over statistics of the text.

The statistics describe characters, words and lines; language, source, id and labels are never among them.  A bounded sample of
labelled rows (``sample_rows``, the lowest hashes of the ids) is described by Spark and fitted on the driver: values are
binned by quantiles, trees grow level by level on per-bin sums of gradients.  The trees are flattened into arrays and every
batch of documents walks down all of them at once with numpy.

Defined results: a null or empty text is described by zeros and scored like any other; null ids are never held out; repeated
rows are scored each; texts of any length are read whole; other columns are passed by or not read; an empty table gives an
empty result; without labels, or with labels of one kind only, every document gets the share of label 1 (one half without any).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, released, ship_code

_MARKS = b"!?|*#$%&+=<>{}[]()/\\_-~^@:;.,'\"0123456789"
STATISTICS = (
    "characters words lines upper digits ascii_punctuation white beyond_ascii word_length word_length_spread longest_word "
    "distinct_words top_word shouted marked_ends line_length short_lines repeated_lines repeated_pairs sentence_ends entropy"
).split() + [f"mark_{b}" for b in _MARKS]


def describe(text: str) -> list[float]:
    """The statistics of one text: shares lie between 0 and 1, sizes are logarithms."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return [0.0] * len(STATISTICS)
    counts = np.bincount(raw, minlength=256)
    n = len(raw)
    words, lines = text.split(), text.split("\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    n_words, seen = max(1, len(words)), {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    shouted = sum(c for w, c in seen.items() if len(w) > 1 and w.isupper())
    marked = sum(c for w, c in seen.items() if not w[-1].isalnum() and w[-1] not in ".,")
    sentence_ends = sum(c for w, c in seen.items() if w[-1] in ".!?")
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    pairs = len(set(zip(words, words[1:], strict=False)))
    share = counts[counts > 0] / n
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    white, digits = counts[[9, 10, 11, 12, 13, 32]].sum(), counts[48:58].sum()
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)),
        counts[65:91].sum() / n, digits / n, (n - letters - white - digits) / n, white / n, counts[128:].sum() / n,
        lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        len(seen) / n_words, max(seen.values(), default=0) / n_words, shouted / n_words, marked / n_words,
        np.log1p(line_lengths.mean()), (line_lengths < 30).mean(), 1 - len(set(lines)) / len(lines),
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0, sentence_ends / n_words,
        float(-(share * np.log(share)).sum()),
        *(counts[np.frombuffer(_MARKS, np.uint8)] / n),
    ]


@dataclass
class Trees:
    """All trees in arrays: node i of a tree has its children at 2i + 1 and 2i + 2; leaves follow the inner nodes."""

    edges: list[np.ndarray]  # of the bins, per statistic
    statistic: np.ndarray  # (trees, inner nodes)
    bound: np.ndarray  # (trees, inner nodes): go right above this bin
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def bins(self, values: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, values[:, j], "left") for j, e in enumerate(self.edges)]
        return np.stack(columns, 1).astype(np.uint8) if columns else np.zeros((len(values), 0), np.uint8)

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        total, rows, inner = np.full(len(values), self.base), np.arange(len(values)), self.statistic.shape[1]
        binned = self.bins(values)
        for statistic, bound, leaf in zip(self.statistic, self.bound, self.leaf, strict=True):
            node = np.zeros(len(values), np.int64)
            while inner and len(node) and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (binned[rows, statistic[node]] > bound[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    values: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0
) -> Trees:
    """Boosts logistic loss; the best split of a node comes from sums of gradients per statistic and bin."""
    n, width, inner = len(values), values.shape[1], 2**depth - 1
    share = float(labels.mean()) if n else 0.5
    none = np.zeros((0, inner), np.int64)
    if not n or not 0 < share < 1:
        return Trees([np.zeros(0)] * width, none, none, np.zeros((0, inner + 1)), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    edges = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    out = Trees(edges, none, none, np.zeros((0, inner + 1)), float(np.log(share / (1 - share))))
    binned = out.bins(values).astype(np.int64)
    cells = binned + np.arange(width) * bins
    raw, statistics, bounds, leaves = np.full(n, out.base), [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        statistic, bound = np.zeros(inner, np.int64), np.full(inner, bins, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (width * bins) + cells).ravel()
            size = count * width * bins
            g = np.bincount(slot, np.repeat(gradient, width), size).reshape(count, width, bins).cumsum(2)
            h = np.bincount(slot, np.repeat(weight, width), size).reshape(count, width, bins).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < 1) | (all_h - h < 1)] = 0
            best = gain.reshape(count, -1).argmax(1)
            useful = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            statistic[first : first + count] = np.where(useful, best // bins, 0)
            bound[first : first + count] = np.where(useful, best % bins, bins)
            node = 2 * node + 1 + (binned[np.arange(n), statistic[node]] > bound[node])
        g, h = (np.bincount(node - inner, x, inner + 1) for x in (gradient, weight))
        leaf = rate * g / (h + ridge)
        raw += leaf[node - inner]
        statistics.append(statistic), bounds.append(bound), leaves.append(leaf)
    out.statistic, out.bound, out.leaf = np.array(statistics), np.array(bounds), np.array(leaves)
    return out


def _described(texts: Iterable[str | None]) -> np.ndarray:
    rows = [describe(t or "") for t in texts]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text"
) -> Trees:
    """Fits trees on at most ``sample_rows`` labelled rows that are not held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # the sample has a fixed size, so it may be sent to every task
    sample = known.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows)
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id").select("text", "label")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            values = _described(batch.column("text").to_pylist())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, batch.column("label")], ["statistics", "label"])

    found = rows.mapInArrow(run, "statistics array<double>, label int").toArrow()
    lists = found.column("statistics").combine_chunks()
    flat = lists.flatten().to_numpy() if len(lists) else np.zeros(0)
    values, marks = flat.reshape(-1, len(STATISTICS)), found.column("label").to_numpy().astype(np.float64)
    order = np.lexsort([*values.T, marks])  # rows arrive in any order; the result must not depend on it
    return fit(values[order], marks[order])


def score(docs: DataFrame, trees: Trees, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1.  A column of that name in ``docs`` is replaced."""
    spark = docs.sparkSession
    ship_code(spark)
    docs = docs.drop(name)
    names, sent = [*docs.columns, name], spark.sparkContext.broadcast(trees)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            texts = batch.column(names.index(text_col))
            scores = sent.value.score(_described(t.as_py() for t in texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
