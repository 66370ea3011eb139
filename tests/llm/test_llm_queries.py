"""The registered queries, with their fixed parameters, over a whole small folder: against the libraries and plain versions."""

import collections
import hashlib
import math

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import SMALL, crc, ordered, small_rows
from test_llm_text import _base
from tokenizers import Tokenizer

from listingflow.llm import quality, queries, token_store
from listingflow.llm.common import documents, new_folder

DOCS = [(i, t or "") for i, t in small_rows()]
TABLES = ("documents", "labels", "embeddings")


def _rows(spark, name):
    return queries.QUERIES[name](spark, SMALL).collect()


def _library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_token_store(spark):
    library, start, expected = _library("byte_bpe_50k.json"), 0, []
    for doc_id, text in DOCS:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in _rows(spark, "op1_token_store")) == expected


def test_some_tokens_of_some_documents(spark, monkeypatch):
    folder, decoded = new_folder(spark, "token-store"), []
    token_store.write(documents(spark, SMALL), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, shard_tokens=3000)
    shards, library = token_store.read(spark, folder), _library("byte_bpe_50k.json")
    assert shards.count() > 20
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in DOCS}
    some = [i for i, _ in DOCS][::7]
    wanted = [(i, b, e) for i in some for b, e in ((0, 1), (3, 9), (0, 10**6), (len(ids[i]) - 1, len(ids[i])), (5, 5))] + [(-77, 0, 5), (None, 0, 1), (some[0], 10**7, 10**8)]
    frame = spark.createDataFrame(wanted, "doc_id long, begin long, end long")
    got = sorted((r.doc_id, r.begin, tuple(r.ids)) for r in token_store.tokens(shards, frame).collect())
    assert got == sorted((i, b, tuple(ids[i][b:e])) for i, b, e in wanted if i in ids and b <= len(ids[i]))
    # in a shard only what is asked for is decoded
    codes = token_store.Codes(shards.first().codes)
    unpack = np.unpackbits
    monkeypatch.setattr(token_store.np, "unpackbits", lambda bits, **kw: decoded.append(len(bits)) or unpack(bits, **kw))
    codes.slice(1000, 1008)
    assert sum(decoded) <= 2 * len(codes.levels)


def test_personal_data(spark):
    got = {r.doc_id: r for r in _rows(spark, "op3_personal_data")}
    kinds = ("email", "ip", "card", "phone")
    for doc_id, text in DOCS:
        found = sorted(_base(text), key=lambda s: (kinds.index(s[0]), s[1]))
        r, counts = got[doc_id], collections.Counter(s[0] for s in found)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in kinds)
        assert r.base_sha256 == _sha(",".join(f"{k}:{a}:{b}" for k, a, b in found))
        assert set(f"{k}:{a}:{b}" for k, a, b in found) <= set(r.spans.split(","))


def test_token_counts_and_codec(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    ids = {i: library.encode(t) for i, t in DOCS}
    counts = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in _rows(spark, "op4_token_counts")}
    assert counts == {(i, len(t.encode()), len(ids[i]), len(ids[i]) > 4096) for i, t in DOCS}
    coded = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in _rows(spark, "op5_sentencepiece")}
    assert coded == {(i, len(x), _sha(",".join(map(str, x))), _sha(library.decode(x))) for i, x in ids.items()}


def test_packing(spark):
    library, pieces, sequences = _library("word_bpe_49k.json"), collections.defaultdict(list), collections.defaultdict(list)
    for r in _rows(spark, "op6_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {i for i, _ in DOCS}
    total = 0
    for doc_id, text in DOCS:
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
        total += at
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert len(sequences) <= 1.05 * total / 4096 + 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_give_the_rows_of_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    expected = con.execute(queries.ORACLES[name])
    names = [c[0] for c in expected.description]
    assert ordered(queries.QUERIES[name](spark, SMALL).select(names).collect()) == ordered(expected.fetchall())


def _plain_trees(values, labels, trees, depth, rate, ridge, edges):
    """Scores of the rows after boosting by a search over every statistic and bound, row by row."""
    n, raw = len(labels), [math.log(sum(labels) / (len(labels) - sum(labels)))] * len(labels)
    cell = [[sum(e < v for e in edges[j]) for j, v in enumerate(row)] for row in values]

    def grow(rows, g, h, level):
        total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
        best = (1e-6, None)
        if level < depth:
            for j in range(len(edges)):
                for bound in range(len(edges[j]) + 1):
                    low = [i for i in rows if cell[i][j] <= bound]
                    a, b = sum(g[i] for i in low), sum(h[i] for i in low)
                    if b < 1 or total_h - b < 1:
                        continue
                    gain = a * a / (b + ridge) + (total_g - a) ** 2 / (total_h - b + ridge) - total_g**2 / (total_h + ridge)
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, bound))
        if best[1] is None:
            return {i: rate * total_g / (total_h + ridge) for i in rows}
        j, bound = best[1]
        parts = [i for i in rows if cell[i][j] <= bound], [i for i in rows if cell[i][j] > bound]
        return grow(parts[0], g, h, level + 1) | grow(parts[1], g, h, level + 1)

    for _ in range(trees):
        p = [1 / (1 + math.exp(-x)) for x in raw]
        step = grow(list(range(n)), [y - q for y, q in zip(labels, p, strict=True)], [q * (1 - q) for q in p], 0)
        raw = [x + step[i] for i, x in enumerate(raw)]
    return [1 / (1 + math.exp(-x)) for x in raw]


@pytest.mark.parametrize(("seed", "depth", "trees"), [(0, 1, 1), (1, 2, 3), (2, 3, 4)])
def test_the_learner_finds_the_splits_of_a_plain_search(seed, depth, trees):
    rnd = np.random.default_rng(seed)
    values = rnd.normal(size=(60, 3))
    labels = (values[:, 0] + 0.5 * values[:, 1] + rnd.normal(size=60) * 0.3 > 0).astype(float)
    made = quality.fit(values, labels, trees=trees, depth=depth, rate=0.3, bins=8, ridge=2.0)
    plain = _plain_trees(values.tolist(), labels.tolist(), trees, depth, 0.3, 2.0, [e.tolist() for e in made.edges])
    assert np.allclose(made.score(values), plain, atol=1e-9)
