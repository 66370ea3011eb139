"""Token operators against the libraries whose results they must equal."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import crc, frame, ordered, small_rows, tricky_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listingflow.llm import common, library_tokens, packing, piece_model, sentencepiece_codec, token_counts, token_store
from listingflow.llm.common import new_folder

PIECES, BYTES, WORDS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
ROWS = small_rows() + tricky_rows()
PARTS = ["a", "b", " ", "  ", "▁", "th", "the", "\n", "é", "é", "ß", "İ", "Σ", "€", "\U0001f600", "1", "23", "...", "'s", "in", " in", "\t", "<s>", "<|endoftext|>", "한", " ", "\x1c", "\x85", "​"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.characters(codec="utf-8")), max_size=40).map("".join))
def test_pieces_equal_the_library(library, text):
    model = piece_model.load(PIECES)
    words = model.split(text)
    ids = piece_model.encode_words(model, words)[0] if words else np.zeros(0, np.int64)
    assert ids.tolist() == library.encode(text)
    assert sentencepiece_codec.decode(model, ids) == library.decode(ids.tolist())


def test_long_words_use_the_queue_with_equal_results(library):
    model = piece_model.load(PIECES)
    for text in ("the" * 500, "▁" * 700 + "x", "ab" * 3000, "\U0001f600" * 300):
        assert piece_model.encode_words(model, model.split(text))[0].tolist() == library.encode(text)


@pytest.mark.parametrize(("kind", "path"), [(library_tokens.ByteLevelTokens, BYTES), (library_tokens.WordTokens, WORDS)])
def test_ids_by_part_equal_ids_of_the_whole(kind, path):
    rnd, own, whole = random.Random(3), kind(path), Tokenizer.from_file(path)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 40))) for _ in range(4000)] + [t or "" for _, t in ROWS]
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert own.encode(pa.array([], pa.string())) == []


def test_an_emptied_lexicon_changes_nothing():
    own = library_tokens.WordTokens(WORDS)
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(200)) for i in range(20)])
    expected = [x.tolist() for x in own.encode(texts)]
    own.lexicon.limit = 50
    for i in (0, 5, 0):
        assert [x.tolist() for x in own.encode(texts.slice(i, 5))] == expected[i : i + 5]
    assert len(own.lexicon.start) == 1000


def test_word_cache_keeps_to_its_limit():
    cache = common.WordCache(lambda words: [len(w) for w in words], limit=50, longest=10)
    for i in range(40):
        known = cache.ready([[f"w{i}x{j}" for j in range(20)], ["long" * i]])
        assert known[f"w{i}x7"] == len(f"w{i}x7") and known["long" * i] == 4 * i
    assert len(cache.known) < 100 and sum(len(w) > 10 for w in cache.known) == 1


def test_counts(spark, library):
    got = token_counts.count_tokens(frame(spark, ROWS), PIECES, limit=500).collect()
    expected = []
    for doc_id, text in ROWS:
        n = len(library.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 500))
    assert ordered(got) == ordered(expected)


def test_round_trip(spark, library):
    expected = []
    for doc_id, text in ROWS:
        ids = library.encode(text or "")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((doc_id, len(ids), *digests))
    assert ordered(sentencepiece_codec.round_trip(frame(spark, ROWS), PIECES).collect()) == ordered(expected)


def test_encode_gives_the_ids(spark, library):
    got = sentencepiece_codec.encode(frame(spark, tricky_rows()), PIECES).collect()
    assert ordered((r.doc_id, str(r.ids)) for r in got) == ordered((i, str(library.encode(t or ""))) for i, t in tricky_rows())


@pytest.mark.parametrize("top", [200, 60_000, 1 << 24, 1 << 32])
def test_codes_give_any_id_and_any_range(top):
    rnd = np.random.default_rng(top)
    for n in (0, 1, 511, 512, 513, 1024, 5000):
        ids = rnd.integers(0, top, n).astype(np.uint32)
        codes = token_store.Codes(token_store.encode_codes(ids))
        assert len(codes) == n and (codes.slice(0, n) == ids).all()
        for _ in range(20 if n else 0):
            a, b = sorted(rnd.integers(0, n + 1, 2).tolist())
            assert (codes.slice(a, b) == ids[a:b]).all()
            i = int(rnd.integers(0, n))
            assert codes[i] == ids[i]


def test_codes_of_anything_else_are_refused():
    with pytest.raises(ValueError):
        token_store.Codes(b"nothing of the kind")


def test_store_reads_back_what_it_was_given(spark):
    folder = new_folder(spark, "store")
    token_store.write(frame(spark, ROWS), folder, BYTES, end_id=0, shard_tokens=2000)
    shards = token_store.read(spark, folder)
    got = sorted(token_store.directory(shards).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(BYTES)
    ids = [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in ROWS]
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered((i, len(x), crc(x)) for i, x in ids)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in got[:2]] == [None, None]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert shards.count() > 5


def _check_packed(rows, capacity, got):
    whole = Tokenizer.from_file(WORDS)
    expected = ordered((i, tuple([*whole.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length and 0 < r.length <= capacity
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        used += at
    assert used == sum(len(ids) for _, ids in expected)
    return expected, len(sequences) * capacity - used, used


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_holds_every_id_once(spark, capacity):
    rows = [(n, t) for n, (_, t) in enumerate(ROWS)]
    got = packing.pack(frame(spark, rows), WORDS, capacity).collect()
    expected, padding, used = _check_packed(rows, capacity, got)
    docs = {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == len(docs.setdefault(r.doc_id, []))
        docs[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        docs[r.doc_id, "n"] = r.doc_tokens
    for doc_id, ids in expected:
        assert tuple(docs[doc_id]) == ids and docs[doc_id, "n"] == len(ids)
    assert padding <= 0.01 * used + capacity + 16 * len(got)


def test_packing_of_repeats_nulls_and_equal_lengths(spark):
    rows = [(1, "a b c")] * 40 + [(None, None)] * 7 + [(2, "x " * 5000)] * 3
    got = packing.pack(frame(spark, rows), WORDS, 128).collect()
    _check_packed(rows, 128, got)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=20))
def test_places_and_filling_cover_every_piece(histogram):
    placements, patterns = packing.place(histogram, 64)
    held = {}
    for p in placements:
        for i in range(p.count):
            held.setdefault(p.sequence + i, []).append((p.offset, p.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert {n: sum(p.count for p in placements if p.length == n) for n in histogram} == histogram
    gone, rooms = packing.dissolve(patterns, 64, 4)
    space = sum((64 - p.held) * p.count for p in rooms)
    assert sum(p.held * p.count for p in gone) <= space


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert sentencepiece_codec.round_trip(none, PIECES).count() == 0
    assert packing.pack(none, WORDS).count() == 0
    folder = new_folder(spark, "empty-store")
    token_store.write(none, folder, BYTES)
    assert token_store.directory(token_store.read(spark, folder)).count() == 0


def test_other_models_are_refused(tmp_path):
    path, data = tmp_path / "model", open(PIECES, "rb").read()
    # the normaliser message again, now one that removes extra white space: later fields replace earlier ones
    at = data.index(b"\x1a\x12\x0a\x08identity")
    path.write_bytes(data[:at] + b"\x1a\x0e\x0a\x08identity\x18\x01\x20\x01" + data[at + 20 :])
    with pytest.raises(ValueError):
        piece_model.PieceModel(str(path))


def test_count_limit_is_a_column_rule(spark):
    row = token_counts.count_tokens(frame(spark, [(1, "a b")]), PIECES, limit=2).select(F.col("over_limit")).first()
    assert row.over_limit is False
