"""Personal data, quality and the whole pipeline."""

import hashlib
import random
import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SMALL, classes, crc, frame, ordered, shingles, small_rows, tricky_rows

from listingflow.llm import personal_data, quality, queries
from listingflow.llm.common import documents, table

ROWS = small_rows() + tricky_rows()


def _base(text):
    """The four base kinds by plain patterns."""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 16 <= len(digits) <= 19 and sum(sum(divmod(d * 2, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0:
            out.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m))
    return [(kind, m.start(), m.end()) for kind, m in out]


PARTS = ["a", "@", "b.c", ".", "1", "23", "255", "256", "+", "-", " ", "(", ")", "4111111111111111", "4111 1111", "@x.com", "é", "\n", "%", "00", "999", "9"]


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert [s[:3] for s in personal_data.find(text) if s.kind in personal_data.BASE_KINDS] == _base(text)


def test_patterns_take_linear_time():
    for run in ("1", "a", "1.", "+1(", "1 ", "A1", "a@", "@", "AB12 ", "."):
        personal_data.find(run * 200_000 + "@a.b")


def test_parts_of_thousands_of_zeros():
    zeros = "0" * 5000
    for text, found in ((f"{zeros}.1.1.1", True), (f"{zeros}1.{zeros}.0.{zeros}255", True), (f"{zeros}256.1.1.1", False)):
        assert [s[:3] for s in personal_data.find(text) if s.kind == "ip"] == [("ip", 0, len(text))] * found


def test_other_kinds_need_checksum_or_context():
    find = lambda text: [(s.kind, text[s.start : s.end]) for s in personal_data.find(text)]
    assert find("pay to GB82 WEST 1234 5698 7654 32 now") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert find("pay to GB82 WEST 1234 5698 7654 33 now") == []
    assert find("number 123-45-6789 here") == [] and find("SSN: 123-45-6789") == [("ssn", "123-45-6789")]
    assert find("visa 378282246310005") == [("short_card", "378282246310005")] and find("code 378282246310005") == []
    assert find("test model visa 378282246310005") == []


def test_redaction_covers_overlaps():
    text = "x +1 (555) 555-0100 a.b@c.example 4111 1111 1111 1111."
    assert personal_data.redact(text, personal_data.find(text)) == "x <PHONE> <EMAIL> <CARD>."
    spans = [personal_data.Span("a", 0, 5, 1.0), personal_data.Span("b", 3, 8, 1.0), personal_data.Span("c", 8, 9, 1.0)]
    assert personal_data.redact("0123456789", spans) == "<A><C>9"


def test_span_digests(spark):
    got = personal_data.digests(personal_data.spans_of(frame(spark, ROWS))).collect()
    expected = []
    for doc_id, text in ROWS:
        found = _base(text or "")
        named = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        counts = [sum(k == kind for k, *_ in found) for kind in personal_data.BASE_KINDS]
        expected.append((doc_id, *counts, hashlib.sha256(named.encode()).hexdigest()))
    assert ordered(tuple(r)[:-1] for r in got) == ordered(expected)


def test_redacted_rows(spark):
    docs = frame(spark, ROWS).withColumnRenamed("size", "other")
    got = personal_data.redacted(docs)
    assert got.columns == docs.columns and got.count() == len(ROWS)
    for r in got.collect():
        assert r.text is None or not _base(r.text)
    assert personal_data.redacted(docs.where("false")).count() == 0


def test_statistics_are_finite_for_any_text():
    for _, text in ROWS:
        values = quality.describe(text or "")
        assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


def test_trees_equal_a_walk_from_node_to_node():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(800, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality.fit(x, y, trees=25, depth=3)
    binned = trees.bins(x)
    for i in range(0, 800, 40):
        total = trees.base
        for statistic, bound, leaf in zip(trees.statistic, trees.bound, trees.leaf, strict=True):
            node = 0
            while node < 7:
                node = 2 * node + (2 if binned[i, statistic[node]] > bound[node] else 1)
            total += leaf[node - 7]
        assert trees.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_labels_of_one_kind_give_their_share():
    for marks, low, high in (([1.0] * 5, 0.9, 1), ([0.0] * 5, 0, 0.1), ([], 0.49, 0.51)):
        trees = quality.fit(np.zeros((len(marks), 2)), np.array(marks))
        assert ((trees.score(np.zeros((3, 2))) >= low) & (trees.score(np.zeros((3, 2))) <= high)).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op10_quality(spark, folder).collect()}
    marks = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    rest = [(got[i].predicted, y) for i, y in marks if got[i].held_out]
    assert len(rest) > 500 and np.mean([p == y for p, y in rest]) > 0.98


def test_quality_of_odd_rows(spark):
    docs = frame(spark, ROWS)
    marks = spark.createDataFrame([(i % 150, i % 2, None) for i in range(200)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.learn(docs, marks, sample_rows=100)
    got = quality.score(docs, trees)
    assert got.count() == len(ROWS) and set(got.columns) == set(docs.columns)
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert quality.score(docs.where("false"), quality.learn(docs.where("false"), marks)).count() == 0
    assert quality.learn(docs, marks.where("false")).score(np.zeros((1, len(quality.STATISTICS))))[0] == pytest.approx(0.5)


def test_learning_does_not_depend_on_the_order_of_rows(spark):
    docs, marks = documents(spark, SMALL), table(spark, SMALL, "labels")
    one, two = (quality.learn(d, marks) for d in (docs, docs.repartition(7).orderBy("text")))
    assert (one.leaf == two.leaf).all() and (one.bound == two.bound).all()


def test_stages_by_brute_force(spark):
    from tokenizers import Tokenizer

    docs = documents(spark, SMALL)
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stage(spark, steps[-1], SMALL).cache())
    rows = [{r.doc_id: r for r in s.collect()} for s in steps[:-1]]
    assert all(s.columns == docs.columns for s in steps[:-1])
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.learn(docs, table(spark, SMALL, "labels"))).collect()}
    assert set(rows[1]) == {i for i in rows[0] if scores[i] >= 0.3}
    last = {}
    for i in sorted(rows[1]):
        last[rows[1][i].text] = i
    assert set(rows[2]) == set(last.values())
    sets = {i: shingles(r.text, 5) for i, r in rows[2].items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = classes(sets, links)
    assert set(rows[3]) == {i for i in found if found[i] == i}
    for i, r in rows[4].items():
        old = rows[3][i].text
        assert r.text == personal_data.redact(old, personal_data.find(old)) and r.n_chars == (len(r.text) if r.text != old else rows[3][i].n_chars)
    whole, used = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")), {}
    for r in steps[-1].collect():
        used.setdefault(r.doc_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids))
    for i, r in rows[4].items():
        ids = [*whole.encode(r.text, add_special_tokens=False).ids, 2]
        assert crc(ids) == zlib.crc32(b"".join(bytes(p.ids) for p in sorted(used[i], key=lambda p: p.start)))


@pytest.mark.parametrize("stage", range(5))
def test_stages_handle_odd_rows(spark, stage):
    rows = [(*r, None, None, None, None) for r in random.Random(1).sample(ROWS, len(ROWS))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    _, run = corpus_pipeline.STAGES[stage]
    got = run(spark, docs, SMALL)
    assert got.count() > 0 and (stage == 4 or got.columns == docs.columns)
    assert run(spark, docs.where("false"), SMALL).count() == 0


def test_every_query_is_registered_and_runs(spark):
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES] == list(range(1, 14))
    assert corpus_pipeline.run(spark, SMALL).count() > 100
