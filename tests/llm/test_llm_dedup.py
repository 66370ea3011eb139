"""De-duplication operators against brute force."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import WORD, classes, frame, ordered, shingles, small_rows, tricky_rows

from listingflow.llm import blocks, components, embedding_dedup, exact_dedup, jaccard_join, substring_dedup, words
from listingflow.llm.common import new_folder

ROWS = small_rows() + tricky_rows()


def _expected_copies(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda i: i != keep)):
            out.append((i, hashlib.sha256(text.encode()).digest(), keep, len(ids), n == 0))
    return out


def test_exact_copies(spark):
    got = exact_dedup.deduplicate(frame(spark, ROWS)).select("doc_id", "digest", "keep_id", "group_size", "kept").collect()
    assert ordered((r[0], bytes(r[1]), *r[2:]) for r in got) == ordered(_expected_copies(ROWS))


def test_index_outlives_a_batch(spark):
    place = new_folder(spark, "index")
    index = exact_dedup.DigestIndex(spark, place, buckets=4)
    first = [(1, "a"), (2, "a"), (3, "b"), (None, "n")]
    second = [(9, "a"), (10, "c"), (11, "c"), (12, None), (13, "")]
    assert {(r.doc_id, r.kept) for r in index.absorb(frame(spark, first)).collect()} == {(1, False), (2, True), (3, True), (None, True)}
    again = exact_dedup.DigestIndex(spark, place, buckets=4)
    got = {(r.doc_id, r.keep_id, r.kept) for r in again.absorb(frame(spark, second)).collect()}
    assert got == {(9, 2, False), (10, 11, False), (11, 11, True), (12, 13, False), (13, 13, True)}
    assert again.rows().count() == 5 and again.rows().select("digest").distinct().count() == 5
    third = again.absorb(frame(spark, first + second))
    assert third.where("kept").count() == 0 and again.rows().count() == 5


def test_an_index_keeps_its_number_of_buckets(spark):
    place = new_folder(spark, "index")
    texts = [(i, f"text {i}") for i in range(300)]
    index = exact_dedup.DigestIndex(spark, place, buckets=64)
    assert index.absorb(frame(spark, texts)).where("kept").count() == 300
    spark.sql(f"DROP TABLE `{index.name}`")  # as in another catalog; the files stay
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, place, buckets=16)
    again = exact_dedup.DigestIndex(spark, place)
    assert again.buckets == 64 and exact_dedup.deduplicate(frame(spark, texts), again).where("kept").count() == 0


def test_indexes_with_alike_locations_are_apart(spark):
    end = "x" * 90
    a, b = (exact_dedup.DigestIndex(spark, f"{new_folder(spark, 'index')}/{end}", buckets=2) for _ in range(2))
    a.absorb(frame(spark, [(1, "a")]))
    assert a.rows().count() == 1 and b.rows().count() == 0


def test_a_lost_batch_is_absorbed_again(spark):
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    index.absorb(frame(spark, [(1, "a"), (2, "b")]), batch="first").count()
    second = frame(spark, [(3, "a"), (4, "c"), (5, "c"), (6, None), (7, "d")])
    results = [ordered(index.absorb(second, batch="second").drop("digest").collect()) for _ in range(3)]
    assert results[0] == results[1] == results[2] and len([r for r in results[0] if r[-1]]) == 3
    assert index.rows().count() == 5
    # an attempt that appended a part only
    other = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    other.absorb(frame(spark, [(4, "c"), (5, "c")]), batch="second").count()
    got = other.absorb(second, batch="second")
    assert got.where("kept").count() == 4 and other.rows().select("digest").distinct().count() == other.rows().count() == 4


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_copies_found_in_batches(spark, batches):
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    got = exact_dedup.in_batches(frame(spark, ROWS), index, batches).collect()
    assert ordered((r.doc_id, bytes(r.digest), r.keep_id, r.group_size, r.kept) for r in got) == ordered(_expected_copies(ROWS))
    assert exact_dedup.in_batches(frame(spark, []), exact_dedup.DigestIndex(spark, new_folder(spark, "index"), 2)).count() == 0


def test_the_index_is_not_shuffled(spark):
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    index.absorb(frame(spark, [(1, "a")]))
    left = spark.createDataFrame([(bytearray(b"x"),)], "digest binary").hint("merge")
    plan = left.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.split("\n")) if "FileScan" in line)
    assert "SortMergeJoin" in plan and "Exchange" not in "".join(plan.split("\n")[scan - 2 : scan])


def test_kept_rows_have_all_columns(spark):
    docs = frame(spark, ROWS)
    got = exact_dedup.keep_first_copies(docs)
    assert got.columns == docs.columns
    expected = [(i, d) for i, d, _, _, kept in _expected_copies(ROWS) if kept]
    assert ordered((r.doc_id, hashlib.sha256((r.text or "").encode()).digest()) for r in got.collect()) == ordered(expected)


def _linked(sets, percent):
    links = []
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                links.append((a, b))
    return links


def _unique_ids(rows):
    seen = set()
    return [r for r in rows if r[0] is None or not (r[0] in seen or seen.add(r[0]))]


@pytest.mark.parametrize(("n", "percent", "most"), [(4, 85, 1024), (5, 80, 1024), (1, 60, 3), (2, 50, 2)])
def test_jaccard_classes(spark, n, percent, most):
    rnd = random.Random(n)
    words_ = [f"v{i}" for i in range(40)]
    base = [rnd.choice(words_) for _ in range(25)]
    rows = _unique_ids(small_rows()[:60] + tricky_rows())
    for i in range(60):  # a chain of near copies around one text
        base[rnd.randrange(25)] = rnd.choice(words_)
        rows.append((1000 + i, " ".join(base)))
    sets = {i: shingles(t, n) for i, t in rows if i is not None}
    expected = classes(sets, _linked(sets, percent))
    got = jaccard_join.near_duplicates(frame(spark, rows), n, percent, block_rows=most).collect()
    assert ordered(tuple(r) for r in got) == ordered((i, len(shingles(t, n)), None if i is None else expected[i]) for i, t in rows)


def test_ids_with_several_texts_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, "quite another text of seven words here"), (6, text + " end"), (6, text + " end"), (7, "quite another text of seven words here")]
    got = jaccard_join.near_duplicates(frame(spark, rows), 4, 85).collect()
    assert len(got) == 5 and {r.component_id for r in got} == {5}
    kept = jaccard_join.keep_one_of_each(frame(spark, rows), 4, 85)
    assert {r.doc_id for r in kept.collect()} == {5} and kept.columns == frame(spark, rows).columns


def test_rows_sent_to_tasks_do_not_grow_with_their_family(spark, monkeypatch):
    sent, own = [], jaccard_join.F.broadcast
    monkeypatch.setattr(jaccard_join.F, "broadcast", lambda frame: sent.append(frame) or own(frame))
    words_ = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words_[:i], "x", *words_[i:]])) for i in range(60)]
    got = jaccard_join.near_duplicates(frame(spark, rows), 2, 60, block_rows=3).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 60
    assert len(sent) == 1 and not [t for _, t in sent[0].dtypes if t.startswith("array")]


def test_one_of_each_near_group_stays(spark):
    rows = _unique_ids(ROWS)
    sets = {i: shingles(t, 5) for i, t in rows if i is not None}
    found = classes(sets, _linked(sets, 80))
    got = {r.doc_id for r in jaccard_join.keep_one_of_each(frame(spark, rows)).collect()}
    assert got == {i for i in found if found[i] == i} | {None}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=8), st.integers(1, 5))
def test_overlaps_are_exact(sets, columns):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    assert blocks.overlaps(arrays, columns=columns)[np.triu_indices(len(sets), 1)].tolist() == [
        len(sets[i] & sets[j]) for i in range(len(sets)) for j in range(i + 1, len(sets))
    ]


def test_every_pair_of_a_large_group_meets(spark):
    members = spark.createDataFrame([("g", i) for i in range(40)] + [("h", 99)], "g string, m long")
    met = collections.defaultdict(set)
    for r in blocks.block_pairs(members, "g", "m", 7).collect():
        met[r.block].add(r.m)
    assert max(map(len, met.values())) < 40 and 99 not in set().union(*met.values())
    assert {(a, b) for s in met.values() for a in s for b in s if a < b} == {(a, b) for a in range(40) for b in range(a + 1, 40)}


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(500, 900)] + [(900, 901), (901, 902), (902, 900), (3, 3)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    expected = classes({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])
    assert got == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@given(st.lists(st.text(st.sampled_from("aB \n\té€\x0b\x1c"), max_size=30), min_size=1, max_size=5))
def test_words_of_arrow_columns(texts):
    found = words.words_of(pa.array(["skipped", *texts]).slice(1))
    expected = [WORD.findall(t) for t in texts]
    got = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end, strict=True)]
    assert got == [w for ws in expected for w in ws]
    assert np.diff(found.first).tolist() == [len(w) for w in expected]
    assert len(set(zip(got, found.hashes.tolist(), strict=True))) == len(set(got))


def _without_repeats(rows, width):
    texts = [WORD.findall(t or "") for _, t in rows]
    count = collections.Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 35])
def test_repeated_passages(spark, width):
    rnd = random.Random(width)
    rows = [(i, " ".join(rnd.choices("a b é c".split(), k=rnd.randint(0, 14)))) for i in range(60)]
    rows += [(700 + i, " ".join(rnd.choices([f"w{j}" for j in range(30)], k=60)) + " p1 p2 p3 p4 p5 p6 p7 p8 " + "tail " * i) for i in range(12)]
    rows += ROWS
    got = substring_dedup.remove_repeats(frame(spark, rows), width).collect()
    assert ordered(got) == ordered(_without_repeats(rows, width))


def _vectors(rnd, n):
    base = rnd.normal(size=(n // 4, 16))
    rows = np.concatenate([base, base + rnd.normal(size=base.shape) * 0.12, base[: n // 8] * 2, rnd.normal(size=(n // 4, 16))])
    return [(i, [float(x) for x in v], int(i % 3 if i % 7 else 0)) for i, v in enumerate(rows.astype(np.float32))]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_vectors(spark, kind):
    rows = _vectors(np.random.default_rng(1), 400)
    rows += [(900 + i, rows[0][1], rows[0][2]) for i in range(30)]
    odd = [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1), (2004, rows[0][1], None), (2005, [], 1), (2006, [1.0] * 5, 1), (2007, [float("inf")] * 16, 1), (None, rows[0][1], rows[0][2])]
    table = spark.createDataFrame([(*r, "x") for r in rows + odd], f"vec_id long, embedding array<{kind}>, label int, weight string")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(table, 0.93, block_rows=16).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.array([r[2] for r in rows])
    close = (x @ x.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(close, False)
    found = np.array([got[r[0]].n_links for r in rows])
    assert (found <= close.sum(1)).all() and found.sum() >= 0.99 * close.sum()
    expected = classes([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in zip(*np.nonzero(np.triu(close)), strict=True)])
    if found.sum() == close.sum():
        assert {r[0]: got[r[0]].component_id for r in rows} == expected
    assert all(got[i].kept == (got[i].component_id == i) for i in expected)
    assert all((got[r[0]].n_links, got[r[0]].component_id) == (0, r[0]) for r in odd)


def _fitted(spark, x, **bounds):
    """The grid of unit vectors of one label, and the share of pairs (first, last row) that its visits find."""
    x = x / np.linalg.norm(x, axis=1)[:, None]
    rows = pa.table({"rep": np.arange(len(x)), "label": np.zeros(len(x), np.int64), "weight": np.ones(len(x), np.int64), "vector": [v.tobytes() for v in x]})
    table = spark.createDataFrame(rows).repartition(4)
    grid = embedding_dedup.fit_grid(table, "<f8", 0.93, 0.999, **bounds)

    def share(pairs):
        a, b = np.array(pairs).T
        there, back = ((grid.nearest(x[i], grid.visits) == grid.cells(x[j])[:, None]).any(1) for i, j in ((a, b), (b, a)))
        return (there | back).mean()

    return grid, share


def _planted(rnd, base, cosine):
    noise = rnd.normal(size=base.shape)
    base = base / np.linalg.norm(base, axis=1)[:, None]
    noise -= (noise * base).sum(1)[:, None] * base
    return cosine * base + (1 - cosine**2) ** 0.5 * noise / np.linalg.norm(noise, axis=1)[:, None]


def test_rare_pairs_get_enough_visits(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(8000, 32))
    x = np.concatenate([x, _planted(rnd, x[:20], 0.94)])
    grid, share = _fitted(spark, x, sample_rows=1024, query_rows=64, most_visits=64)
    assert grid.visits >= 64 and share([(i, 8000 + i) for i in range(20)]) >= 0.9


def test_one_tight_group_does_not_set_the_visits(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(4000, 32))
    hot = x[:1] + rnd.normal(size=(2000, 32)) * 0.01
    x = np.concatenate([x, hot, _planted(rnd, x[1000:1600], 0.94)])
    _, share = _fitted(spark, x, sample_rows=2048, query_rows=512, most_visits=300)
    assert share([(1000 + i, 6000 + i) for i in range(600)]) >= 0.99


@pytest.mark.parametrize("pairs", [20, 1500])
def test_visits_go_on_until_the_target_is_reached(spark, pairs):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(6000, 32))
    x = np.concatenate([x, _planted(rnd, x[:pairs], 0.935)])
    grid, share = _fitted(spark, x, sample_rows=2048, query_rows=512, most_visits=2)
    assert grid.visits > 2 and share([(i, 6000 + i) for i in range(pairs)]) >= 0.99


@pytest.mark.parametrize("most", [16, 2048])
def test_vectors_of_every_length_link(spark, most):
    rnd = np.random.default_rng(6)
    rows = []
    for width, n in ((16, 200), (12, 80), (1, 3), (5, 6)):
        x = rnd.normal(size=(n, width))
        x = np.concatenate([x, x + rnd.normal(size=x.shape) * 0.05, x[:2]]).astype(np.float32)
        rows += [(len(rows) + i, [float(c) for c in v], i % 2 if width == 5 else 0) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(table, 0.93, block_rows=most).collect()}
    unit = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    links = [(i, j) for i, _, m in rows for j, _, n in rows[i + 1 :] if m == n and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    expected = collections.Counter(i for pair in links for i in pair)
    assert {i: got[i].n_links for i, *_ in rows} == {i: expected[i] for i, *_ in rows}
    assert {i: got[i].component_id for i, *_ in rows} == classes([i for i, *_ in rows], links)


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 30), st.integers(0, 10**6))
def test_traversal_visits_nearest_cells_first(visits, seed):
    rnd = np.random.default_rng(seed)
    grid = embedding_dedup.Grid(rnd.normal(size=(5, 3)), rnd.normal(size=(6, 3)), visits)
    x = rnd.normal(size=(4, 6))
    left, right = grid.distances(x)
    total = (left[:, :, None] + right[:, None, :]).reshape(4, -1)
    assert np.allclose(np.take_along_axis(total, grid.nearest(x, visits), 1), np.sort(total, 1)[:, :visits])
    assert (grid.nearest(x, visits)[:, 0] == grid.cells(x)).all()


def test_empty_tables(spark):
    none = frame(spark, [(1, "x")]).where("false")
    assert exact_dedup.deduplicate(none).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_vectors(vectors).count() == 0
