"""Fingerprints, Merkle manifest and filter audit against brute force."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SMALL, WORD, frame, ordered, small_rows, tricky_rows
from pyspark.sql import functions as F

from listingflow.llm import filter_audit, fingerprints, merkle_manifest, queries

ROWS = small_rows() + tricky_rows()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, rank long, failing int, hash long, path string"


def labelled_rows():
    """The rows with languages and sources, of which one holds a third of all, nulls among them."""
    rnd = random.Random(3)
    out = []
    for i, (doc_id, text) in enumerate(ROWS):
        lang = rnd.choice(["en", "en", "de", "", None])
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "B", "é", "\U0001f600", "", None, f"own{i}"])
        out.append((doc_id, text, lang, source, None if i % 7 == 0 else len(text or "")))
    return out


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], COLUMNS).repartition(3)


# fingerprints


def _paragraphs(text, cut=fingerprints.CUT):
    got = fingerprints.paragraphs(pa.array([text or ""], pa.large_string()), cut)
    return set(got.digest.tolist())


def _alike(a, b):
    x, y = _paragraphs(a), _paragraphs(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def _successors(rows):
    """(id, text, next text); ids that occur repeatedly are not among the rows."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, t, rows[(n + 1) % len(rows)][1]) for n, (i, t) in enumerate(rows)]


def _once(rows):
    seen = set()
    return [r for r in rows if not (r[0] in seen or seen.add(r[0]))]


@pytest.mark.parametrize(("n", "partitions"), [(1, 4), (2, 4), (40, 4), (1000, 4), (1000, 1)])
def test_fingerprints_of_documents_and_their_successors(spark, n, partitions):
    rows = _once(ROWS)[:n] if n < 1000 else _once(ROWS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    by_text = collections.defaultdict(set)
    for doc_id, text, following in _successors(rows):
        k, r = len(text) // 4, got[doc_id]
        edited = text[: len(text) - k] + following[:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_edited, r.near_next) == (_alike(text, edited), _alike(text, following))
        by_text[text].add(r.fingerprint)
        by_text[edited].add(r.edited_fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_rows_that_share_an_id_follow_each_other_in_one_order(spark):
    rows = [(5, f"text {i % 40} of many words in a row") for i in range(400)] + [(None, None)] * 60 + [(4, "before"), (6, "after")]
    got = fingerprints.fingerprints(frame(spark, rows, extra=False)).collect()
    again = fingerprints.fingerprints(frame(spark, rows[::-1], extra=False)).collect()
    assert len(got) == len(rows) and ordered(got) == ordered(again)


def test_fingerprints_of_an_empty_table(spark):
    assert fingerprints.fingerprints(frame(spark, [])).count() == 0
    assert fingerprints.changes(frame(spark, []), frame(spark, [])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400))), min_size=1, max_size=6), st.sampled_from([3, 24]))
def test_differences_come_out_whole(pairs, size):
    def of(sets):
        digests = [fingerprints.mixed(np.array(sorted(s), np.uint64)) for s in sets]
        return fingerprints.Paragraphs(np.concatenate(digests), np.cumsum([0, *map(len, digests)]))

    left, right = of([a for a, _ in pairs]), of([b for _, b in pairs])
    row = np.arange(len(pairs))
    found = fingerprints.difference(left, row, right, row, size)
    got = sorted(zip(found.pair.tolist(), found.digest.tolist(), found.sign.tolist(), strict=True))
    one = lambda x: int(fingerprints.mixed(np.array([x], np.uint64))[0])
    assert got == sorted([(i, one(x), 1) for i, (a, b) in enumerate(pairs) for x in a - b] + [(i, one(x), -1) for i, (a, b) in enumerate(pairs) for x in b - a])


def test_changed_paragraphs_between_versions(spark):
    lines = [f"line {i} has a few words of its own and more" for i in range(300)]
    old = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "gone"), (4, None), (None, "x"), (6, "same same\nsame same")]
    new = [(1, "\n".join([*lines[:9], "quite new", *lines[10:]])), (2, "\n".join(lines[200:])), (4, ""), (5, "come"), (6, "same same")]
    got = {r.doc_id: r for r in fingerprints.changes(frame(spark, old), frame(spark, new), cut=0).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    texts = {"old": dict(old), "new": dict(new)}
    for doc_id, r in got.items():
        a, b = (_paragraphs(texts[v].get(doc_id), 0) for v in ("old", "new"))
        signed = lambda x: sorted(np.array(sorted(x), np.uint64).view(np.int64).tolist())
        assert (r.n_old, r.n_new, r.only_old, r.only_new) == (len(a), len(b), signed(a - b), signed(b - a))
    assert [len(got[2].only_old), len(got[1].only_new), len(got[6].only_old)] == [200, 1, 1]
    digests = fingerprints.paragraph_digests(frame(spark, old), cut=0).where("doc_id = 1")
    assert digests.count() == 300 and digests.where(F.col("digest") == got[1].only_old[0]).count() == 1


def test_fingerprints_hold_the_smallest_sketch():
    texts = pa.array(["a b c", "a  b\tc", "a b d", ""], pa.large_string())
    held = fingerprints.sketches(fingerprints.paragraphs(texts)).texts()
    assert held[0] == held[1] != held[2] and len(base64.b64decode(held[3])) == fingerprints.CELLS * 20


# Merkle manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars):
    shown = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(*map(shown, (doc_id, source, lang, n_chars, text)))


def _tree(leaves, fan_out):
    """(root, for each leaf its siblings before and after at each level)."""
    paths, place, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, p in enumerate(place):
            run = p // fan_out * fan_out
            paths[i].append((level[run:p], level[p + 1 : run + fan_out]))
        level = [_h(*level[i : i + fan_out]) for i in range(0, len(level), fan_out)]
        place = [p // fan_out for p in place]
    return level[0], paths


def _manifest(rows, shown, fan_out):
    """Rows of the query's result; ``shown`` gives the text under which a row is claimed."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0], _leaf(*r), _leaf(r[0], shown(r), *r[2:])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = _tree([r[1] for r in groups[s]], fan_out)
    root, tops = _tree([trees[s][0] for s in names], fan_out)
    out = []
    for s, top in zip(names, tops, strict=True):
        for (doc_id, leaf, claimed), path in zip(groups[s], trees[s][1], strict=True):
            steps, held = path + top, claimed
            for a, b in steps:
                held = _h(*a, held, *b)
            out.append((doc_id, leaf, trees[s][0], root, _h(*(x for a, b in steps for x in a + b)), held, held == root))
    return out


def _tampered(row):
    doc_id, text = row[:2]
    chosen = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
    return re.sub("[A-Z]", lambda m: m.group().lower(), text) if chosen and text else text


def _verified(spark, rows, fan_out):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(chosen, merkle_manifest.lowered(F.col("text")))
    return merkle_manifest.verification(merkle_manifest.manifest(table_of(spark, rows), shown, fan_out)).collect()


@pytest.mark.parametrize("fan_out", [2, 3, 16])
def test_manifest_and_tampered_rows(spark, fan_out):
    rows = labelled_rows()
    got = _verified(spark, rows, fan_out)
    assert ordered(got) == ordered(_manifest(rows, _tampered, fan_out))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 257])
def test_one_source(spark, n):
    rows = [(i, f"Text {i}", "en", "only", i) for i in range(n)]
    assert ordered(_verified(spark, rows, 16)) == ordered(_manifest(rows, _tampered, 16))


def test_lone_rows_and_repeats(spark):
    rows = [(i, "T", None, f"s{i:03}", None) for i in range(40)] + [(7, "T", None, "x", None)] * 20 + [(None, None, None, None, None)] * 3
    assert ordered(_verified(spark, rows, 16)) == ordered(_manifest(rows, _tampered, 16))


def test_manifest_of_an_empty_table(spark):
    assert _verified(spark, [], 16) == []


# filter audit


def _failing(rows):
    """(part, letters failed) of each row."""
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        failed = {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        failed |= {"E"} if doc_id is not None and doc_id > least[text] else set()
        out.append((lang or "", failed))
    return out


def _audit(rows, good, toxic, letters="ABCDE"):
    docs = [(part, failed, r[0] in good, r[0] in toxic) for r, (part, failed) in zip(rows, _failing(rows), strict=True)]
    out, shares = [], collections.Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in itertools.permutations(letters):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shares[part, f] += len(gone)
                fails = sum(f in d[1] for d in mine)
                alone = sum(d[1] == {f} for d in mine)
                out.append([part, "".join(order), step, len(left), len(gone), fails - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone), f])
    return [(*r[:-1], shares[r[0], r[-1]]) for r in out]


def _audited(spark, rows, labels):
    conditions = filter_audit.text_conditions()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string, n long")
    counts = filter_audit.counts_by_set(filter_audit.failing_sets(table_of(spark, rows), conditions, "E"), marks)
    return filter_audit.audit(counts, "ABCDE").collect()


def test_audit_of_all_orders(spark):
    rows = labelled_rows()
    rnd = random.Random(5)
    labels = [(r[0], rnd.choice([0, 1, None]), rnd.choice([0, 1]), None, None) for r in rows if rnd.random() < 0.6]
    labels += [(labels[0][0], 1, 1, None, None), (None, 1, 1, None, None), (10**6, 1, 1, None, None)]
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    assert ordered(_audited(spark, rows, labels)) == ordered(_audit(rows, good, toxic))


def test_audit_without_labels_or_rows(spark):
    rows = [(1, "a b", "en", None, None), (1, "a b", "en", None, None), (2, "a b", None, None, None), (None, None, "en", None, None)]
    assert ordered(_audited(spark, rows, [])) == ordered(_audit(rows, set(), set()))
    assert _audited(spark, [], []) == []


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_paths_through_the_lattice(k):
    held = filter_audit.Lattice("ABCDEFGH"[:k])
    assert held.forward[-1] == held.backward[0] == math.factorial(k)
    for s, f in held.edges:
        size = s.bit_count()
        assert held.weight(s, f) == math.factorial(size) * math.factorial(k - size - 1)
    with pytest.raises(ValueError):
        filter_audit.Lattice("AA")


def test_fingerprint_query_on_whole_tables(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op11_fingerprints"](spark, SMALL).collect()}
    for doc_id, text, following in _successors(small_rows()):
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc_id].near_edited == _alike(text, edited) and got[doc_id].near_next == _alike(text, following)
