import random

from hypothesis import given, settings, strategies as st

from listingflow.operators import entities, matching

from conftest import rows

DECISION = "clientId string, clientName string, entityName string, entityId string, mapStatus string, similarityScore double, confidenceScore double, countryName string, entityTypeDescription string"


def test_gate_boundary_and_best(spark):
    df = spark.createDataFrame(
        [
            ("Acme_T_NYSE", "Acme", "Acme Corp", "000BCD-E", "MAPPED", 0.9, 0.75, "US", "Public"),
            ("Beta__", "Beta", "Beta Low", "000001-E", "mapped", 0.99, 0.80, "US", "Public"),
            ("Beta__", "Beta", "Beta High", "000002-E", "MAPPED", 0.50, 0.90, "US", "Public"),
            ("Gone_T_X", "Gone", "Gone", "000003-E", "UNMAPPED", 1.0, 1.0, "US", "Public"),
        ],
        DECISION,
    )
    got = {r.company_name: r for r in entities.decisions_to_map(df).collect()}
    assert set(got) == {"Acme", "Beta"}
    # exactly .75 is not enough
    assert got["Acme"].mapstatus == "UNMAPPED" and got["Acme"].iconum is None and got["Acme"].confidencescore is None
    assert got["Beta"].entityname == "Beta High" and got["Beta"].iconum == 2 and got["Beta"].ticker is None
    detail = entities.mapped_decisions(df)
    assert "entityTypeCode" not in detail.columns and detail.count() == 3


def test_worklist_branches(spark):
    listings = spark.sql("SELECT * FROM VALUES ('a', 't', 'x', TIMESTAMP_NTZ '2024-01-01'), ('a', 't', 'x', TIMESTAMP_NTZ '2024-01-02'), ('b', NULL, 'x', NULL), ('c', 't', NULL, NULL), (NULL, 't', 'x', NULL) AS v(company_name, ticker, exchange, time_added)")
    known = spark.sql("SELECT * FROM VALUES ('a', NULL, NULL, 'UNMAPPED'), ('c', 5L, 'e', 'MAPPED') AS v(company_name, iconum, entity_id, mapstatus)")
    assert rows(entities.unmapped(listings, known), "company_name", "client_id") == [("b", "b__x")]
    assert rows(entities.unmapped(listings, known, recheck_all=True), "company_name") == [("a",), ("b",)]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _pairs(left, right, threshold):
    found = set()
    for a in set(left):
        for b in set(right):
            score = 1 - _distance(a, b) / max(len(a), len(b), 1)
            if a != b and score >= threshold - 1e-9:
                found.add((a, b, round(score, 9)))
    return found


def _check(spark, left, right, threshold):
    made = matching.candidate_pairs(
        spark.createDataFrame([(v,) for v in set(left)], "name string"), spark.createDataFrame([(v,) for v in set(right)], "name string"), threshold
    )
    assert {(r[0], r[1], round(r[2], 9)) for r in made.collect()} == _pairs(left, right, threshold)


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.text("ab c", min_size=1, max_size=14), min_size=1, max_size=40),
    st.lists(st.text("ab c", min_size=1, max_size=14), min_size=1, max_size=40),
    st.sampled_from([0.7, 0.8, 0.9]),
)
def test_no_similar_pair_is_missed_on_few_letters(spark, left, right, threshold):
    _check(spark, left, right, threshold)


def test_no_similar_pair_is_missed_on_edited_names(spark):
    pick = random.Random(5)
    words = ["acme", "holdings", "group", "pacific", "energy", "bio", "therapeutics", "capital", "trust"]
    right = [" ".join(pick.sample(words, pick.randint(1, 4))) for _ in range(80)]
    left = []
    for name in right:
        text = list(name)
        for _ in range(pick.randint(0, 4)):
            i = pick.randrange(len(text) + 1)
            text[i : i + pick.randint(0, 1)] = pick.choice(["", "x", "e"])
        left.append("".join(text) or "x")
    for threshold in (0.7, 0.85):
        _check(spark, left, right, threshold)


def test_match_names_keeps_every_row(spark):
    listings = spark.createDataFrame([(1, "Acme Holdngs, Inc."), (2, "ACME HOLDNGS INC"), (3, "zzz"), (4, None), (5, "Beta")], "i int, company_name string")
    universe = spark.createDataFrame([("Acme Holdings", "E2"), ("ACME Holdings Ltd", "E1"), ("Beta", "E3"), ("Bet", "E4")], "entityname string, entity_id string")
    got = {r.i: r for r in matching.match_names(listings, universe).collect()}
    assert len(got) == 5
    assert got[1].entity_id == got[2].entity_id == "E1" and got[1].mapstatus == "MAPPED"
    assert got[3].mapstatus == got[4].mapstatus == "UNMAPPED"
    assert (got[5].entity_id, got[5].confidence) == ("E3", 1.0)


def test_types(spark):
    df = spark.createDataFrame([("PUB",), ("FND",), (None,)], "entity_type string")
    assert entities.of_types(df).count() == 1
