from listingflow.sources import html, readers, records, writers

from conftest import rows

PAGE = """
<html><body><table id="first"><tr><td>1</td><td>2</td></tr></table>
<div><h2>Upcoming</h2></div>
<section><div><span>Priced</span></div><table class="table-data wide" data-k="v">
<thead><tr><th>Date</th><th>Company</th></tr></thead>
<tr><td> 2024-01-01&nbsp;</td><td>Acme &amp; Co<br>Ltd</td><td><a href="/a">more</a><a>none</a></td></tr>
<tr><td>Date</td><td>company_name</td></tr>
<tr><td>only one</td></tr>
<tr><td></td><td>  </td></tr>
<tr><th>x</th><td>Unclosed
</table></section></body></html>
"""
BASE = {"table_elem": "table", "row_elem": "tr", "cell_elem": "td", "columns": ["ipo_date", "company_name"]}


def test_container_by_attribute_and_links():
    for attrs in ({"class": "table-data"}, {"class": ["other", "wide"]}, {"class": "table-data wide"}, {"data-k": "v"}):
        got = html.page_rows(PAGE, {**BASE, "table_attrs": attrs, "link_elem": "a", "link_key": "href", "link_base": "https://x.example"})
        assert got == [["2024-01-01", "Acme & CoLtd", "morenone", "https://x.example/a"], ["", ""]]
    assert html.page_rows(PAGE, {**BASE, "table_attrs": {"class": "absent"}}) == []


def test_container_by_number_and_title():
    assert html.page_rows(PAGE, {**BASE, "table_num": 0}) == [["1", "2"]]
    assert html.page_rows(PAGE, {**BASE, "table_num": 5}) == []
    titled = html.page_rows(PAGE, {**BASE, "table_title": "Priced", "cell_elem": ["th", "td"]})
    assert titled == []  # the title's grandparent holds no table here
    nested = "<div><p><b>Upcoming</b></p><table><tr><td>a</td><td>b</td></tr></table></div>"
    assert html.page_rows(nested, {**BASE, "table_title": "Upcoming"}) == []
    wrapped = "<div><p>Upcoming</p><table><tr><th>a</th><td>b</td></tr></table></div>"
    assert html.page_rows(wrapped, {**BASE, "table_title": "Upcoming", "cell_elem": ["th", "td"]}) == [["a", "b"]]


def test_several_cell_elements():
    got = html.page_rows(PAGE, {**BASE, "table_num": 1, "cell_elem": ["th", "td"]})
    assert got[0] == ["Date", "Company"] and got[-1] == ["x", "Unclosed"]


def test_rows_of_a_frame_and_names(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, PAGE), (3, None)], "page_id long, html string")
    found = html.extract_rows(pages, {**BASE, "table_attrs": {"class": "wide"}})
    assert html.table_width(found) == 3
    named = html.name_cells(found, ["ipo_date", "company_name"], 3)
    assert named.columns == ["page_id", "row_no", "ipo_date", "company_name", "Unnamed_column_0"]
    # the wholly blank record is gone, on both pages
    assert rows(named, "page_id", "company_name") == [(1, "Acme & CoLtd"), (2, "Acme & CoLtd")]
    assert html.fitted_names(["a", "b", "c"], 2) == ["a", "b"]
    skipped = html.extract_rows(pages, {**BASE, "table_attrs": {"class": "wide"}, "column_names_as_row": True})
    assert rows(skipped, "page_id", "row_no") == [(1, 0), (2, 0)]


def test_marked_records(spark):
    cells = ["lost", "Acme*", "1", "2", "Beta*", "3", "Gamma*"]
    df = spark.createDataFrame([(1, i, c) for i, c in enumerate(cells)], "page int, pos long, cell string")
    for block in (2, 100):
        got = rows(records.marked_records(df, ["page"], "pos", "cell", "*", ["name", "x"], block))
        assert got == [(1, 0, "lost", None, [], 1), (1, 1, "Acme", "1", ["2"], 3), (1, 4, "Beta", "3", [], 2), (1, 6, "Gamma", None, [], 1)]


def test_cards_keep_the_last_label(spark):
    df = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "a", "y"), (2, 0, "b", "z"), (3, 0, "c", "q")], "card int, n int, label string, value string")
    assert rows(records.cards(df, ["card"], "label", "value", "n", {"a": "A", "b": "B"})) == [(1, "y", None), (2, None, "z"), (3, None, None)]


def test_delimited_text_and_lists(spark):
    df = spark.createDataFrame([("a,b\r\n1,2\r\n3,4\r\n",)], "t string")
    assert rows(readers.delimited_text(df, "t", ["a", "b"])) == [(1, "1", "2", []), (2, "3", "4", [])]
    piped = spark.createDataFrame([("a|b\n1|2|x|y\n3|\n4",)], "t string")
    assert rows(readers.delimited_text(piped, "t", ["a", "b"], separator="|")) == [(1, "1", "2", ["x", "y"]), (2, "3", "", [])]
    lists = spark.sql("SELECT array(named_struct('x', 1)) AS A, array(named_struct('x', 2, 'y', 3)) AS B")
    assert rows(readers.stack_lists(lists, ["A", "B"])) == [("A", 1, None), ("B", 2, 3)]
    nested = spark.sql("SELECT named_struct('b', named_struct('c', 1, 'd', array(1))) AS a, 2 AS e")
    assert readers.flatten(nested).columns == ["a.b.c", "a.b.d", "e"]


def test_csv_literals(spark, tmp_path):
    df = spark.createDataFrame([("NA", "x, \"y\""), (None, "z")], "a string, b string")
    writers.export_csv(df, str(tmp_path / "plain"), bom=True)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "plain").glob("*.csv"))
    assert text.startswith("﻿a,b")
    writers.export_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), "a string, b string")) == [("NA", 'x, "y"'), (None, "z")]
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), "a string, b string", ["a"], ["NA"])) == [(None,), (None,)]


def test_versioned_table(spark, tmp_path):
    table = writers.VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.write(spark.range(3))
    assert table.write(table.read().where("id > 0")) == 2
    assert table.read().count() == 2 and table.read(before=2).count() == 3


def test_json_of_unknown_shape(spark):
    texts = ['{"a":1,"A":"x","b":{"c d":2.5,"e.f":[1,2],"g":null}}', '{"a":"t","b":{"c d":3},"l":[{"q":1},{"r":"s"}],"it\'s":true}', "no json", None, "[1, 2]", "{}", '{"a":{"deep":1}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    got = readers.json_unknown(df, "j", ["i"])
    assert got.columns == ["i", "A", "a", "b.c d", "b.e.f", "b.g", "it's", "l", "other_json"]
    by = {r[0]: tuple(r[1:]) for r in got.collect()}
    assert by[0] == ("x", "1", 2.5, [1, 2], None, None, None, None)
    assert by[1][:7] == (None, "t", 3.0, None, None, True, [(1, None), (None, "s")])
    assert by[6][1] == '{"deep":1}' and by[5] == (None,) * 8
    assert [by[i][-1] for i in (2, 3, 4)] == ["no json", None, "[1, 2]"]
    assert readers.json_unknown(df.where("i = 2"), "j").columns == ["other_json"]


def test_records_that_do_not_fit_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,s\n1,x\nbad,y\n2,z,more\n3\n"4","q, r"\n')
    df = readers.read_csv(spark, str(tmp_path / "a.csv"), "n int, s string", rescue="misfit")
    assert rows(df, "n", "s", "misfit") == [(1, "x", None), (2, "z", "2,z,more"), (3, None, "3"), (4, "q, r", None), (None, "y", "bad,y")]
    assert rows(df.select("s", "misfit").where("misfit is not null"), "s") == [("y",), ("z",), (None,)]
    report = readers.misfits(df, "misfit")
    assert rows(report, "record") == [("2,z,more",), ("3",), ("bad,y",)] and report.first().file.endswith("/a.csv")
    narrow = readers.read_csv(spark, str(tmp_path / "a.csv"), "n int, s string", columns=["s"], rescue="misfit")
    assert narrow.where("misfit is not null").count() == 3
    (tmp_path / "b.json").write_text('{"n": 1}\n{"n": "word"}\n{broken\n')
    read = readers.read_files(spark, str(tmp_path / "b.json"), "n int", "json", rescue="misfit")
    assert rows(read, "n", "misfit") == [(1, None), (None, '{"n": "word"}'), (None, "{broken")]


def test_saved_tables_without_duplicates(spark, tmp_path):
    from listingflow.operators import dedupe

    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, None)], "k int, `odd name` string")
    empty = spark.createDataFrame([], "v string")
    for _ in range(2):
        report = dedupe.clean({"a": a, "empty": empty}, str(tmp_path / "clean"))
        assert rows(report.drop("checksum")) == [("a", 4, 3, 1), ("empty", 0, 0, 0)]
        saved = spark.read.parquet(str(tmp_path / "clean/a"))
        assert rows(saved) == [(1, None), (2, "x"), (None, None)]
        sums = dict(rows(report.select("table_name", "checksum")))
        assert saved.repartition(3).agg(dedupe.checksum(saved.columns)).first()[0] == sums["a"] != 0
        assert spark.read.parquet(str(tmp_path / "clean/a")).where("k = 1").agg(dedupe.checksum(saved.columns)).first()[0] != sums["a"]


def test_pages_of_any_depth(spark, tmp_path):
    from listingflow.operators import ordering

    df = spark.createDataFrame([(i * 7919 % 1000 // 3 if i % 50 else None, i) for i in range(1000)], "a int, b int").repartition(5)
    keys = [("a", "desc"), ("b", "asc")]
    whole = [tuple(r) for r in ordering.order(df, keys).collect()]
    pages = ordering.Pages(df, keys, str(tmp_path / "pages"), ranges=8)
    assert len(pages) == 1000 and len(pages.counts) > 4
    for number, size in ((0, 10), (3, 100), (9, 100), (10, 100), (99, 10), (0, 1000), (1, 999), (200, 7), (142, 7)):
        assert [tuple(r) for r in pages.page(number, size).collect()] == whole[number * size : (number + 1) * size]
    plan = pages.page(50, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert ordering.Pages(df.limit(0), keys, str(tmp_path / "none")).page(0).count() == 0
