import datetime as dt

from pyspark.sql import functions as F

from listingflow.sources.normalise import americas, asia_pacific, combine_all, europe, final
from listingflow.sources.normalise.common import listings

from conftest import rows

NOW = "2024-06-15 12:00:00"
STAMP = "2024-06-01 08:00"


def raw(spark, names, *data):
    schema = ", ".join(f"{n} string" for n in [*names.split(), "time_added", "time_removed"])
    return spark.createDataFrame([(*d, STAMP, None) for d in data], schema)


def test_nyse_lists_the_day_after_pricing(spark):
    df = raw(spark, "ipo_date company_name ticker exchange deal_size shares_offered price_range", ("6/30/2024", "Acme, Inc", "AC", "NYSE", "1,000,000", "bad", "10-12"), ("soon", "B", "B", "NYSE", None, "1,500", None))
    got = americas.nyse(df)
    assert rows(got, "ipo_date", "shares_offered", "deal_size") == [(dt.date(2024, 7, 1), None, 1000000.0), (None, 1500.0, None)]
    assert got.schema["time_added"].dataType.simpleString() == "timestamp_ntz"


def test_withdrawn_notes_are_null_without_a_date(spark):
    df = raw(spark, "postponement_date company_name ticker shares_offered status", ("2024-01-02", "A", "a", "1,0", "Postponed"), (None, "B", "b", "2", "Postponed"))
    assert rows(americas.nyse_withdrawn(df), "company_name", "notes", "exchange") == [("A", "Withdrawn on 2024-01-02", "NYSE"), ("B", None, "NYSE")]


def test_nasdaq_price_or_range(spark):
    df = raw(spark, "ticker company_name exchange price shares_offered ipo_date", ("A", "A", "N", "10.00-12.00", "1", "6/30/2024"), ("B", "B", "N", "1 4.5", "1", "6/30/2024"), ("C", "C", "N", None, "1", "6/30/2024"))
    assert rows(americas.nasdaq(df), "ticker", "price", "price_range") == [("A", None, "10.00-12.00"), ("B", 14.5, None), ("C", None, None)]


def test_scoop(spark):
    df = raw(
        spark,
        "company_name ticker shares_offered_mm price_range_low price_range_high ipo_date",
        ("A", "a", "1.5", "10", "10", "6/20/2024 Priced"),
        ("B", "b", "x", "10", "12", "6/21/2024 Week of"),
        ("C", "c", "2", None, "12", None),
    )
    assert rows(americas.iposcoop(df), "company_name", "status", "ipo_date", "price", "price_range", "shares_offered") == [
        ("A", "Priced", dt.date(2024, 6, 20), 10.0, None, 1500000.0),
        ("C", None, None, None, None, 2000000.0),
    ]


def test_feed(spark):
    lines = raw(
        spark,
        "symbol name ipoDate priceRangeLow priceRangeHigh exchange",
        ("A", "Acme Units", "2024-06-20", "0", "0", '"""NYSE American"""'),
        ("B", "Beta Warrants to purchase Common Stock", "2024-06-20", "9", "10", "NYSE"),
        ("C", "Gamma ETF Trust", "2024-06-20", "10", "10", "NYSE"),
        ("D", "Delta Class A Common Stock", "2024-06-20", "bad", "10", "NYSE"),
    )
    got = americas.feed(americas.feed_raw(lines))
    assert rows(got, "ticker", "company_name", "assetType", "price", "price_range", "exchange") == [
        ("A", "Acme", "Units", None, None, "NYSE American"),
        ("B", "BetaCommon Stock", "Warrants", None, "9.0 - 10.0", "NYSE"),
        ("C", "Gamma", "ETF", 10.0, None, "NYSE"),
        ("D", "Delta", "Shares", None, None, "NYSE"),
    ]


def test_price_expected_note_uses_the_instant(spark):
    df = spark.createDataFrame([("2024-06-15",), ("2024-06-16",)], "d string").select(F.col("d").cast("date").alias("ipo_date"), F.lit("x").alias("notes"))
    assert rows(americas.price_expected(df, NOW), "notes") == [("Price expected 2024-06-15",), ("x",)]


def test_tmx(spark):
    names = "identification change_type list_symbol company_name security_description effective_date details entry_date modification_date exchange file"
    df = raw(
        spark,
        names,
        ("1", "New Listing", "A", "Acme", "Common", "2024-06-01", "n" * 300, "2024-05-01", None, "TSX", "20240601 x"),
        ("1", "New Listing", "A", "Acme", "Common", "2024-06-01", "n" * 300, "2024-05-01", None, "TSX", "20240602 x"),
        ("2", "New Listing", "B", "Beta", "Common", "2024-06-01", None, "2024-05-01", None, "TSX", "20240601 x"),
        ("3", "New Listing", "C", "Gamma Fund", "Common", "2024-06-01", None, "2024-05-01", None, "TSX", "20240602 x"),
        ("4", "New Listing", "D", "Delta", "Warrants", "2024-06-01", None, "2024-05-01", None, "TSX", "20240602 x"),
        ("5", "New Listing", "E", "Eps", "Common", "2024-06-01", "A TRANSFER", "2024-05-01", None, "TSX", "20240602 x"),
        ("6", "Other", "F", "Zeta", "Common", "2024-06-01", None, "2024-05-01", None, "TSX", "20240602 x"),
    )
    wanted = ["ticker", "file", F.length("notes").alias("n"), "time_removed"]
    assert rows(americas.tmx(df, NOW).select(*wanted)) == [("A", "20240601 x", 300, None), ("B", "20240601 x", None, dt.datetime(2024, 6, 15, 12))]
    # notes that differ only far behind are two rows, and words there count
    late = raw(
        spark,
        names,
        ("1", "New Listing", "A", "Acme", "Common", "2024-06-01", "n" * 300 + "1", "2024-05-01", None, "TSX", "20240602 x"),
        ("1", "New Listing", "A", "Acme", "Common", "2024-06-01", "n" * 300 + "2", "2024-05-01", None, "TSX", "20240602 x"),
        ("2", "New Listing", "B", "Beta", "Common", "2024-06-01", "n" * 300 + " transfer", "2024-05-01", None, "TSX", "20240602 x"),
    )
    short = americas.tmx(late, NOW, note_length=200).select("ticker", F.length("notes").alias("n"))
    assert rows(short) == [("A", 200), ("A", 200)]


def test_japan(spark):
    jpx = raw(spark, "ipo_date date_of_listing_approval company_name ticker market_segment", ("2024-06-20", "2024-06-01", "** Nippon,Co. ", "100", "Growth"), ("2024-06-21", None, "Other", "200", None))
    tokyo = raw(
        spark,
        "company_name ipo_date ticker price price_range price_range_expected_date price_expected_date",
        ("N", "2024-06-20", "100", "900", "7/1", "7/1", None),
        ("N", "2024-06-20", "100", None, "800-900", None, "7/9"),
    )
    got = asia_pacific.japan({"JPX": jpx, "TokyoIPO": tokyo})
    assert rows(got, "company_name", "exchange", "price", "price_range", "notes") == [
        ("Nippon, Co.", "Japan Stock Exchange - Growth", 900.0, None, "Price Range expected 7/1Technical Listing"),
        ("Other", None, None, None, ""),
    ]


def test_china(spark):
    sh = raw(spark, "new_share_name subscription_date price ipo_date announcement_of_winning_results", ("中国移动600941", None, "5", None, None), ("平安601318", None, "5", "2024-06-10", None))
    sz = raw(spark, "ticker company_name release_date price shares_offered ipo_date", ("000001", "深发", None, "7", "1.5", None))
    em = raw(spark, "ticker ipo_date", ("600941", "06-18"), ("601318", "06-30"), ("000001", "-"))
    got = asia_pacific.china({"Shanghai": sh, "CNInfo": sz, "East Money": em}, NOW)
    assert rows(got, "company_name", "ticker", "ipo_date", "shares_offered") == [
        ("中国移动", "600941", dt.date(2024, 6, 18), None),
        ("平安", "601318", dt.date(2024, 6, 10), None),
        ("深发", "000001", None, 15000.0),
    ]


def test_frankfurt(spark):
    names = "ipo_date summary market_segment sector sub_price_and_deal_size first_price_and_market_cap"
    df = raw(
        spark,
        names,
        ("6/20/2024", "(X)Rhein AGSector: y", "Scale (IPO)", "Sector:\n\t\t\tTech", "First Price / Quotation: € 11.50 / € 1,000.5", None),
        ("6/20/2024", "(X)Main AGSector: y", "Prime Standard (Transfer)", None, "Volume: € 12.25 / € 2,000", None),
        ("6/20/2024", "none", "General Standard", None, "Volume: € 12.25 / € 2,000", "First Price / Quotation: € 10.00 / € 900"),
    )
    got = europe.frankfurt(df)
    assert rows(got, "company_name", "offer_type", "notes", "exchange", "first_traded_price", "market_cap", "price", "deal_size", "sector") == [
        ("Rhein AG", "IPO", "Offer Type: IPO", "Frankfurt Stock Exchange - Scale", "11.50", "1,000.5", None, None, "Tech"),
        (None, None, "Offer Type: ", None, "10.00", "900", 12.25, "2,000", None),
    ]


def test_small_sources(spark):
    bme = raw(spark, "ipo_date isin company_name shares_offered deal_size volume listing_type", ("2024-06-20", "ES1", "A", "1,000", "5,000.7", "2,500", None), ("2024-06-20", "ES2", "B", "0", "1", "2", "Integration"))
    assert rows(europe.bme(bme), "ticker", "price", "deal_size") == [("ES1", 2.5, 5000)]
    sgx = raw(spark, "company_name ipo_date price market_segment closing_price_first_day", ("A", "2024-06-20", "SGD 0.25", None, "1"), ("X ETF", "2024-06-20", "SGD 1", "M", "1"))
    assert rows(asia_pacific.sgx(sgx), "company_name", "price", "exchange") == [("A", 0.25, "Singapore Exchange - ")]
    bit = raw(spark, "company_name listing_type ipo_date market_segment", ("A", None, "02/03/2024", "AIM*"), ("B", "Transition from X", "02/03/2024", "M"))
    assert rows(europe.borsa_italiana(bit), "company_name", "ipo_date", "exchange") == [("A", dt.date(2024, 3, 2), "Borsa Italiana - AIMProfessional Segment")]
    nordic = raw(spark, "company_name last_price percent_change ipo_date", ("A", "1", "2", "2024-06-20"), ("A", "3", "4", "2024-06-20"))
    assert europe.nasdaq_nordic(nordic).count() == 1
    hk = raw(spark, "ticker company_name price ipo_date", ("01234.HK", "A", "1.1-1.3", "2024/06/20"), ("x", "B", "2.5", None))
    assert rows(asia_pacific.aastocks(hk), "ticker", "price", "price_range", "ipo_date") == [("01234", None, "1.1-1.3", dt.date(2024, 6, 20)), (None, 2.5, None, None)]
    asx = raw(spark, "listing_info", ("Acme Ltd (ACM) - 5 June 2024",), ("strange",))
    assert rows(asia_pacific.asx_raw(asx), "company_name", "ipo_date") == [("Acme Ltd (ACM)", dt.date(2024, 6, 5)), (None, None)]
    hub = spark.createDataFrame([("12.5 SEK", "2024"), ("5-7 SEK", "2024-07-01"), (None, None)], "price string, ipo_date string")
    assert rows(europe.ipohub_raw(hub, NOW), "price", "price_range", "currency", "ipo_date") == [(12.5, None, "SEK", None), (None, "5-7 SEK", "SEK", dt.date(2024, 7, 1)), (None, None, None, None)]
    lse = raw(spark, "company_name exchange ipo_date", ("A (x) (y)", None, "2024-06-20"))
    assert rows(europe.lse(lse), "company_name", "exchange") == [("A", "London Stock Exchange ")]


def test_tokyo_records(spark):
    df = spark.createDataFrame([("Acme ", "7/1", "100(Growth)", "900-1000", "7/12", "x"), ("", "", "", "", "", ""), ("Beta", "7/2", "200", "6/30", "1,200", "y")], "company_name string, ipo_date string, ticker string, price_range string, price string, blank_0 string")
    got = asia_pacific.tokyo_ipo_raw(df, NOW)
    assert rows(got, "company_name", "ipo_date", "ticker", "exchange", "price", "price_expected_date", "price_range_expected_date") == [
        ("Acme", dt.date(2024, 7, 1), "100", "Japan Stock Exchange - Growth", None, "7/12", None),
        ("Beta", dt.date(2024, 7, 2), "200", None, 1200.0, None, "6/30"),
    ]


def test_final_format(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('A, Inc', 'X', DATE '2024-06-16', NULL, TIMESTAMP_NTZ '2024-01-01'), ('A Inc', 'X', DATE '2024-06-15', 'Priced', TIMESTAMP_NTZ '2024-01-02'),
           ('B', 'X', DATE '2024-06-20', 'Priced', TIMESTAMP_NTZ '2024-01-02'), ('C', 'X', DATE '2024-01-01', ' Priced ', NULL), ('D', NULL, NULL, NULL, NULL)
           AS v(company_name, exchange, ipo_date, status, time_added)"""
    )
    got = combine_all([df], NOW)
    assert rows(got, "company_name", "status") == [("A Inc", "Listing Today"), ("B", "Upcoming Priced"), ("C", "Priced"), ("D", None)]
    assert [r[0] for r in final.newest_first(got).select("company_name").collect()] == ["B", "A Inc", "C", "D"]
    assert listings(got).columns[0] == "company_name"


def test_stages_too_large_for_a_jvm_to_compile_are_run_in_small_methods(spark, tmp_path):
    from __spark_entry__ import queries

    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.sql("SELECT 1L AS o_orderkey, 2L AS o_custkey, 'F' AS o_orderstatus, 1.0D AS o_totalprice, TIMESTAMP_NTZ '1998-02-06 00:00:00' AS o_orderdate, '5-LOW' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get(limit)
    spark.conf.set(limit, "65535")  # as a session has it that was set up elsewhere
    try:
        got = queries()["calendar_nyse"](spark, str(tmp_path))
        assert int(spark.conf.get(limit)) <= 8000
        assert rows(got, "company_name", "ipo_date") == [("Company 2, Inc.", dt.date(1998, 2, 7))]
    finally:
        spark.conf.set(limit, before)
