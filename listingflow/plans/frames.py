"""The test tables reshaped as the working tables of the library.

Written in the part of SQL that Spark and the checking engine share, so both sides start from the same rows: orders play
the listings, customers the entity map, line items the internal deals, events the polls.
"""

LISTING = """
SELECT c_name AS company_name,
       CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'T' || CAST(o_custkey AS STRING) END AS ticker,
       CASE o_orderkey % 5 WHEN 0 THEN 'Shanghai Stock Exchange' WHEN 1 THEN 'NYSE' WHEN 2 THEN 'Nasdaq'
            WHEN 3 THEN 'Euronext Paris' ELSE 'Shenzhen Stock Exchange' END AS exchange,
       CAST(o_orderdate AS DATE) AS ipo_date,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 7 = 0 THEN '10 - 12' END AS price_range,
       CAST(o_orderkey % 1000 AS DOUBLE) * 100 AS shares_offered,
       CASE o_orderstatus WHEN 'F' THEN 'Withdrawn' WHEN 'P' THEN 'Priced' END AS status,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS notes,
       o_orderdate AS time_added,
       nullif(o_orderdate, o_orderdate) AS time_removed
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

ENTITY = """
SELECT c_name AS company_name,
       'T' || CAST(c_custkey AS STRING) AS ticker,
       c_mktsegment AS exchange,
       CASE WHEN c_custkey % 3 <> 0 THEN c_name || ' Holdings' END AS entityname,
       CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS iconum,
       CASE WHEN c_custkey % 3 <> 0 THEN 'E' || CAST(c_custkey AS STRING) END AS entity_id,
       CASE WHEN c_custkey % 3 <> 0 THEN 'MAPPED' WHEN c_custkey % 2 = 0 THEN 'UNMAPPED' END AS mapstatus
FROM {customer}
"""

DEAL = """
SELECT CASE WHEN l_orderkey % 4 <> 0 THEN l_orderkey END AS iconum,
       'Customer#' || lpad(CAST(l_orderkey + 1 AS STRING), 9, '0') AS company_name,
       l_orderkey * 10 + l_linenumber % 2 AS master_deal,
       CASE WHEN l_linenumber % 3 <> 0 THEN 'C' || CAST(l_suppkey AS STRING) END AS cusip,
       CAST(l_orderkey * 10 + l_linenumber % 2 AS STRING) || '.NI' AS client_deal_id,
       CASE WHEN l_partkey % 4 = 0 THEN 'nan' WHEN l_partkey % 4 = 1 THEN NULL
            ELSE 'T' || CAST(l_orderkey AS STRING) END AS ticker,
       CASE WHEN l_returnflag = 'A' THEN ' Shanghai Stock Exchange ' WHEN l_returnflag = 'N' THEN 'Nasdaq' END AS exchange,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice END AS price,
       l_extendedprice * 0.5 AS min_offering_price,
       l_extendedprice * 2 AS max_offering_price,
       nullif(l_shipdate, l_shipdate) AS announcement_date,
       nullif(l_shipdate, l_shipdate) AS pricing_date,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_shipdate END AS trading_date,
       nullif(l_shipdate, l_shipdate) AS closing_date,
       CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS deal_status,
       l_shipdate AS last_updated_date_utc
FROM {lineitem}
"""

# Deals as `reconcile.deals_per_entity` leaves them, in SQL.
DEAL_PER_ENTITY = f"""
SELECT d.iconum, d.company_name, d.master_deal, x.cusip, d.client_deal_id, x.ticker, x.exchange, d.price,
       d.min_offering_price, d.max_offering_price, d.announcement_date, d.pricing_date, d.trading_date, d.closing_date,
       d.deal_status, d.last_updated_date_utc
FROM (SELECT *, row_number() OVER (PARTITION BY iconum, master_deal ORDER BY last_updated_date_utc DESC NULLS LAST,
             company_name, client_deal_id, price NULLS LAST, min_offering_price, max_offering_price, trading_date NULLS LAST,
             deal_status) AS rn
      FROM (SELECT DISTINCT * FROM ({DEAL}) d0) d1) d
LEFT JOIN (SELECT iconum,
                  string_agg(DISTINCT CASE WHEN ticker NOT IN ('nan', 'None') THEN ticker END, ', ' ORDER BY CASE WHEN ticker NOT IN ('nan', 'None') THEN ticker END) AS ticker,
                  string_agg(DISTINCT trim(exchange), ', ' ORDER BY trim(exchange)) AS exchange,
                  string_agg(DISTINCT cusip, ', ' ORDER BY cusip) AS cusip
           FROM ({DEAL}) d2 WHERE iconum IS NOT NULL GROUP BY iconum) x ON d.iconum = x.iconum
WHERE d.rn = 1
"""

# Listings with their entity (`reconcile.with_entities`), in SQL.
EXTERNAL = f"""
SELECT CASE WHEN l.exchange IN ('Shenzhen Stock Exchange', 'Shanghai Stock Exchange', 'Shanghai', 'Shenzhen')
             AND coalesce(e.entityname, f.company_name) IS NOT NULL
            THEN coalesce(e.entityname, f.company_name) ELSE l.company_name END AS company_name,
       l.ticker, l.exchange, l.ipo_date, l.price, l.price_range, l.shares_offered, l.status, l.notes, l.time_added,
       l.time_removed, coalesce(e.entityname, f.company_name) AS entityname, coalesce(e.iconum, f.iconum) AS iconum
FROM ({LISTING}) l
LEFT JOIN ({ENTITY}) e ON l.company_name = e.company_name
LEFT JOIN (SELECT ticker, company_name, iconum FROM ({DEAL_PER_ENTITY}) dpe
           WHERE exchange IN ('Shenzhen Stock Exchange', 'Shanghai Stock Exchange', 'Shanghai', 'Shenzhen')
             AND ticker IS NOT NULL) f ON l.ticker = f.ticker
"""

POLLS = """
SELECT 'user' || CAST(user_id AS STRING) AS source,
       CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS result,
       CAST(CAST(ts AS DATE) AS STRING) AS time_checked
FROM {events}
"""

# Tickets: one per customer, some of them closed, some by hand.
LEDGER = """
SELECT CAST(c_custkey AS STRING) AS iconum,
       'C' || CAST(c_custkey % 100 AS STRING) AS cusip,
       c_name AS company_name,
       'T' || CAST(c_custkey AS STRING) AS ticker,
       c_mktsegment AS exchange,
       DATE '1998-03-01' AS ipo_date,
       c_acctbal AS price,
       CAST(NULL AS STRING) AS price_range,
       CAST(NULL AS STRING) AS status,
       CAST(NULL AS STRING) AS notes,
       TIMESTAMP_NTZ '1998-01-01 00:00:00' AS last_checked,
       CAST(c_custkey AS STRING) || '.NI' AS ipo_deal_id,
       lower(c_name) AS formatted_company_name,
       c_custkey + 500000 AS ticket_number,
       'https://tickets.example/' || CAST(c_custkey + 500000 AS STRING) AS ticket_link,
       TIMESTAMP_NTZ '1998-02-01 00:00:00' AS ticket_created,
       CASE WHEN c_nationkey % 5 = 0 THEN 'Resolved' WHEN c_nationkey % 5 = 1 THEN NULL ELSE 'Open' END AS ticket_status
FROM {customer}
"""

# Listings in ticket layout.
TICKET_LISTING = """
SELECT CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS STRING) END AS iconum,
       CASE WHEN o_orderkey % 2 = 0 THEN 'C' || CAST(o_custkey % 100 AS STRING) WHEN o_orderkey % 5 = 0 THEN 'C0' END AS cusip,
       c_name AS company_name,
       CASE WHEN o_orderkey % 6 <> 0 THEN 'T' || CAST(o_custkey AS STRING) END AS ticker,
       c_mktsegment AS exchange,
       CASE WHEN o_orderkey % 4 = 0 THEN DATE '1998-03-01' WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS ipo_date,
       o_totalprice AS price,
       CAST(NULL AS STRING) AS price_range,
       CASE WHEN o_orderstatus = 'F' THEN 'Withdrawn' END AS status,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS notes,
       o_orderdate AS last_checked,
       CAST(o_orderkey AS STRING) || '.NI' AS ipo_deal_id,
       lower(c_name) AS formatted_company_name
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""
