"""The given tables seen as the tables of the linkage model. One SQL text for each, which Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")

_BILL = "'118-' || CASE {0} % 5 WHEN 0 THEN 'hres' WHEN 1 THEN 's' ELSE 'hr' END || '-' || {0}"
_CENTS = "CAST(SUM(CAST(ROUND({0} * 100) AS BIGINT)) AS DOUBLE) / 100"

#: By name: the SQL. Braces name given tables or earlier entries.
BINDINGS: dict[str, str] = {
    "members": """SELECT c_custkey AS member_id, c_name AS name, c_mktsegment AS party, CASE WHEN c_custkey % 4 = 0 THEN 'senate' ELSE 'house' END AS chamber,
        c_nationkey AS state, '' || (c_custkey % 53) AS district, DATE '2024-01-01' AS fetched_at FROM {customer}""",
    "trades": """SELECT o_orderkey AS filing_id, o_custkey AS member_id, CAST(o_orderdate AS DATE) AS tx_date,
        CASE o_orderstatus WHEN 'F' THEN 'purchase' WHEN 'O' THEN 'sale' ELSE 'sale_partial' END AS tx_type,
        CASE o_orderkey % 5 WHEN 0 THEN 'Spouse' WHEN 1 THEN 'joint' ELSE 'self' END AS holder,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 97 = 3 THEN 'SPY' ELSE 'T' || (o_orderkey % 97) END AS ticker,
        CASE WHEN o_orderkey % 13 = 0 THEN 'Vanguard fund ' ELSE 'Asset ' END || (o_orderkey % 97) AS asset,
        CASE o_orderkey % 7 WHEN 0 THEN 'GS' WHEN 1 THEN 'OT' WHEN 2 THEN NULL WHEN 3 THEN 'Stock' ELSE 'ST' END AS asset_type,
        CASE WHEN o_totalprice < 50000 THEN '$1,001 - $15,000' WHEN o_totalprice < 200000 THEN '$15,001 - $50,000' ELSE '$50,001 - $100,000' END AS amount_band,
        CASE o_orderkey % 3 WHEN 0 THEN 0.7 WHEN 1 THEN 0.95 ELSE 1.0 END AS match_confidence FROM {orders}""",
    "votes": f"""SELECT member_id, vote_id, vote_date, position, party_position, vote_question, bill_id FROM (
        SELECT o.o_custkey AS member_id, l.l_orderkey || '-' || l.l_linenumber AS vote_id, CAST(l.l_shipdate AS DATE) AS vote_date,
            CASE l.l_returnflag WHEN 'A' THEN 'yea' WHEN 'N' THEN 'nay' ELSE 'absent' END AS position, CASE l.l_linestatus WHEN 'F' THEN 'yea' ELSE 'nay' END AS party_position,
            CASE l.l_linenumber % 3 WHEN 0 THEN 'On Motion to Table' WHEN 1 THEN 'On Passage' ELSE 'H.Res. 5' END AS vote_question,
            CASE WHEN l.l_partkey % 19 = 0 THEN NULL ELSE {_BILL.format("l.l_partkey")} END AS bill_id,
            ROW_NUMBER() OVER (PARTITION BY l.l_orderkey, l.l_linenumber ORDER BY l.l_shipdate, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS nth
        FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey) numbered WHERE nth = 1""",
    "bills": f"""SELECT {_BILL.format("p_partkey")} AS bill_id, CASE WHEN p_partkey % 17 = 0 THEN p_name || ' Relief Act' ELSE p_name END AS bill_title,
        p_name || ' T' || (p_partkey % 97) || ' act' AS bill_summary FROM {{part}}""",
    "bill_subjects": f"""SELECT {_BILL.format("p_partkey")} AS bill_id, split_part(p_name, ' ', 1) AS subject, p_type AS policy_area FROM {{part}}
        UNION ALL SELECT {_BILL.format("p_partkey")} AS bill_id, split_part(p_name, ' ', 2) AS subject, p_type AS policy_area FROM {{part}}""",
    "bill_committees": f"""SELECT {_BILL.format("p_partkey")} AS bill_id, p_brand AS committee_name, lower(p_brand) AS committee_canonical FROM {{part}}
        UNION ALL SELECT {_BILL.format("p_partkey")} AS bill_id, 'Brand#' || (p_size % 25 + 1) AS committee_name, 'brand#' || (p_size % 25 + 1) AS committee_canonical FROM {{part}} WHERE p_partkey % 6 = 0""",
    "memberships": """SELECT c_custkey AS member_id, 'Brand#' || (c_nationkey + 1) AS committee_name, 'brand#' || (c_nationkey + 1) AS committee_canonical,
            CASE c_custkey % 4 WHEN 0 THEN 'Chair' WHEN 1 THEN 'Ranking Member' ELSE 'Member' END AS role FROM {customer}
        UNION ALL SELECT c_custkey AS member_id, 'Brand#' || (c_custkey % 7 + 1) AS committee_name, 'brand#' || (c_custkey % 7 + 1) AS committee_canonical, 'Member' AS role FROM {customer}""",
    "ticker_sectors": """SELECT ticker, CAST(substr(ticker, 2) AS INT) % 10 AS sic, 'Group ' || (CAST(substr(ticker, 2) AS INT) % 10) AS sic_description
        FROM (SELECT DISTINCT ticker FROM {trades} WHERE ticker LIKE 'T%') named""",
    "sic_theme": "SELECT * FROM (VALUES (0, 'Energy'), (1, 'Tech'), (2, 'Health'), (3, 'Finance'), (4, 'Defense'), (5, 'Media')) AS seed(sic, theme)",
    "overrides": "SELECT * FROM (VALUES ('T16', 'Tech'), ('T27', 'Energy'), ('T8', 'Media')) AS seed(ticker, theme)",
    "rules": """SELECT * FROM (VALUES ('Energy', 'ECONOMY', NULL), ('Tech', 'SMALL', NULL), ('Health', 'PROMO', NULL), ('Defense', 'MEDIUM', NULL),
        ('Finance', NULL, 'red%'), ('Media', NULL, '%gizmo%')) AS seed(theme, policy_area, subject_pattern)""",
    "sponsors": f"""SELECT DISTINCT s.s_nationkey AS member_id, {_BILL.format("p.p_partkey")} AS bill_id, p.p_name AS title
        FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{part}} p ON l.l_partkey = p.p_partkey""",
    "donors": f"""SELECT c.c_nationkey AS member_id, 'SUPPLIER ' || l.l_suppkey AS donor, MIN(s.s_name) AS donor_name, CASE l.l_suppkey % 3 WHEN 0 THEN 'pac' WHEN 1 THEN 'individual' END AS donor_type, {_CENTS.format("l.l_extendedprice")} AS amount
        FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey JOIN {{customer}} c ON o.o_custkey = c.c_custkey JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
        GROUP BY c.c_nationkey, l.l_suppkey""",
    "donor_industry": f"""SELECT c.c_nationkey AS member_id, CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) + CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) % 2 AS cycle,
            c.c_mktsegment || ' industry' AS industry, {_CENTS.format("o.o_totalprice")} AS total,
            {_CENTS.format("CASE WHEN o.o_orderkey % 2 = 0 THEN o.o_totalprice ELSE 0 END")} AS individuals,
            {_CENTS.format("CASE WHEN o.o_orderkey % 2 = 1 THEN o.o_totalprice ELSE 0 END")} AS pacs, MIN(o.o_orderpriority) AS source
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""",
    "industry_patterns": "SELECT * FROM (VALUES ('AUTO%', 'Energy'), ('build%', 'Defense'), ('%HOLD%', 'Tech'), ('H%', 'Tech'), ('MACH%', 'Health'), ('%CHINERY%', 'Robots'), ('%NITURE%', 'Media')) AS seed(industry_pattern, theme)",
    "contracts": f"""SELECT s.s_nationkey AS district, CAST(EXTRACT(YEAR FROM l.l_shipdate) AS INT) AS cy, CASE WHEN p.p_partkey % 3 = 0 THEN '3' || (1 + s.s_nationkey % 4) || '99' ELSE '3' || substr(p.p_brand, 7) || (p.p_partkey % 10) END AS code, {_CENTS.format("l.l_extendedprice")} AS amount
        FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{part}} p ON l.l_partkey = p.p_partkey GROUP BY 1, 2, 3""",
    "prefixes": "SELECT * FROM (VALUES ('31', 'Energy'), ('32', 'Tech'), ('317', 'Media'), ('3251', 'Health'), ('34', 'Defense')) AS seed(prefix, theme)",
    "awards": """SELECT c.c_nationkey AS district, 'r' || l.l_suppkey || '/' || (c.c_nationkey % 5) AS recipient_key, l.l_extendedprice AS amount
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "recipients": f"SELECT district, recipient_key, {_CENTS.format('amount')} AS amount FROM {{awards}} GROUP BY 1, 2",
    "confirms": """SELECT DISTINCT 'r' || s_suppkey || '/' || (n_nationkey % 5) AS recipient_key,
            CASE WHEN s_suppkey % 20 = 0 THEN 'T95' WHEN s_suppkey % 10 = 0 THEN 'T96' ELSE 'T' || (s_suppkey % 19 * 5 + n_nationkey % 5) END AS ticker
        FROM {supplier} JOIN {nation} ON (s_suppkey + n_nationkey % 5) % 3 < 2
        UNION ALL SELECT 'r' || s_suppkey || '/9' AS recipient_key, 'T1' AS ticker FROM {supplier} WHERE s_suppkey % 7 = 0""",
    "traded": "SELECT m.state AS district, t.ticker, COUNT(*) AS n_trades FROM {trades} t JOIN {members} m ON t.member_id = m.member_id WHERE t.ticker IS NOT NULL GROUP BY 1, 2",
    "spending": """SELECT c.c_nationkey AS member_id, CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) + CAST(EXTRACT(YEAR FROM o.o_orderdate) AS INT) % 2 AS cycle,
        o.o_orderpriority AS committee, CASE o.o_orderstatus WHEN 'F' THEN 'S' ELSE 'O' END AS side, CAST(ROUND(o.o_totalprice) AS BIGINT) AS amount
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "lobby_roles": """SELECT event_id AS filing_id, user_id AS lobbyist_id, CAST(2014 + event_id % 11 AS INT) AS filing_year, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS posted_at,
        CASE event_id % 12 WHEN 0 THEN 'Counsel, Rep. Ann Member' || (event_id % 37) WHEN 1 THEN 'Aide to Senator Member' || (event_id % 37)
            WHEN 2 THEN 'Staff, House Cmte on ' || CASE event_id % 5 WHEN 0 THEN 'Widgets' WHEN 1 THEN 'Bioenergy' ELSE 'Bolts' END WHEN 3 THEN 'N/A'
            WHEN 4 THEN 'Chief of Staff,  Rep Ann  T. Member' || (event_id % 37) || ' (2015)' WHEN 5 THEN 'Rep. Adam Member' || (event_id % 37)
            WHEN 6 THEN 'Sen. Ann Lee-Roe van Member' || (event_id % 37) || ', and CMTE staff: boltsmith' WHEN 7 THEN 'intern, CONGRESSWOMAN ann member' || (event_id % 37) || '; cmte on ENERGY'
            WHEN 8 THEN 'Rep. Ann One Two Three Member' || (event_id % 37) WHEN 9 THEN 'Prep. Member' || (event_id % 37) || 's' WHEN 10 THEN NULL
            ELSE 'ex-Senator Member' || (event_id % 37) || '-Smith' END AS role FROM {events}""",
    "lobby_members": """SELECT DISTINCT CAST(event_id % 37 AS BIGINT) AS member_id, CASE event_id % 37 % 5 WHEN 0 THEN 'Ann Member' || (event_id % 37) WHEN 1 THEN 'Ann T. Member' || (event_id % 37) || ', Jr.'
            WHEN 2 THEN 'Ann  Member' || (event_id % 37) || ' PhD' WHEN 3 THEN 'Member' || (event_id % 37) ELSE 'Zoe Member' || (event_id % 37) END AS name,
        CASE event_id % 37 % 3 WHEN 0 THEN 'house' WHEN 1 THEN 'senate' END AS chamber FROM {events}""",
    "lobby_keywords": "SELECT DISTINCT CAST(event_id % 37 AS BIGINT) AS member_id, CASE event_id % 37 % 3 WHEN 0 THEN 'widgets' WHEN 1 THEN 'bolts' ELSE 'energy' END AS keyword FROM {events}",
    "filings": """SELECT user_id AS filing_id, event_id, CAST(event_id % 5 AS INT) AS activity, event_type AS issue, CAST(event_id % 7 AS INT) AS lobbyist,
        CASE event_id % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN ' ' ELSE 'Aide ' || (event_id % 9) END AS position, 'Entity ' || (event_id % 4) AS entity FROM {events}""",
}


class Tables:
    """The given tables and the bindings as DataFrames, made when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or not (name in GIVEN or name in BINDINGS):
            raise AttributeError(name)
        if name not in self._made:
            if name in GIVEN:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                sql = BINDINGS[name]
                needs = {n: getattr(self, n) for n in (*GIVEN, *BINDINGS) if f"{{{n}}}" in sql}
                self._made[name] = self.spark.sql(sql, **needs)
        return self._made[name]


def with_clause(extra: dict[str, str] = {}) -> str:
    """The bindings, and more, as common table expressions for DuckDB."""
    parts = []
    for name, sql in {**BINDINGS, **extra}.items():
        for given in (*GIVEN, *BINDINGS):
            sql = sql.replace(f"{{{given}}}", given)
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n"
