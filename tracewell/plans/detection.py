"""Registered queries of detectors, null models, calibration, entity resolution, quality and text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions import rng, text
from tracewell.operators import calibration, detectors, flatten, nullmodel, ordering, proximity, quality, resolve, rollups, themes
from tracewell.scratch import discard, staged
from tracewell.sources import sinks

from .queries import _MEDIANS, _TOTALS, before, donor_theme, eligible, instruments, nexus, query, sponsored_theme

_FUNDS = ", ".join(f"'{x}'" for x in detectors.MARKET_FUNDS)
_WORDS = ", ".join(f"'{x}'" for x in detectors.WORD_TICKERS)
_NAMED = f"(bill_mentions_ticker AND upper(coalesce(ticker, '')) NOT IN ({_WORDS}))"
_SCORE = """CASE WHEN days_before_vote = 0 AND member_on_bill_committee THEN 100 WHEN days_before_vote = 0 THEN 90
    WHEN days_before_vote <= 3 AND member_on_bill_committee THEN 85 WHEN days_before_vote <= 3 THEN 80 WHEN member_on_bill_committee THEN 70 ELSE {0} END"""
_ALIGNED = f"""(SELECT * FROM (SELECT *, {_NAMED} AS ticker_named, {_SCORE.format(60)} + CASE WHEN {_NAMED} THEN 5 ELSE 0 END AS score,
    row_number() OVER (PARTITION BY member_id, filing_id, tx_date, tx_type, upper(coalesce(ticker, asset))
      ORDER BY {_SCORE.format(60)} + CASE WHEN {_NAMED} THEN 5 ELSE 0 END DESC, days_before_vote, vote_id) AS rn
    FROM before WHERE days_before_vote <= 14 AND upper(coalesce(ticker, '')) NOT IN ({_FUNDS}) AND (member_on_bill_committee OR {_NAMED})) r WHERE rn = 1)"""


def _cited(trade_label: str) -> str:
    """The cited trades, votes and dates of a member's rows as texts, as DuckDB SQL."""
    listed = lambda rows, kind: f"list_transform({rows}, lambda x: '{kind}:' || x.id || ':' || x.label)"
    trades = f"list_sort(list({{'id': filing_id::VARCHAR, 'label': {trade_label}}}))"
    votes = "list_sort(list(DISTINCT {'id': vote_id, 'label': 'Vote ' || vote_date || ': ' || coalesce(bill_title, vote_question)}))"
    return f"""md5(array_to_string(list_concat({listed(trades, 'trade')}, {listed(votes, 'vote')}), '|')) AS citing,
        array_to_string(list_sort(list_distinct(list_concat(list(tx_date::VARCHAR), list(vote_date::VARCHAR)))), ',') AS dates"""


def _as_texts(found):
    """Hits with what they cite as texts, to compare."""
    citing = F.array_join(F.transform("citing", lambda x: F.concat_ws(":", x["kind"], x["id"], x["label"])), "|")
    return found.withColumn("citing", F.md5(citing)).withColumn("dates", F.array_join(F.transform("dates", lambda d: d.cast("string")), ","))


@query(f"""SELECT *, n_trades || ' trade' || CASE WHEN n_trades = 1 THEN '' ELSE 's' END || ' placed within 14 days before a vote on a related bill'
      || CASE WHEN n_committee > 0 THEN '; ' || n_committee || ' where the member sat on a committee that handled the bill' ELSE '' END
      || CASE WHEN n_named > 0 THEN '; ' || n_named || ' where the bill text names the traded company' ELSE '' END
      || CASE WHEN n_same_day > 0 THEN '; ' || n_same_day || ' on the same day as the vote' ELSE '' END || '.' AS finding FROM (
    SELECT member_id, count(*) AS n_trades, count(*) FILTER (member_on_bill_committee) AS n_committee, count(*) FILTER (NOT member_on_bill_committee AND ticker_named) AS n_named,
      count(*) FILTER (days_before_vote = 0) AS n_same_day, least(1.0, max(score) / 100.0)::DOUBLE AS intensity, {_cited("tx_type || ' ' || coalesce(ticker, asset) || ' (' || tx_date || ')'")} FROM {_ALIGNED} x GROUP BY 1) g""")
def d01_trade_vote_alignment(t):
    found = _as_texts(detectors.trade_vote_alignment(before(t, 14)))
    return found.select("member_id", "n_trades", "n_committee", "n_named", "n_same_day", "intensity", "citing", "dates", "finding")


@query(f"""SELECT member_id, to_json(list_concat(list_transform(list_sort(list({{'id': filing_id::VARCHAR, 'label': tx_type || ' ' || coalesce(ticker, asset) || ' (' || tx_date || ')'}})), lambda x: {{'kind': 'trade', 'id': x.id, 'label': x.label}}),
      list_transform(list_sort(list(DISTINCT {{'id': vote_id, 'label': 'Vote ' || vote_date || ': ' || coalesce(bill_title, vote_question)}})), lambda x: {{'kind': 'vote', 'id': x.id, 'label': x.label}})))::VARCHAR AS citing_json,
    to_json(list_sort(list_distinct(list_concat(list(tx_date::VARCHAR), list(vote_date::VARCHAR)))))::VARCHAR AS dates_json FROM {_ALIGNED} x GROUP BY 1""")
def snk1_encoded_hits(t):
    """What hits cite and their dates as JSON texts, as they are stored."""
    return sinks.encoded(detectors.trade_vote_alignment(before(t, 14))).select("member_id", "citing_json", "dates_json")


@query(f"""SELECT member_id, n_trades, n_spouse, n_joint, intensity, citing, dates,
    CASE WHEN n_spouse > 0 AND n_joint > 0 THEN n_trades || ' household trade' || s || ' (' || n_spouse || ' spouse-held, ' || n_joint || ' jointly-held)'
      WHEN n_joint > 0 THEN n_trades || ' jointly-held trade' || s ELSE n_trades || ' spouse-held trade' || s END
      || ' placed within 14 days before a vote on a bill the member''s committee handled' || CASE WHEN n_same_day > 0 THEN '; ' || n_same_day || ' on the same day as the vote' ELSE '' END || '.' AS finding FROM (
    SELECT member_id, count(*) AS n_trades, CASE WHEN count(*) = 1 THEN '' ELSE 's' END AS s, count(*) FILTER (lower(holder) = 'spouse') AS n_spouse, count(*) FILTER (lower(holder) = 'joint') AS n_joint, count(*) FILTER (days_before_vote = 0) AS n_same_day,
      round(least(1.0, 0.5 + 0.3 * (1 - min(days_before_vote) / 14.0) + 0.2 * least(1.0, count(*) / 5.0)), 6)::DOUBLE AS intensity, {_cited("lower(holder) || ' ' || tx_type || ' ' || coalesce(ticker, asset) || ' (' || tx_date || ')'")} FROM (
      SELECT *, row_number() OVER (PARTITION BY member_id, filing_id, tx_date, tx_type, upper(coalesce(ticker, asset)) ORDER BY days_before_vote, vote_id) AS rn FROM before
      WHERE lower(holder) IN ('spouse', 'joint') AND member_on_bill_committee AND days_before_vote <= 14 AND upper(coalesce(ticker, '')) NOT IN ({_FUNDS})) r WHERE rn = 1 GROUP BY 1) g""")
def d02_household_trade_timing(t):
    found = _as_texts(detectors.household_trade_timing(before(t, 14)))
    return found.select("member_id", "n_trades", "n_spouse", "n_joint", F.round("intensity", 6).alias("intensity"), "citing", "dates", "finding")


@query("""SELECT d.member_id, d.theme, round(share, 6) AS share, n_bills, round(least(1.0, share + 0.1 * least(n_bills, 5)), 6)::DOUBLE AS intensity FROM (
    SELECT *, theme_total / sum(theme_total) OVER (PARTITION BY member_id) AS share, row_number() OVER (PARTITION BY member_id ORDER BY theme_total DESC, theme) AS rn FROM donor_theme) d
    JOIN (SELECT member_id, theme, count(DISTINCT bill_id) AS n_bills FROM sponsored_theme GROUP BY 1, 2) s ON s.member_id = d.member_id AND s.theme = d.theme
    WHERE rn <= 3 AND share >= 0.2 AND n_bills >= 3""")
def d03_donor_sector_alignment(t):
    found = detectors.donor_sector_alignment(donor_theme(t), sponsored_theme(t))
    return found.select("member_id", "theme", F.round("share", 6).alias("share"), "n_bills", F.round("intensity", 6).alias("intensity"))


@query(f"""SELECT c.district, c.theme, round(share, 6) AS share, round(median_share, 6) AS median_share, n_trades FROM (
    SELECT *, total / grand_total AS share, row_number() OVER (PARTITION BY district ORDER BY total DESC, theme) AS rn FROM {_TOTALS} x WHERE theme IS NOT NULL) c
    JOIN {_MEDIANS} m ON m.theme = c.theme JOIN (SELECT *, row_number() OVER (PARTITION BY district ORDER BY n_trades DESC, theme) AS trn FROM (
      SELECT tr.district, i.theme, sum(tr.n_trades)::BIGINT AS n_trades FROM traded tr JOIN instrument_theme i USING (ticker) GROUP BY 1, 2) g) t ON t.district = c.district AND t.theme = c.theme
    WHERE rn <= 3 AND share >= 0.2 AND share >= 1.5 * median_share AND trn <= 3 AND n_trades >= 3""")
def d04_contract_trade_alignment(t):
    totals = rollups.contract_theme_totals(t.contracts, t.prefixes)
    traded = t.traded.join(instruments(t), "ticker").groupBy("district", "theme").agg(F.sum("n_trades").alias("n_trades"))
    found = detectors.contract_trade_alignment(totals, rollups.median_shares(totals, t.contracts), traded)
    return found.select("district", "theme", F.round("share", 6).alias("share"), F.round("median_share", 6).alias("median_share"), "n_trades")


_DOLLARS = """(SELECT r.district, c.ticker, sum(r.amount) AS amount FROM recipients r JOIN confirms c USING (recipient_key) WHERE c.ticker NOT IN (
    SELECT c2.ticker FROM recipients r2 JOIN confirms c2 USING (recipient_key) GROUP BY 1 HAVING count(DISTINCT r2.district) * 3 > 25) GROUP BY 1, 2)"""


@query(f"SELECT count(*) AS s1, round(coalesce(sum(d.amount), 0), 2) AS s2 FROM {_DOLLARS} d JOIN traded t ON t.district = d.district AND t.ticker = d.ticker")
def d05_recipient_overlap(t):
    found = detectors.recipient_overlap(t.traded, detectors.recipient_dollars(t.confirms, t.recipients, 25))
    return found.select("s1", F.round("s2", 2).alias("s2"))


_FINDINGS = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY score DESC, days_before_vote, tx_date DESC, ticker NULLS LAST, asset) AS rn3 FROM (
    SELECT *, row_number() OVER (PARTITION BY member_id, tx_date ORDER BY score DESC, days_before_vote, ticker NULLS LAST, asset) AS rn2 FROM (
      SELECT *, {_SCORE.format(50)} AS score, row_number() OVER (PARTITION BY member_id, ticker, tx_date ORDER BY {_SCORE.format(50)} DESC, days_before_vote,
        CASE WHEN vote_question ILIKE 'On Ordering the Previous Question%' OR vote_question ILIKE 'On Motion to%' OR vote_question ILIKE 'H.Res.%' THEN 2 ELSE 1 END, vote_id, filing_id) AS rn
      FROM before WHERE days_before_vote <= 30) a WHERE rn = 1) b WHERE rn2 = 1) c WHERE rn3 <= 5)"""


@query(f"SELECT member_id, filing_id, vote_id, days_before_vote, score FROM {_FINDINGS} x")
def w07_best_findings(t):
    return detectors.best_findings(before(t, 30)).select("member_id", "filing_id", "vote_id", "days_before_vote", "score")


@query(f"""SELECT member_id, count(*) AS n, CASE WHEN bool_or(days_before_vote <= 3 AND member_on_bill_committee) OR count(*) FILTER (days_before_vote = 0) >= 3 THEN 'high'
    WHEN bool_or(days_before_vote <= 3) OR bool_or(member_on_bill_committee) THEN 'medium' ELSE 'low' END AS level FROM {_FINDINGS} x GROUP BY 1
    UNION ALL SELECT member_id, 0, 'none' FROM members WHERE member_id NOT IN (SELECT member_id FROM {_FINDINGS} y)""")
def d06_finding_level(t):
    return detectors.finding_level(detectors.best_findings(before(t, 30)), t.members)


_TITLES = r"CASE m.chamber WHEN 'senate' THEN 'Sen\.?|Senator' WHEN 'house' THEN 'Rep\.?|Congressman|Congresswoman' ELSE 'Sen\.?|Senator|Rep\.?|Congressman|Congresswoman' END"
_DIRECT = rf"""(SELECT r.*, m.member_id FROM lobby_roles r JOIN (SELECT *, 'Member' || member_id AS last, split_part(name, ' ', 1) AS first FROM lobby_members) m
    ON regexp_matches(r.role, '(?i)(' || {_TITLES} || ')\s+(?:' || m.last || '|' || m.first || '(?:\s+[A-Z][\w\.\-]*){{0,2}}\s+' || m.last || ')\b'))"""


@query(f"SELECT DISTINCT member_id, lobbyist_id, filing_id FROM {_DIRECT} d")
def j17_named_in_roles(t):
    return detectors.named_in_roles(t.lobby_roles, t.lobby_members).select("member_id", "lobbyist_id", "filing_id").distinct()


_KEYWORD = "(SELECT DISTINCT r.*, k.member_id FROM lobby_roles r JOIN lobby_keywords k ON r.role ILIKE '%cmte%' AND r.role ILIKE '%' || k.keyword || '%')"


@query(f"SELECT DISTINCT member_id, lobbyist_id, filing_id FROM {_KEYWORD} k")
def j18_keyword_roles(t):
    return detectors.keyword_roles(t.lobby_roles, t.lobby_keywords).select("member_id", "lobbyist_id", "filing_id").distinct()


@query(f"""SELECT member_id, lobbyist_id, connection, filing_id, filing_year, CASE WHEN 2024 - filing_year <= 1 THEN 'active' WHEN 2024 - filing_year <= 3 THEN 'recent' ELSE 'historical' END AS tier FROM (
    SELECT *, row_number() OVER (PARTITION BY member_id, lobbyist_id ORDER BY filing_year DESC, posted_at DESC NULLS LAST, filing_id) AS rn FROM (
      SELECT *, 'direct' AS connection FROM {_DIRECT} d UNION ALL SELECT *, 'committee' FROM {_KEYWORD} k
      WHERE NOT EXISTS (SELECT 1 FROM {_DIRECT} d2 WHERE d2.member_id = k.member_id AND d2.lobbyist_id = k.lobbyist_id)) u) r WHERE rn = 1""")
def d07_revolving_door(t):
    return detectors.revolving_door(t.lobby_roles, t.lobby_members, t.lobby_keywords, 2024)


_MASK = "4294967295::HUGEINT"


def _seed_sql(s: str) -> str:
    """FNV-1a of an ASCII expression as DuckDB SQL."""
    codes = f"list_transform(string_split({s}, ''), lambda c: ascii(c)::HUGEINT)"
    return f"list_reduce(list_prepend(2166136261::HUGEINT, {codes}), lambda h, c: (xor(h::BIGINT, c::BIGINT)::HUGEINT * 16777619) & {_MASK})"


def _with_draw(source: str, seed: str, k: str) -> str:
    """The rows of a source with draw k of a seed as u, as DuckDB SQL."""
    return f"""(SELECT * EXCLUDE (a, t1, t2), (xor(t2, t2 >> 14) & 4294967295) / 4294967296.0::DOUBLE AS u FROM (
        SELECT *, xor((t1 + ((xor(t1, t1 >> 7)::HUGEINT * (t1 | 61)::HUGEINT) & {_MASK})::BIGINT) & 4294967295, t1) AS t2 FROM (
        SELECT *, ((xor(a, a >> 15)::HUGEINT * (a | 1)::HUGEINT) & {_MASK})::BIGINT AS t1 FROM (
        SELECT *, (({seed} + ({k} + 1)::HUGEINT * 1831565813) & {_MASK})::BIGINT AS a FROM {source} s0) s1) s2) s3)"""


def _calendar_sql(trades: str, votes: str, n_perm: int, seed: str) -> str:
    """Drawn days (trades.*, perm, day) of trades (member_id, slot, n_trades, d) as DuckDB SQL; votes (member_id, d) widen the span."""
    pools = f"""(SELECT member_id, list_filter(list_transform(range(0, date_diff('day', min(d), max(d)) + 1), lambda i: min(d) + i::INT), lambda x: isodow(x) < 6) AS pool,
        any_value({_seed_sql(f"'{seed}:' || member_id")}) AS seed FROM (SELECT member_id, d FROM {trades} a UNION ALL SELECT member_id, d FROM {votes} b) c GROUP BY 1)"""
    rows = f"(SELECT t.*, p.pool, p.seed, perm FROM {trades} t JOIN {pools} p USING (member_id), (SELECT unnest(range({n_perm})) AS perm) n WHERE len(p.pool) > 0)"
    return f"(SELECT * EXCLUDE (pool, seed, u), pool[floor(u * len(pool))::INT + 1] AS day FROM {_with_draw(rows, 'seed', 'perm * n_trades + slot')} x)"


_THEMED = """(SELECT t.member_id, t.tx_date AS d, concat_ws('|', t.tx_date::VARCHAR, t.tx_type, upper(coalesce(t.ticker, t.asset))) AS trade_id, i.theme,
    row_number() OVER (PARTITION BY t.member_id ORDER BY t.tx_date, concat_ws('|', t.tx_date::VARCHAR, t.tx_type, upper(coalesce(t.ticker, t.asset))), t.filing_id) - 1 AS slot,
    count(*) OVER (PARTITION BY t.member_id) AS n_trades FROM trades t JOIN instrument_theme i ON i.ticker = upper(t.ticker))"""
_OBSERVED = "(SELECT member_id, concat_ws('|', tx_date::VARCHAR, tx_type, upper(ticker)) AS trade_id, min(days_before_vote) AS observed_gap FROM nexus GROUP BY 1, 2)"
#: p of members with fewer than 50 trades, whose dates are drawn.
_PAIR_P = f"""(SELECT member_id, trade_id, observed_gap, (1 + count(*) FILTER (hit)) / 101.0::DOUBLE AS p_pair FROM (
    SELECT c.member_id, c.trade_id, o.observed_gap, c.perm, bool_or(v.d IS NOT NULL) AS hit FROM {_calendar_sql('themed', "(SELECT member_id, vote_date AS d FROM eligible)", 100, 'theme-gap')} c
    JOIN {_OBSERVED} o ON o.member_id = c.member_id AND o.trade_id = c.trade_id
    LEFT JOIN (SELECT DISTINCT member_id, theme, vote_date AS d FROM eligible) v ON v.member_id = c.member_id AND v.theme = c.theme AND date_diff('day', c.day, v.d) BETWEEN 0 AND o.observed_gap
    WHERE c.n_trades < 50 GROUP BY 1, 2, 3, 4) h GROUP BY 1, 2, 3)"""


def _trade_id() -> Column:
    return F.concat_ws("|", F.col("tx_date").cast("string"), "tx_type", F.upper(detectors.instrument()))


def _theme_trades(t) -> DataFrame:
    rows = t.trades.join(instruments(t).select(F.col("ticker").alias("_of"), "theme"), F.upper("ticker") == F.col("_of")).select("member_id", "filing_id", "tx_date", "theme", _trade_id().alias("trade_id"))
    return rows.withColumn("slot", F.row_number().over(Window.partitionBy("member_id").orderBy("tx_date", "trade_id", "filing_id")) - 1)


def _receipts(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nexus rows, the trades that map to a theme, and p of each observed pair."""
    trades, votes = staged(_theme_trades(t), "theme-trades"), staged(eligible(t), "eligible")
    pairs = staged(nexus(t, votes).withColumn("trade_id", F.concat_ws("|", F.col("tx_date").cast("string"), "tx_type", F.upper("ticker"))), "nexus")
    gaps = pairs.groupBy("member_id", "trade_id").agg(F.min("days_before_vote").alias("observed_gap"))
    return pairs, trades, nullmodel.receipt_p_values(trades, votes, gaps, 100, "theme-gap")


@query(f"WITH themed AS MATERIALIZED (SELECT * FROM {_THEMED} x) SELECT member_id, trade_id, observed_gap, round(p_pair, 6) AS p_pair FROM {_PAIR_P} p")
def n06_pair_lower_tail(t):
    """The chance that a random date would come as near to a vote of the trade's theme."""
    return _receipts(t)[2].select("member_id", "trade_id", "observed_gap", F.round("p_pair", 6).alias("p_pair"))


@query(f"""WITH themed AS MATERIALIZED (SELECT * FROM {_THEMED} x) SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY CASE WHEN band = 'ranked' THEN coalesce(p_pair, 1) END NULLS FIRST, tx_date, trade_id, ticker, vote_id, theme) AS place FROM (
    SELECT n.member_id, n.trade_id, n.tx_date, n.ticker, n.vote_id, n.theme, n.days_before_vote, coalesce(c.n, 0) AS trade_count, CASE WHEN coalesce(c.n, 0) < 5 THEN 'insufficient-data' WHEN c.n < 10 THEN 'low-power' ELSE 'ranked' END AS band,
      CASE WHEN coalesce(c.n, 0) >= 5 THEN round(p.p_pair, 6) END AS p_pair FROM (SELECT *, concat_ws('|', tx_date::VARCHAR, tx_type, upper(ticker)) AS trade_id FROM nexus) n
    LEFT JOIN (SELECT member_id, count(*) AS n FROM themed GROUP BY 1) c USING (member_id) LEFT JOIN {_PAIR_P} p ON p.member_id = n.member_id AND p.trade_id = n.trade_id) r""", dates=("tx_date",))
def d08_receipts(t):
    pairs, trades, p = _receipts(t)
    found = detectors.theme_gap_receipts(pairs, trades, p.withColumn("p_pair", F.round("p_pair", 6)))
    return found.select("member_id", "trade_id", "tx_date", "ticker", "vote_id", "theme", "days_before_vote", "trade_count", "band", "p_pair", "place")


def _substrate(t) -> tuple[DataFrame, DataFrame]:
    """Trades and votes of the null models, both staged."""
    return nullmodel.near_substrate(t.trades, t.votes, t.members, t.bills, t.bill_committees, t.memberships)


@query(f"""SELECT member_id, vote_id, vote_date, bool_or(member_on_bill_committee) AS committee, coalesce(string_agg(DISTINCT CASE WHEN {_NAMED} THEN upper(ticker) END, ',' ORDER BY CASE WHEN {_NAMED} THEN upper(ticker) END), '') AS named
    FROM before GROUP BY 1, 2, 3""", dates=("vote_date",))
def n01_substrate_votes(t):
    _, votes = nullmodel.substrate(before(t))
    return votes.select("member_id", "vote_id", "vote_date", "committee", F.array_join("named", ",").alias("named"))


_TRADES = f"(SELECT DISTINCT member_id, filing_id, tx_date, tx_type, upper(coalesce(ticker, asset)) AS instrument FROM before WHERE upper(coalesce(ticker, '')) NOT IN ({_FUNDS}))"
_NVOTES = f"(SELECT DISTINCT member_id, vote_date, member_on_bill_committee AS committee, CASE WHEN {_NAMED} THEN upper(ticker) END AS named FROM before)"


_OBSERVED_NEXUS = f"""(SELECT t.member_id, count(*) AS n_trades, count(*) FILTER (EXISTS (SELECT 1 FROM {_NVOTES} v WHERE v.member_id = t.member_id
    AND date_diff('day', t.tx_date, v.vote_date) BETWEEN 0 AND 14 AND (v.committee OR v.named = t.instrument))) AS observed FROM {_TRADES} t GROUP BY 1)"""


@query(f"SELECT * FROM {_OBSERVED_NEXUS} o")
def n02_observed_nexus(t):
    return nullmodel.observed_nexus(*_substrate(t))


_SLOTTED = f"""WITH slotted AS MATERIALIZED (SELECT member_id, instrument, tx_date AS d, row_number() OVER (PARTITION BY member_id ORDER BY filing_id, tx_date, tx_type, instrument) - 1 AS slot,
    count(*) OVER (PARTITION BY member_id) AS n_trades FROM {_TRADES} t), nvotes AS MATERIALIZED (SELECT *, vote_date AS d FROM {_NVOTES} v) """


def _drawn_sql(n_perm: int, seed: str) -> str:
    return f"""(SELECT member_id, perm, count(*) FILTER (hit) AS drawn FROM (SELECT c.member_id, c.perm, c.slot, bool_or(v.d IS NOT NULL) AS hit FROM {_calendar_sql('slotted', 'nvotes', n_perm, seed)} c
        LEFT JOIN nvotes v ON v.member_id = c.member_id AND date_diff('day', c.day, v.d) BETWEEN 0 AND 14 AND (v.committee OR v.named = c.instrument) GROUP BY 1, 2, 3) h GROUP BY 1, 2)"""


@query(_SLOTTED + f"SELECT * FROM {_drawn_sql(50, 'calendar')} x")
def n03_calendar_null(t):
    return nullmodel.calendar_null(*_substrate(t), 50, "calendar")


def _shuffled_sql(trades: str, n_perm: int, seed: str, having: str = "true") -> str:
    """Rows (member_id, perm, arr) of members' days, in the order of their slots, shuffled swap by swap from the last place down; DuckDB SQL with a recursion over places.

    trades: member_id, slot, d. having: which members, by n.
    """
    members = f"(SELECT member_id, list(d ORDER BY slot) AS days, count(*) AS n, any_value({_seed_sql(f"'{seed}:' || member_id")}) AS seed FROM {trades} t0 GROUP BY 1 HAVING {having})"
    steps = f"(SELECT member_id, n, seed, perm, unnest(range(1, n)) AS i FROM {members} m0, (SELECT unnest(range({n_perm})) AS perm) p0)"
    swap = "list_transform(s.arr, lambda x, k: CASE WHEN k = s.i + 1 THEN s.arr[d.j + 1] WHEN k = d.j + 1 THEN s.arr[s.i + 1] ELSE x END)"
    return f"""(WITH RECURSIVE drawn AS MATERIALIZED (SELECT member_id, perm, i, floor(u * (i + 1))::BIGINT AS j FROM {_with_draw(steps, 'seed', 'perm * (n - 1) + (n - 1 - i)')} x),
      swapped AS (SELECT member_id, perm, n - 1 AS i, days AS arr FROM {members} m, (SELECT unnest(range({n_perm})) AS perm) p
        UNION ALL SELECT s.member_id, s.perm, s.i - 1, {swap} FROM swapped s JOIN drawn d ON d.member_id = s.member_id AND d.perm = s.perm AND d.i = s.i)
      SELECT member_id, perm, arr FROM swapped WHERE i = 0)"""


def _shuffle_drawn_sql(slotted: str, nvotes: str, n_perm: int, seed: str, having: str = "true") -> str:
    """(member_id, perm, drawn) of shuffled dates as DuckDB SQL."""
    moved = f"(SELECT x.member_id, x.perm, t.instrument, x.arr[t.slot + 1] AS day, t.slot FROM {_shuffled_sql(slotted, n_perm, seed, having)} x JOIN {slotted} t USING (member_id))"
    return f"""(SELECT member_id, perm, count(*) FILTER (hit) AS drawn FROM (SELECT c.member_id, c.perm, c.slot, bool_or(v.d IS NOT NULL) AS hit FROM {moved} c
        LEFT JOIN {nvotes} v ON v.member_id = c.member_id AND date_diff('day', c.day, v.d) BETWEEN 0 AND 14 AND (v.committee OR v.named = c.instrument) GROUP BY 1, 2, 3) h GROUP BY 1, 2)"""


@query(_SLOTTED + f"SELECT * FROM {_shuffle_drawn_sql('slotted', 'nvotes', 50, 'shuffle')} x")
def n04_shuffle_null(t):
    return nullmodel.shuffle_null(*_substrate(t), 50, "shuffle")


#: Members joined to so many that each has 50 trades or more.
_BUSY = "CAST(member_id % 25 AS BIGINT)"


@query(f"""WITH slotted AS MATERIALIZED (SELECT member_id, instrument, tx_date AS d, row_number() OVER (PARTITION BY member_id ORDER BY filing_id, tx_date, tx_type, instrument) - 1 AS slot FROM (SELECT * REPLACE ({_BUSY} AS member_id) FROM {_TRADES} t) b),
    nvotes AS MATERIALIZED (SELECT DISTINCT * REPLACE ({_BUSY} AS member_id), vote_date AS d FROM {_NVOTES} v),
    observed AS (SELECT t.member_id, count(*) AS n_trades, count(*) FILTER (EXISTS (SELECT 1 FROM nvotes v WHERE v.member_id = t.member_id AND date_diff('day', t.d, v.d) BETWEEN 0 AND 14 AND (v.committee OR v.named = t.instrument))) AS observed FROM slotted t GROUP BY 1)
    SELECT member_id, o.observed, count(*) AS n_perm, round(avg(drawn), 6) AS expected, round(stddev_pop(drawn), 6) AS sd, round(avg((drawn >= o.observed)::INT), 6) AS p_value
    FROM {_shuffle_drawn_sql('slotted', 'nvotes', 5, 'busy', 'count(*) >= 50')} d JOIN observed o USING (member_id) GROUP BY 1, 2""")
def n05_nexus_test_busy(t):
    """The test of members with 50 trades or more, whose own dates are shuffled: many members' trades and votes put together."""
    as_busy = lambda df: df.withColumn("member_id", F.expr(_BUSY))
    trades, votes = (as_busy(df) for df in _substrate(t))
    slot = F.row_number().over(Window.partitionBy("member_id").orderBy("filing_id", "tx_date", "tx_type", "instrument")) - 1
    trades = staged(trades.withColumn("slot", slot), "busy-trades")
    found = nullmodel.nexus_test(trades, votes, 5, "busy")
    many = trades.groupBy("member_id").count().where("count >= 50").select("member_id")
    rounded = (F.round("expected", 6).alias("expected"), F.round("sd", 6).alias("sd"), F.round("p_value", 6).alias("p_value"))
    return found.join(many, "member_id").select("member_id", "observed", "n_perm", *rounded)


@query(_SLOTTED + f"""SELECT member_id, o.observed, count(*) AS n_perm, round(avg(drawn), 6) AS expected, round(stddev_pop(drawn), 6) AS sd, round(avg((drawn >= o.observed)::INT), 6) AS p_value,
    round(CASE WHEN stddev_pop(drawn) = 0 THEN 0 ELSE (o.observed - avg(drawn)) / stddev_pop(drawn) END, 4) AS z_score FROM {_drawn_sql(100, 'nexus')} d JOIN {_OBSERVED_NEXUS} o USING (member_id) WHERE o.n_trades < 50 GROUP BY 1, 2""")
def n05_nexus_test(t):
    """The SQL has the members with fewer than 50 trades, whose dates are drawn; shuffles have none."""
    found = nullmodel.nexus_test(*_substrate(t), 100, "nexus")
    rounded = (F.round("expected", 6).alias("expected"), F.round("sd", 6).alias("sd"), F.round("p_value", 6).alias("p_value"), F.round("z_score", 4).alias("z_score"))
    return found.select("member_id", "observed", "n_perm", *rounded)


def _pair_scores(t) -> DataFrame:
    dollars = detectors.recipient_dollars(t.confirms, t.recipients, 25)
    traded = t.traded.select(F.col("district").alias("member_id"), "ticker").distinct()
    return dollars.join(traded, "ticker").groupBy("member_id", "district").agg(F.count("*").alias("hits"), F.sum("amount").alias("amount"))


_PAIR_SCORES = f"(SELECT t.district AS member_id, d.district, count(*) AS hits, sum(d.amount) AS amount FROM {_DOLLARS} d JOIN (SELECT DISTINCT district, ticker FROM traded) t ON t.ticker = d.ticker GROUP BY 1, 2)"


@query(f"""SELECT perm, coalesce(sum(hits), 0)::BIGINT AS s1, round(coalesce(sum(amount), 0), 2) AS s2 FROM (SELECT d.perm, d.entity, n.n_nationkey AS district FROM (
    SELECT *, row_number() OVER (PARTITION BY perm ORDER BY u, i) - 1 AS place FROM {_with_draw("(SELECT n_nationkey AS entity, i, perm FROM (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation) a, (SELECT unnest(range(200)) AS perm) b)", '7', 'perm * 25 + i')} x) d
    JOIN (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation) n ON n.i = d.place) p LEFT JOIN {_PAIR_SCORES} s ON s.member_id = p.entity AND s.district = p.district GROUP BY 1""")
def n07_pairing_null(t):
    found = nullmodel.pairing_null(_pair_scores(t), t.nation.select(F.col("n_nationkey").alias("entity")), 200, 7)
    return found.select("perm", "s1", F.round("s2", 2).alias("s2"))


def _scrambled_sql(source: str, by: str, columns: str, order: str, replicates: int, seed: str) -> str:
    """Rows of a source with columns permuted within its groups, by replicate, as DuckDB SQL. by and columns: comma-separated names, by perhaps empty."""
    part, key = (f"PARTITION BY {by}", f"{by}, ") if by else ("", "")
    text = f"'{seed}'" + "".join(f" || ':' || {c}" for c in by.split(", ") if c)
    placed = f"(SELECT *, row_number() OVER ({part} ORDER BY {order}) - 1 AS i, count(*) OVER ({part}) AS gn FROM {source} p0)"
    drawn = _with_draw(f"(SELECT p.*, {_seed_sql(text)} AS seed, replicate FROM {placed} p, (SELECT unnest(range({replicates})) AS replicate) r)", "seed", "replicate * gn + i")
    return f"""(SELECT x.* EXCLUDE ({columns}, i, gn, seed, u), {', '.join('y.' + c.strip() for c in columns.split(','))} FROM {drawn} x
        JOIN (SELECT {key}replicate, {columns}, row_number() OVER (PARTITION BY {key}replicate ORDER BY u, i) - 1 AS i FROM {drawn} z) y USING ({key}replicate, i))"""


@query(f"""WITH control AS MATERIALIZED (SELECT * FROM {_scrambled_sql('confirms', '', 'ticker', 'recipient_key', 20, 'confirms')} c)
    SELECT replicate, count(*) AS s1, round(sum(amount), 2) AS s2 FROM (SELECT c.replicate, r.district, c.ticker, sum(r.amount) AS amount FROM recipients r JOIN control c USING (recipient_key) GROUP BY 1, 2, 3) d
    JOIN (SELECT DISTINCT district, ticker FROM traded) t USING (district, ticker) GROUP BY 1""")
def n08_scrambled_confirms(t):
    """The overlap with ticker identities permuted among confirmed recipients, by replicate."""
    control = nullmodel.scrambled(t.confirms, [], ["ticker"], ["recipient_key"], 20, "confirms")
    dollars = t.recipients.join(control, "recipient_key").groupBy("replicate", "district", "ticker").agg(F.sum("amount").alias("amount"))
    both = dollars.join(t.traded.select("district", "ticker").distinct(), ["district", "ticker"])
    return both.groupBy("replicate").agg(F.count("*").alias("s1"), F.round(F.sum("amount"), 2).alias("s2"))


def _control(t, replicates: int) -> tuple[DataFrame, DataFrame]:
    """Trades and votes of each replicate, in which (committee, named tickers) are permuted among each member's votes; a replicate's member is a member of its own."""
    trades, votes = _substrate(t)
    control = staged(nullmodel.scrambled(votes, ["member_id"], ["committee", "named"], ["vote_date", "vote_id"], replicates, "votes"), "control")
    as_one = lambda df: df.withColumn("member_id", F.concat_ws(":", "replicate", "member_id")).drop("replicate")
    both = staged(as_one(trades.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))), "control-trades"), as_one(control)
    discard(trades, votes)
    return both


_VOTES_SQL = f"""(SELECT member_id, vote_id, vote_date, bool_or(member_on_bill_committee) AS committee, list_sort(list(DISTINCT CASE WHEN {_NAMED} THEN upper(ticker) END) FILTER ({_NAMED})) AS named FROM before GROUP BY 1, 2, 3)"""
_CONTROL_SQL = f"""WITH svotes AS MATERIALIZED (SELECT * FROM {_VOTES_SQL} v), control AS MATERIALIZED (SELECT * FROM {_scrambled_sql('svotes', 'member_id', 'committee, named', 'vote_date, vote_id', 3, 'votes')} c) """


@query(_CONTROL_SQL + f"""SELECT r.replicate || ':' || t.member_id AS member_id, count(*) AS n_trades, count(*) FILTER (EXISTS (SELECT 1 FROM control v WHERE v.member_id = t.member_id AND v.replicate = r.replicate
    AND date_diff('day', t.tx_date, v.vote_date) BETWEEN 0 AND 14 AND (v.committee OR list_contains(v.named, t.instrument)))) AS observed FROM {_TRADES} t, (SELECT unnest(range(3)) AS replicate) r GROUP BY 1""")
def n08_scrambled_votes(t):
    """The second control: vote attributes travel together to another vote of the member."""
    return nullmodel.observed_nexus(*_control(t, 3))


@query()
def n09_control_verdict(t):
    """How often controls, scored as the data are, come out as significant."""
    tests = nullmodel.nexus_test(*_control(t, 5), 40, "control")
    parts = F.split("member_id", ":")
    return nullmodel.control_verdict(tests.select(parts[1].alias("member_id"), parts[0].alias("replicate"), "p_value"))


@query(f"""SELECT c_custkey, ((t3 & {_MASK}) / 4294967296.0::DOUBLE)::DOUBLE AS drawn FROM (
    SELECT c_custkey, xor(t2, t2 >> 14) AS t3 FROM (SELECT c_custkey, xor((t1 + ((xor(t1, t1 >> 7) * (t1 >> 0 | 61)) & {_MASK})) & {_MASK}, t1) AS t2 FROM (
    SELECT c_custkey, ((xor(a, a >> 15)::HUGEINT * (a | 1)::HUGEINT) & {_MASK})::BIGINT::HUGEINT AS t1 FROM (
    SELECT c_custkey, ((12345 + (c_custkey + 1)::HUGEINT * 1831565813) & {_MASK})::BIGINT AS a FROM customer) x) y) z) w""".replace("(t1 >> 0 | 61)", "(t1 | 61)"))
def n10_seeded_draws(t):
    """Draw number c_custkey of the sequence of seed 12345."""
    return t.customer.select("c_custkey", rng.draw(F.lit(12345), F.col("c_custkey")).alias("drawn"))


_BINARY = """(SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY vote_date, vote_id) AS nth, count(*) OVER (PARTITION BY member_id) AS n,
    CASE position WHEN 'yea' THEN 1 ELSE 0 END AS actual FROM votes WHERE position IN ('yea', 'nay'))"""
_SPLIT = f"(SELECT *, nth <= floor(n * 0.7::DOUBLE) AS is_train FROM {_BINARY} b WHERE n >= 20 AND n - floor(n * 0.7::DOUBLE) >= 3)"
_PRED = f"""(SELECT member_id, u.ordinal, u.model, u.p FROM (SELECT o.*, list_zip_models AS l FROM (
    SELECT o.member_id, [
      {{'ordinal': 0, 'model': 'naive-half', 'p': 0.5::DOUBLE}}, {{'ordinal': 1, 'model': 'always-yes', 'p': 1.0::DOUBLE}}, {{'ordinal': 2, 'model': 'historical-rate', 'p': yeas / total::DOUBLE}},
      {{'ordinal': 3, 'model': 'laplace-smoothed', 'p': (yeas + 1) / (total + 2)::DOUBLE}},
      {{'ordinal': 4, 'model': 'party-class-rate', 'p': least(total / 50::DOUBLE, 1.0::DOUBLE) * (yeas / total::DOUBLE) + (1 - least(total / 50::DOUBLE, 1.0::DOUBLE)) * CASE WHEN pt > 0 THEN py / pt::DOUBLE ELSE 0.5::DOUBLE END}}
    ] AS list_zip_models FROM (SELECT member_id, sum(actual) AS yeas, count(*) AS total FROM {_SPLIT} s WHERE is_train GROUP BY 1) o
    JOIN (SELECT m.member_id, sum(coalesce(y, 0)) OVER (PARTITION BY party, chamber) - coalesce(y, 0) AS py, sum(coalesce(c, 0)) OVER (PARTITION BY party, chamber) - coalesce(c, 0) AS pt FROM members m
      LEFT JOIN (SELECT member_id, sum(actual) AS y, count(*) AS c FROM {_BINARY} b GROUP BY 1) v USING (member_id)) pe USING (member_id)) o) q, unnest(q.l) AS z(u))"""


@query(f"""SELECT s.member_id, p.model, count(*) AS sample_size, round(avg((p - actual) * (p - actual)), 4) AS brier_score,
    round(avg(CASE WHEN (CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) = actual THEN 1 ELSE 0 END), 4) AS accuracy, round(avg(actual), 4) AS actual_rate
    FROM {_SPLIT} s JOIN {_PRED} p ON p.member_id = s.member_id WHERE NOT is_train GROUP BY 1, 2""")
def f03_model_scores(t):
    return calibration.scored(t.votes, t.members).select("member_id", "model", "sample_size", "brier_score", "accuracy", "actual_rate")


@query(f"""SELECT p.model, least(floor(p * 10), 9)::INT AS bucket, round(avg(actual), 3) AS actual_rate, count(*) AS n FROM {_SPLIT} s JOIN {_PRED} p ON p.member_id = s.member_id WHERE NOT is_train GROUP BY 1, 2""")
def f04_calibration_buckets(t):
    return calibration.buckets(t.votes, t.members)


@query(f"""SELECT member_id, arg_min(model, (brier, ordinal)) AS best_model FROM (SELECT s.member_id, p.model, p.ordinal, round(avg((p - actual) * (p - actual)), 4) AS brier
    FROM {_SPLIT} s JOIN {_PRED} p ON p.member_id = s.member_id WHERE NOT is_train GROUP BY 1, 2, 3) x GROUP BY 1""")
def f05_best_model(t):
    return calibration.best_model(calibration.scored(t.votes, t.members))


@query("""SELECT member_id, binary_votes, CASE WHEN binary_votes < 20 THEN 'insufficient sample' ELSE 'test set too small' END AS warning FROM (
    SELECT member_id, count(*) FILTER (position IN ('yea', 'nay')) AS binary_votes FROM votes GROUP BY 1) x WHERE binary_votes < 20 OR binary_votes - floor(binary_votes * 0.7::DOUBLE) < 3""")
def f02_skipped_members(t):
    return calibration.skips(t.votes)


def _filers(t) -> DataFrame:
    return t.members.select(
        F.concat(F.lit("Hon. Jane "), F.substring_index("name", "#", -1), F.lit(" Jr")).alias("filer"), F.col("state").alias("state"), F.when(F.col("member_id") % 2 == 0, F.col("district")).alias("district")
    )


@query("""SELECT f.filer, f.state, f.district, CASE WHEN n > 1 AND n_same = 1 THEN same ELSE first END AS member_id,
    CASE WHEN n = 1 THEN 1.0 WHEN n > 1 AND n_same = 1 THEN 0.95 WHEN n > 1 THEN 0.7 END::DOUBLE AS confidence FROM (
    SELECT DISTINCT 'Hon. Jane ' || split_part(name, '#', 2) || ' Jr' AS filer, state, CASE WHEN member_id % 2 = 0 THEN district END AS district, split_part(name, '#', 2) AS last FROM members) f
    LEFT JOIN LATERAL (SELECT count(*) AS n, min(m.member_id) AS first, count(*) FILTER (m.district = f.district) AS n_same, min(m.member_id) FILTER (m.district = f.district) AS same
      FROM members m WHERE m.state = f.state AND contains(lower(m.name), lower(f.last))) c ON true""")
def er01_resolve_filers(t):
    return resolve.resolve_filers(_filers(t), t.members).select("filer", "state", "district", "member_id", "confidence")


def _people(t) -> DataFrame:
    n = F.col("c_custkey")
    return t.customer.select(
        n.alias("person_id"), F.concat(F.lit("Ann"), n % 20).alias("first"), F.concat(F.lit("Smith"), n % 30).alias("last"), F.when(n % 4 == 0, F.concat(F.lit("Nick"), n % 20)).alias("nickname"), F.col("c_name").alias("official")
    )


_ALIASES = r"""(SELECT DISTINCT array_to_string(list_filter(string_split_regex(regexp_replace(lower(form), '[.,''"]', ' ', 'g'), '\s+'), lambda x: length(x) > 1), ' ') AS alias, person_id FROM (
    SELECT c_custkey AS person_id, unnest([c_name, 'Ann' || (c_custkey % 20) || ' Smith' || (c_custkey % 30), 'Smith' || (c_custkey % 30) || ', Ann' || (c_custkey % 20),
      CASE WHEN c_custkey % 4 = 0 THEN 'Nick' || (c_custkey % 20) || ' Smith' || (c_custkey % 30) END, CASE WHEN c_custkey % 4 = 0 THEN 'Smith' || (c_custkey % 30) || ', Nick' || (c_custkey % 20) END]) AS form FROM customer) f
    WHERE form IS NOT NULL)"""


@query(f"SELECT alias, person_id FROM {_ALIASES} a")
def er03_aliases(t):
    return resolve.aliases(_people(t))


@query(f"""SELECT 'Ann' || k || ' Smith' || (k + 7) AS query, CASE WHEN count(a.person_id) = 1 THEN min(a.person_id) END AS person_id,
    CASE count(a.person_id) WHEN 0 THEN 'unresolved' WHEN 1 THEN 'ok' ELSE 'ambiguous' END AS status, count(a.person_id)::INT AS candidates
    FROM (SELECT n_nationkey AS k FROM nation) n LEFT JOIN {_ALIASES} a ON a.alias = 'ann' || k || ' smith' || (k + 7) GROUP BY 1""")
def er04_resolve_aliases(t):
    k = F.col("n_nationkey")
    asked = t.nation.select(F.concat(F.lit("Ann"), k, F.lit(" Smith"), k + 7).alias("query"), F.lit(None).cast("long").alias("known_id"))
    return resolve.resolve_aliases(asked, resolve.aliases(_people(t)))


@query("SELECT c_custkey AS person_id, CASE WHEN c_custkey % 5 = 0 THEN 'old-' || c_custkey ELSE trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') END AS slug FROM customer")
def er05_stable_slugs(t):
    people = t.customer.select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"))
    existing = people.where("person_id % 5 = 0").select("person_id", F.concat(F.lit("old-"), "person_id").alias("slug"))
    return resolve.stable_slugs(people, existing)


@query("""SELECT s_suppkey AS key, CASE WHEN s_suppkey % 2 = 0 THEN 'T' || (s_suppkey % 31) WHEN s_suppkey % 3 = 0 THEN 'T' || (s_suppkey % 29) END AS ticker,
    CASE WHEN s_suppkey % 2 = 0 THEN 'own-name' WHEN s_suppkey % 3 = 0 THEN 'parent-name' END AS basis FROM supplier""")
def er06_match_tickers(t):
    k = F.col("s_suppkey")
    names = t.supplier.select(
        k.alias("key"), F.when(k % 2 == 0, F.concat(F.lit("Firm"), k % 31, F.lit(" Systems, Inc."))).otherwise(F.lit("Nobody LLC")).alias("name"), F.when(k % 3 == 0, F.concat(F.lit("FIRM"), k % 29, F.lit(" Corp"))).alias("parent_name")
    )
    titles = t.supplier.select((k % 31).alias("n")).distinct().unionAll(t.supplier.select((k % 29).alias("n"))).distinct().select(F.concat(F.lit("Firm"), "n", F.lit(" Holdings")).alias("title"), F.concat(F.lit("t"), "n").alias("ticker"), F.col("n").alias("ordinal"))
    return resolve.match_tickers(names, titles).select("key", "ticker", "basis")


@query("SELECT key, CASE WHEN n = 1 THEN v END AS verdict, CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'conflict' END AS problem FROM (SELECT s_suppkey AS key, CASE s_suppkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS n, 'keep' AS v FROM supplier) x")
def er10_assemble_verdicts(t):
    work = t.supplier.select(F.col("s_suppkey").alias("key"))
    said = work.where("key % 4 > 0").select("key", F.lit("keep").alias("verdict")).unionAll(work.where("key % 4 = 1").select("key", F.lit("reject").alias("verdict")))
    return resolve.assemble_verdicts(work, said)


@query("""SELECT DISTINCT member_id, name FROM (SELECT CASE WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS member_id, c_mktsegment AS name FROM customer) x""")
def er12_fold_aliases(t):
    rows = t.customer.select(F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("name"))
    folded = t.customer.where("c_custkey % 10 = 1").select(F.col("c_custkey").alias("alias_id"), (F.col("c_custkey") - 1).alias("main_id"))
    return resolve.fold_aliases(rows, folded, "member_id")


def _rules() -> list:
    return [
        quality.rule("tx_date", "critical", "date in the future", F.col("tx_date") > F.lit("2001-01-01").cast("date")),
        quality.rule("ticker", "warning", "missing", F.col("ticker").isNull()),
        quality.rule("match_confidence", "warning", "low confidence", F.col("match_confidence") < 0.9),
    ]


_PROFILE = """(SELECT c_custkey AS id, c_comment_like AS bio, state, in_office, bill_date, bill_confidence, vote_date, vote_confidence FROM (
    SELECT c_custkey, repeat('x', CAST(c_custkey % 100 AS INT)) AS c_comment_like, CASE c_custkey % 4 WHEN 0 THEN 'ca' WHEN 1 THEN 'ZZ' WHEN 2 THEN NULL ELSE 'US' END AS state,
      CASE c_custkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN '"true"' END AS in_office, CASE WHEN c_custkey % 7 < 5 THEN CAST('2024-01-0' || (1 + c_custkey % 7) AS DATE) END AS bill_date,
      CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 5 * 0.2 END AS bill_confidence, CASE WHEN c_custkey % 7 < 3 THEN CAST('2024-01-0' || (2 + c_custkey % 6) AS DATE) END AS vote_date, 0.6 AS vote_confidence FROM customer) x)"""


@query(f"""SELECT id, 'data.bio' AS field, 'critical' AS severity, 'Bio too short: ' || length(bio) || ' chars (min 50)' AS message FROM {_PROFILE} p WHERE length(bio) < 50
    UNION ALL SELECT id, 'data.state', 'warning', 'Unrecognized state code: ' || state FROM {_PROFILE} p WHERE state = 'ZZ'
    UNION ALL SELECT id, 'data', 'info', 'bills, votes, and donors are all empty' FROM {_PROFILE} p WHERE bill_date IS NULL AND vote_date IS NULL
    UNION ALL SELECT id, 'data.bills[B' || id || '].introducedAt', 'critical', 'Future date: ' || bill_date FROM {_PROFILE} p WHERE bill_date > DATE '2024-01-03'
    UNION ALL SELECT id, 'data.votes[V' || id || '].date', 'critical', 'Future date: ' || vote_date FROM {_PROFILE} p WHERE vote_date > DATE '2024-01-03'
    UNION ALL SELECT id, 'data', 'warning', 'Low confidence (' || bill_confidence::DOUBLE || ') on: B' || id FROM {_PROFILE} p WHERE bill_date IS NOT NULL AND bill_confidence < 0.6
    UNION ALL SELECT id, 'data.inOffice', 'critical', 'inOffice must be boolean, got ' || CASE WHEN in_office IS NULL THEN 'undefined' ELSE 'string' END FROM {_PROFILE} p WHERE in_office IS DISTINCT FROM 'true'""")
def dq1_issues(t):
    t.customer.createOrReplaceTempView("customer_of_profiles")
    p = t.spark.sql(f"SELECT * FROM {_PROFILE.replace('FROM customer', 'FROM customer_of_profiles')}")
    item = lambda name, title, date, confidence: F.when(F.col(date).isNotNull(), F.array(F.struct(F.concat(F.lit(title), "id").alias("title"), F.col(date).alias("date"), F.col(confidence).cast("double").alias("confidence")))).alias(name)
    nobody = F.array().cast("array<struct<title: string, confidence: double>>").alias("donors")
    profiles = p.select("id", "bio", "state", F.col("in_office"), item("bills", "B", "bill_date", "bill_confidence"), item("votes", "V", "vote_date", "vote_confidence"), nobody)
    return quality.profile_issues(profiles, "id", F.lit("2024-01-03").cast("date"))


@query("""SELECT filing_id, round(greatest(0, 1 - CASE WHEN tx_date > DATE '2001-01-01' THEN 0.3 ELSE 0 END - CASE WHEN ticker IS NULL THEN 0.1 ELSE 0 END - CASE WHEN match_confidence < 0.9 THEN 0.1 ELSE 0 END), 4)::DOUBLE AS score,
    NOT tx_date > DATE '2001-01-01' AS passed FROM trades""")
def dq2_scores(t):
    found = quality.quality_scores(t.trades, quality.issues(t.trades, "filing_id", _rules()), "filing_id")
    return found.select("filing_id", F.round("score", 4).alias("score"), "passed")


@query("SELECT vote_id, CASE position WHEN 'yea' THEN 'Yes' WHEN 'nay' THEN 'No' ELSE position END AS position, CASE WHEN position IN ('yea', 'nay') THEN 1 ELSE 0 END AS corrections FROM votes")
def dq3_corrections(t):
    found = quality.corrected(t.votes.select("vote_id", "position"), {"position": {"yea": "Yes", "nay": "No"}})
    return found.select("vote_id", "position", F.size("corrections").alias("corrections"))


@query("SELECT event_type, count(*) AS n, avg(CASE WHEN json_extract_string(props, '$.k') IS NOT NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate FROM events GROUP BY 1")
def dq4_conformance(t):
    rates, _ = quality.conformance(t.events, "props", "event_type", {"k": "long"})
    return rates


@query("""WITH good AS (SELECT * FROM part WHERE p_size <> 7) SELECT '$.name' AS path, count(*) AS docs, 'string' AS types, 0 AS numeric_strings FROM good UNION ALL SELECT '$.size.n', count(*), 'number', 0 FROM good
    UNION ALL SELECT '$.tags[]', count(*), 'string', 0 FROM good UNION ALL SELECT '$.code', count(*), CASE WHEN count(*) FILTER (p_size % 3 = 1) > 0 THEN 'number,string' ELSE 'string' END, count(*) FILTER (p_size % 3 = 0) FROM good WHERE p_size % 3 < 2
    UNION ALL SELECT '!', count(*), 'invalid', 0 FROM part WHERE p_size = 7 HAVING count(*) > 0""")
def dq5_shape_profile(t):
    """Documents of three nested shapes made from parts; those of size 7 aren't JSON."""
    nested = [F.col("p_name").alias("name"), F.struct(F.col("p_size").alias("n")).alias("size"), F.split("p_name", " ").alias("tags")]
    shape = F.when(F.col("p_size") == 7, "{broken").when(F.col("p_size") % 3 == 0, F.to_json(F.struct(*nested, F.col("p_size").cast("string").alias("code"))))
    doc = shape.when(F.col("p_size") % 3 == 1, F.to_json(F.struct(*nested, F.col("p_size").alias("code")))).otherwise(F.to_json(F.struct(*nested)))
    return quality.shape_profile(t.part.select("p_partkey", doc.alias("doc")), "p_partkey", "doc").select("path", "docs", "types", "numeric_strings")


_TERMS = ["the", "que", "of the", "stupid", "al-", "radical"]


@query(r"""SELECT doc_id, term FROM documents, (VALUES ('the', '\bthe\b'), ('que', '\bque\b'), ('of the', 'of the'), ('stupid', '\bstupid\b'), ('al-', 'al-'), ('radical', '\bradical\b')) AS b(term, pattern) WHERE regexp_matches(lower(text), pattern)""")
def dq6_banned_terms(t):
    return quality.banned_terms(t.documents, "doc_id", "text", _TERMS)


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '(?i)of the', 'of a', 'g'), '(?i)tion', 'sion', 'g')) AS digest FROM documents")
def dq7_replaced_phrases(t):
    return t.documents.select("doc_id", F.md5(quality.replace_phrases(F.col("text"), [("of the", "of a"), ("tion", "sion")])).alias("digest"))


@query("SELECT p_partkey, CASE WHEN NOT (p_size > 5) THEN 'rejected' WHEN (CASE WHEN p_retailprice > 950 THEN 0 ELSE 1 END) + (CASE WHEN p_brand = 'Brand#2' THEN 0 ELSE 1 END) + (CASE WHEN p_type = 'SMALL' THEN 0 ELSE 1 END) >= 3 THEN 'approved_with_warnings' ELSE 'approved' END AS verdict FROM part")
def dq9_release_verdict(t):
    checks = [F.col("p_retailprice") > 950, F.col("p_brand") == "Brand#2", F.col("p_type") == "SMALL"]
    return t.part.select("p_partkey", quality.release_verdict(checks, [F.col("p_size") > 5]).alias("verdict"))


@query("""SELECT industry AS item, 'several themes' AS problem FROM industry_theme GROUP BY 1 HAVING count(DISTINCT theme) > 1 UNION ALL SELECT DISTINCT industry, 'unknown theme' FROM industry_theme WHERE theme NOT IN (SELECT theme FROM sic_theme)
    UNION ALL SELECT prefix, 'prefix stands ' || count(*) || ' times' FROM (SELECT prefix FROM prefixes UNION ALL SELECT DISTINCT substr(code, 1, 2) FROM contracts) p GROUP BY 1 HAVING count(*) > 1""")
def dq10_crosswalk_conflicts(t):
    found = quality.crosswalk_conflicts(themes.industry_themes(t.donor_industry, t.industry_patterns), "industry", "theme", t.sic_theme).toDF("item", "problem")
    added = t.prefixes.select("prefix").unionAll(t.contracts.select(F.substring("code", 1, 2)).distinct())
    twice = quality.repeated_prefixes(added).select("prefix", F.concat(F.lit("prefix stands "), "n", F.lit(" times")))
    return found.unionAll(twice)


@query("""SELECT avg(CASE WHEN v.bill_id IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS left_null_share, count(DISTINCT v.bill_id) AS left_keys, (SELECT avg(CASE WHEN bill_id IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE FROM sponsors) AS right_null_share,
    (SELECT count(DISTINCT bill_id) FROM sponsors) AS right_keys, (SELECT count(*) FROM (SELECT DISTINCT bill_id FROM votes WHERE bill_id IN (SELECT bill_id FROM sponsors)) x) AS shared_keys FROM votes v""")
def dq12_key_overlap(t):
    return quality.key_overlap(t.votes, t.sponsors, "bill_id", "bill_id")


@query("SELECT bill_id, count(*) AS n FROM votes GROUP BY 1 ORDER BY n DESC, bill_id NULLS LAST LIMIT 10")
def dq12_top_keys(t):
    return quality.top_keys(t.votes, "bill_id")


@query(r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\x0b\f\r]+', ' ', 'g'))) AS digest FROM pages""")
def fn_strip_html(t):
    return t.pages.select("page_id", F.md5(text.strip_html(F.col("html"))).alias("digest"))


@query(r"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(upper(coalesce('Dr. ' || c_name || ', Jr.', '')), '\b(JR|SR|II|III|IV|ESQ|PHD|MD)\b\.?', '', 'g'), '[.,]', ' ', 'g'), '\s+', ' ', 'g')) AS donor,
    trim(regexp_replace(regexp_replace(lower(c_name), '[''"]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
    CASE WHEN NOT isfinite(c_acctbal) THEN '$' WHEN floor(c_acctbal + 0.5) >= 1000000 THEN 'M' WHEN floor(c_acctbal + 0.5) >= 1000 THEN 'K' ELSE '$' END AS money FROM customer""")
def fn_names(t):
    label = text.money_label(F.col("c_acctbal"))
    money = F.when(label.endswith("M"), "M").when(label.endswith("K"), "K").otherwise("$")
    return t.customer.select("c_custkey", text.donor_canonical(F.concat(F.lit("Dr. "), "c_name", F.lit(", Jr."))).alias("donor"), text.slug(F.col("c_name")).alias("slug"), money.alias("money"))


@query("""SELECT p_partkey, 'hr-' || p_partkey AS bill, '118/' || CASE WHEN p_partkey % 2 = 0 THEN 'hr' ELSE 's' END || '/' || p_partkey AS from_url, '118-2024/h' || p_partkey AS vote_id, 118 AS congress FROM part""")
def fn_identifiers(t):
    k = F.col("p_partkey")
    url = F.concat(F.lit("https://example.org/bill/118th-congress/"), F.when(k % 2 == 0, "house-bill").otherwise("senate-bill"), F.lit("/"), k)
    vote = F.concat(F.lit("https://example.org/congress/votes/118-2024/h"), k)
    return t.part.select(
        "p_partkey", text.bill_reference(F.concat(F.lit("On Passage: H. R. "), k, F.lit(" as amended"))).alias("bill"), text.bill_id_from_url(url).alias("from_url"), text.vote_id_from_url(vote).alias("vote_id"), text.congress_from_url(vote).alias("congress")
    )


@query("""SELECT filing_id, lobbyist, array_to_string(list_distinct_first, ' / ') AS issues, position, entities FROM (
    SELECT f.filing_id, f.lobbyist, (SELECT list(issue ORDER BY first_at) FROM (SELECT issue, min(event_id) AS first_at FROM filings g WHERE g.filing_id = f.filing_id AND g.lobbyist = f.lobbyist GROUP BY issue) u) AS list_distinct_first,
      arg_min(CASE WHEN upper(trim(position)) NOT IN ('', 'N/A') THEN position END, CASE WHEN upper(trim(position)) NOT IN ('', 'N/A') THEN event_id END) AS position,
      (SELECT string_agg(DISTINCT entity, '; ' ORDER BY entity) FROM filings g WHERE g.filing_id = f.filing_id) AS entities FROM filings f GROUP BY 1, 2) x""")
def l10_lobbyists(t):
    activity = F.struct(
        F.col("event_id").alias("order"), F.col("issue"), F.array(F.struct(F.col("lobbyist").cast("string").alias("lobbyist_id"), F.lit("name").alias("name"), F.col("position"))).alias("lobbyists"), F.array("entity").alias("entities")
    )
    nested = t.filings.groupBy("filing_id").agg(F.array_sort(F.collect_list(activity)).alias("activities"))
    return flatten.lobbyists(nested).select("filing_id", F.col("lobbyist_id").cast("int").alias("lobbyist"), "issues", "position", "entities")


_DONOR = "CASE amount % 8 WHEN 0 THEN 'WinRed Technical Services' WHEN 1 THEN committee || ' Victory Fund' WHEN 2 THEN 'X ACTBLUE EMPLOYEE' WHEN 3 THEN 'ANEDOT' WHEN 4 THEN 'ActBlue' WHEN 5 THEN 'actbluecivics' ELSE committee END"


@query(rf"""SELECT member_id, donor, amount, n FROM (SELECT member_id, upper(name) AS donor, sum(amount)::BIGINT AS amount, count(DISTINCT cycle) AS n, row_number() OVER (PARTITION BY member_id ORDER BY sum(amount) DESC, upper(name)) AS rn
    FROM (SELECT *, {_DONOR} AS name FROM spending) d WHERE amount > 0 AND NOT regexp_matches(name, '(?i)^WINRED\b') AND NOT regexp_matches(name, '(?i)^ACTBLUE\b') AND NOT regexp_matches(name, '(?i)\bVICTORY\b') GROUP BY 1, 2) r WHERE rn <= 6""")
def l13_donor_rollup(t):
    """Conduits, their look-alikes and donors proper."""
    receipts = t.spending.select("member_id", F.expr(_DONOR).alias("name"), "amount", "cycle", F.lit("pac").alias("donor_type"), F.lit(None).cast("date").alias("date"))
    return flatten.donor_rollup(receipts, 6).select("member_id", "donor", "amount", F.size("cycles").cast("long").alias("n"))


@query("""SELECT member_id, cycle, committee, side, sum(amount)::BIGINT AS amount, count(*) AS n, (sum(sum(amount)) OVER (PARTITION BY member_id, cycle, side))::BIGINT AS side_total FROM spending GROUP BY 1, 2, 3, 4""")
def l14_spending_aggregate(t):
    return flatten.spending_aggregate(t.spending)


_FUNDER = "CASE member_id WHEN 3 THEN ' ActBlue ' WHEN 4 THEN 'winred' WHEN 6 THEN 'ACTBLUE PAC' ELSE 'F' || member_id END"
_MEMO = "CASE member_id % 5 WHEN 0 THEN 'See: EARMARKED through this organization' WHEN 1 THEN 'Attribution to earmark conduit' END"


@query(f"""SELECT committee, name, amount FROM (SELECT committee, {_FUNDER} AS name, sum(amount)::BIGINT AS amount, row_number() OVER (PARTITION BY committee ORDER BY sum(amount) DESC, {_FUNDER}) AS rn
    FROM spending WHERE member_id NOT IN (3, 4) AND member_id % 5 <> 0 GROUP BY 1, 2) r WHERE rn <= 9""")
def l15_top_funders(t):
    """Names that pass money on, in any case, look-alikes of them, memos that say so and others that speak of earmarks."""
    funders = t.spending.select("committee", F.expr(_FUNDER).alias("name"), F.expr(_MEMO).alias("memo"), "amount")
    return flatten.top_funders(funders, k=9)


@query("SELECT p_partkey AS bill_id, subject, policy_area FROM (SELECT p_partkey, unnest(CASE WHEN p_partkey % 3 = 0 THEN [p_type] ELSE string_split(p_name, ' ') END) AS subject, p_type AS policy_area FROM part) x")
def l17_subjects_or_area(t):
    subjects = F.when(F.col("p_partkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return flatten.subjects_or_area(t.part.select(F.col("p_partkey").alias("bill_id"), subjects.alias("subjects"), F.col("p_type").alias("policy_area")))


@query("SELECT member_id, kind, n FROM (SELECT member_id, tx_type AS kind, count(*) AS n, row_number() OVER (PARTITION BY member_id ORDER BY count(*) DESC, tx_type) AS rn FROM trades GROUP BY 1, 2) r WHERE rn <= 1")
def w12_busiest_kind(t):
    return quality.busiest(t.trades.withColumn("kind", F.col("tx_type")), ["member_id"], "kind", 1)


@query(f"""SELECT member_id, kind, n, array_to_string(labels[1:8], '|') AS labels, greatest(n - 8, 0) AS more FROM (
    SELECT member_id, 'trade' AS kind, count(*) AS n, list(tx_type || ' ' || coalesce(ticker, asset) || ' (' || tx_date || ')' ORDER BY tx_type || ' ' || coalesce(ticker, asset) || ' (' || tx_date || ')') AS labels FROM {_ALIGNED} x GROUP BY 1) g""")
def a22_evidence_groups(t):
    found = rollups.evidence_groups(detectors.trade_vote_alignment(before(t, 14))).where("kind = 'trade'")
    return found.select("member_id", "kind", (F.size("labels") + F.col("more")).cast("long").alias("n"), F.array_join("labels", "|").alias("labels"), "more")


_HIT = "least(1.0, max(score) / 100.0)::DOUBLE"


@query(f"""SELECT member_id, pattern, intensity, z_score, detected_at FROM (
    SELECT member_id, pattern, intensity, detected_at, CASE WHEN n_trades > 1 THEN round((n_trades - avg(n_trades) OVER (PARTITION BY pattern)) / nullif(stddev_pop(n_trades) OVER (PARTITION BY pattern), 0), 6) END AS z_score FROM (
      SELECT member_id, 'trade-vote-alignment' AS pattern, {_HIT} AS intensity, count(*) AS n_trades, max(vote_date) AS detected_at FROM {_ALIGNED} x GROUP BY 1
      UNION ALL SELECT member_id, 'spousal-trade-timing', round(least(1.0, 0.5 + 0.3 * (1 - min(days_before_vote) / 14.0) + 0.2 * least(1.0, count(*) / 5.0)), 6)::DOUBLE, count(*), max(vote_date) FROM (
        SELECT *, row_number() OVER (PARTITION BY member_id, filing_id, tx_date, tx_type, upper(coalesce(ticker, asset)) ORDER BY days_before_vote, vote_id) AS rn FROM before
        WHERE lower(holder) IN ('spouse', 'joint') AND member_on_bill_committee AND days_before_vote <= 14 AND upper(coalesce(ticker, '')) NOT IN ({_FUNDS})) r WHERE rn = 1 GROUP BY 1) h) z
    ORDER BY z_score DESC NULLS LAST, intensity DESC, detected_at DESC, pattern, member_id LIMIT 12""", dates=("detected_at",))
def w11_strongest_flags(t):
    """Hits of two patterns; z is how far a member's number of trades stands out among the pattern's, unknown for one trade."""
    rows = staged(detectors.related(before(t, 14)), "related")
    hits = [detectors.trade_vote_alignment(rows), detectors.household_trade_timing(rows).withColumn("intensity", F.round("intensity", 6))]
    both = reduce(DataFrame.unionByName, (h.select("member_id", "pattern", "intensity", "n_trades", "detected_at") for h in hits))
    scored = detectors.with_z_scores(staged(both, "hits"))
    return detectors.strongest_flags(scored, 12).select("member_id", "pattern", "intensity", "z_score", "detected_at")
