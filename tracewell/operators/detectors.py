"""Detectors: rules that find patterns and cite the rows behind each finding. All members in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.text import recency_tier, surname

from .ordering import first_rows, top_rows
from .resolve import containing

#: Funds that follow the whole market, by ticker.
MARKET_FUNDS = (
    "SPY", "QQQ", "VOO", "VTI", "IVV", "DIA", "IWM", "VEA", "VWO", "BND", "AGG", "VUG", "VTV", "VIG", "VYM", "VXUS", "VEU", "VO", "VB", "SCHB",
    "SCHD", "SCHX", "SCHF", "SCHA", "ITOT", "IJR", "IJH", "EFA", "EEM", "TLT", "IEF", "SHY", "LQD", "HYG", "GLD", "SLV", "XLF", "XLK", "XLE",
    "XLV", "XLI", "XLP", "XLY", "XLU", "XLB", "XLRE", "RSP", "MDY", "SDY",
)
#: Tickers that are words of the language.
WORD_TICKERS = (
    "NOW", "ALL", "IT", "ON", "A", "AN", "ARE", "BE", "BY", "FOR", "GO", "OR", "SO", "TO", "UP", "US", "WE", "AT", "DO", "IS", "IN", "OF", "AS", "NO",
    "ONE", "OUT", "ANY", "KEY", "MAIN", "WELL", "OPEN", "REAL", "FREE", "SAFE", "CARE", "LOVE", "LIFE", "PLAY", "HOPE", "NICE", "GOOD", "TRUE", "FUN",
)
WINDOW_DAYS = 14
#: How the titles of each chamber's members end, in lower case.
SENATE_TITLES, HOUSE_TITLES = r"sen\.?|senator", r"rep\.?|congressman|congresswoman"
#: The sentences of findings.
PLACED = "placed within 14 days before a vote on"
ON_COMMITTEE = "%d where the member sat on a committee that handled the bill"
NAMES_COMPANY = "%d where the bill text names the traded company"
SAME_DAY = "%d on the same day as the vote"


def no_market_fund(ticker: str = "ticker") -> Column:
    return ~F.upper(F.coalesce(ticker, F.lit(""))).isin(*MARKET_FUNDS)


def no_word(ticker: str = "ticker") -> Column:
    return ~F.upper(F.coalesce(ticker, F.lit(""))).isin(*WORD_TICKERS)


def instrument() -> Column:
    return F.coalesce("ticker", "asset")


def trade_key() -> list[Column]:
    """A trade is a filing, date, kind and instrument, the latter in upper case."""
    return [F.col("filing_id"), F.col("tx_date"), F.col("tx_type"), F.upper(instrument())]


def base_score(other: int = 60) -> Column:
    days, on = F.col("days_before_vote"), F.col("member_on_bill_committee")
    return F.when((days == 0) & on, 100).when(days == 0, 90).when((days <= 3) & on, 85).when(days <= 3, 80).when(on, 70).otherwise(other)


def _hits(trades: DataFrame, pattern: str, said: tuple = (), **aggregates: Column) -> DataFrame:
    """One row per member: the aggregates, cited trades and votes, dates in order. said: what a trade's label says before its date."""
    cite = lambda kind, i, label: F.struct(F.lit(kind).alias("kind"), F.col(i).cast("string").alias("id"), label.alias("label"))
    trade = cite("trade", "filing_id", F.concat_ws(" ", *(said or ("tx_type", instrument())), F.concat(F.lit("("), "tx_date", F.lit(")"))))
    vote = cite("vote", "vote_id", F.concat(F.lit("Vote "), "vote_date", F.lit(": "), F.coalesce("bill_title", "vote_question")))
    return trades.groupBy("member_id").agg(
        *(c.alias(name) for name, c in aggregates.items()),
        F.concat(F.array_sort(F.collect_list(trade)), F.array_sort(F.collect_set(vote))).alias("citing"),
        F.array_sort(F.array_union(F.collect_set("tx_date"), F.collect_set("vote_date"))).alias("dates"),
        F.greatest(F.max("tx_date"), F.max("vote_date")).alias("detected_at"),
    ).withColumn("pattern", F.lit(pattern))


def aligned_trades(before: DataFrame) -> DataFrame:
    """Each trade shortly before a vote on a bill its member's committee handled, or that names it, with its best vote.

    Ties between votes go to fewer days, then to the smaller vote id.
    """
    named = F.col("bill_mentions_ticker") & no_word()
    rows = before.where((F.col("days_before_vote") <= WINDOW_DAYS) & no_market_fund() & (F.col("member_on_bill_committee") | named)).withColumn("ticker_named", named)
    scored = rows.withColumn("score", base_score() + F.col("ticker_named").cast("int") * 5)
    best = Window.partitionBy("member_id", *trade_key()).orderBy(F.col("score").desc(), "days_before_vote", "vote_id")
    return scored.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")


def related(before: DataFrame) -> DataFrame:
    """The rows that the detectors of trades shortly before a vote read: few, so that several detectors can share them staged."""
    rows = before.where((F.col("days_before_vote") <= WINDOW_DAYS) & no_market_fund() & (F.col("member_on_bill_committee") | F.col("bill_mentions_ticker")))
    trade, vote = ("member_id", "filing_id", "tx_date", "tx_type", "ticker", "asset", "holder"), ("vote_id", "vote_date", "vote_question", "bill_title")
    return rows.select(*trade, *vote, "days_before_vote", "member_on_bill_committee", "bill_mentions_ticker")


def trade_vote_alignment(before: DataFrame) -> DataFrame:
    """Hits of trades within 14 days before a related vote."""
    on = F.col("member_on_bill_committee")
    found = _hits(
        aligned_trades(before),
        "trade-vote-alignment",
        n_trades=F.count("*"),
        n_committee=F.count_if(on),
        n_named=F.count_if(~on & F.col("ticker_named")),
        n_same_day=F.count_if(F.col("days_before_vote") == 0),
        intensity=F.least(F.lit(1.0), F.max("score") / 100),
    )
    plural = F.when(F.col("n_trades") == 1, "").otherwise("s")
    parts = F.array_compact(
        F.array(
            F.format_string(f"%d trade%s {PLACED} a related bill", "n_trades", plural),
            F.when(F.col("n_committee") > 0, F.format_string(ON_COMMITTEE, "n_committee")),
            F.when(F.col("n_named") > 0, F.format_string(NAMES_COMPANY, "n_named")),
            F.when(F.col("n_same_day") > 0, F.format_string(SAME_DAY, "n_same_day")),
        )
    )
    return found.withColumn("finding", F.concat(F.array_join(parts, "; "), F.lit(".")))


def household_trade_timing(before: DataFrame) -> DataFrame:
    """Hits of a spouse's or joint trades within 14 days before a vote of the member's committee."""
    holder = F.lower("holder")
    rows = before.where(holder.isin("spouse", "joint") & F.col("member_on_bill_committee") & (F.col("days_before_vote") <= WINDOW_DAYS) & no_market_fund())
    best = Window.partitionBy("member_id", *trade_key()).orderBy("days_before_vote", "vote_id")
    trades = rows.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")
    found = _hits(
        trades,
        "spousal-trade-timing",
        said=(holder, "tx_type", instrument()),
        n_trades=F.count("*"),
        n_spouse=F.count_if(holder == "spouse"),
        n_joint=F.count_if(holder == "joint"),
        n_same_day=F.count_if(F.col("days_before_vote") == 0),
        tightest=F.min("days_before_vote"),
    )
    closeness, volume = 1 - F.col("tightest") / WINDOW_DAYS, F.least(F.lit(1.0), F.col("n_trades") / 5)
    plural = F.when(F.col("n_trades") == 1, "").otherwise("s")
    both, joint = (F.col("n_spouse") > 0) & (F.col("n_joint") > 0), F.col("n_joint") > 0
    subject = (
        F.when(both, F.format_string("%d household trade%s (%d spouse-held, %d jointly-held)", "n_trades", plural, "n_spouse", "n_joint"))
        .when(joint, F.format_string("%d jointly-held trade%s", "n_trades", plural))
        .otherwise(F.format_string("%d spouse-held trade%s", "n_trades", plural))
    )
    same = F.when(F.col("n_same_day") > 0, F.concat(F.lit("; "), F.format_string(SAME_DAY, "n_same_day"))).otherwise("")
    finding = F.concat(subject, F.lit(f" {PLACED} a bill the member's committee handled"), same, F.lit("."))
    return found.withColumn("intensity", F.least(F.lit(1.0), 0.5 + 0.3 * closeness + 0.2 * volume)).withColumn("finding", finding)


def with_z_scores(hits: DataFrame) -> DataFrame:
    """hits with z_score: how far a member's number of trades stands out among the pattern's, unknown for one trade. A pattern's hits are never gathered; pass them staged."""
    stats = hits.groupBy(F.col("pattern").alias("_of")).agg(F.avg("n_trades").alias("_mean"), F.stddev_pop("n_trades").alias("_sd"))
    z = (F.col("n_trades") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return hits.join(F.broadcast(stats), F.col("pattern").eqNullSafe(F.col("_of"))).withColumn("z_score", F.when(F.col("n_trades") > 1, F.round(z, 6))).drop("_of", "_mean", "_sd")


def strongest_flags(hits: DataFrame, k: int = 12) -> DataFrame:
    """The k hits (member_id, pattern, intensity, z_score, detected_at) that stand out most: by z, unknown ones last, then intensity, the latest, pattern and member."""
    return first_rows(hits, [F.desc_nulls_last("z_score"), F.desc_nulls_last("intensity"), F.desc_nulls_last("detected_at"), F.asc("pattern"), F.asc("member_id")], k)


def donor_sector_alignment(themes: DataFrame, sponsored: DataFrame, top: int = 3, least_share: float = 0.2, least_bills: int = 3) -> DataFrame:
    """Themes among a member's first three by money, with a fifth of it, in which the member sponsored three focused bills."""
    by_member = Window.partitionBy("member_id")
    ranked = themes.withColumn("share", F.col("theme_total") / F.sum("theme_total").over(by_member)).withColumn(
        "rank", F.row_number().over(by_member.orderBy(F.col("theme_total").desc(), "theme"))
    )
    bills = sponsored.groupBy("member_id", "theme").agg(F.count_distinct("bill_id").alias("n_bills"))
    found = ranked.where((F.col("rank") <= top) & (F.col("share") >= least_share)).join(bills.where(F.col("n_bills") >= least_bills), ["member_id", "theme"])
    return found.select("member_id", "theme", "theme_total", "share", "n_bills", F.least(F.lit(1.0), F.col("share") + 0.1 * F.least("n_bills", F.lit(5))).alias("intensity"))


def contract_trade_alignment(totals: DataFrame, medians: DataFrame, traded: DataFrame, top: int = 3, least_share: float = 0.2, fold: float = 1.5, least_trades: int = 3) -> DataFrame:
    """Themes that a district's contracts and its member's trades both favour: first three, a fifth, 1.5 times the median share, three trades.

    totals: (district, theme, total, grand_total), traded: (district, theme, n_trades).
    """
    share = F.col("total") / F.col("grand_total")
    by_district = Window.partitionBy("district")
    c = totals.withColumn("share", share).withColumn("rank", F.row_number().over(by_district.orderBy(F.col("total").desc(), "theme")))
    t = traded.withColumn("trade_rank", F.row_number().over(by_district.orderBy(F.col("n_trades").desc(), "theme")))
    return (
        c.join(medians, "theme")
        .where((F.col("rank") <= top) & (F.col("share") >= least_share) & (F.col("share") >= fold * F.col("median_share")))
        .join(t.where((F.col("trade_rank") <= top) & (F.col("n_trades") >= least_trades)), ["district", "theme"])
        .select("district", "theme", "share", "median_share", "n_trades")
    )


def ubiquitous(confirms: DataFrame, recipients: DataFrame, n_districts: int) -> DataFrame:
    """Tickers whose recipients stand in more than a third of the districts."""
    return recipients.join(confirms, "recipient_key").groupBy("ticker").agg(F.count_distinct("district").alias("n")).where(F.col("n") * 3 > n_districts).select("ticker")


def recipient_dollars(confirms: DataFrame, recipients: DataFrame, n_districts: int) -> DataFrame:
    """(district, ticker, amount) of confirmed recipients, without ubiquitous tickers."""
    sums = recipients.join(confirms, "recipient_key").groupBy("district", "ticker").agg(F.sum("amount").alias("amount"))
    return sums.join(ubiquitous(confirms, recipients, n_districts), "ticker", "left_anti")


def recipient_overlap(traded: DataFrame, dollars: DataFrame) -> DataFrame:
    """One row: how many (district, ticker) both trade and have contracts, and the dollars of those."""
    both = dollars.join(traded.select("district", "ticker").distinct(), ["district", "ticker"])
    return both.agg(F.count("*").alias("s1"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("s2"))


def best_findings(before: DataFrame, window: int = 30, k: int = 5) -> DataFrame:
    """Per member up to k findings: the best vote of each ticker and day, then the best ticker of each day."""
    procedural = F.when(F.col("vote_question").rlike("(?i)^(on ordering the previous question|on motion to|h\\.res\\.)"), 2).otherwise(1)
    rows = before.where(F.col("days_before_vote") <= window).withColumn("score", base_score(50)).withColumn("procedural", procedural)
    first = top_rows(rows, ["member_id", "ticker", "tx_date"], [F.col("score").desc(), F.col("days_before_vote"), F.col("procedural"), F.col("vote_id"), F.col("filing_id")], 1)
    second = top_rows(first, ["member_id", "tx_date"], [F.col("score").desc(), F.col("days_before_vote"), F.col("ticker").asc_nulls_last(), F.col("asset")], 1)
    return top_rows(second, ["member_id"], [F.col("score").desc(), F.col("days_before_vote"), F.col("tx_date").desc(), F.col("ticker").asc_nulls_last(), F.col("asset")], k)


def finding_level(findings: DataFrame, members: DataFrame) -> DataFrame:
    """(member_id, n, level) of every member: none, low, medium or high."""
    days, on = F.col("days_before_vote"), F.col("member_on_bill_committee")
    found = findings.groupBy("member_id").agg(
        F.count("*").alias("n"), F.count_if(days == 0).alias("same_day"), F.max((days <= 3) & on).alias("close_on"), F.max(days <= 3).alias("close"), F.max(on).alias("on")
    )
    high = F.col("close_on") | (F.col("same_day") >= 3)
    level = F.when(F.col("n").isNull(), "none").when(high, "high").when(F.col("close") | F.col("on"), "medium").otherwise("low")
    return members.select("member_id").join(found, "member_id", "left").select("member_id", F.coalesce("n", F.lit(0)).alias("n"), level.alias("level"))


def named_in_roles(roles: DataFrame, members: DataFrame) -> DataFrame:
    """(role rows, member_id) where a role names a member (member_id, name, chamber).

    A role names a member if a title of the member's chamber (any title for another chamber or
    none) is followed by the surname, or by the member's own first name, two more words at most
    and the surname: "Rep. Jason T. Smith" is Jason Smith, "Rep. Adam Smith" isn't.

    Distinct roles are cut into words; each word after a title that may be a surname is a row, joined
    to members by its leading letters and digits. No role is held against a member whose
    surname it doesn't hold, and no pattern is made for a member.
    """
    words = F.split(F.trim(F.regexp_replace("role", r"\s+", " ")), " ")
    ends = lambda w, titles: F.lower(w).rlike(f"({titles})$")
    texts = roles.where("role is not null").select("role").distinct().select("role", words.alias("_words"))
    places = F.filter(F.sequence(F.lit(1), F.size("_words")), lambda i: ends(F.element_at("_words", i), f"{SENATE_TITLES}|{HOUSE_TITLES}"))
    titled = texts.select("role", "_words", F.explode(places).alias("_at")).withColumn("_title", F.element_at("_words", F.col("_at")))
    spread = titled.select("role", "_title", F.lower(F.try_element_at("_words", F.col("_at") + 1)).alias("_next"), F.slice("_words", F.col("_at") + 1, 4).alias("_after"))
    each = spread.select("*", F.posexplode("_after").alias("_nth", "_word"))
    middle = F.forall(F.slice("_after", 2, F.greatest(F.col("_nth") - 1, F.lit(0))), lambda w: w.rlike(r"^[A-Za-z][A-Za-z0-9_.\-]*$"))
    each = each.where((F.col("_nth") == 0) | middle).select("role", "_title", "_next", "_nth", F.lower("_word").alias("_word"))
    run = lambda c: F.regexp_extract(c, "^[a-z0-9_]*", 0)
    m = members.select("member_id", "chamber", F.lower(surname(F.col("name"))).alias("_last"), F.lower(F.element_at(F.split(F.trim("name"), r"\s+"), 1)).alias("_first"))
    pairs = each.withColumn("_run", run("_word")).join(m.where("_last <> ''").withColumn("_run", run("_last")), "_run")
    of_senate, of_house = ends(F.col("_title"), SENATE_TITLES), ends(F.col("_title"), HOUSE_TITLES)
    own_title = F.when(F.col("chamber") == "senate", of_senate).when(F.col("chamber") == "house", of_house).otherwise(True)
    own_name = (F.col("_nth") == 0) | (F.col("_next") == F.col("_first"))
    # the surname ends where a word ends
    is_word = lambda c: c.rlike("^[A-Za-z0-9_]$")
    after = F.substr("_word", F.length("_last") + 1, F.lit(1))
    whole = F.startswith("_word", F.col("_last")) & (is_word(F.right("_last", F.lit(1))) != is_word(after))
    found = pairs.where(own_title & own_name & whole).select("role", "member_id").distinct()
    return roles.join(found, "role").select(*roles.columns, "member_id")


def keyword_roles(roles: DataFrame, keywords: DataFrame) -> DataFrame:
    """(role rows, member_id) where a role speaks of a committee and one of a member's keywords (member_id, keyword) stands in it, within words too, in any case.

    An inverted index of the distinct roles by runs of three letters; a keyword is looked up by its
    rarest run and compared there alone.
    """
    texts = roles.where(F.contains(F.lower("role"), F.lit("cmte"))).select("role").distinct().withColumn("_text", F.lower("role"))
    asked = keywords.where("keyword is not null").select(F.lower("keyword").alias("_asked")).distinct()
    held = containing(texts, "_text", asked, F.col("_asked"), [])
    found = held.select("role", "_asked").join(keywords.select("member_id", F.lower("keyword").alias("_asked")), "_asked").select("role", "member_id").distinct()
    return roles.join(found, "role").select(*roles.columns, "member_id")


def latest_filing_order() -> list[Column]:
    """Latest first: by year, then the day it was posted, unknown days last; then the smaller id."""
    return [F.col("filing_year").desc_nulls_last(), F.col("posted_at").desc_nulls_last(), F.col("filing_id").asc_nulls_last()]


def revolving_door(roles: DataFrame, members: DataFrame, keywords: DataFrame, as_of_year: int) -> DataFrame:
    """(member_id, lobbyist_id, connection, tier): direct mentions, then committee mentions of pairs without a direct one; the latest matching filing of each pair counts."""
    direct = named_in_roles(roles, members).withColumn("connection", F.lit("direct"))
    by_committee = keyword_roles(roles, keywords).withColumn("connection", F.lit("committee"))
    rest = by_committee.join(direct.select("member_id", "lobbyist_id").distinct(), ["member_id", "lobbyist_id"], "left_anti")
    latest = top_rows(direct.unionByName(rest), ["member_id", "lobbyist_id"], latest_filing_order(), 1)
    return latest.select("member_id", "lobbyist_id", "connection", "filing_id", "filing_year", recency_tier(F.col("filing_year"), as_of_year).alias("tier"))


def power_band(n_trades: Column) -> Column:
    """How much a member's number of trades that map to a theme lets one say."""
    return F.when(n_trades < 5, "insufficient-data").when(n_trades < 10, "low-power").otherwise("ranked")


def theme_gap_receipts(nexus: DataFrame, trades: DataFrame, p_values: DataFrame) -> DataFrame:
    """One row for each nexus row (member_id, trade_id, tx_date, ticker, vote_id, ...) with the member's trade_count and band, p_pair and its place.

    trades: all of a member's trades that map to a theme. Receipts stand in the order of time; in
    the band "ranked" in that of p_pair, missing ones counting as 1. With insufficient data p_pair is null.
    """
    counts = trades.groupBy("member_id").agg(F.count("*").alias("trade_count"))
    rows = nexus.join(counts, "member_id", "left").withColumn("trade_count", F.coalesce("trade_count", F.lit(0))).withColumn("band", power_band(F.col("trade_count")))
    p = F.when(F.col("band") != "insufficient-data", F.col("_p"))
    known = rows.join(p_values.select("member_id", "trade_id", F.col("p_pair").alias("_p")), ["member_id", "trade_id"], "left").withColumn("p_pair", p).drop("_p")
    first = F.when(F.col("band") == "ranked", F.coalesce("p_pair", F.lit(1.0)))
    order = Window.partitionBy("member_id").orderBy(first, "tx_date", "trade_id", "ticker", "vote_id", "theme")
    return known.withColumn("place", F.row_number().over(order))


def row_tier(score: Column) -> Column:
    return F.when(score >= 85, "high").when(score >= 70, "medium").otherwise("low")


def pattern_tier(intensity: Column, p_value: Column) -> Column:
    """Tier of a hit; one that isn't significant is low."""
    return F.when(p_value >= 0.05, "low").otherwise(row_tier(intensity * 100))


def confidence_statement(observed: Column, expected: Column, p_value: Column) -> Column:
    fold = F.format_string("%.1f times as often as chance", observed / F.when(expected > 0, expected))
    return F.when(p_value.isNull(), "unscored").when(p_value <= 0.05, F.coalesce(fold, F.lit("never by chance"))).otherwise("about as often as chance")
