"""Aggregations: counts, sums, shares, rollups by theme."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordering import top_rows
from .themes import longest_prefix

#: How many rows a member's page lists of each kind.
FACTS = {"donors": 10, "spending": 10, "positions": 100, "broke": 8, "trades": 20, "hits": 100}
#: The middle of each band of amounts.
BAND_MIDPOINTS = {
    "$1,001 - $15,000": 8_000,
    "$15,001 - $50,000": 32_500,
    "$50,001 - $100,000": 75_000,
    "$100,001 - $250,000": 175_000,
    "$250,001 - $500,000": 375_000,
    "$500,001 - $1,000,000": 750_000,
    "$1,000,001 - $5,000,000": 3_000_000,
    "$5,000,001 - $25,000,000": 15_000_000,
    "$25,000,001 - $50,000,000": 37_500_000,
    "Over $50,000,000": 50_000_000,
}


def top_donors(donors: DataFrame) -> DataFrame:
    """(donor, sample_name, member_count, total_amount) over all members."""
    return donors.groupBy("donor").agg(F.min("donor_name").alias("sample_name"), F.count_distinct("member_id").alias("member_count"), F.sum("amount").alias("total_amount"))


def member_trade_summary(trades: DataFrame) -> DataFrame:
    return trades.groupBy("member_id").agg(
        F.count("*").alias("total_trades"),
        F.count_distinct(F.coalesce("ticker", "asset")).alias("distinct_assets"),
        F.count_if(F.col("tx_type") == "purchase").alias("purchase_count"),
        F.count_if(F.col("tx_type").startswith("sale")).alias("sale_count"),
        F.min("tx_date").alias("first_trade_date"),
        F.max("tx_date").alias("last_trade_date"),
        F.round(F.avg("match_confidence"), 3).alias("avg_match_confidence"),
    )


def freshness(members: DataFrame, fetched: str, as_of: Column) -> DataFrame:
    """Days since each row was fetched, as of a given date."""
    return members.select("member_id", F.datediff(as_of, F.col(fetched)).alias("days_since_fetch"))


def joined_names(rows: DataFrame, by: list[str], name: str, separator: str = " · ") -> DataFrame:
    """Names of each group in order, joined."""
    return rows.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list(name)), separator).alias("names"))


def donor_theme_rollup(donor_industry: DataFrame, industry_theme: DataFrame, by: list[str]) -> DataFrame:
    """Sums of an industry's money by theme; industries without a theme are left out."""
    return (
        donor_industry.join(industry_theme, "industry")
        .groupBy(*by, "theme")
        .agg(
            F.sum("total").alias("theme_total"),
            F.sum("individuals").alias("theme_individuals"),
            F.sum("pacs").alias("theme_pacs"),
            F.count("*").alias("industry_count"),
            F.min("source").alias("source"),
            F.min("cycle").alias("min_cycle"),
            F.max("cycle").alias("max_cycle"),
        )
    )


def contract_theme_totals(contracts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(district, theme, total, grand_total, roster_total): sums by the theme of the longest known prefix; codes without one count in the grand total only."""
    mapped = longest_prefix(contracts, "code", prefixes, "prefix", "theme")
    by_theme = contracts.join(mapped, "code").groupBy("district", "theme").agg(F.sum("amount").alias("total"))
    with_all = by_theme.withColumn("grand_total", F.sum("total").over(Window.partitionBy("district")))
    roster = by_theme.where(F.col("theme").isNotNull()).groupBy("theme").agg(F.sum("total").alias("roster_total"))
    return with_all.join(roster, "theme")


def median_shares(totals: DataFrame, districts: DataFrame) -> DataFrame:
    """(theme, median_share) over all districts; a district without the theme has share 0.

    Districts without a theme are one row of share 0 that counts as often as there are such districts.
    """
    shares = totals.select("theme", (F.col("total") / F.col("grand_total")).alias("share"), F.lit(1).cast("long").alias("times"))
    everywhere = districts.agg(F.count_distinct("district").alias("n"))
    absent = shares.groupBy("theme").agg(F.count("*").alias("held")).join(everywhere, F.lit(True))
    zeros = absent.select("theme", F.lit(0.0).alias("share"), (F.col("n") - F.col("held")).alias("times")).where("times > 0")
    return shares.unionAll(zeros).groupBy("theme").agg(F.percentile("share", F.lit(0.5), F.col("times")).alias("median_share"))


def counts_per_key(base: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """Rows of each table by key, 0 where there are none; every table is counted before it is joined."""
    out = base.select(key).distinct()
    for name, table in tables.items():
        out = out.join(table.groupBy(key).agg(F.count("*").alias(name)), key, "left")
    return out.select(key, *(F.coalesce(name, F.lit(0)).alias(name) for name in tables))


def data_through(key: str, **dated: tuple[DataFrame, str]) -> DataFrame:
    """(key, data_through): the latest date over several tables."""
    parts = [table.select(key, F.col(date).cast("date").alias("_date")) for table, date in dated.values()]
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.max("_date").alias("data_through"))


def activity_glance(members: DataFrame, trades: DataFrame, votes: DataFrame, sponsored: DataFrame, donors: DataFrame, before: DataFrame, start: Column, end: Column) -> DataFrame:
    """Per member, of the cycle from start to before end: trades, volume at the middle of each band, distinct tickers, votes, and
    trades within 14 days before a related vote; of all time: bills sponsored and the donor type that gave most.

    A vote is related if the member's committee handled its bill or the bill names the ticker. Every
    table is summed before it is joined.
    """
    in_cycle = lambda date: (F.col(date) >= start) & (F.col(date) < end)
    middle = F.create_map(*(F.lit(x) for pair in BAND_MIDPOINTS.items() for x in pair))[F.col("amount_band")]
    trade = F.struct("filing_id", F.coalesce("asset", F.lit("")), F.coalesce("ticker", F.lit("")))
    related = before.where(in_cycle("tx_date") & (F.col("days_abs") <= 14) & (F.col("bill_mentions_ticker") | F.col("member_on_bill_committee")))
    parts = [
        trades.where(in_cycle("tx_date")).groupBy("member_id").agg(F.count("*").alias("trades"), F.sum(F.coalesce(middle, F.lit(0))).alias("volume"), F.count_distinct(F.nullif("ticker", F.lit(""))).alias("tickers")),
        votes.where(in_cycle("vote_date")).groupBy("member_id").agg(F.count("*").alias("votes")),
        sponsored.groupBy("member_id").agg(F.count("*").alias("bills_sponsored")),
        related.groupBy("member_id").agg(F.count_distinct(trade).alias("related_trades")),
    ]
    by_type = donors.where("donor_type is not null").groupBy("member_id", "donor_type").agg(F.sum("amount").alias("total"))
    top = by_type.groupBy("member_id").agg(F.min_by("donor_type", F.struct(-F.col("total"), F.col("donor_type"))).alias("top_donor_type"))
    out = reduce(lambda a, b: a.join(b, "member_id", "left"), [*parts, top], members.select("member_id"))
    return out.select("member_id", "top_donor_type", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("trades", "volume", "tickers", "votes", "bills_sponsored", "related_trades")))


def recipient_sums(awards: DataFrame) -> DataFrame:
    """(district, recipient_key, amount) over all awards."""
    return awards.groupBy("district", "recipient_key").agg(F.sum("amount").alias("amount"))


def portfolio(trades: DataFrame, k: int = 40) -> DataFrame:
    """Each member's k most traded instruments: count, first and last date, kinds of transaction."""
    by = trades.groupBy("member_id", F.coalesce("ticker", "asset").alias("instrument")).agg(
        F.count("*").alias("n"), F.min("tx_date").alias("first_date"), F.max("tx_date").alias("last_date"), F.array_join(F.array_sort(F.collect_set("tx_type")), "/").alias("types")
    )
    return top_rows(by, ["member_id"], [F.col("n").desc(), F.col("last_date").desc(), F.col("instrument")], k)


def linkage(votes: DataFrame, by: list[str]) -> DataFrame:
    """Votes and how many of them name a bill."""
    return votes.groupBy(*by).agg(F.count("*").alias("votes_total"), F.count_if(F.col("bill_id").isNotNull()).alias("votes_linked"))


def census(**tables: DataFrame) -> DataFrame:
    """(table_name, n) of several tables."""
    return reduce(DataFrame.unionAll, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()])


def spending_by_side(spending: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """Of each member's latest cycle: totals for and against, and the k largest committees of each side."""
    last = spending.groupBy("member_id").agg(F.max("cycle").alias("cycle"))
    rows = spending.join(last, ["member_id", "cycle"])
    total = lambda side: F.sum(F.when(F.col("side") == side, F.col("amount")).otherwise(0.0))
    totals = rows.groupBy("member_id", "cycle").agg(total("S").alias("support"), total("O").alias("oppose"))
    by = rows.groupBy("member_id", "cycle", "side", "committee").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    return totals, top_rows(by, ["member_id", "side"], [F.col("amount").desc(), F.col("committee")], k)


def money_and_bills(themes: DataFrame, sponsored: DataFrame) -> DataFrame:
    """Each member's themes with their share of the mapped money and the number of focused bills sponsored."""
    share = F.col("theme_total") / F.sum("theme_total").over(Window.partitionBy("member_id"))
    bills = sponsored.groupBy("member_id", "theme").agg(F.count_distinct("bill_id").alias("bills"))
    cycles = F.when(F.col("min_cycle") == F.col("max_cycle"), F.col("min_cycle").cast("string")).otherwise(F.concat_ws("-", "min_cycle", "max_cycle"))
    return (
        themes.withColumn("share", share)
        .join(bills, ["member_id", "theme"], "left")
        .select("member_id", "theme", "theme_total", "share", F.coalesce("bills", F.lit(0)).alias("bills"), cycles.alias("cycles"))
    )


def evidence_groups(hits: DataFrame, k: int = 8) -> DataFrame:
    """Of each hit and kind of evidence the first k labels and how many more there are."""
    rows = hits.select("pattern", "member_id", F.inline("citing"))
    by = rows.groupBy("pattern", "member_id", "kind").agg(F.array_sort(F.collect_list("label")).alias("labels"))
    return by.select("pattern", "member_id", "kind", F.slice("labels", 1, k).alias("labels"), F.greatest(F.size("labels") - k, F.lit(0)).alias("more"))


def fact_sheet(donors: DataFrame, spending: DataFrame, votes: DataFrame, trades: DataFrame, hits: DataFrame, most: dict[str, int] = FACTS) -> DataFrame:
    """(member_id, section, place, label, amount): the top lists of each member's page, in one table.

    Money in: largest donors. Outside spending: largest sums. Positions: how often each was taken. Broke
    with party: latest votes against it. Trades: latest ones. Hits: those that stand out most. Orders are total.
    """
    money = lambda c: F.col(c).cast("double").alias("amount")
    voted = F.lower("position").isin("yea", "nay") & F.lower("party_position").isin("yea", "nay") & (F.lower("position") != F.lower("party_position"))
    day = lambda c: F.col(c).cast("string")
    lists = {
        "donors": donors.select("member_id", F.concat_ws(" ", "donor", F.concat(F.lit("("), F.coalesce("donor_type", F.lit("?")), F.lit(")"))).alias("label"), money("amount"), F.lit("").alias("at")),
        "spending": spending.select("member_id", F.concat_ws(" ", "side", "committee", F.col("cycle").cast("string")).alias("label"), money("amount"), F.lit("").alias("at")),
        "positions": votes.groupBy("member_id", F.col("position").alias("label")).agg(F.count("*").cast("double").alias("amount")).withColumn("at", F.lit("")),
        "broke": votes.where(voted).select("member_id", F.concat_ws(" ", day("vote_date"), "position", "vote_id").alias("label"), F.lit(None).cast("double").alias("amount"), day("vote_date").alias("at")),
        "trades": trades.select("member_id", F.concat_ws(" ", day("tx_date"), "tx_type", "asset", "ticker", "amount_band", "holder", F.col("filing_id").cast("string")).alias("label"), F.lit(None).cast("double").alias("amount"), day("tx_date").alias("at")),
        "hits": hits.select("member_id", F.concat_ws(" ", "pattern", "finding").alias("label"), F.coalesce("z_score", F.lit(float("-inf"))).alias("amount"), F.lpad(F.round(F.col("intensity") * 1e6).cast("long").cast("string"), 8, "0").alias("at")),
    }
    order = [F.desc_nulls_last("amount"), F.desc_nulls_last("at"), F.asc_nulls_last("label")]
    ranked = [top_rows(rows.withColumn("section", F.lit(name)), ["member_id"], order, most[name], "place") for name, rows in lists.items()]
    return reduce(DataFrame.unionByName, ranked).select("member_id", "section", "place", "label", F.when(F.col("amount") != float("-inf"), F.col("amount")).alias("amount"))


def upper_tails(rows: DataFrame, value: str) -> DataFrame:
    """(value, p_value) of each distinct value: the share of rows with as much or more. Rows are counted by value first; only distinct values are put in order."""
    by = rows.groupBy(value).agg(F.count("*").alias("_n"))
    upto = Window.orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by.join(rows.agg(F.count("*").alias("_all")), F.lit(True)).select(value, (F.sum("_n").over(upto) / F.col("_all")).alias("p_value"))


def resolution_coverage(recipients: DataFrame, traded: DataFrame, top: int = 15) -> DataFrame:
    """recipients (district, recipient_key, amount, ticker or null) and traded (district, ticker): per district the resolved number, money and its share, what of it
    the district's member traded, largest first, and the unresolved among the ``top`` largest recipients. Equal amounts go by key.
    """
    known, money = F.col("ticker").isNotNull(), lambda c: F.sum(F.when(c, F.col("amount")).otherwise(0.0))
    mine = traded.where("ticker is not null").select("district", F.upper("ticker").alias("ticker"), F.lit(True).alias("_mine")).distinct()
    place = F.row_number().over(Window.partitionBy("district").orderBy(F.desc_nulls_last("amount"), F.asc("recipient_key"), F.asc_nulls_last("ticker")))
    rows = recipients.withColumn("ticker", F.upper("ticker")).join(mine, ["district", "ticker"], "left").withColumn("_place", place)
    listed = lambda c, *fields: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("_place", *fields)))), lambda x: F.struct(*(x[f] for f in fields)))
    return rows.groupBy("district").agg(
        F.count("*").alias("recipients"),
        F.count_if(known).alias("resolved"),
        money(known).alias("resolved_amount"),
        (money(known) / F.sum("amount")).alias("resolved_share"),
        listed(F.col("_mine"), "recipient_key", "ticker", "amount").alias("overlap"),
        listed(~known & (F.col("_place") <= top), "recipient_key", "amount").alias("unresolved_top"),
    )


def collapse_trades(capped: DataFrame, key: list[str], samples: int = 3) -> DataFrame:
    """One row per trade: closest vote, closest vote with a committee, the first votes, the number of pairs."""
    order = F.struct("days_abs", "vote_id")
    near = F.array_sort(F.collect_list(order))
    return capped.groupBy(*key).agg(
        F.min_by("vote_id", order).alias("closest_vote"),
        F.min("days_abs").alias("closest_days"),
        F.min_by(F.when(F.col("member_on_bill_committee"), F.col("vote_id")), F.when(F.col("member_on_bill_committee"), order)).alias("closest_committee_vote"),
        F.transform(F.slice(near, 1, samples), lambda x: x["vote_id"]).alias("sample_votes"),
        F.count("*").alias("pairs"),
    )


def timeline(votes: DataFrame, trades: DataFrame, most_votes: int = 2000) -> DataFrame:
    """(member_id, event_date, kind, event_id, label, place): a member's first ``most_votes`` votes and all its trades as one stream in the order of time."""
    v = votes.select("member_id", F.col("vote_date").alias("event_date"), F.lit("vote").alias("kind"), F.col("vote_id").cast("string").alias("event_id"), F.col("position").alias("label"))
    t = trades.select("member_id", F.col("tx_date").alias("event_date"), F.lit("trade").alias("kind"), F.col("filing_id").cast("string").alias("event_id"), F.col("tx_type").alias("label"))
    first = top_rows(v, ["member_id"], [F.col(c).asc_nulls_last() for c in ("event_date", "label", "event_id")], most_votes)
    order = Window.partitionBy("member_id").orderBy("event_date", "kind", "event_id")  # a person's events
    return first.unionByName(t).where("event_date is not null").withColumn("place", F.row_number().over(order))
