"""Crosswalk joins: bills, instruments, industries and codes to themes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases in titles of bills that carry money for everything, and kinds of bills that can be about one thing.
BROAD_TITLES = (
    "appropriations", "consolidated", "continuing", "relief act", "reconciliation", "omnibus", "national defense authorization", "rescissions act",
)
BROAD_START = "providing for consideration"
#: Two more for bills that a member sponsors.
BUDGET_TITLES = ("budget resolution", "concurrent resolution on the budget")
FOCUSED_KINDS = ("hr", "s", "hjres", "sjres")
MOST_SUBJECTS = 25


def is_focused(title: Column, bill_id: Column, more_titles: tuple[str, ...] = (), separator: str = "-") -> Column:
    """A title of 6 characters or more without a broad phrase, on a bill of a focused kind. False for nulls."""
    broad = F.lower(title).rlike(f"^{BROAD_START}|{'|'.join((*BROAD_TITLES, *more_titles))}")
    kind = bill_id.rlike(f"[{separator}]({'|'.join(FOCUSED_KINDS)})[{separator}]")
    return F.coalesce((F.length(title) >= 6) & ~broad & kind, F.lit(False))


def bill_themes(subjects: DataFrame, rules: DataFrame) -> DataFrame:
    """(bill_id, theme): a rule's policy area equals the bill's, or its pattern fits a subject of a bill with few subjects.

    The two halves of the OR are joined each for itself: equal policy areas by hash, patterns over
    distinct subjects of focused bills only, against the rule table, which is curated and small.
    """
    area = subjects.select("bill_id", "policy_area").distinct().join(rules.select("theme", "policy_area"), "policy_area").select("bill_id", "theme")
    few = subjects.groupBy("bill_id").count().where(F.col("count") <= MOST_SUBJECTS).select("bill_id")
    patterns = rules.select("theme", "subject_pattern").where(F.col("subject_pattern").isNotNull())
    words = subjects.select("subject").distinct()
    fits = words.join(patterns, F.ilike("subject", "subject_pattern")).select("subject", "theme")
    by_pattern = subjects.join(few, "bill_id", "left_semi").join(fits, "subject").select("bill_id", "theme")
    return area.unionAll(by_pattern).distinct()


def instrument_themes(sectors: DataFrame, sic_theme: DataFrame, overrides: DataFrame) -> DataFrame:
    """(ticker, sic, sic_description, theme): the override if there is one, else the industry code's theme."""
    own = overrides.select("ticker", F.col("theme").alias("_own"))
    return (
        sectors.join(sic_theme.select("sic", F.col("theme").alias("_by_sic")), "sic", "left")
        .join(own, "ticker", "left")
        .select("ticker", "sic", "sic_description", F.coalesce("_own", "_by_sic").alias("theme"))
        .where(F.col("theme").isNotNull())
    )


def theme_nexus(before: DataFrame, instruments: DataFrame, themes_of_bills: DataFrame) -> DataFrame:
    """Trades before a vote on a focused bill that has the theme of the traded instrument; distinct rows."""
    focused = before.where(F.col("ticker").isNotNull() & is_focused(F.col("bill_title"), F.col("bill_id"))).withColumn("_ticker", F.upper("ticker"))
    named = instruments.withColumnRenamed("ticker", "_ticker")
    return focused.join(named, "_ticker").join(themes_of_bills, ["bill_id", "theme"]).drop("_ticker").distinct()


def eligible_votes(votes: DataFrame, bills: DataFrame, themes_of_bills: DataFrame) -> DataFrame:
    """(member_id, vote_id, vote_date, theme, bill_id) of all votes on focused bills, whether anybody traded or not."""
    titled = bills.where(is_focused(F.col("bill_title"), F.col("bill_id"))).select("bill_id")
    return votes.join(titled, "bill_id").join(themes_of_bills, "bill_id").select("member_id", "vote_id", "vote_date", "theme", "bill_id").distinct()


def industry_themes(industries: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (industry, theme): patterns are held against distinct industries only."""
    return industries.select("industry").distinct().join(patterns, F.ilike("industry", "industry_pattern")).select("industry", "theme").distinct()


def longest_prefix(codes: DataFrame, code: str, prefixes: DataFrame, prefix: str, value: str, shortest: int = 1) -> DataFrame:
    """(code, value): the value of the longest prefix in the table; null when none fits.

    Each distinct code is spread to its prefixes and joined by equality, so no inequality join is needed.
    """
    distinct = codes.select(F.col(code).alias("_code")).distinct()
    spread = distinct.where(F.length("_code") >= shortest).select(
        "_code", F.explode(F.transform(F.sequence(F.lit(shortest), F.length("_code")), lambda n: F.substring(F.col("_code"), F.lit(1), n))).alias("_prefix")
    )
    found = spread.join(prefixes.select(F.col(prefix).alias("_prefix"), F.col(value).alias("_value")), "_prefix")
    best = found.groupBy("_code").agg(F.max_by("_value", F.length("_prefix")).alias(value))
    return distinct.join(best, "_code", "left").select(F.col("_code").alias(code), value)
