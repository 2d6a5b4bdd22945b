"""Nested records to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.text import bill_reference, congress_from_url, strip_html

from .ordering import top_rows

#: Patterns, in any case, of donors that pass other people's money on.
CONDUITS = (r"^WINRED\b", r"^ACTBLUE\b", r"\bVICTORY\b")
#: Names of funders that pass money on, and what a memo says of it.
PASSTHROUGH_NAMES = ("ACTBLUE", "WINRED")
PASSTHROUGH_MEMO = "earmarked through this organization"


def link_votes(votes: DataFrame) -> DataFrame:
    """bill_id filled where it is null, from the question's bill and the url's congress."""
    ref = bill_reference(F.col("question"))
    made = F.when(ref.isNotNull(), F.concat_ws("-", congress_from_url(F.col("source_url")).cast("string"), ref))
    return votes.withColumn("bill_id", F.coalesce("bill_id", made))


def latest_summaries(summaries: DataFrame) -> DataFrame:
    """(bill_id, title, text) of the highest version: title from the first bold text, text without tags."""
    last = summaries.groupBy("bill_id").agg(F.max_by("html", "version").alias("html"))
    title = F.nullif(F.regexp_extract("html", r"<strong>(.*?)</strong>", 1), F.lit(""))
    return last.select("bill_id", title.alias("title"), strip_html(F.col("html")).alias("text"))


def _usable(position: Column) -> Column:
    return F.when(~F.upper(F.trim(position)).isin("", "N/A"), position)


def lobbyists(filings: DataFrame) -> DataFrame:
    """One row per filing and lobbyist: issues distinct in order of mention, the first usable position, all entities of the filing.

    filings: filing_id, activities array<struct<issue, lobbyists array<struct<lobbyist_id, name, position>>, entities array<string>>>.
    """
    entities = F.array_sort(F.array_distinct(F.flatten(F.transform("activities", lambda a: a["entities"]))))
    rows = filings.select("filing_id", entities.alias("entities"), F.posexplode("activities").alias("at", "activity"))
    each = rows.select("filing_id", "entities", "at", F.col("activity.issue").alias("issue"), F.posexplode("activity.lobbyists").alias("nth", "l"))
    said = F.transform(F.array_sort(F.collect_list(F.struct("at", "nth", "issue"))), lambda x: x["issue"])
    position = _usable(F.col("l.position"))
    return each.groupBy("filing_id", F.col("l.lobbyist_id").alias("lobbyist_id")).agg(
        F.min_by("l.name", F.struct("at", "nth")).alias("name"),
        F.array_join(F.array_distinct(said), " / ").alias("issues"),
        F.min_by(position, F.when(position.isNotNull(), F.struct("at", "nth"))).alias("position"),
        F.array_join(F.first("entities"), "; ").alias("entities"),
    )


def with_usable_position(filings: DataFrame) -> DataFrame:
    """Filings of which some lobbyist has a usable position."""
    return filings.where(F.exists(F.flatten(F.transform("activities", lambda a: a["lobbyists"])), lambda p: _usable(p["position"]).isNotNull()))


def latest_activity(activities: DataFrame) -> DataFrame:
    """Per bill and committee the latest activity that has a name; the latest of all where none has."""
    named = F.col("name").isNotNull()
    order = Window.partitionBy("bill_id", "committee").orderBy(named.desc(), F.col("date").desc_nulls_last(), F.col("name").asc_nulls_last())
    return activities.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def donor_rollup(receipts: DataFrame, k: int = 100) -> DataFrame:
    """Each member's k largest donors: sums over cycles by upper-case name, without conduits and amounts of 0 or less."""
    real = receipts.where(~F.col("name").rlike("(?i)" + "|".join(CONDUITS)) & (F.col("amount") > 0))
    rank = F.when(F.col("donor_type") == "individual", 1).otherwise(0)
    by = real.groupBy("member_id", F.upper("name").alias("donor")).agg(
        F.sum("amount").alias("amount"), F.sort_array(F.collect_set("cycle")).alias("cycles"), F.max("date").alias("last_date"), F.min_by("donor_type", F.struct(rank, "donor_type")).alias("donor_type")
    )
    return top_rows(by, ["member_id"], [F.col("amount").desc(), F.col("donor")], k)


def spending_aggregate(spending: DataFrame) -> DataFrame:
    """Sums and counts by member, cycle, committee and side, with the member's totals of each side."""
    by = spending.groupBy("member_id", "cycle", "committee", "side").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    return by.withColumn("side_total", F.sum("amount").over(Window.partitionBy("member_id", "cycle", "side")))


def passthrough(name: Column, memo: Column, names: tuple[str, ...] = PASSTHROUGH_NAMES) -> Column:
    """A name of the set, in any case, or a memo about earmarks."""
    named = F.upper(F.trim(F.coalesce(name, F.lit("")))).isin(*names)
    return named | F.contains(F.lower(F.coalesce(memo, F.lit(""))), F.lit(PASSTHROUGH_MEMO))


def top_funders(funders: DataFrame, names: tuple[str, ...] = PASSTHROUGH_NAMES, k: int = 3) -> DataFrame:
    """Each committee's k largest funders that only pass nothing on."""
    real = funders.where(~passthrough(F.col("name"), F.col("memo"), names))
    by = real.groupBy("committee", "name").agg(F.sum("amount").alias("amount"))
    return top_rows(by, ["committee"], [F.col("amount").desc(), F.col("name")], k)


def _meetings(meetings: DataFrame) -> DataFrame:
    """(event_id, date, kind, codes): the kind is Markup or Hearing by the title, else Meeting if that is the record's type, else Other; codes in lower case."""
    title = F.lower(F.coalesce("title", F.lit("")))
    kind = F.when(title.contains("markup"), "Markup").when(title.contains("hearing"), "Hearing").when(F.col("type") == "Meeting", "Meeting").otherwise("Other")
    return meetings.select("event_id", "date", kind.alias("kind"), F.array_distinct(F.transform("committees", F.lower)).alias("codes"))


def relevant_meetings(meetings: DataFrame, memberships: DataFrame) -> DataFrame:
    """(member_id, event_id, date, kind): meetings of a member's committees, each once.

    meetings: event_id, date, title, type, committees.
    """
    rows = _meetings(meetings).select("event_id", "date", "kind", F.explode("codes").alias("code"))
    mine = memberships.select("member_id", F.lower("committee_code").alias("code")).distinct()
    return rows.join(mine, "code").select("member_id", "event_id", "date", "kind").distinct()


def meeting_counts(meetings: DataFrame, memberships: DataFrame) -> DataFrame:
    """(member_id, kind, n, first_event, event_sum) of ``relevant_meetings`` without making a row for each member and meeting.

    Meetings of the same committees and kind are summed to one row, and members of the same
    committees are one class; classes meet the sums, once for each that they share a committee with.
    """
    spread = _meetings(meetings).select("event_id", "date", "kind", F.explode("codes").alias("code"))
    # rows of one meeting are one meeting of all their committees
    whole = spread.where("code is not null").groupBy("event_id", "date", "kind").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    summed = whole.groupBy("codes", "kind").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.sum("event_id").alias("event_sum"))
    members = memberships.where("committee_code is not null").groupBy("member_id").agg(F.array_sort(F.collect_set(F.lower("committee_code"))).alias("own"))
    asked = members.select("own").distinct().withColumn("code", F.explode("own"))
    met = asked.join(summed.withColumn("code", F.explode("codes")), "code").select("own", "codes", "kind", "n", "first_event", "event_sum").distinct()
    by = met.groupBy("own", "kind").agg(F.sum("n").alias("n"), F.min("first_event").alias("first_event"), F.sum("event_sum").alias("event_sum"))
    # Spark takes the members for as small as their compressed file; they aren't to be broadcast
    return members.hint("merge").join(by, "own").select("member_id", "kind", "n", "first_event", "event_sum")


def subjects_or_area(bills: DataFrame) -> DataFrame:
    """(bill_id, subject, policy_area): a row for each subject, or one with the policy area for bills without any."""
    listed = F.when(F.coalesce(F.size("subjects"), F.lit(0)) <= 0, F.array("policy_area")).otherwise(F.col("subjects"))
    return bills.select("bill_id", F.explode(listed).alias("subject"), "policy_area").where("subject is not null")
