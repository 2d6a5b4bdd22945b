"""Bounded time-proximity joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.text import role_rank

from .pairs import HEAVY_ITEMS, pair_tasks

#: Kinds of assets that nobody picks one by one, and words in the names of such funds.
PASSIVE_KINDS = ("GS", "MF", "EF", "BA", "CT", "AB", "Corporate Bond", "Municipal Security")
FUND_WORDS = ("etf", "index fund", "s&p 500", "vanguard", "ishares", "schwab", "fidelity", "matthews international mutual")
#: Kinds in which fund words count.
FREE_TEXT_KINDS = ("OT", "Stock")


def band_join(left: DataFrame, right: DataFrame, on: list[str], left_date: str, right_date: str, window: int, forward_only: bool = False, bucket_name: str | None = None) -> DataFrame:
    """Pairs with equal keys whose dates are at most ``window`` days apart.

    The key is extended by a bucket of ``window`` days: a right row lies in one bucket, a left row
    looks into its own and its neighbours, so a busy key spreads over its buckets instead of
    meeting in one task, and each pair is found once. Put the smaller side left. Null keys and dates
    match nothing. bucket_name: keeps the right row's bucket, so that grouping by it and the right row needs no shuffle.
    """
    day = lambda c: F.unix_date(F.col(c))
    bucket = lambda c: F.floor(day(c) / window)
    gap = day(right_date) - day(left_date)
    looks = F.sequence(bucket(left_date) - F.lit(0 if forward_only else 1), bucket(left_date) + 1)
    a = left.where(F.col(left_date).isNotNull()).withColumn("_bucket", F.explode(looks))
    b = right.where(F.col(right_date).isNotNull()).withColumn("_bucket", bucket(right_date))
    near = gap.between(0, window) if forward_only else F.abs(gap) <= window
    found = a.join(b, [*on, "_bucket"]).where(near)
    return found.withColumnRenamed("_bucket", bucket_name) if bucket_name else found.drop("_bucket")


def gap_columns(from_date: str, to_date: str) -> list[Column]:
    """Signed days from the first to the second date (positive: first one earlier), absolute, before, after."""
    gap = F.datediff(to_date, from_date)
    return [
        gap.alias("days_from_trade_to_vote"),
        F.abs(gap).alias("days_abs"),
        F.greatest(F.lit(0), gap).alias("days_before_vote"),
        F.greatest(F.lit(0), -gap).alias("days_after_vote"),
    ]


#: Bills or members of a class that one array holds, or a hundred-thousandth of all if that is more: so 100,000 classes at most have several arrays.
CLASS_PART = 1_000


def _classes(held: DataFrame, key: str, name: str, most: int, tasks: int) -> tuple[DataFrame, DataFrame]:
    """Classes of rows that hold the same (``_held``) with their number of parts, and the parts with arrays of ``most`` keys or so, dealt to tasks.

    A class is known by a hash of 128 bits, so rows don't meet to learn theirs; the sizes of classes of several parts are broadcast.
    """
    own = held.withColumn(name, F.md5(F.to_json("_held")))
    classes = own.groupBy(name).agg(F.first("_held").alias("_held"), F.ceil(F.count("*") / most).cast("int").alias(f"{name}_parts"))
    large = classes.where(F.col(f"{name}_parts") > 1).select(name, f"{name}_parts")
    part = F.pmod(F.xxhash64(key), F.coalesce(f"{name}_parts", F.lit(1))).cast("int").alias(f"{name}_part")
    dealt = own.join(F.broadcast(large), name, "left").select(name, part, F.struct(key).alias("_key")).repartition(tasks, name, f"{name}_part")
    return classes, dealt.groupBy(name, f"{name}_part").agg(F.collect_list("_key").alias(f"{name}_keys"))


def _all_roles(bill_committees: DataFrame, memberships: DataFrame) -> DataFrame:
    """``committee_roles`` of all bills and members.

    The role is found once for each class of bills and of members; then arrays of the bills of one
    meet arrays of the members of the other and become rows there, so no pair is shuffled.
    """
    handled, seats = (rows.where("committee_canonical is not null") for rows in (bill_committees, memberships))
    sizes = [rows.groupBy("committee_canonical").agg(F.count("*").cast("double").alias(n)) for rows, n in ((handled, "_x"), (seats, "_y"))]
    x, y, work = sizes[0].join(sizes[1], "committee_canonical", "full").agg(F.sum("_x"), F.sum("_y"), F.sum(F.col("_x") * F.col("_y"))).first()
    tasks, most = pair_tasks(handled, work), lambda n: max(CLASS_PART, int((n or 0) // HEAVY_ITEMS))
    bills, bill_parts = _classes(handled.groupBy("bill_id").agg(F.array_sort(F.collect_set("committee_canonical")).alias("_held")), "bill_id", "_b", most(x), tasks)
    members, member_parts = _classes(seats.groupBy("member_id").agg(F.array_sort(F.collect_set(F.struct("committee_canonical", "role"))).alias("_held")), "member_id", "_m", most(y), tasks)
    # Spark takes the rows for as small as their compressed file; they aren't to be broadcast
    met = bills.select("_b", F.explode("_held").alias("committee_canonical")).hint("merge").join(members.select("_m", "_m_parts", F.inline("_held")), "committee_canonical")
    roles = met.groupBy("_b", "_m", "_m_parts").agg(F.min_by("role", role_rank(F.col("role"))).alias("member_committee_role"))
    left = roles.hint("merge").join(bill_parts, "_b").select("_b_keys", "_m", F.explode(F.sequence(F.lit(0), F.col("_m_parts") - 1)).alias("_m_part"), "member_committee_role")
    pairs = left.repartition(tasks, "_m", "_m_part").hint("merge").join(member_parts, ["_m", "_m_part"])
    return pairs.select("_m_keys", "member_committee_role", F.inline("_b_keys")).select("bill_id", F.inline("_m_keys"), "member_committee_role")


def committee_roles(bill_committees: DataFrame, memberships: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(bill_id, member_id, member_committee_role): the highest role on a committee that handled the bill.

    With pairs (bill_id, member_id) only those are looked up, so rows grow with the pairs; without,
    every member of every committee of every bill is a row.
    """
    if pairs is None:
        return _all_roles(bill_committees, memberships)
    asked = pairs.select("bill_id", "member_id").where("bill_id is not null").distinct()
    handled = asked.join(bill_committees.select("bill_id", "committee_canonical"), "bill_id")
    found = handled.join(memberships.select("member_id", "committee_canonical", "role"), ["member_id", "committee_canonical"])
    return found.groupBy("bill_id", "member_id").agg(F.min_by("role", role_rank(F.col("role"))).alias("member_committee_role"))


def committee_role_classes(bill_committees: DataFrame, memberships: DataFrame) -> DataFrame:
    """(kind, bill_id, member_id, class_id, member_committee_role, n): all of ``committee_roles`` by classes.

    Bills of the same committees are one class, known by its smallest bill, and members of the same committees and roles another. kind role: a
    class of bills, a class of members, their role and n, the number of pairs that it holds for. kind bill and member: each bill and member with
    its class and n, the number of members or bills that it is paired with.
    """
    handled = bill_committees.where("committee_canonical is not null").groupBy("bill_id").agg(F.array_sort(F.collect_set("committee_canonical")).alias("_held"))
    seats = memberships.where("committee_canonical is not null").groupBy("member_id").agg(F.array_sort(F.collect_set(F.struct("committee_canonical", "role"))).alias("_held"))
    bills = handled.groupBy("_held").agg(F.min("bill_id").alias("bill_id"), F.count("*").alias("_bills"))
    members = seats.groupBy("_held").agg(F.min("member_id").alias("member_id"), F.count("*").alias("_members"))
    met = bills.select("bill_id", "_bills", F.explode("_held").alias("committee_canonical")).join(members.select("member_id", "_members", F.inline("_held")), "committee_canonical")
    roles = met.groupBy("bill_id", "member_id", "_bills", "_members").agg(F.min_by("role", role_rank(F.col("role"))).alias("member_committee_role"))

    def of(rows: DataFrame, classes: DataFrame, key: str, other: str) -> DataFrame:
        each = roles.groupBy(F.col(key).alias("_class")).agg(F.sum(other).alias("n"))
        known = classes.select("_held", F.col(key).alias("_class")).join(each, "_class", "left")
        # Spark takes bills and members for as small as their compressed files; they aren't to be broadcast
        return rows.hint("merge").join(known, "_held").select(F.lit(key.removesuffix("_id")).alias("kind"), key, F.col("_class").cast("string").alias("class_id"), F.coalesce("n", F.lit(0)).alias("n"))

    found = roles.select(F.lit("role").alias("kind"), "bill_id", "member_id", "member_committee_role", (F.col("_bills") * F.col("_members")).alias("n"))
    both = found.unionByName(of(handled, bills, "bill_id", "_members"), allowMissingColumns=True).unionByName(of(seats, members, "member_id", "_bills"), allowMissingColumns=True)
    return both.select("kind", "bill_id", "member_id", "class_id", "member_committee_role", "n")


def committee_names(bill_committees: DataFrame) -> DataFrame:
    """(bill_id, bill_committees): names in order, joined."""
    names = F.array_join(F.sort_array(F.collect_list("committee_name")), " · ")
    return bill_committees.groupBy("bill_id").agg(names.alias("bill_committees"))


def with_roles(votes: DataFrame, bill_committees: DataFrame, memberships: DataFrame) -> DataFrame:
    """Votes with the voter's role on the bill's committees. Found on the votes, before any join multiplies them."""
    roles = committee_roles(bill_committees, memberships, votes).withColumn("member_on_bill_committee", F.lit(True))
    return votes.join(roles, ["bill_id", "member_id"], "left").withColumn("member_on_bill_committee", F.coalesce("member_on_bill_committee", F.lit(False)))


def with_bills(rows: DataFrame, bills: DataFrame, bill_committees: DataFrame) -> DataFrame:
    """Rows with a bill_id with its title, summary and committees."""
    return rows.join(bills.select("bill_id", "bill_title", "bill_summary"), "bill_id", "left").join(committee_names(bill_committees), "bill_id", "left")


def near_votes(trades: DataFrame, votes: DataFrame, members: DataFrame, window: int) -> DataFrame:
    """Each trade with each vote of its member within the window, and the days between them."""
    t = trades.join(members.select("member_id", F.col("name").alias("member_name")), "member_id")
    return band_join(t, votes, ["member_id"], "tx_date", "vote_date", window).select("*", *gap_columns("tx_date", "vote_date"))


def trades_near_votes(
    trades: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, bill_committees: DataFrame, memberships: DataFrame, window: int = 180
) -> DataFrame:
    """Each trade with each vote of its member within the window, with bill, committees and role."""
    known = with_bills(with_roles(votes, bill_committees, memberships), bills, bill_committees)
    return near_votes(trades, known, members, window)


def is_discretionary(fund_words: tuple[str, ...] = FUND_WORDS) -> Column:
    """Neither a passive kind of asset nor, among free-text kinds, a fund by its name. Null kinds don't pass."""
    fund = F.lit(False)
    for word in fund_words:
        fund = fund | F.contains(F.lower("asset"), F.lit(word))
    return ~F.col("asset_type").isin(*PASSIVE_KINDS) & ~(F.col("asset_type").isin(*FREE_TEXT_KINDS) & fund)


def mentions(text: Column, word: Column) -> Column:
    """The word with a space on a side where the text goes on, in any case; false for nulls and for a text that is the word."""
    t, w = F.lower(text), F.lower(word)
    found = F.contains(t, F.concat(F.lit(" "), w, F.lit(" "))) | F.startswith(t, F.concat(w, F.lit(" "))) | F.endswith(t, F.concat(F.lit(" "), w))
    return F.coalesce(found, F.lit(False))


#: Up to a window of so many days there are fewer pairs than votes.
NARROW = 30


def trades_before_votes(trades: DataFrame, votes: DataFrame, *others: DataFrame, window: int = 180) -> DataFrame:
    """Discretionary trades on or before a vote's day; filtered before they are joined."""
    near = _narrow(trades.where(is_discretionary()), votes, *others, window=window) if window <= NARROW else trades_near_votes(trades.where(is_discretionary()), votes, *others, window=window)
    return near.where("days_from_trade_to_vote >= 0").withColumn("bill_mentions_ticker", mentions(F.col("bill_summary"), F.col("ticker")))


def _narrow(trades: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, bill_committees: DataFrame, memberships: DataFrame, window: int) -> DataFrame:
    """The rows of ``trades_near_votes`` on or before a vote's day, for windows in which few votes have a trade: votes are read once and meet
    trades before anything is looked up, so that bills, committees and roles are brought to the pairs alone.
    """
    t = trades.join(members.select("member_id", F.col("name").alias("member_name")), "member_id")
    pairs = band_join(t, votes, ["member_id"], "tx_date", "vote_date", window, forward_only=True).select("*", *gap_columns("tx_date", "vote_date"))
    handled = bill_committees.where("committee_canonical is not null").groupBy("bill_id").agg(F.collect_set("committee_canonical").alias("_handled"))
    known = bills.select("bill_id", "bill_title", "bill_summary").join(handled, "bill_id", "full").join(committee_names(bill_committees), "bill_id", "full").withColumnRenamed("bill_id", "_bill")
    seats = memberships.where("committee_canonical is not null").groupBy("member_id").agg(F.collect_set(F.struct(role_rank(F.col("role")).alias("rank"), "role", "committee_canonical")).alias("_seats"))
    # pairs without a bill are dealt by their vote, and bills and members aren't broadcast (see ``with_handled``)
    dealt = pairs.withColumn("_key", F.coalesce("bill_id", F.concat(F.lit("-"), F.col("vote_id").cast("string"))))
    found = dealt.hint("merge").join(known, (F.col("_key") == F.col("_bill")) & F.col("bill_id").isNotNull(), "left").drop("_key", "_bill")
    found = found.hint("merge").join(seats, "member_id", "left")
    own = F.coalesce(F.filter("_seats", lambda seat: F.array_contains("_handled", seat["committee_canonical"])), F.array().cast(found.schema["_seats"].dataType))
    best = F.array_min(F.transform(F.filter(own, lambda seat: seat["rank"].isNotNull()), lambda seat: F.struct(seat["rank"], seat["role"].alias("role"))))
    return found.withColumns({"member_committee_role": best["role"], "member_on_bill_committee": F.size(own) > 0}).drop("_handled", "_seats")


def with_handled(votes: DataFrame, bills: DataFrame, bill_committees: DataFrame) -> DataFrame:
    """Votes with their bill's summary and ``handled``, the set of its committees.

    Votes without a bill, which may be many, match nothing: they are dealt by their own id, so that they aren't gathered in one task.
    """
    handled = bill_committees.where("committee_canonical is not null").groupBy("bill_id").agg(F.collect_set("committee_canonical").alias("handled"))
    known = bills.select("bill_id", "bill_summary").join(handled, "bill_id", "full").withColumnRenamed("bill_id", "_bill")
    dealt = votes.withColumn("_key", F.coalesce("bill_id", F.concat(F.lit("-"), F.col("vote_id").cast("string"))))
    # Spark takes bills and members for as small as their compressed files; they aren't to be broadcast
    return dealt.hint("merge").join(known, (F.col("_key") == F.col("_bill")) & F.col("bill_id").isNotNull(), "left").drop("_key", "_bill")


def mentioning_votes(trades: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, bill_committees: DataFrame, memberships: DataFrame, named: Column, window: int = 180) -> DataFrame:
    """(member_id, vote_id, vote_date, committee, named): the votes of ``trades_before_votes``, each once, and what ``named`` makes of the tickers of its trades that the bill's summary mentions.

    Votes are read once. Their pairs with trades are summed where they are made, since all pairs of a vote lie in its bucket, and are
    never stored. A trade carries its member's committees, a vote those of its bill.
    """
    seats = memberships.where("committee_canonical is not null").groupBy("member_id").agg(F.collect_set("committee_canonical").alias("_seats"))
    known = with_handled(votes.select("member_id", "vote_id", "vote_date", "bill_id"), bills, bill_committees).drop("bill_id")
    t = trades.where(is_discretionary()).select("member_id", "tx_date", "ticker").join(members.select("member_id"), "member_id").hint("merge").join(seats, "member_id", "left")
    pairs = band_join(t, known, ["member_id"], "tx_date", "vote_date", window, forward_only=True, bucket_name="_at")
    on, told = F.coalesce(F.arrays_overlap("handled", "_seats"), F.lit(False)), F.when(mentions(F.col("bill_summary"), F.col("ticker")), named)
    found = pairs.groupBy("member_id", "_at", "vote_id", "vote_date").agg(F.max(on).alias("committee"), F.array_sort(F.collect_set(told)).alias("named"))
    return found.drop("_at")


TRADE_KEY = ["filing_id", "tx_date", "tx_type", "asset", "ticker"]


def cap_per_trade(near: DataFrame, window: int, closest: int = 6) -> DataFrame:
    """Of each trade's votes within the window the closest, and the closest with a committee; with the count of all.

    The order is total: gap, then vote, band and holder. One sort gives both ranks: rows with a
    committee rank by how many such rows came so far, the others after all of these.
    """
    key = Window.partitionBy(*TRADE_KEY)
    close = key.orderBy("days_abs", *(F.col(c).asc_nulls_last() for c in ("vote_id", "amount_band", "holder")))
    on = F.col("member_on_bill_committee")
    so_far = F.count_if(on).over(close.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        near.where(F.col("days_abs") <= window)
        .withColumn("rn_close", F.row_number().over(close))
        .withColumn("_on", so_far)
        .withColumn("window_vote_count", F.count("*").over(key))
        .withColumn("_all_on", F.count_if(on).over(key))
        .withColumn("rn_cmte", F.when(on, F.col("_on")).otherwise(F.col("_all_on") + F.col("rn_close") - F.col("_on")).cast("int"))
        .where((F.col("rn_close") <= closest) | (on & (F.col("rn_cmte") == 1)))
        .drop("_on", "_all_on")
    )


def capped_near_votes(
    trades: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, bill_committees: DataFrame, memberships: DataFrame, window: int = 90, closest: int = 6
) -> DataFrame:
    """Near votes capped per trade; bills are joined to what the cap leaves."""
    near = near_votes(trades, with_roles(votes, bill_committees, memberships), members, window)
    return with_bills(cap_per_trade(near, window, closest), bills, bill_committees)


def next_same_kind(events: DataFrame, by: list[str], date: str, is_trade: str, window: int) -> DataFrame:
    """For each trade row of one table of trades and votes the days to the next vote at or after it; only those within the window.

    One pass over sorted groups, without a join: the next vote's date is the first that isn't null
    from the row on, with a day's trades before its votes.
    """
    order = Window.partitionBy(*by).orderBy(F.col(date), F.col(is_trade).desc()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    vote_day = F.first(F.when(~F.col(is_trade), F.col(date)), ignorenulls=True).over(order)
    gap = F.datediff(vote_day, F.col(date))
    return events.withColumn("gap", gap).where(F.col(is_trade) & (F.col("gap") <= window))
