"""Seeded permutation null models, for all members at once.

A permutation of a member is a row of the plan: draws are column expressions of (seed, permutation,
slot), so no state passes from one to the next, and counts are summed before anything shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.rng import STEP, draw, draws, seed_from
from tracewell.scratch import staged

from .detectors import no_market_fund, no_word
from .ordering import numbered
from .proximity import is_discretionary, mentioning_votes

NEXUS_DAYS, GAP_DAYS, SHUFFLE_FROM = 14, 90, 50


def substrate(before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct trades (member_id, filing_id, tx_date, tx_type, instrument, slot) and votes (member_id, vote_id, vote_date, committee, named).

    Slots number a member's trades from 0 in a total order. A vote's committee flag holds if any
    row has it; named is the set of tickers that the bill names, without words of the language.
    """
    instrument = F.upper(F.coalesce("ticker", "asset")).alias("instrument")
    trades = before.where(no_market_fund()).select("member_id", "filing_id", "tx_date", "tx_type", instrument).distinct()
    slot = F.row_number().over(Window.partitionBy("member_id").orderBy("filing_id", "tx_date", "tx_type", "instrument")) - 1  # a person's trades
    named = F.when(F.col("bill_mentions_ticker") & no_word(), F.upper("ticker"))
    votes = before.groupBy("member_id", "vote_id", "vote_date").agg(F.max("member_on_bill_committee").alias("committee"), F.array_sort(F.collect_set(named)).alias("named"))
    return trades.withColumn("slot", slot), votes


def near_substrate(
    trades: DataFrame, votes: DataFrame, members: DataFrame, bills: DataFrame, bill_committees: DataFrame, memberships: DataFrame, window: int = 180
) -> tuple[DataFrame, DataFrame]:
    """The tables of ``substrate`` for ``trades_before_votes`` of these tables, both staged; no pair of a trade and a vote is stored.

    A trade is kept if one of the votes kept comes on its day or up to ``window`` days later.
    """
    named = F.when(no_word(), F.upper("ticker"))
    found = staged(mentioning_votes(trades, votes, members, bills, bill_committees, memberships, named, window), "null-votes")
    tasks = _member_tasks(found)
    days = found.select("member_id", F.unix_date("vote_date").alias("day")).repartition(tasks, "member_id")
    first = F.min("day").over(Window.partitionBy("member_id")) - window
    reached = hit_words(days.withColumn("first", first), ["member_id", "first"], window)
    own = trades.where(is_discretionary() & no_market_fund()).join(members.select("member_id"), "member_id").repartition(tasks, "member_id").join(reached, "member_id")
    kept = own.where(has_day(F.col("words"), F.unix_date("tx_date") - F.col("first")))
    kept = kept.select("member_id", "filing_id", "tx_date", "tx_type", F.upper(F.coalesce("ticker", "asset")).alias("instrument")).distinct()
    slot = F.row_number().over(Window.partitionBy("member_id").orderBy("filing_id", "tx_date", "tx_type", "instrument")) - 1  # a person's trades
    return staged(kept.withColumn("slot", slot), "null-trades"), found


def hit_days(days: Column, first: Column, last: Column, window: Column | int) -> Column:
    """For each day from first to last whether one of the sorted days comes on it or up to ``window`` days later.

    Built in one pass: between two of the days the last ``window`` + 1 hit and those before don't.
    """
    whole = lambda c: c.cast("int")
    window = F.lit(window) if isinstance(window, int) else window
    lead = lambda before, day: F.concat(
        F.array_repeat(F.lit(False), whole(F.greatest(day - before - window - 1, F.lit(0)))), F.array_repeat(F.lit(True), whole(F.least(day - before, window + 1)))
    )
    before = F.concat(F.array(whole(first - 1)), F.slice(days, 1, F.greatest(F.size(days) - 1, F.lit(0))))
    some = F.concat(F.flatten(F.zip_with(before, days, lead)), F.array_repeat(F.lit(False), whole(last - F.try_element_at(days, F.lit(-1)))))
    return F.when(F.coalesce(F.size(days), F.lit(0)) > 0, some).otherwise(F.array_repeat(F.lit(False), whole(last - first + 1)))


def hit_words(days: DataFrame, by: list[str], window: Column | int) -> DataFrame:
    """(by, words) from rows (by, day, first): the days from ``first`` on that have one of the days on them or up to ``window`` days later.

    Days are bits of whole numbers, 64 in each, so that seven years take 40 numbers. A day sets its bits of a word
    at once, and they are combined before anything shuffles.
    """
    window = F.lit(window) if isinstance(window, int) else window
    low, high = F.greatest(F.col("day") - window - F.col("first"), F.lit(0)), F.col("day") - F.col("first")
    word = F.explode(F.sequence(F.floor(low / 64).cast("int"), F.floor(high / 64).cast("int")))
    spread = days.where("day >= first").select(*by, low.alias("_low"), high.alias("_high"), word.alias("_word"))
    start, end = F.greatest(F.col("_low") - F.col("_word") * 64, F.lit(0)), F.least(F.col("_high") - F.col("_word") * 64, F.lit(63))
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (63 - end + start).cast("int"))
    bits = spread.select(*by, "_word", F.call_function("shiftleft", ones, start.cast("int")).alias("_bit"))
    words = bits.groupBy(*by, "_word").agg(F.bit_or("_bit").alias("_bits")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    dense = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("_held"))), lambda w: F.coalesce(F.try_element_at("_held", w), F.lit(0).cast("long")))
    return words.select(*by, dense.alias("words"))


def has_day(words: Column, at: Column) -> Column:
    """Whether the day so many days after the first is among the words' days; false where there are no words."""
    word = F.get(words, F.floor(at / 64).cast("int"))
    return F.coalesce(F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1, F.lit(False))


#: Votes of a task that makes words of them. A member's words are larger than the dates that they are made of, so that bytes don't tell.
TASK_VOTES = 200_000


def _member_tasks(votes: DataFrame) -> int:
    """How many tasks share what is made of members' votes; the memory of each stays the same as votes grow."""
    return 4 + votes.count() // TASK_VOTES


def _spans(trades: DataFrame, votes: DataFrame) -> DataFrame:
    """(member_id, first, last): day numbers of each member's first and last trade or vote."""
    dates = trades.select("member_id", F.unix_date("tx_date").alias("d")).unionAll(votes.select("member_id", F.unix_date("vote_date").alias("d")))
    return dates.groupBy("member_id").agg(F.min("d").alias("first"), F.max("d").alias("last"))


def _known(trades: DataFrame, votes: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(member_id, first, last, n_trades, committee_on) of each member, and (member_id, instrument, named_on); n_trades is null without trades.

    The days, as words from the member's first day on, that committee votes, and votes that name the ticker, make hits: found once for a member, and once
    for a ticker that a bill names, not for each trade.
    """
    tasks = _member_tasks(votes)
    dealt = votes.select("member_id", F.unix_date("vote_date").alias("day"), "committee", "named").repartition(tasks, "member_id")
    own = trades.select("member_id", F.unix_date("tx_date").alias("day")).repartition(tasks, "member_id")
    span = lambda df, n, *more: df.groupBy("member_id").agg(F.min("day").alias(f"f{n}"), F.max("day").alias(f"l{n}"), *more)
    both = span(own, 1, F.count("*").alias("n_trades")).join(span(dealt, 2), "member_id", "full")
    spans = both.select("member_id", F.least("f1", "f2").alias("first"), F.greatest("l1", "l2").alias("last"), "n_trades")
    dated = dealt.hint("merge").join(spans.select("member_id", "first"), "member_id")
    committee = hit_words(dated.where("committee").select("member_id", "day", "first").distinct(), ["member_id"], window)
    named = hit_words(dated.select("member_id", "day", "first", F.explode("named").alias("instrument")).distinct(), ["member_id", "instrument"], window)
    return spans.hint("merge").join(committee.withColumnRenamed("words", "committee_on"), "member_id", "left"), named.withColumnRenamed("words", "named_on")


def _observed(trades: DataFrame, members: DataFrame, named: DataFrame) -> DataFrame:
    # days are looked up where they are joined; no row carries them on
    at = lambda: F.unix_date("tx_date") - F.col("first")
    rows = trades.select("member_id", "instrument", "tx_date").join(members.select("member_id", "first", "committee_on"), "member_id")
    rows = rows.select("member_id", "instrument", at().alias("at"), has_day(F.col("committee_on"), at()).alias("hit"))
    rows = rows.join(named, ["member_id", "instrument"], "left").select("member_id", (F.col("hit") | has_day(F.col("named_on"), F.col("at"))).alias("hit"))
    return rows.groupBy("member_id").agg(F.count("*").alias("n_trades"), F.count_if("hit").alias("observed"))


def observed_nexus(trades: DataFrame, votes: DataFrame, window: int = NEXUS_DAYS) -> DataFrame:
    """(member_id, n_trades, observed): trades that a committee vote or a vote naming their ticker follows within the window, each once."""
    return _observed(trades, *_known(trades, votes, window))


def weekdays_between(first: Column, last: Column) -> Column:
    """How many days from Monday to Friday there are from day number first to last. Day 0 was a Thursday."""
    upto = lambda d: F.floor((d + 3) / 7) * 5 + F.least(F.pmod(d + 3, F.lit(7)) + 1, F.lit(5))
    return upto(last) - upto(first - 1)


def nth_weekday(first: Column, n: Column) -> Column:
    """The day number of weekday n, from 0, on or after first."""
    place = F.pmod(first + 3, F.lit(7))
    start = first + F.when(place > 4, 7 - place).otherwise(0)
    return start + n + 2 * F.floor((F.pmod(start + 3, F.lit(7)) + n) / 5)


def _spread(rows: DataFrame, n_perm: int) -> DataFrame:
    return rows.withColumn("perm", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))


def _drawn_day(slot: Column) -> Column:
    """The weekday of the member's span that the draw of a row's slot falls on."""
    return nth_weekday(F.col("first"), F.floor(draw(F.col("seed"), F.col("perm") * F.col("n_trades") + slot) * F.col("weekdays")))


def _seeds(seed: str) -> Column:
    return seed_from(F.concat(F.lit(f"{seed}:"), F.col("member_id").cast("string"))).alias("seed")


def _pools(members: DataFrame, seed: str) -> DataFrame:
    """(member_id, first, last, n_trades, weekdays, seed) and what else members hold, of those whose span holds a weekday and who have trades."""
    return members.where("n_trades > 0").withColumns({"weekdays": weekdays_between(F.col("first"), F.col("last")), "seed": _seeds(seed)}).where("weekdays > 0")


#: Draws of a task. Rows that are to be drawn are small, so that their bytes say nothing of the work they make.
TASK_DRAWS = 4_000_000


def _tasks(trades: DataFrame, n_perm: int) -> int:
    """How many tasks share the draws of all trades: the work and memory of each stay the same as members grow."""
    return 1 + trades.count() * n_perm // TASK_DRAWS


def calendar_null(trades: DataFrame, votes: DataFrame, n_perm: int, seed: str, window: int = NEXUS_DAYS, block: int = 256) -> DataFrame:
    """(member_id, perm, drawn): each trade moved to a random weekday between the member's first and last date.

    Trade i of permutation p takes draw p * T + i of the member's sequence, and falls on the k-th
    weekday by arithmetic. Trades of instruments that no bill names differ in their slots alone, which
    are 0 to T - 1: they need no rows, only blocks of slots, each with the member's days of
    committee hits. Trades of named instruments add the draws that only the naming makes a hit.
    """
    return _calendar(trades, *_known(trades, votes, window), n_perm, seed, _tasks(trades, n_perm), block)


def _calendar(trades: DataFrame, members: DataFrame, named: DataFrame, n_perm: int, seed: str, tasks: int, block: int = 256) -> DataFrame:
    pools = _pools(members, seed)
    blocks = pools.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_trades") - 1) / block))))
    # dealt, so that a member with many trades is drawn by many tasks
    dealt = blocks.repartition(tasks, "member_id", "block")
    slots = F.explode(F.sequence(F.col("block") * block, F.least(F.col("block") * block + block, F.col("n_trades")) - 1))
    day = (_drawn_day(F.col("slot")) - F.col("first")).cast("int")
    count = lambda rows, hit: _spread(rows, n_perm).groupBy("member_id", "perm").agg(F.count_if(hit).alias("drawn"))
    all_slots = dealt.select("member_id", "first", "weekdays", "n_trades", "seed", "committee_on", slots.alias("slot"))
    by_committee = count(all_slots, has_day(F.col("committee_on"), day))
    only = _without(F.col("named_on"), F.coalesce("committee_on", F.array().cast("array<bigint>")))
    only_named = named.join(pools.drop("last"), "member_id").withColumn("named_on", only).drop("committee_on")
    rows = trades.select("member_id", "instrument", "slot").join(only_named, ["member_id", "instrument"]).repartition(tasks, "member_id", "slot")
    by_name = count(rows, has_day(F.col("named_on"), day)).where("drawn > 0")
    return by_committee.unionAll(by_name).repartition(tasks, "member_id").groupBy("member_id", "perm").agg(F.sum("drawn").alias("drawn"))


def _without(words: Column, others: Column) -> Column:
    """The days of words that others doesn't have."""
    return F.transform(words, lambda w, i: w.bitwiseAND(F.bitwise_not(F.coalesce(F.get(others, i), F.lit(0).cast("long")))))


def _shuffles(days: np.ndarray, seeds: np.ndarray, first: int, last: int) -> np.ndarray:
    """Of each row of days of T trades, with its own seed, the permutations first to last: [row, permutation, place].

    A permutation takes T - 1 draws, from the last place down; a step swaps in all of them at once.
    """
    (rows, n), count = days.shape, last - first
    out = np.repeat(days, count, 0)
    if n > 1:
        line = draws(seeds + STEP * (n - 1) * first, (n - 1) * count).reshape(rows * count, n - 1)
        each = np.arange(rows * count)
        for i in range(n - 1, 0, -1):
            j = (line[:, n - 1 - i] * (i + 1)).astype(np.int64)
            out[each, j], out[:, i] = out[:, i].copy(), out[each, j]
    return out.reshape(rows, count, n)


#: Days that a task shuffles at once.
SHUFFLED_DAYS = 1_000_000


def _shuffled(trades: DataFrame, others: DataFrame, columns: dict[str, Column], n_perm: int, seed: str, block: int, count, schema: str) -> DataFrame:
    """What ``count`` makes of the shuffled days of members (with their rows of others, arrays in the order of their slots), for blocks of permutations.

    A member's trades are one row, as a shuffle of them is one sequence of swaps; permutations are dealt to tasks in blocks, fewer in
    a block where trades are many. Rows of as many trades are shuffled together: count gets the batch, the places of such rows in it,
    their permutations and days [row, permutation, slot].
    """
    listed = F.array_sort(F.collect_list(F.struct("slot", F.unix_date("tx_date").alias("day"), *(c.alias(k) for k, c in columns.items()))))
    one = trades.groupBy("member_id").agg(listed.alias("t"), F.first(_seeds(seed)).alias("seed")).join(others, "member_id")
    size = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(SHUFFLED_DAYS / F.size("t")))).cast("int")
    sized = one.withColumn("size", size)
    blocks = sized.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((n_perm - 1) / F.col("size")).cast("int")))).repartition("member_id", "block")
    own = [c for c in others.columns if c != "member_id"]
    flat = blocks.select("member_id", "seed", "size", "block", F.col("t.slot").alias("slot"), F.col("t.day").alias("day"), *(F.col(f"t.{k}").alias(k) for k in columns), *own)

    def run(batches):
        for batch in batches:
            number = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            days, starts, lengths = _lists(batch.column("day"))
            begins = number("block") * number("size")
            kinds = np.stack([lengths, begins, np.minimum(begins + number("size"), n_perm)])
            for n, first, last in np.unique(kinds, axis=1).T.tolist():
                rows = np.flatnonzero((kinds == [[n], [first], [last]]).all(0))
                most = max(1, SHUFFLED_DAYS // (n * (last - first)))
                for part in (rows[i : i + most] for i in range(0, len(rows), most)):
                    moved = _shuffles(days[starts[part][:, None] + np.arange(n)], number("seed")[part], first, last)
                    yield count(batch, part, np.arange(first, last), moved)

    kind = trades.schema["member_id"].dataType.simpleString()
    return flat.mapInArrow(run, f"member_id {kind}, {schema}")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a column of lists of numbers, nulls among them as -1, and where each list begins and how long it is; a null list is empty."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    return column.values.fill_null(-1).to_numpy(), offsets[:-1], lengths


def shuffled_dates(trades: DataFrame, n_perm: int, seed: str, block: int = 200) -> DataFrame:
    """(member_id, perm, slot, day): the member's own trade dates in random order."""

    def count(batch, part, perms, moved):
        slots, starts, _ = _lists(batch.column("slot"))
        rows, p, n = moved.shape
        of = slots[starts[part][:, None] + np.arange(n)]
        member = batch.column("member_id").take(pa.array(np.repeat(part, p * n)))
        perm, slot = np.tile(np.repeat(perms, n), rows), np.repeat(of[:, None, :], p, 1).ravel()
        return pa.record_batch([member, pa.array(perm, pa.int32()), pa.array(slot, pa.int32()), pa.array(moved.ravel(), pa.int32())], ["member_id", "perm", "slot", "day"])

    return _shuffled(trades, trades.select("member_id").distinct(), {}, n_perm, seed, block, count, "perm int, slot int, day int")


def shuffle_null(trades: DataFrame, votes: DataFrame, n_perm: int, seed: str, window: int = NEXUS_DAYS, block: int = 200) -> DataFrame:
    """(member_id, perm, drawn) with the member's own dates shuffled among its trades; counted where they are shuffled."""
    return _shuffle(trades, *_known(trades, votes, window), n_perm, seed, block)


def _has(words: tuple[np.ndarray, np.ndarray, np.ndarray], lists: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether days are among those of the numbered lists of words; lists: one for each day, -1 for none."""
    bits, starts, lengths = words
    word = at >> 6
    inside = (lists >= 0) & (word >= 0) & (word < (lengths[lists] if len(lengths) else 0))
    out = np.zeros(at.shape, bool)
    out[inside] = bits[starts[lists[inside]] + word[inside]].view(np.uint64) >> (at[inside] & 63).astype(np.uint64) & np.uint64(1)
    return out


def _shuffle(trades: DataFrame, members: DataFrame, named: DataFrame, n_perm: int, seed: str, block: int = 200) -> DataFrame:
    # a trade carries the number of its instrument alone; the instrument's days stand once with the member
    numbers = named.withColumn("nth", F.row_number().over(Window.partitionBy("member_id").orderBy("instrument")) - 1)
    marked = trades.join(numbers.drop("named_on"), ["member_id", "instrument"], "left")
    listed = numbers.groupBy("member_id").agg(F.array_sort(F.collect_list(F.struct("nth", "named_on"))).alias("_l")).select("member_id", F.col("_l.named_on").alias("named"))

    def count(batch, part, perms, moved):
        own = lambda name: batch.column(name)
        at = moved - own("first").to_numpy()[part].astype(np.int64)[:, None, None]
        hit = _has(_lists(own("committee_on")), np.broadcast_to(part[:, None, None], at.shape), at)
        of, starts, _ = _lists(own("nth"))
        nth = of[starts[part][:, None] + np.arange(at.shape[2])].astype(np.int64)
        named_from = own("named").offsets.to_numpy().astype(np.int64)[part][:, None]
        lists = np.where(nth < 0, -1, named_from + nth)
        hit |= _has(_lists(own("named").values), np.broadcast_to(lists[:, None, :], at.shape), at)
        member = own("member_id").take(pa.array(np.repeat(part, len(perms))))
        return pa.record_batch([member, pa.array(np.tile(perms, len(part)), pa.int32()), pa.array(hit.sum(2).ravel(), pa.int64())], ["member_id", "perm", "drawn"])

    by_member = members.select("member_id", "first", "committee_on").join(listed, "member_id", "left")
    return _shuffled(marked, by_member, {"nth": F.col("nth")}, n_perm, seed, block, count, "perm int, drawn long")


def summary(observed: DataFrame, drawn: DataFrame, by: list[str]) -> DataFrame:
    """expected, population sd, z (0 if sd is 0) and the upper tail, the share of draws not below what was observed."""
    joined = drawn.join(observed.select(*by, "observed"), by)
    stats = joined.groupBy(*by, "observed").agg(
        F.avg("drawn").alias("expected"), F.stddev_pop("drawn").alias("sd"), F.avg((F.col("drawn") >= F.col("observed")).cast("int")).alias("p_value"), F.count("*").alias("n_perm")
    )
    z = F.when(F.col("sd") == 0, 0.0).otherwise((F.col("observed") - F.col("expected")) / F.col("sd"))
    return stats.withColumn("z_score", z)


def nexus_test(trades: DataFrame, votes: DataFrame, n_perm: int, seed: str, window: int = NEXUS_DAYS) -> DataFrame:
    """The test for each member: dates shuffled from 50 trades on, calendar draws below. Both tables are read several times: pass them staged.

    What both halves and the observed counts need of votes is found once and staged, one step after the other, so that no step waits for all
    of the others' tasks.
    """
    members, named = (staged(df, f"test-{name}") for df, name in zip(_known(trades, votes, window), ("members", "named")))
    observed = staged(_observed(trades, members, named), "test-observed")
    low = _calendar(trades, members.where(F.col("n_trades") < SHUFFLE_FROM), named, n_perm, seed, _tasks(trades, n_perm))
    many = members.where(F.col("n_trades") >= SHUFFLE_FROM)
    high = _shuffle(trades.join(many.select("member_id"), "member_id", "left_semi"), many, named, n_perm, seed)
    return summary(observed, low.unionByName(high), ["member_id"])


def _gap(days: Column, day: Column, window: int) -> Column:
    """Days to the first of the sorted days from the given one on; null beyond the window."""
    return F.array_min(F.transform(F.filter(days, lambda d: d.between(day, day + window)), lambda d: d - day))


def observed_gaps(trades: DataFrame, theme_votes: DataFrame, window: int = GAP_DAYS) -> DataFrame:
    """(member_id, trade_id, observed_gap): days to the next vote of the trade's theme, of trades that have one within the window."""
    days = theme_votes.groupBy("member_id", "theme").agg(F.array_sort(F.collect_set(F.unix_date("vote_date"))).alias("days"))
    gap = _gap(F.col("days"), F.unix_date("tx_date"), window)
    found = trades.join(days, ["member_id", "theme"]).select("member_id", "trade_id", gap.alias("observed_gap")).where("observed_gap is not null")
    return found.groupBy("member_id", "trade_id").agg(F.min("observed_gap").alias("observed_gap"))


def pair_lower_tail(trades: DataFrame, theme_votes: DataFrame, n_perm: int, seed: str, observed: DataFrame, mode: str = "calendar", block: int = 200) -> DataFrame:
    """(member_id, trade_id, observed_gap, p_pair) for those trades (member_id, slot, trade_id, tx_date, theme) that observed (member_id, trade_id, observed_gap) has.

    p is (1 + permutations with a gap not above the observed one) / (n_perm + 1); of several slots
    with one trade_id any may come near. mode: calendar draws, or shuffle of the member's own trade
    dates. Which days come near enough to a vote of the theme is found once for each trade. Trades
    that observed doesn't have still take their draws.
    """
    days = theme_votes.groupBy("member_id", "theme").agg(F.array_sort(F.collect_set(F.unix_date("vote_date"))).alias("days"))
    spans = _spans(trades, theme_votes)
    known = trades.join(observed, ["member_id", "trade_id"]).groupBy("member_id", "trade_id", "theme", "observed_gap").agg(F.array_sort(F.collect_list("slot")).alias("slots"))
    if mode == "calendar":
        # a trade's own days, as bits, are made where its theme's days are joined; no row carries days through a shuffle
        by = ["member_id", "theme", "trade_id", "observed_gap", "slots", "first", "weekdays", "n_trades", "seed"]
        pools = _pools(spans.join(trades.groupBy("member_id").agg(F.count("*").alias("n_trades")), "member_id"), seed)
        rows = known.join(pools, "member_id").join(days, ["member_id", "theme"]).select(*by, F.explode("days").alias("day"))
        near = hit_words(rows, by, F.col("observed_gap"))
        hit = lambda slot: has_day(F.col("words"), (_drawn_day(slot) - F.col("first")).cast("int"))
        # staged, so that the many trades of one slot are counted by plain columns, without the functions that several slots need
        near = staged(near, "near-days")
        tasks = _tasks(trades, n_perm)

        def count(rows: DataFrame, once: Column) -> DataFrame:
            return _spread(rows.repartition(tasks, "member_id", "trade_id"), n_perm).groupBy("member_id", "trade_id", "observed_gap").agg(F.count_if(once).alias("hits"))

        single = near.where(F.size("slots") == 1).withColumn("slot", F.col("slots")[0]).drop("slots")
        counted = count(single, hit(F.col("slot"))).unionAll(count(near.where(F.size("slots") > 1), F.exists("slots", hit)))
    else:
        held = known.join(days, ["member_id", "theme"]).groupBy("member_id").agg(F.collect_list(F.struct("trade_id", "observed_gap", "slots", "days")).alias("held"))

        def count(batch, part, perms, moved):
            found = []
            for row, drawn_days in zip(part.tolist(), moved):
                asked, sums = batch.column("held")[row].values, []
                for slots, gap, listed in zip(asked.field("slots").to_pylist(), asked.field("observed_gap").to_pylist(), asked.field("days")):
                    own, drawn = listed.values.to_numpy(), drawn_days[:, slots]
                    after = np.append(own, np.iinfo(own.dtype).max)[np.searchsorted(own, drawn)]
                    sums.append(int((after.astype(np.int64) - drawn <= gap).any(1).sum()))
                member = batch.column("member_id").take(pa.array(np.full(len(sums), row)))
                found.append(pa.record_batch([member, asked.field("trade_id"), asked.field("observed_gap").cast(pa.int32()), pa.array(sums, pa.int64())], ["member_id", "trade_id", "observed_gap", "hits"]))
            return pa.concat_batches(found)

        parts = _shuffled(trades, held, {}, n_perm, seed, block, count, "trade_id string, observed_gap int, hits long")
        counted = parts.groupBy("member_id", "trade_id", "observed_gap").agg(F.sum("hits").alias("hits"))
    return counted.select("member_id", "trade_id", F.col("observed_gap").cast("int").alias("observed_gap"), ((F.col("hits") + 1) / F.lit(n_perm + 1)).alias("p_pair"))


def receipt_p_values(trades: DataFrame, theme_votes: DataFrame, observed: DataFrame, n_perm: int, seed: str) -> DataFrame:
    """p of each observed pair: dates shuffled for members with 50 trades or more, calendar draws for the others."""
    many = trades.groupBy("member_id").count().where(F.col("count") >= SHUFFLE_FROM).select("member_id")
    part = lambda how: (df.join(many, "member_id", how) for df in (trades, theme_votes, observed))
    (t, v, o), (ts, vs, os_) = part("left_anti"), part("left_semi")
    return pair_lower_tail(t, v, n_perm, seed, o).unionByName(pair_lower_tail(ts, vs, n_perm, seed, os_, "shuffle"))


def pairing_null(scores: DataFrame, entities: DataFrame, n_perm: int, seed: int) -> DataFrame:
    """(perm, s1, s2): members paired with districts at random; scores (member_id, district, hits, amount) of all pairs that score.

    Scores are computed once. A permutation orders the entities by a draw of their own; the one at
    place i is paired with the district of entity i, so it is a join of two numberings.
    """
    plain = numbered(entities.select("entity"), [], [F.col("entity")], "i")
    rows = _spread(plain.join(plain.agg(F.count("*").alias("n")), F.lit(True)), n_perm)
    key = draw(F.lit(seed), F.col("perm") * F.col("n") + F.col("i"))
    dealt = numbered(rows.select("perm", "entity", "i", key.alias("_key")), ["perm"], [F.col("_key"), F.col("i")], "place", "_key")
    pairs = dealt.select("perm", F.col("entity").alias("member_id"), "place").join(plain.select(F.col("i").alias("place"), F.col("entity").alias("district")), "place")
    found = pairs.join(scores, ["member_id", "district"], "left")
    return found.groupBy("perm").agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("s1"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("s2"))


def scrambled(rows: DataFrame, by: list[str], columns: list[str], order: list[str], replicates: int, seed: str) -> DataFrame:
    """Replicates of rows with the named columns, as one tuple, permuted within each group; all else stays.

    A negative control: what fires on it reads marginals, not pairings. Row i of a group of n takes draw
    r * n + i of the group's sequence in replicate r, and rows are dealt in the order of their draws. They take
    their numbers in two levels, so that a group isn't gathered in one task.
    """
    seeded = seed_from(F.concat_ws(":", F.lit(seed), *(F.col(c).cast("string") for c in by)))
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    large = sizes.where(F.col("_n") > WINDOW_ROWS) if by else sizes
    if large.isEmpty():
        return _scrambled_in_place(rows, by, columns, order, replicates, seeded)
    if by:
        large = large.select(*(F.col(c).alias(f"_{c}") for c in by))
        same = _null_safe(by)
        small = _scrambled_in_place(rows.join(large, same, "left_anti"), by, columns, order, replicates, seeded)
        rows = rows.join(large, same, "left_semi")
    placed = staged(numbered(rows, by, [F.col(c) for c in order], "_nth"), "scrambled-rows")
    of = [F.col(c).alias(f"_{c}") for c in by]
    known = placed.groupBy(*by).agg(F.count("*").alias("_n")).select(*of, "_n", seeded.alias("_seed"))
    tasks = 1 + placed.count() * replicates // TASK_SCRAMBLED
    spread = _spread(placed.join(known, _null_safe(by)).select(*by, *columns, "_nth", "_n", "_seed").repartition(tasks, *by, "_nth"), replicates).withColumnRenamed("perm", "replicate")
    key = draw(F.col("_seed"), F.col("replicate") * F.col("_n") + F.col("_nth"))
    keyed = spread.select(*by, "replicate", *columns, F.col("_nth").alias("_was"), key.alias("_key"))
    dealt = numbered(keyed, [*by, "replicate"], [F.col("_key"), F.col("_was")], "_nth", "_key")
    # what a row is given in all replicates comes to it at once, so that only the tuples are multiplied before they move
    given = dealt.groupBy(*by, "_nth").agg(F.collect_list(F.struct("replicate", *columns)).alias("_given")).select(*of, F.col("_nth").alias("__nth"), "_given")
    met = placed.drop(*columns).join(given, _null_safe([*by, "_nth"]))
    found = met.select(*(c for c in rows.columns if c not in columns), F.inline("_given")).select("replicate", *rows.columns)
    return found.unionByName(small) if by else found


def _null_safe(names: list[str]) -> Column:
    """Columns equal those of the other side, whose names begin with _; nulls equal nulls."""
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


#: Rows of replicates that a task draws for.
TASK_SCRAMBLED = 500_000
#: Groups of more rows are numbered in two levels.
WINDOW_ROWS = 100_000


def _scrambled_in_place(rows: DataFrame, by: list[str], columns: list[str], order: list[str], replicates: int, seeded: Column) -> DataFrame:
    """``scrambled`` of groups of bounded size: all in one shuffle by the group.

    A row stands twice in its replicate: at its place as the one that takes, and at the place of its draw, just before the taker there, as the one that gives.
    """
    group, to = Window.partitionBy(*by), Window.partitionBy(*by, "replicate")
    placed = rows.repartition(_member_tasks(rows), *by).withColumns({"_i": F.row_number().over(group.orderBy(*order)) - 1, "_n": F.count("*").over(group), "_seed": seeded})
    spread = placed.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    keyed = spread.withColumn("_key", draw(F.col("_seed"), F.col("replicate") * F.col("_n") + F.col("_i"))).drop("_seed", "_n")
    ranked = keyed.withColumn("_to", F.row_number().over(to.orderBy("_key", "_i")) - 1).drop("_key")
    twice = ranked.withColumn("_takes", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("_place", F.when(F.col("_takes"), F.col("_i")).otherwise(F.col("_to")))
    given = F.lag(F.struct(*columns)).over(to.orderBy("_place", "_takes"))
    found = twice.withColumn("_given", given).where("_takes")
    return found.select("replicate", *(F.col(f"_given.{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))


def control_verdict(tests: DataFrame, alpha: float = 0.05, pooled: float = 0.10, most: int = 4) -> DataFrame:
    """One row from (member_id, replicate, p_value): the pooled rate of significant replicates, the most of any member, and whether both are low enough."""
    hit = (F.col("p_value") < alpha).cast("int")
    by = tests.groupBy("member_id").agg(F.sum(hit).alias("hits"), F.count("*").alias("n"))
    found = by.agg((F.sum("hits") / F.sum("n")).alias("pooled_rate"), F.max("hits").alias("most_hits"))
    return found.withColumn("passed", (F.col("pooled_rate") <= pooled) & (F.col("most_hits") <= most))
