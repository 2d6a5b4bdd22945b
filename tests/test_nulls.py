"""The steps that null models share: each is made once, its tasks keep their size, and no pair is stored."""

import datetime

import numpy as np
import pytest

from tracewell.operators import nullmodel, themes
from tracewell.plans.bindings import Tables
from tracewell.plans.queries import before, bill_theme, eligible, instruments, nexus
from tracewell.plans.registry import queries_and_oracles
from tracewell.scratch import staged

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    t = Tables(spark, SF)
    return nullmodel.near_substrate(t.trades, t.votes, t.members, t.bills, t.bill_committees, t.memberships)


def test_near_substrate_is_that_of_the_pairs(spark, tables):
    trades, votes = nullmodel.substrate(before(Tables(spark, SF)))
    assert rows(tables[0].select(*trades.columns)) == rows(trades) and rows(tables[1].select(*votes.columns)) == rows(votes)
    assert tables[0].count() > 100 and tables[1].where("size(named) > 0").count() > 0


def test_nexus_test_reads_votes_once(tables):
    """What both halves need of votes stands with the members when the test itself runs."""
    files = nullmodel.nexus_test(*tables, 3, "s").inputFiles()
    assert any("test-members" in f for f in files) and not set(files) & set(tables[1].inputFiles())


def test_draws_and_words_are_dealt_by_their_number(tables, monkeypatch):
    """Tasks follow the draws and votes, not the bytes of rows, which are small."""
    plan = lambda: nullmodel.calendar_null(*tables, 4, "s")._jdf.queryExecution().executedPlan().toString()
    want = rows(nullmodel.calendar_null(*tables, 4, "s"))
    monkeypatch.setattr(nullmodel, "TASK_DRAWS", tables[0].count())
    monkeypatch.setattr(nullmodel, "TASK_VOTES", tables[1].count() // 3 + 1)
    said = plan()
    assert ", 5), REPARTITION_BY_NUM" in said and ", 6), REPARTITION_BY_NUM" in said
    assert rows(nullmodel.calendar_null(*tables, 4, "s")) == want


def test_shuffles_of_several_members_are_those_of_each():
    days, seeds = np.array([[3, 1, 4, 1, 5], [9, 2, 6, 5, 3], [8, 9, 7, 9, 3]]), np.array([7, 2**32 - 1, 12345])
    both = nullmodel._shuffles(days, seeds, 2, 9)
    for i in range(3):
        alone = nullmodel._shuffles(days[i : i + 1], seeds[i : i + 1], 2, 9)[0]
        assert (both[i] == alone).all() and (np.sort(alone, 1) == np.sort(days[i])).all()


def test_blocks_of_many_trades_are_small(spark, monkeypatch):
    day = datetime.date(2024, 1, 1)
    trades = spark.createDataFrame([("m", i, day + datetime.timedelta(i)) for i in range(20)] + [("o", 0, day)], "member_id string, slot int, tx_date date")
    want = rows(nullmodel.shuffled_dates(trades, 9, "s"))
    monkeypatch.setattr(nullmodel, "SHUFFLED_DAYS", 40)
    found = nullmodel.shuffled_dates(trades, 9, "s")
    assert rows(found) == want and len(want) == 9 * 21


def test_scrambled_in_one_shuffle_and_in_two_levels(spark, monkeypatch):
    """Groups above the limit go in two levels, the others in place: the same rows either way, null columns too."""
    data = spark.createDataFrame([(k, i, None if i % 3 == 0 else f"{k}{i}") for k, n in (("a", 9), ("b", 2), ("c", 1)) for i in range(n)], "k string, i int, v string")
    one = nullmodel.scrambled(data, ["k"], ["v"], ["i"], 3, "s")
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    want = rows(one)
    monkeypatch.setattr(nullmodel, "WINDOW_ROWS", 5)
    assert rows(nullmodel.scrambled(data, ["k"], ["v"], ["i"], 3, "s").select(*one.columns)) == want and len(want) == 36


def test_nexus_pairs_trades_with_votes_of_their_theme_alone(spark):
    """With staged votes neither bills nor the votes' own tables are read again, and the rows are those of all pairs, filtered."""
    t = Tables(spark, SF)
    found = nexus(t, staged(eligible(t), "eligible"))
    names = {f.rsplit("/", 1)[-1] for f in found.inputFiles()}
    assert not names & {"lineitem.parquet", "part.parquet"}
    want = themes.theme_nexus(before(t), instruments(t), bill_theme(t)).select(*found.columns).distinct()
    assert rows(found) == rows(want) and found.count() > 10


def test_pair_tail_has_days_as_bits(spark):
    day = datetime.date(2024, 1, 1)
    trades = spark.createDataFrame([(1, i, f"t{i}", day + datetime.timedelta(9 * i), "Tech") for i in range(6)], "member_id int, slot int, trade_id string, tx_date date, theme string")
    votes = spark.createDataFrame([(1, "Tech", day + datetime.timedelta(30))], "member_id int, theme string, vote_date date")
    p = nullmodel.pair_lower_tail(trades, votes, 20, "a", nullmodel.observed_gaps(trades, votes))
    said = p._jdf.queryExecution().optimizedPlan().toString()
    assert "array_repeat" not in said and all("near-days" in f for f in p.inputFiles()) and p.count() == 4


def test_scrambled_draws_once_a_row_in_tasks_by_their_number(spark, monkeypatch):
    """no filter repeats the expression of a draw, and draws are dealt to tasks by their number."""
    data = spark.createDataFrame([(i, f"v{i}") for i in range(40)], "i long, v string")
    monkeypatch.setattr(nullmodel, "TASK_SCRAMBLED", 30)
    found = nullmodel.scrambled(data, [], ["v"], ["i"], 6, "s")
    execution = found._jdf.queryExecution()
    assert not [line for line in execution.optimizedPlan().toString().split("\n") if "Filter" in line and "shiftleft" in line]
    assert ", 9), REPARTITION_BY_NUM" in execution.executedPlan().toString()
    got = found.collect()
    for k in range(6):
        assert sorted(r["v"] for r in got if r["replicate"] == k) == sorted(f"v{i}" for i in range(40))


def test_scrambled_keeps_a_large_group_without_a_key(spark, monkeypatch):
    data = spark.createDataFrame([(None if i < 9 else i % 2, i, f"v{i}") for i in range(20)], "k long, i long, v string")
    want = rows(nullmodel.scrambled(data, ["k"], ["v"], ["i"], 2, "s").select("replicate", "k", "i", "v"))
    monkeypatch.setattr(nullmodel, "WINDOW_ROWS", 5)
    assert rows(nullmodel.scrambled(data, ["k"], ["v"], ["i"], 2, "s").select("replicate", "k", "i", "v")) == want and len(want) == 40


def test_fact_sheet_reads_votes_once(spark):
    """the lists of votes and the hits read one staged table; lineitem is left to the donors, who read no vote."""
    found = queries_and_oracles()[0]["w13_fact_sheet"](spark, SF)
    assert any("/votes-" in f for f in found.inputFiles())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(l_orderkey" not in plan
