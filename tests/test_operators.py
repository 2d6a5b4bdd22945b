"""Boundary cases with answers worked out by hand."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from tracewell.functions import rng, text
from tracewell.operators import calibration, detectors, flatten, merge, nullmodel, ordering, pairs, proximity, quality, resolve, rollups, themes
from tracewell.plans.registry import queries_and_oracles
from tracewell.sources import readers, sinks, stored
from tracewell.streaming.proximity import near_votes_stream, write_near_votes

D = dt.date
QUERIES, ORACLES = queries_and_oracles()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def value(spark, column, **given):
    df = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'long' if isinstance(v, int) else 'double'}" for k, v in given.items()))
    return df.select(column.alias("x")).first()["x"]


def test_band_join_is_the_plain_join(spark):
    trades = spark.createDataFrame([(m, D(2024, 1, 1) + dt.timedelta(days=d)) for m in (1, 2) for d in range(0, 60, 7)] + [(1, None)], "member_id int, tx_date date")
    votes = spark.createDataFrame([(m, D(2023, 12, 1) + dt.timedelta(days=d)) for m in (1, 2) for d in range(0, 120, 5)] + [(1, None)], "member_id int, vote_date date")
    for window in (1, 7, 14):
        got = rows(proximity.band_join(trades, votes, ["member_id"], "tx_date", "vote_date", window))
        plain = trades.join(votes, "member_id").where(F.abs(F.datediff("vote_date", "tx_date")) <= window)
        assert got == rows(plain.select("member_id", "tx_date", "vote_date"))
    ahead = proximity.band_join(trades, votes, ["member_id"], "tx_date", "vote_date", 14, forward_only=True)
    assert rows(ahead) == rows(trades.join(votes, "member_id").where(F.datediff("vote_date", "tx_date").between(0, 14)).select("member_id", "tx_date", "vote_date"))


def test_ticker_mentions_need_a_space(spark):
    word = lambda t, w: value(spark, proximity.mentions(F.col("t"), F.col("w")), t=t, w=w)
    assert word("an act for nvda chips", "NVDA") and word("NVDA act", "nvda") and word("for NVDA", "NVDA")
    assert not word("NVDA, an act", "NVDA") and not word("NVDA", "NVDA") and word(None, "NVDA") is False and word("x", None) is False


def test_next_same_kind_edges(spark):
    at = lambda d: D(2024, 1, 1) + dt.timedelta(days=d)
    events = [("a", at(0), True), ("a", at(9), False), ("b", at(5), True), ("b", at(4), False), ("c", at(0), True), ("c", at(90), False), ("d", at(0), True), ("d", at(91), False), ("e", at(3), True), ("e", at(3), False)]
    df = spark.createDataFrame(events, "theme string, date date, is_trade boolean")
    assert rows(proximity.next_same_kind(df, ["theme"], "date", "is_trade", 90).select("theme", "gap")) == [("a", 9), ("c", 90), ("e", 0)]


def test_draws_are_the_sequence(spark):
    got = [r[0] for r in spark.range(5).select(rng.draw(F.lit(12345), F.col("id"))).collect()]
    assert got == rng.draws(12345, 5).tolist()
    assert value(spark, rng.seed_from(F.col("s")), s="") == 0x811C9DC5
    h = 0x811C9DC5
    for c in "member-7":
        h = (h ^ ord(c)) * 0x01000193 & 0xFFFFFFFF
    assert value(spark, rng.seed_from(F.col("s")), s="member-7") == h


def nexus_tables(spark, votes):
    trades = spark.createDataFrame([(1, 0, D(2024, 1, 1), "NVDA")], "member_id int, slot int, tx_date date, instrument string")
    return trades, spark.createDataFrame([(1, f"v{i}", D(2024, 1, 1) + dt.timedelta(days=d), c, n) for i, (d, c, n) in enumerate(votes)], "member_id int, vote_id string, vote_date date, committee boolean, named array<string>")


@pytest.mark.parametrize(
    "votes,want",
    [([(14, True, [])], 1), ([(15, True, [])], 0), ([(0, True, [])], 1), ([(-1, True, [])], 0), ([(3, False, ["NVDA"])], 1), ([(3, False, ["AMD"])], 0), ([(3, True, []), (4, True, ["NVDA"])], 1)],
)
def test_nexus_edges(spark, votes, want):
    assert nullmodel.observed_nexus(*nexus_tables(spark, votes)).first()["observed"] == want


def test_nulls_repeat_and_differ_by_seed(spark):
    trades = spark.createDataFrame([(1, i, D(2024, 1, 1) + dt.timedelta(days=3 * i), f"T{i}") for i in range(12)], "member_id int, slot int, tx_date date, instrument string")
    votes = spark.createDataFrame([(1, f"v{i}", D(2024, 3, 1) + dt.timedelta(days=31 * i), True, []) for i in range(4)], "member_id int, vote_id string, vote_date date, committee boolean, named array<string>")
    once = rows(nullmodel.calendar_null(trades, votes, 20, "a"))
    assert once == rows(nullmodel.calendar_null(trades.repartition(7), votes, 20, "a")) and len(once) == 20
    assert once != rows(nullmodel.calendar_null(trades, votes, 20, "b"))
    # a draw at a time gives the same counts
    days = [(D(2024, 1, 1) + dt.timedelta(days=k)) for k in range((D(2024, 6, 2) - D(2024, 1, 1)).days + 1)]
    pool = [d for d in days if d.weekday() < 5]
    seed = value(spark, rng.seed_from(F.col("s")), s="a:1")
    line = rng.draws(seed, 20 * 12)
    vote_days = [r["vote_date"] for r in votes.collect()]
    for perm in range(20):
        moved = [pool[int(line[perm * 12 + i] * len(pool))] for i in range(12)]
        assert once and dict((p, n) for _, p, n in once)[perm] == sum(any(0 <= (v - d).days <= 14 for v in vote_days) for d in moved)
    shuffled = nullmodel.shuffled_dates(trades, 60, "a", block=25)
    assert all(sorted(r["d"]) == sorted((t["tx_date"] - D(1970, 1, 1)).days for t in trades.collect()) for r in shuffled.groupBy("perm").agg(F.collect_list("day").alias("d")).collect())
    assert rows(shuffled) == rows(nullmodel.shuffled_dates(trades, 60, "a", block=7))


def test_summary_of_a_constant_null(spark):
    observed = spark.createDataFrame([(1, 3)], "member_id int, observed long")
    drawn = spark.createDataFrame([(1, p, 3) for p in range(10)], "member_id int, perm int, drawn long")
    r = nullmodel.summary(observed, drawn, ["member_id"]).first()
    assert (r["z_score"], r["p_value"], r["expected"]) == (0.0, 1.0, 3.0)


def test_scramble_keeps_marginals(spark):
    confirms = spark.createDataFrame([(f"r{i}", f"T{i % 5}") for i in range(40)], "recipient_key string, ticker string")
    control = nullmodel.scrambled(confirms, [], ["ticker"], ["recipient_key"], 3, "s")
    for k in range(3):
        one = control.where(F.col("replicate") == k)
        assert sorted(r["ticker"] for r in one.collect()) == sorted(r["ticker"] for r in confirms.collect())
        assert sorted(r["recipient_key"] for r in one.collect()) == sorted(r["recipient_key"] for r in confirms.collect())


def test_recipient_overlap_boundary(spark):
    confirms = spark.createDataFrame([("r-nice", "NICE"), ("r-lmt-a", "LMT"), ("r-lmt-b", "LMT"), ("r-syk", "SYK")], "recipient_key string, ticker string")
    rec = spark.createDataFrame([("m1", "r-nice", 500.0), ("m1", "r-lmt-a", 10.0), ("m2", "r-lmt-b", 20.0), ("m2", "r-syk", 7.0), ("m3", "r-lmt-a", 30.0)], "district string, recipient_key string, amount double")
    assert rows(detectors.ubiquitous(confirms, rec, 6)) == [("LMT",)]  # 3 of 6 is more than a third
    assert rows(detectors.ubiquitous(confirms, rec, 9)) == []  # exactly a third stays
    traded = spark.createDataFrame([("m1", "NICE"), ("m2", "LMT"), ("m3", "SYK")], "district string, ticker string")
    assert rows(detectors.recipient_overlap(traded, detectors.recipient_dollars(confirms, rec, 6))) == [(1, 500.0)]


def test_longest_prefix(spark):
    codes = spark.createDataFrame([("334510",), ("3345",), ("33",), ("9",)], "code string")
    prefixes = spark.createDataFrame([("3345", "Tech"), ("334510", "Health"), ("33", "Industry")], "prefix string, theme string")
    assert rows(themes.longest_prefix(codes, "code", prefixes, "prefix", "theme")) == [("33", "Industry"), ("3345", "Tech"), ("334510", "Health"), ("9", None)]


def test_names(spark):
    corp = lambda s: value(spark, text.corporate_name(F.col("s")), s=s)
    assert [corp(s) for s in ("NICE SYSTEMS INC", "Stryker Corporation", "FRONTIER TECHNOLOGY INC", "GENERAL ELECTRIC COMPANY")] == ["NICE", "STRYKER", "FRONTIER", "GENERAL ELECTRIC"]
    assert value(spark, text.last_name(F.col("s")), s="Hon. Donald Sternoff Beyer Jr") == "Beyer"
    assert value(spark, text.committee_canonical(F.col("s")), s="Senate Committee on the Judiciary — Crime") == "judiciary"
    assert value(spark, text.person_name(F.col("s")), s="Smith, Robert J.") == "smith robert"
    assert value(spark, text.bill_reference(F.col("s")), s="On H.J.Res. 100") == "hjres-100" and value(spark, text.bill_reference(F.col("s")), s="none") is None
    assert value(spark, text.iso_date(F.col("s")), s="3/9/2024") == D(2024, 3, 9) and value(spark, text.iso_date(F.col("s")), s="2024-02-30") is None
    assert value(spark, text.regex_escape(F.col("s")), s="a.b") == r"a\.b"
    assert value(spark, text.role_rank(F.col("s")), s="Chairman") == "1|Chairman"


def test_aliases_and_ambiguity(spark):
    people = spark.createDataFrame([("a", "Robert", "Smith", None, None), ("b", "Robert", "Smith", None, None), ("c", "Charles", "Schumer", "Chuck", "Charles E. Schumer")], "person_id string, first string, last string, nickname string, official string")
    asked = spark.createDataFrame([("Chuck Schumer", None), ("Schumer, Chuck", None), ("Robert Smith", None), ("Schumer", None), ("x", "b")], "query string, known_id string")
    got = {r["query"]: (r["person_id"], r["status"]) for r in resolve.resolve_aliases(asked, resolve.aliases(people)).collect()}
    assert got == {"Chuck Schumer": ("c", "ok"), "Schumer, Chuck": ("c", "ok"), "Robert Smith": (None, "ambiguous"), "Schumer": (None, "unresolved"), "x": ("b", "ok")}


def test_roster_brand_and_registry(spark):
    asked = ["Chuck Schumer", "Robert Smith", "John Schultz", "Debbie Wasserman Schultz", "deborah wasserman schultz", "Schumer", "Bernie Sanders", "Bern Sanders", ""]
    names = spark.createDataFrame([(q,) for q in asked], "query string")
    people = [("c", "Charles Ellis", "Schumer"), ("a", "Robert", "Smith"), ("b", "Robert", "Smith"), ("d", "Debbie", "Wasserman Schultz"), ("s", "Bernard", "Sanders")]
    roster = spark.createDataFrame(people, "person_id string, first string, last string")
    got = {r["query"]: (r["person_id"], r["status"]) for r in resolve.match_roster(names, roster).collect()}
    assert got == {
        "Chuck Schumer": ("c", "ok"), "Robert Smith": (None, "ambiguous"), "John Schultz": (None, "unresolved"), "Debbie Wasserman Schultz": ("d", "ok"),
        "deborah wasserman schultz": (None, "unresolved"), "Schumer": (None, "unresolved"), "Bernie Sanders": ("s", "ok"), "Bern Sanders": (None, "unresolved"), "": (None, "unresolved"),
    }
    loose = {r["query"]: (r["person_id"], r["status"]) for r in resolve.match_roster_loosely(names, roster).collect()}
    assert loose["Bern Sanders"] == ("s", "ok") and loose["Debbie Wasserman Schultz"] == ("d", "ok") and loose["John Schultz"] == (None, "unresolved") and loose[""] == (None, "unresolved")
    assert value(spark, resolve.brand_contained(F.col("b"), F.col("n")), b="General Electric Co", n="Electric General Boats") is True
    tier = lambda n, t: value(spark, resolve.accept_tier(F.col("n"), F.col("t")), n=n, t=t)
    # alike without company words: one word is not enough
    assert tier("FRONTIER TECHNOLOGY INC", "Frontier Group Holdings, Inc.") == "verify" and tier("NICE SYSTEMS INC", "NICE LTD") == "verify"
    assert tier("Stryker Corporation", "STRYKER CORPORATION") == "accept" and tier("GENERAL ELECTRIC COMPANY", "General Electric Co") == "accept"
    gone = resolve.split_tiers(spark.createDataFrame([("k", "GENERAL ELECTRIC COMPANY", None, "GE", "own-name")], "key string, name string, parent_name string, ticker string, basis string"), spark.createDataFrame([], "title string, ticker string, ordinal int"))
    assert rows(gone.select("tier")) == [("verify",)]
    people = spark.createDataFrame([("c", "smith", "CA", "S")], "person_id string, last_name string, state string, office string")
    registry = spark.createDataFrame([("old", "smith", "CA", "S", D(2020, 1, 1)), ("new", "smith", "CA", "S", D(2022, 1, 1)), ("house", "smith", "CA", "H", D(2024, 1, 1))], "candidate_id string, last_name string, state string, office string, last_file_date date")
    assert rows(resolve.newest_candidate(people, registry)) == [("c", "new")]
    senate = spark.createDataFrame([(1, "Ann Lee", "senate"), (2, "Bob Lee", "senate"), (3, "Mitch McConnell", "senate"), (4, "Al Nobody", "house")], "member_id int, name string, chamber string")
    filers = spark.createDataFrame([("Ann M.", "Lee"), ("Zoe", "Lee"), ("Al", "Nobody"), ("A. Mitchell", "McConnell, Jr."), ("", "Lee"), ("X", "3")], "first_name string, last_name string")
    assert rows(resolve.resolve_senate_filers(filers, senate)) == [
        ("", "Lee", 1, 0.7, "senate_lastname_ambiguous"), ("A. Mitchell", "McConnell, Jr.", 3, 1.0, "exact_senate_lastname"), ("Al", "Nobody", None, 0.0, "unmatched"),
        ("Ann M.", "Lee", 1, 0.95, "senate_firstname_lastname"), ("X", "3", None, 0.0, "unmatched"), ("Zoe", "Lee", 1, 0.7, "senate_lastname_ambiguous"),
    ]


def test_contained_names_that_begin_alike(spark):
    whole = spark.createDataFrame([(i, f"000{i:03d}") for i in range(300)] + [(900, "ab"), (901, None)], "id int, name string")
    asked = spark.createDataFrame([("0007",), ("b",), ("ab",), ("zzz",), ("",), (None,), ("000299",), ("0002",)], "part string")
    got = {(r["id"], r["part"]) for r in resolve.containing(whole, "name", asked, F.col("part"), []).collect()}
    names, parts = [(r["id"], r["name"]) for r in whole.collect()], [r["part"] for r in asked.collect()]
    assert got == {(i, p) for i, n in names for p in parts if n and p and p in n}


def test_members_named_in_roles(spark):
    said = {
        "Rep. Jason T. Smith": {1, 4}, "Rep. Adam Smith": {2}, "Counsel to Rep. Smith": {1, 2, 4}, "Representative Smith": set(), "Sen Smith; staff": {3, 4}, "Senator Jason Lee Von Smith": {3, 4},
        "Rep. Jason A B C Smith": set(), "CONGRESSWOMAN debbie WASSERMAN schultz, aide": {5}, "Rep. Wasserman Schultz": set(), "Rep. Schultz": {5}, "Rep. Smithson": set(), "Rep. Smith-Jones": {1, 2, 4},
        "Congressman  O'Neil's office": {6}, "xRep. Smith": {1, 2, 4}, "Rep.Smith": set(), "Smith, Rep.": set(), "N/A": set(), "Rep. Jason 3 Smith": set(),
    }
    members = [(1, "Jason Smith", "house"), (2, "Adam Q. Smith, Jr.", "house"), (3, "Jason Smith", "senate"), (4, "Jason Smith", None), (5, "Debbie Wasserman Schultz", "house"), (6, "Pat O'Neil PhD", "house"), (7, "", "house")]
    roles = spark.createDataFrame([(i, r) for i, r in enumerate(said)] + [(99, None)], "filing_id int, role string")
    found = detectors.named_in_roles(roles, spark.createDataFrame(members, "member_id int, name string, chamber string"))
    got = {r: set() for r in said}
    for r in found.collect():
        got[r["role"]].add(r["member_id"])
    assert got == said


def test_keywords_stand_within_words(spark):
    roles = spark.createDataFrame([(1, "Staff, Cmte on Bioenergy"), (2, "CMTE ENERGY"), (3, "Energy desk"), (4, None), (5, "cmte"), (6, "Cmte on energ")], "filing_id int, role string")
    keywords = spark.createDataFrame([(7, "energy"), (7, "bioen"), (8, "science"), (9, None)], "member_id int, keyword string")
    assert rows(detectors.keyword_roles(roles, keywords).select("filing_id", "member_id")) == [(1, 7), (2, 7)]


def test_latest_matching_filing_is_posted_last(spark):
    filings = spark.createDataFrame([("b", 2024, D(2024, 5, 1)), ("a", 2024, D(2024, 5, 1)), ("c", 2024, None), ("d", 2023, D(2025, 1, 1))], "filing_id string, filing_year int, posted_at date")
    assert [r["filing_id"] for r in filings.orderBy(*detectors.latest_filing_order()).collect()] == ["a", "b", "c", "d"]


def test_conduits_and_money_passed_on(spark):
    said = ["WINRED TECHNICAL SERVICES", "ActBlue Civics", "SMITH VICTORY FUND", "ANEDOT", "X ACTBLUE EMPLOYEE", "VICTORYLAND", "WINREDX"]
    receipts = spark.createDataFrame([(1, n, 5.0, 2024, "pac", None) for n in said], "member_id int, name string, amount double, cycle int, donor_type string, date date")
    assert rows(flatten.donor_rollup(receipts).select("donor")) == [("ANEDOT",), ("VICTORYLAND",), ("WINREDX",), ("X ACTBLUE EMPLOYEE",)]
    passes = lambda n, m: value(spark, flatten.passthrough(F.col("n"), F.col("m")), n=n, m=m)
    assert passes(" ActBlue ", None) and passes("x", "* Earmarked Through This Organization: y") and not passes("ACTBLUE CIVICS", "earmark of a conduit") and not passes(None, None)


def test_money_labels(spark):
    label = lambda v: value(spark, text.money_label(F.col("v")), v=v)
    assert [label(v) for v in (1_200_000.0, 340_400.0, 1_500.0, 99.4, 999.5, 999_950.0, 0.0, -5_000.0)] == ["$1.20M", "$340.4K", "$1.5K", "$99", "$1.0K", "$1000.0K", "$0", "$-5000"]
    assert [label(v) for v in (1_150.0, 1_250.0, 1_005_000.0, 1_015_000.0)] == ["$1.1K", "$1.3K", "$1.00M", "$1.01M"]  # as doubles 1.15, 1.005 and 1.015 lie below
    null = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "v double").select(text.money_label(F.col("v")).alias("x"))
    assert {r["x"] for r in null.collect()} == {"—"}


def test_banned_terms_and_facts(spark):
    docs = spark.createDataFrame([(1, "A firefighter, heroic; Hero! far-leftist"), (2, "radicalize claims to heroin"), (3, None)], "id int, body string")
    assert rows(quality.banned_terms(docs, "id", "body")) == [(1, "far-left"), (1, "hero"), (2, "claims to")]
    facts = spark.createDataFrame([(1, ["With their own", "Energy bill", " ", None, "The new act"], "bioenergy with their")], "id int, facts array<string>, corpus string")
    assert rows(quality.split_facts(facts, "id", "facts", "corpus")) == [(1, ["Energy bill"], ["With their own", "The new act"])]


def test_replace_scope_twice_is_once_and_clears(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "scope int, x string")
    new = spark.createDataFrame([(1, "z")], "scope int, x string")
    scopes = spark.createDataFrame([(1,), (2,)], "scope int")
    once = merge.replace_scope(old, new, scopes, ["scope"])
    assert rows(once) == rows(merge.replace_scope(once, new, scopes, ["scope"])) == [(1, "z")]


def test_bands_tiers_and_statements(spark):
    assert [value(spark, detectors.power_band(F.col("n")), n=n) for n in (4, 5, 9, 10)] == ["insufficient-data", "low-power", "low-power", "ranked"]
    assert value(spark, detectors.pattern_tier(F.col("i"), F.col("p")), i=0.9, p=0.2) == "low" and value(spark, detectors.pattern_tier(F.col("i"), F.col("p")), i=0.9, p=0.01) == "high"
    assert value(spark, detectors.confidence_statement(F.col("o"), F.col("e"), F.col("p")), o=4.0, e=2.0, p=0.01).startswith("2.0 times")


def test_calibration_edges(spark):
    def votes(n, yes):
        return spark.createDataFrame([(1, f"v{i:03d}", D(2024, 1, 1) + dt.timedelta(days=i), "yea" if i < yes else "nay") for i in range(n)], "member_id int, vote_id string, vote_date date, position string")

    members = spark.createDataFrame([(1, "A", "house")], "member_id int, party string, chamber string")
    assert calibration.split(votes(19, 19)).count() == 0 and calibration.split(votes(20, 20)).where("is_train").count() == 14
    scores = {r["model"]: r["brier_score"] for r in calibration.scored(votes(20, 20), members).collect()}
    assert scores["always-yes"] == 0 and scores["naive-half"] == 0.25 and "party-class-rate" not in scores  # no peers
    assert calibration.best_model(calibration.scored(votes(20, 20), members)).first()["best_model"] == "always-yes"
    assert rows(calibration.buckets(votes(20, 20), members).where("model = 'always-yes'").select("bucket", "n")) == [(9, 6)]


def test_flatten_edges(spark):
    votes = spark.createDataFrame([("On Passage: H.R. 5", "https://x/congress/votes/118-2024/h5", None), ("On H.R. 6", "https://x/congress/votes/118-2024/h6", "kept")], "question string, source_url string, bill_id string")
    assert rows(flatten.link_votes(votes).select("bill_id")) == [("118-hr-5",), ("kept",)]
    s = spark.createDataFrame([("b", "00", "<p>old</p>"), ("b", "36", "<p><strong>Title</strong> a&amp;b  <i>c</i></p>")], "bill_id string, version string, html string")
    assert rows(flatten.latest_summaries(s)) == [("b", "Title", "Title a&b c")]
    acts = spark.createDataFrame([("b", "c", None, D(2024, 5, 1)), ("b", "c", "named", D(2024, 1, 1))], "bill_id string, committee string, name string, date date")
    assert flatten.latest_activity(acts).first()["name"] == "named"
    held = [("e", D(2024, 1, 1), "Full Hearing", "Meeting", ["HSAG", "hsag"]), ("f", D(2024, 1, 1), "Business meeting", "Briefing", ["HSAG"]), ("g", D(2024, 1, 1), None, "Meeting", ["HSAG"])]
    m = spark.createDataFrame(held, "event_id string, date date, title string, type string, committees array<string>")
    mine = spark.createDataFrame([(1, "hsag")], "member_id int, committee_code string")
    assert [(r["event_id"], r["kind"]) for r in flatten.relevant_meetings(m, mine).orderBy("event_id").collect()] == [("e", "Hearing"), ("f", "Other"), ("g", "Meeting")]
    f = spark.createDataFrame([("f", [("i", [("1", "n", "N/A")], ["x"])]), ("g", [("i", [("1", "n", "Aide")], ["x"])])], "filing_id string, activities array<struct<issue string, lobbyists array<struct<lobbyist_id string, name string, position string>>, entities array<string>>>")
    assert rows(flatten.with_usable_position(f).select("filing_id")) == [("g",)]


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, '{"a": {"b": "5"}, "c": [1, 2]}'), (2, "not json")], "id int, doc string")
    got = {r["path"]: (r["docs"], r["types"], r["numeric_strings"]) for r in quality.shape_profile(docs, "id", "doc").collect()}
    assert got == {"$.a.b": (1, "string", 1), "$.c[]": (1, "number", 0), "!": (1, "invalid", 0)}
    kept = value(spark, quality.grounded(F.col("t"), F.col("f")), t="Oil drilling rose. Nothing here.", f="drilling permits")
    assert kept == "Oil drilling rose."
    with pytest.raises(ValueError):
        quality.require(spark.createDataFrame([(0.5,)], "rate double"), "rate >= 0.75", "linkage")
    quality.require(spark.createDataFrame([(0.8,)], "rate double"), "rate >= 0.75", "linkage")
    shares = rollups.median_shares(spark.createDataFrame([(1, "T", 5.0, 10.0)], "district int, theme string, total double, grand_total double"), spark.createDataFrame([(1,), (2,), (3,)], "district int"))
    assert rows(shares) == [("T", 0.0)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "house").mkdir()
    good = {"filingId": "1", "year": 2024, "filer": {"name": "Hon. A B", "stateDistrict": "CA12"}, "transactions": [{"asset": "x", "ticker": "NVDA", "type": "P", "date": "2024-01-02"}, {"asset": "y", "date": "01/05/2024"}]}
    (tmp_path / "house/a.json").write_text(json.dumps(good))
    (tmp_path / "house/b.json").write_text("{broken")
    (tmp_path / "house/c.json").write_text(json.dumps({"filingId": "2", "filer": {"name": "x"}, "transactions": []}))
    (tmp_path / "senate/2023").mkdir(parents=True)
    (tmp_path / "senate/2023/a.json").write_text(json.dumps({"filingId": "s", "filer": {"firstName": "C", "lastName": "D"}, "ptrUrl": "u", "transactions": [{"transactionDate": "2023-02-03", "owner": "Self"}]}))
    house, bad = readers.read_json(spark, str(tmp_path / "house"), readers.HOUSE_FILING)
    senate, _ = readers.read_json(spark, str(tmp_path / "senate/*"), readers.SENATE_FILING)
    both = readers.disclosures(house, senate)
    assert rows(both.select("filing_id", "tx_index", "tx_date", "source_year")) == [("1", 0, D(2024, 1, 2), 2024), ("1", 1, D(2024, 1, 5), 2024), ("s", 0, D(2023, 2, 3), 2023)]
    assert bad.count() == 1
    known = spark.createDataFrame([("k1",), ("k2",)], "recipient_key string")
    head = "\t".join(readers.CONFIRM_COLUMNS)
    (tmp_path / "ok.tsv").write_text(f"{head}\nk1\tName\tNVDA\town-name\tlong enough\t2024-01-01\n")
    assert readers.read_confirms(spark, str(tmp_path / "ok.tsv"), known).count() == 1
    for line in ("k1\tName\tnvda\town-name\tlong enough\t2024-01-01", "k1\tName\tNVDA\tguess\tlong enough\t2024-01-01", "k1\tName\tNVDA\tmanual\tthin\t2024-01-01", "k9\tName\tNVDA\tmanual\tlong enough\t2024-01-01", "k1\tName\tNVDA\tmanual\tlong enough\t2024-13-01"):
        (tmp_path / "bad.tsv").write_text(f"{head}\n{line}\n")
        with pytest.raises(ValueError):
            readers.read_confirms(spark, str(tmp_path / "bad.tsv"), known)
    (tmp_path / "m.json").write_text(json.dumps({"data": {"id": "m", "votes": [{"vote_id": "v", "position": "Yea"}], "donors": []}}))
    tables = readers.member_tables(readers.read_json(spark, str(tmp_path / "m.json"), readers.MEMBER_DOCUMENT)[0])
    assert tables["votes"].count() == 1 and tables["donors"].count() == 0
    level = spark.createDataFrame([("awards", "d", 2024, [("1", "n", 5.0)])], "spending_level string, district string, cy int, rows array<struct<code string, name string, amount double>>")
    with pytest.raises(Exception, match="spending_level"):
        readers.contract_rows(level).collect()
    hits = "pattern string, member_id int, finding string"
    write = lambda found, ran: sinks.write_hits(spark.createDataFrame(found, hits), spark.createDataFrame(ran, "pattern string, member_id int"), str(tmp_path / "hits"))
    found = lambda: rows(sinks.read_hits(spark, str(tmp_path / "hits"), hits).select("pattern", "member_id", "finding"))
    write([("p1", 1, "a"), ("p1", 2, "b"), ("p2", 2, "c")], [("p1", 1), ("p1", 2), ("p2", 2)])
    write([("p1", 1, "z")], [("p1", 1)])  # other members' hits stay
    assert found() == [("p1", 1, "z"), ("p1", 2, "b"), ("p2", 2, "c")]
    write([], [("p2", 2), ("p1", 2)])  # a scope that found nothing is cleared
    assert found() == [("p1", 1, "z")]
    write([("p1", 1, "z")], [("p1", 1)])  # twice is once
    assert found() == [("p1", 1, "z")]
    scored = spark.createDataFrame([("p1", 1, "m", 3, 1.5, 0.01, 2.0, 100)], "pattern string, member_id int, null_model string, observed int, expected double, p_value double, z_score double, n_perm int")
    full = sinks.with_statistics(sinks.with_statistics(spark.createDataFrame([("p1", 1, "z"), ("p9", 1, "y")], hits).withColumns({c: F.lit(None) for c in sinks.STATISTICS}), scored), scored)
    assert rows(full.select("pattern", "p_value")) == [("p1", 0.01), ("p9", None)]
    receipts = spark.createDataFrame([(1, 12, "ranked", 2, "t2", 0.5), (1, 12, "ranked", 1, "t1", 0.1), (2, 3, "insufficient-data", 1, "t3", None)], "member_id int, trade_count int, band string, place int, trade_id string, p_pair double")
    sinks.write_receipts(receipts, str(tmp_path / "receipts"), 1)
    docs = sorted((json.loads(line) for f in (tmp_path / "receipts").glob("part*") for line in f.read_text().splitlines()), key=lambda d: d["member_id"])
    assert [[r["trade_id"] for r in d["receipts"]] for d in docs] == [["t1", "t2"], ["t3"]] and docs[0]["band"] == "ranked"


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*")}


def test_a_small_load_writes_its_buckets_alone(spark, tmp_path):
    hits = "pattern string, member_id int, finding string"
    frame = lambda held: spark.createDataFrame(held, hits)
    scopes = lambda held: spark.createDataFrame(held, "pattern string, member_id int")
    everyone = [(p, m, f"{p}{m}") for p in ("p1", "p2") for m in range(40)]
    sinks.write_hits(frame(everyone), scopes([r[:2] for r in everyone]), str(tmp_path / "hits"))
    table, before = sinks.stored_hits(spark, str(tmp_path / "hits"), hits), _files(tmp_path / "hits/rows")
    assert len(table.folders()) > 20 and rows(table.read()) == sorted(everyone, key=str)
    assert sinks.write_hits(frame([("p1", 7, "new")]), scopes([("p1", 7)]), str(tmp_path / "hits")) == 2
    after = _files(tmp_path / "hits/rows")
    assert {f: after[f] for f in before} == before and len({f.split("/_bucket=")[1].split("/")[0] for f in set(after) - set(before)}) == 1
    assert rows(table.read()) == sorted([r for r in everyone if r[:2] != ("p1", 7)] + [("p1", 7, "new")], key=str) and rows(table.read(1)) == sorted(everyone, key=str)
    table.vacuum()
    assert table.versions() == [2] and rows(table.read())[0][0] == "p1" and len(_files(tmp_path / "hits/rows")) < len(after)
    with pytest.raises(ValueError):
        table.replace_scope(frame([("p1", 8, "x")]), scopes([("p1", 7)]))


def test_a_load_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    table = stored.StoredTable(spark, str(tmp_path / "t"), "k int, a string, b string", ["k"], 8)
    frame = lambda held: spark.createDataFrame(held, "k int, a string, b string")
    assert rows(table.read()) == []
    table.upsert_replace(frame([(k, "a", "b") for k in range(20)]))
    with monkeypatch.context() as m:
        m.setattr(stored.StoredTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert_replace(frame([(3, "new", "new")]))
    assert rows(table.read()) == sorted([(k, "a", "b") for k in range(20)], key=str)
    table.upsert_update(frame([(3, "new", None), (30, "x", "y")]), ["a"], ["b"])
    table.insert_if_absent(frame([(3, "no", "no"), (31, "z", "z")]))
    assert rows(table.read().where("k in (3, 30, 31)")) == [(3, "new", "b"), (30, "x", "y"), (31, "z", "z")]
    other = stored.StoredTable(spark, str(tmp_path / "t"), "k int, a string, b string", ["k"], 8)
    held = other.folders()
    with pytest.raises(stored.Conflict):
        other._commit(table.versions()[-1], held)  # another load made it
    table.load(frame([]), lambda old: old)  # nothing to do is a version too
    assert table.read().count() == 22


def test_lobbying_recipients_and_seeds(spark, tmp_path):
    person = lambda i, position: {"lobbyist": {"id": i, "first_name": "Ann", "middle_name": None, "last_name": "Lee"}, "covered_position": position, "new": True}
    filing = {"filing_uuid": "f", "filing_year": 2024, "registrant": {"name": "R"}, "client": {"name": "C"}, "income": "10.5", "expenses": None, "dt_posted": "2024-01-02",
              "lobbying_activities": [{"general_issue_code_display": "Taxes", "government_entities": [{"name": "SENATE"}], "lobbyists": [person(7, "N/A"), {"lobbyist": None}]},
                                      {"general_issue_code_display": "Trade", "government_entities": [{"name": "HOUSE"}, {"name": None}], "lobbyists": [person(7, " Aide ")]}]}
    (tmp_path / "lda.json").write_text(json.dumps(filing))
    (tmp_path / "empty.json").write_text(json.dumps({"filing_uuid": "g"}))
    saved, bad = readers.read_json(spark, str(tmp_path / "*.json"), readers.LOBBYING_FILING)
    flat = readers.lobbying_filings(saved)
    assert rows(flat.select("filing_id", "registrant_name", "income", F.size("activities"))) == [("f", "R", 10.5, 2), ("g", None, None, 0)] and bad.count() == 0
    assert rows(flatten.lobbyists(flat)) == [("f", "7", "Ann Lee", "Taxes / Trade", "Aide", "HOUSE; SENATE")]
    assert rows(flatten.with_usable_position(flat).select("filing_id")) == [("f",)]
    (tmp_path / "rec").mkdir()
    (tmp_path / "rec/a.json").write_text(json.dumps({"district": "d", "cy": 2024, "rows": [{"recipient_id": None, "name": "Solo", "amount": 1.5}, {"recipient_id": "r1", "name": "Named", "amount": 2.0}]}))
    rollup, _ = readers.read_json(spark, str(tmp_path / "rec"), readers.RECIPIENT_ROLLUP)
    assert rows(readers.recipient_rows(rollup).select("recipient_key", "amount")) == [("Solo", 1.5), ("r1", 2.0)]
    (tmp_path / "seed.csv").write_text("sic,theme\n1311,Energy\n")
    assert rows(readers.read_seed(spark, str(tmp_path / "seed.csv"), "sic string, theme string")) == [("1311", "Energy")]
    (tmp_path / "broken.csv").write_text("sic,theme\n1311,Energy,more\n")
    with pytest.raises(Exception):
        readers.read_seed(spark, str(tmp_path / "broken.csv"), "sic int, theme string").collect()


def plain_hits(days, first, last, window):
    return [any(d <= v <= d + window for v in days) for d in range(first, last + 1)]


@pytest.mark.parametrize("days,window", [([], 3), ([5], 0), ([5], 3), ([1, 2, 9, 30], 4), ([1, 30], 90), ([30], 100)])
def test_hit_days(spark, days, window):
    df = spark.createDataFrame([(days, 1, 30)], "days array<int>, first int, last int")
    got = df.select(nullmodel.hit_days(F.col("days"), F.col("first"), F.col("last"), window).alias("x")).first()["x"]
    assert got == plain_hits(days, 1, 30, window)


@pytest.mark.parametrize("days,window", [([5], 0), ([5, 64, 65], 3), ([1, 2, 9, 130], 4), ([1, 30], 90), ([0], 5)])
def test_hit_words(spark, days, window):
    rows_ = spark.createDataFrame([("m", d, 1) for d in days] or [], "who string, day int, first int")
    words = {r["who"]: r["words"] for r in nullmodel.hit_words(rows_, ["who"], window).collect()}
    asked = spark.createDataFrame([(words.get("m"), at) for at in range(0, 140)], "words array<bigint>, at int").select(nullmodel.has_day(F.col("words"), F.col("at")).alias("x"))
    assert [r["x"] for r in asked.collect()] == plain_hits([d for d in days if d >= 1], 1, 140, window)


def test_weekdays_by_arithmetic(spark):
    spans = [(first, first + n) for first in range(-3, 12) for n in range(0, 17)]
    df = spark.createDataFrame(spans, "first int, last int").withColumn("n", nullmodel.weekdays_between(F.col("first"), F.col("last")))
    df = df.withColumn("days", F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda k: nullmodel.nth_weekday(F.col("first"), k))))
    for r in df.collect():
        want = [d for d in range(r["first"], r["last"] + 1) if (d + 3) % 7 < 5]
        assert (r["n"], r["days"] or []) == (len(want), want)


@pytest.mark.parametrize("heavy", [3, 1000])
def test_first_shared_items_without_gathering_all(spark, heavy):
    """an edge's first items are those of all its items, which no row ever holds."""
    held = [(e, f"i{i:03}") for e in range(6) for i in range(150) if (e * 7 + i * 3) % 4] + [(8, "i149"), (9, "i149"), (9, "i149"), (3, None), (None, "i001")]
    df = spark.createDataFrame(held, "e int, i string")
    edges = {}
    for x in held:
        for y in held:
            if None not in (*x, *y) and x[1] == y[1] and x[0] < y[0]:
                edges.setdefault((x[0], y[0]), []).append(x[1])
    found = pairs.first_shared(df, "e", "i", 2, heavy=heavy)
    got = {(r["source_id"], r["target_id"]): (r["shared_items"], r["item_ids"]) for r in found.collect()}
    assert got == {k: (len(v), sorted(v)[:2]) for k, v in edges.items()} and max(map(len, edges.values())) > 80
    # the pairs that become rows are in the ranges of an edge's first items alone
    asked = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in found.inputFiles() if "edge-ranges" in f})
    assert len(edges) <= asked.count() <= 2 * len(edges)


@pytest.mark.parametrize("heavy", [1, 3, 1000])
def test_pairs_of_heavy_items(spark, heavy):
    held = [(e, i, f"t{i}", float(e * 10 + i)) for e in range(12) for i in range(5) if (e * 7 + i * 3) % 4] + [(3, None, None, 1.0), (4, None, None, 1.0)]
    df = spark.createDataFrame(held, "e int, i int, t string, a double")
    both = [(x, y) for x in held for y in held if x[1] is not None and x[1] == y[1] and x[0] != y[0]]
    assert rows(pairs.shared_pairs(df, "e", "i", ["a"], heavy=heavy)) == sorted(((x[0], x[1], x[3], y[0], y[3]) for x, y in both), key=str)
    edges = {}
    for x, y in both:
        if x[0] < y[0]:
            edges.setdefault((x[0], y[0]), []).append(x[1])
    got = {(r["source_id"], r["target_id"]): (r["shared_items"], r["item_ids"]) for r in pairs.co_participation(df, "e", "i", "t", heavy=heavy).collect()}
    assert got == {k: (len(v), sorted(v)) for k, v in edges.items()}
    peers = {(r["subject_id"], r["peer_id"]): (r["shared_count"], r["combined_amount"]) for r in pairs.peers_of(df, "e", "i", "a", subject=F.col("e") < 4, heavy=heavy).collect()}
    want = {}
    for x, y in both:
        if x[0] < 4:
            n, s = want.get((x[0], y[0]), (0, 0.0))
            want[x[0], y[0]] = (n + 1, s + x[3] + y[3])
    assert peers == want


def one_by_one(days, line):
    out = list(days)
    for n, i in enumerate(range(len(out) - 1, 0, -1)):
        j = int(line[n] * (i + 1))
        out[i], out[j] = out[j], out[i]
    return out


def test_shuffle_null_is_a_shuffle_at_a_time(spark):
    trades = spark.createDataFrame([(1, i, D(2024, 1, 1) + dt.timedelta(days=7 * i), f"T{i % 3}") for i in range(15)], "member_id int, slot int, tx_date date, instrument string")
    votes = spark.createDataFrame([(1, f"v{i}", D(2024, 1, 10) + dt.timedelta(days=31 * i), i % 2 == 0, ["T1"] if i % 2 else []) for i in range(5)], "member_id int, vote_id string, vote_date date, committee boolean, named array<string>")
    got = {p: n for _, p, n in rows(nullmodel.shuffle_null(trades, votes, 30, "a", block=8))}
    seed = value(spark, rng.seed_from(F.col("s")), s="a:1")
    line, known = rng.draws(seed, 30 * 14), votes.collect()
    own = sorted(trades.collect(), key=lambda r: r["slot"])
    for perm in range(30):
        moved = one_by_one([t["tx_date"] for t in own], line[perm * 14 : perm * 14 + 14])
        assert got[perm] == sum(any(0 <= (v["vote_date"] - d).days <= 14 and (v["committee"] or t["instrument"] in v["named"]) for v in known) for t, d in zip(own, moved))


@pytest.mark.parametrize("mode", ["calendar", "shuffle"])
def test_pair_lower_tail_is_a_draw_at_a_time(spark, mode):
    schema = "member_id int, slot int, trade_id string, tx_date date, theme string"
    own = [(1, i, f"t{i if i < 10 else 9}", D(2024, 1, 1) + dt.timedelta(days=9 * i), "AB"[i % 2] if i < 10 else "B") for i in range(12)]
    trades = spark.createDataFrame(own, schema)
    known = [(1, f"v{i}", D(2024, 1, 20) + dt.timedelta(days=23 * i), "AB"[i % 2]) for i in range(6)]
    votes = spark.createDataFrame(known, "member_id int, vote_id string, vote_date date, theme string")
    gaps = nullmodel.observed_gaps(trades, votes)
    observed = {r["trade_id"]: r["observed_gap"] for r in gaps.collect()}
    next_gap = lambda day, theme: min(((v[2] - day).days for v in known if v[3] == theme and 0 <= (v[2] - day).days <= 90), default=None)
    assert observed == {i: g for i in {t[2] for t in own} if (g := min((x for t in own if t[2] == i and (x := next_gap(t[3], t[4])) is not None), default=None)) is not None}
    got = {r["trade_id"]: r["p_pair"] for r in nullmodel.pair_lower_tail(trades, votes, 40, "a", gaps, mode, block=7).collect()}
    seed, n = value(spark, rng.seed_from(F.col("s")), s="a:1"), len(own)
    dates = [t[3] for t in own] + [v[2] for v in known]
    pool = [d for k in range((max(dates) - min(dates)).days + 1) if (d := min(dates) + dt.timedelta(days=k)).weekday() < 5]
    hits = dict.fromkeys(observed, 0)
    line = rng.draws(seed, 40 * n)
    for perm in range(40):
        if mode == "calendar":
            moved = [pool[int(line[perm * n + i] * len(pool))] for i in range(n)]
        else:
            moved = one_by_one([t[3] for t in own], line[perm * (n - 1) : (perm + 1) * (n - 1)])
        for i in {t[2] for t, d in zip(own, moved) if t[2] in observed and (g := next_gap(d, t[4])) is not None and g <= observed[t[2]]}:
            hits[i] += 1
    assert got == {i: pytest.approx((h + 1) / 41) for i, h in hits.items()}


def test_vote_attributes_travel_together(spark):
    votes = spark.createDataFrame([(m, f"v{i}", D(2024, 1, 1) + dt.timedelta(days=i), i % 3 == 0, [f"T{i}"]) for m in (1, 2) for i in range(9)], "member_id int, vote_id string, vote_date date, committee boolean, named array<string>")
    control = nullmodel.scrambled(votes, ["member_id"], ["committee", "named"], ["vote_id"], 4, "s")
    tuples = lambda df: sorted((r["member_id"], r["committee"], r["named"][0]) for r in df.collect())
    for k in range(4):
        one = control.where(F.col("replicate") == k)
        assert tuples(one) == tuples(votes) and rows(one.select("member_id", "vote_id", "vote_date")) == rows(votes.select("member_id", "vote_id", "vote_date"))
    assert len({tuple(r["named"][0] for r in sorted(control.where(F.col("replicate") == k).collect(), key=lambda r: (r["member_id"], r["vote_id"]))) for k in range(4)}) == 4


def test_receipts_by_band(spark):
    pairs = spark.createDataFrame([(m, f"t{i}", D(2024, 1, 1 + i), "X", f"v{i}", "Tech", 3) for m in (1, 2) for i in range(3)], "member_id int, trade_id string, tx_date date, ticker string, vote_id string, theme string, days_before_vote int")
    trades = spark.createDataFrame([(1,)] * 4 + [(2,)] * 10, "member_id int")
    p = spark.createDataFrame([(m, f"t{i}", 0.3 - i / 10) for m in (1, 2) for i in range(2)], "member_id int, trade_id string, p_pair double")
    got = rows(detectors.theme_gap_receipts(pairs, trades, p).select("member_id", "place", "trade_id", "band", F.round("p_pair", 2)))
    assert got == [(1, 1, "t0", "insufficient-data", None), (1, 2, "t1", "insufficient-data", None), (1, 3, "t2", "insufficient-data", None), (2, 1, "t1", "ranked", 0.2), (2, 2, "t0", "ranked", 0.3), (2, 3, "t2", "ranked", None)]


def test_numbering_in_two_levels(spark):
    df = spark.createDataFrame([(g, (i * 7919) % 1000 / 1000, i) for g in ("a", None) for i in range(500)], "g string, u double, i int")
    for unit in (None, "u"):
        got = ordering.numbered(df, ["g"], [F.col("u"), F.col("i")], "n", unit).collect()
        for g in ("a", None):
            assert [r["n"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: (r["u"], r["i"]))] == list(range(500))


def test_names_that_contain_short_and_long_parts(spark):
    members = spark.createDataFrame([(1, "Ann Le", "CA", None), (2, "Bob Leeson", "CA", None), (3, "Cy Ng", "CA", None)], "member_id int, name string, state string, district string")
    filers = spark.createDataFrame([("X Lee", "CA", None), ("X Ng", "CA", None), ("X Le", "CA", None), ("X Leeson", "NY", None)], "filer string, state string, district string")
    assert rows(resolve.resolve_filers(filers, members).select("filer", "member_id", "confidence")) == [("X Le", 1, 0.7), ("X Lee", 2, 1.0), ("X Leeson", None, None), ("X Ng", 3, 1.0)]


def test_identity_sources(spark):
    schema = "id struct<bioguide: string, fec: array<string>>, name struct<first: string, last: string, nickname: string, official_full: string>, terms array<struct<type: string, start: string, end: string, state: string, district: int>>, file int"
    data = [(("A", []), ("Ann", "Lee", None, "Ann Lee"), [("rep", "2001-01-03", "2003-01-03", "CA", 12), ("sen", "2003-01-03", "2009-01-03", "CA", None)], 1), (("A", []), ("Anna", "Lee", None, None), [("rep", "2001-01-03", "2003-01-03", "CA", 3)], 0)]
    got = readers.people(spark.createDataFrame(data, schema), F.col("file")).first()
    assert (got["first"], got["chamber"], got["term_start"], got["term_end"]) == ("Ann", "senate", D(2001, 1, 3), D(2009, 1, 3))
    c = spark.createDataFrame([("HSAG", "House Committee on Agriculture", [("01", "Crops")])], "code string, name string, subcommittees array<struct<code: string, name: string>>")
    assert rows(readers.committee_codes(c)) == [("HSAG", "House Committee on Agriculture"), ("HSAG01", "House Committee on Agriculture — Crops")]
    roles = spark.createDataFrame([("A", "HSAG", "Ranking Member"), ("B", "HSAG", "Vice Chairman"), ("C", "HSAG", None)], "bioguide string, code string, title string")
    assert [r[2] for r in rows(readers.membership_roles(roles))] == ["Ranking Member", "Chair", "Member"]
    runs = spark.createDataFrame([("t1", "x", D(2024, 1, 1)), ("t2", "x", D(2024, 2, 1)), ("t3", "x", D(2024, 3, 1))], "task_id string, target string, updated_at date")
    reviews = spark.createDataFrame([("t1", True), ("t2", True), ("t3", False)], "task_id string, ready_to_apply boolean")
    assert readers.latest_approved(runs, reviews).first()["task_id"] == "t2"


def test_stream_of_trades(spark, tmp_path):
    trades = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2022, 1, 1))], "member_id int, tx_date date")
    trades.write.parquet(str(tmp_path / "in"))
    votes = spark.createDataFrame([(1, D(2024, 1, 9))], "member_id int, vote_date date")
    pairs = near_votes_stream(spark.readStream.schema("member_id int, tx_date date").parquet(str(tmp_path / "in")), votes)
    write_near_votes(pairs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("days_from_trade_to_vote")) == [(8,)]


def test_control_verdict(spark):
    def verdict(p_values):
        tests = spark.createDataFrame([(m, r, p) for m, held in p_values.items() for r, p in enumerate(held)], "member_id int, replicate int, p_value double")
        return rows(nullmodel.control_verdict(tests))

    assert verdict({1: [0.04, 0.05, 0.5, 0.9, 1.0], 2: [0.2] * 5}) == [(0.1, 1, True)]  # 0.05 itself is no hit; a tenth is low enough
    assert verdict({1: [0.01, 0.04, 0.5, 0.9, 1.0], 2: [0.2] * 5}) == [(0.2, 2, False)]
    assert verdict({1: [0.01] * 5 + [0.5] * 5, 2: [0.5] * 90}) == [(0.05, 5, False)]  # a member may have four
    assert verdict({1: [0.01] * 4 + [0.5] * 6, 2: [0.5] * 90}) == [(0.04, 4, True)]


SF = "/root/testdata/sf0.001"


def planned(df):
    """The physical plan as it is before any stage has run: what sizes are taken for."""
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name", ["er01_resolve_filers", "er02_resolve_senate", "er13_match_roster_loosely"])
def test_spread_runs_are_never_broadcast(spark, name):
    assert "BroadcastHashJoin" not in planned(QUERIES[name](spark, SF))


def test_parts_of_every_length_are_found(spark):
    names = ["ab" * n for n in (1, 2, 5, 20, 40)] + ["xyz", "x", ""]
    whole = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    asked = spark.createDataFrame([(p,) for p in ("a", "ba", "bab", "abab", "yz", "ba" * 9, "ab" * 33, "q", "xyzx")], "part string")
    got = {(r["id"], r["part"]) for r in resolve.containing(whole, "name", asked, F.col("part"), []).collect()}
    assert got == {(i, p["part"]) for i, n in enumerate(names) for p in asked.collect() if p["part"] in n}


def test_newest_candidate_is_found_before_people_meet_filings(spark):
    people = spark.createDataFrame([("a", "Lee", "CA", "S"), ("b", "Lee", "CA", None), ("c", "Lee", "CA", "P"), ("a", "Ng", "NY", "H")], "person_id string, last_name string, state string, office string")
    filings = [("Lee", "CA", "S", "old", D(2020, 1, 1)), ("Lee", "CA", "S", "s", D(2021, 1, 1)), ("Lee", "CA", "H", "h", D(2022, 1, 1)), ("Lee", "CA", None, "n", D(2023, 1, 1)), ("Ng", "NY", "H", "ng", None)]
    registry = spark.createDataFrame(filings, "last_name string, state string, office string, candidate_id string, last_file_date date")
    found = resolve.newest_candidate(people, registry)
    assert rows(found) == [("a", "s"), ("b", "n"), ("c", "h")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and plan.rindex("Window [") > plan.index("Join Inner")


def test_meetings_are_counted_without_a_row_for_each_member_and_meeting(spark):
    held = [(1, None, "Markup", "x", ["A", "b"]), (1, None, "Markup", "x", ["C"]), (1, D(2024, 1, 1), "Markup", "x", ["C"]), (2, None, None, "Meeting", ["a", "A", None]), (3, None, "Full hearing", None, ["c"]), (4, None, None, None, [])]
    meetings = spark.createDataFrame(held, "event_id long, date date, title string, type string, committees array<string>")
    memberships = spark.createDataFrame([(m, c) for m, own in enumerate(("ab", "BA", "c", "abc", "z", ["a", "a", None])) for c in own], "member_id long, committee_code string")
    got = flatten.meeting_counts(meetings, memberships)
    plain = flatten.relevant_meetings(meetings, memberships).groupBy("member_id", "kind").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.sum("event_id").alias("event_sum"))
    assert rows(got) == rows(plain) and len(rows(got)) == 11


def test_names_and_labels_are_those_of_the_sql(spark, tmp_path):
    amounts = (999.49, 999.5, 999.77, 999999.5, 1e6, -999.6, None, float("nan"), float("inf"))
    named = [(i, f'O\'Neil "{i}" Sr.' if i else None, 1, a, "X") for i, a in enumerate(amounts)]
    spark.createDataFrame(named, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'" if name == "customer" else f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found = QUERIES["fn_names"](spark, str(tmp_path)).select("c_custkey", "donor", "slug", "money")
    assert rows(found) == sorted(con.sql(f"SELECT c_custkey, donor, slug, money FROM ({ORACLES['fn_names']})").fetchall(), key=str)
    assert [r["money"] for r in found.orderBy("c_custkey").collect()] == ["$", "K", "K", "M", "M", "$", "$", "$", "$"]


def test_links_of_classes_are_all_links(spark):
    seats = spark.createDataFrame([(m, c, r) for m, own in enumerate([["aX", "bY"], ["bY", "aX"], ["aX"], ["aX", "aX"], ["c"], ["aZ", None], [None], ["aX"]]) for o in own for c, r in [(o and o[0], o and o[1:])]], "member long, shared string, role string")
    plain = pairs.shared_pairs(seats, "member", "shared", ["role"])
    found = pairs.shared_classes(seats, "member", "shared", ["role"])
    of = found.where("kind = 'member'").select(F.col("subject_id").alias("m"), F.col("peer_id").alias("c"))
    whole = plain.join(of.toDF("subject_id", "s"), "subject_id").join(of.toDF("peer_id", "p"), "peer_id").groupBy("s", "p", "shared", "subject_role", "peer_role").agg(F.count("*").alias("n"))
    assert rows(found.where("kind = 'link'").select("subject_id", "peer_id", "shared", "subject_role", "peer_role", "n")) == rows(whole)
    links = {r["subject_id"]: r["count"] for r in plain.groupBy("subject_id").count().collect()}
    got = found.where("kind = 'member'").collect()
    assert {r["subject_id"]: r["n"] for r in got} == {m: links.get(m, 0) for m in (0, 1, 2, 3, 4, 5, 7)}
    assert [r["peer_id"] for r in sorted(got)] == [0, 0, 2, 3, 4, 5, 2]


def test_roles_of_classes_are_all_roles(spark):
    bills = spark.createDataFrame([("b1", "a"), ("b2", "a"), ("b2", "a"), ("b3", "a"), ("b3", "c"), ("b4", "z"), ("b5", None)], "bill_id string, committee_canonical string")
    seats = spark.createDataFrame([(1, "a", "Member"), (1, "c", "Chair"), (2, "c", "Chair"), (2, "a", "Member"), (3, "a", "Ranking Member"), (4, "y", "Chair")], "member_id long, committee_canonical string, role string")
    found = proximity.committee_role_classes(bills, seats)
    of = lambda k: found.where(f"kind = '{k}'").select(f"{k}_id", F.col("class_id").alias(f"{k}_class"), F.col("n"))
    role = found.where("kind = 'role'").select(F.col("bill_id").alias("bill_class"), F.col("member_id").cast("string").alias("member_class"), "member_committee_role", F.col("n").alias("held"))
    whole = role.join(of("bill").drop("n"), "bill_class").join(of("member").drop("n"), "member_class")
    assert rows(whole.select("bill_id", "member_id", "member_committee_role")) == rows(proximity.committee_roles(bills, seats))
    assert role.agg(F.sum("held")).first()[0] == whole.count() == 9
    assert rows(of("bill").drop("bill_class")) == [("b1", 3), ("b2", 3), ("b3", 3), ("b4", 0)] and rows(of("member").drop("member_class")) == [(1, 3), (2, 3), (3, 3), (4, 0)]


def test_shuffled_trades_carry_no_days_of_their_instrument(spark):
    trades = spark.createDataFrame([(1, 10 + i, D(2024, 1, 1 + i), "buy", "AB"[i % 2], i) for i in range(6)], "member_id long, filing_id long, tx_date date, tx_type string, instrument string, slot int")
    votes = spark.createDataFrame([(1, "v", D(2024, 1, 3), False, ["A"])], "member_id long, vote_id string, vote_date date, committee boolean, named array<string>")
    found = nullmodel.shuffle_null(trades, votes, 4, "s", window=0)
    assert ".named_on AS named_on" not in found._jdf.queryExecution().analyzed().toString()
    moved = nullmodel.shuffled_dates(trades, 4, "s").collect()
    want = [(1, p, sum(r["perm"] == p and r["slot"] % 2 == 0 and dt.date(1970, 1, 1) + dt.timedelta(days=r["day"]) == D(2024, 1, 3) for r in moved)) for p in range(4)]
    assert rows(found) == want


def test_narrow_windows_give_the_rows_of_all_pairs(spark):
    """roles, bills and committees are brought to pairs, and votes are read once."""
    at = lambda n: D(2024, 1, 1) + dt.timedelta(n)
    trades = spark.createDataFrame([(i, i % 3, at(i), "sale", "self", f"T{i % 2}", "Asset", "ST") for i in range(12)], "filing_id int, member_id int, tx_date date, tx_type string, holder string, ticker string, asset string, asset_type string")
    votes = spark.createDataFrame([(m, f"{m}-{i}", at(3 * i), "q", None if i % 5 == 4 else f"b{i % 4}") for m in range(3) for i in range(14)], "member_id int, vote_id string, vote_date date, vote_question string, bill_id string")
    members = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "member_id int, name string")
    bills = spark.createDataFrame([("b0", "t0", "about T0 here"), ("b1", "t1", None), ("b3", None, "T1 first"), (None, "x", "T1 x")], "bill_id string, bill_title string, bill_summary string")
    handled = spark.createDataFrame([("b0", "C", "c"), ("b0", "D", "d"), ("b1", "C", "c"), ("b2", "D", "d"), ("b3", "E", None), (None, "C", "c")], "bill_id string, committee_name string, committee_canonical string")
    seats = spark.createDataFrame([(0, "c", "Member"), (0, "d", "Ranking Member"), (0, "d", "Member"), (1, "d", "Zeal"), (1, "c", None), (2, None, "Chair"), (2, "c", None)], "member_id int, committee_canonical string, role string")
    tables = (trades, votes, members, bills, handled, seats)
    wide = proximity.trades_before_votes(*tables, window=31).where("days_before_vote <= 14")
    narrow = proximity.trades_before_votes(*tables, window=14)
    assert sorted(narrow.columns) == sorted(wide.columns)
    want = rows(wide)
    assert rows(narrow.select(*wide.columns)) == want and len({(r["member_committee_role"], r["member_on_bill_committee"]) for r in wide.collect()}) == 5
    reads = lambda df: sum("vote_id" in line and ("LogicalRDD" in line or "LocalRelation" in line) for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n"))
    assert reads(narrow) == 1 and reads(wide) == 2


def test_z_scores_without_gathering_a_pattern(spark):
    hits = spark.createDataFrame([("a", 1), ("a", 2), ("a", 6), ("b", 4), ("b", 4)], "pattern string, n_trades int")
    found = detectors.with_z_scores(hits)
    assert sorted((r["n_trades"], r["z_score"]) for r in found.where("pattern = 'a'").collect()) == [(1, None), (2, -0.46291), (6, 1.38873)]
    assert [r["z_score"] for r in found.where("pattern = 'b'").collect()] == [None, None]
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def linked(tmp_path, name, **made):
    """What DuckDB gives for the SQL of a query over the tables that are made, and the small ones otherwise."""
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{made[table]}'" if table in made else f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return sorted(con.sql(ORACLES[name]).fetchall(), key=str)


def test_shared_committees_has_a_row_for_each_pair_of_members(spark, tmp_path):
    """classes of members had replaced the pairs."""
    people = [(1, 0), (2, 0), (8, 0), (3, 2), (3, 2), (15, 0), (5, None), (None, 0)]
    spark.createDataFrame(people, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    role = lambda k: "Member" if k is None else ("Chair", "Ranking Member", "Member", "Member")[k % 4]
    seats = [(k, n + 1, role(k)) for k, n in people if n is not None] + [(k, k % 7 + 1, "Member") for k, _ in people if k is not None]
    want = sorted(((a[0], b[0], f"Brand#{a[1]}", a[2], b[2]) for a in seats for b in seats if None not in (a[0], b[0]) and a[0] != b[0] and a[1] == b[1]), key=str)
    assert rows(QUERIES["j08_shared_committees"](spark, str(tmp_path))) == want == linked(tmp_path, "j08_shared_committees", customer=f"{tmp_path}/customer.parquet/*.parquet")


def test_pairs_are_made_where_they_are_read(spark):
    """pairs of a value that many share are dealt to blocks and to a given number of tasks, and nothing shuffles them."""
    seats = spark.range(3000).select(F.col("id").alias("m"), F.col("id").cast("string").substr(9, 1).alias("c"), F.lit("x").alias("r"))
    found = pairs.shared_pairs(seats, "m", "c", ["r"])
    assert found.count() == 3000 * 2999 and found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    plan = planned(found)
    assert plan.index("Generate inline") < plan.index("SortMergeJoin") < plan.index("REPARTITION_BY_NUM") and plan.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("most", [2, 1000])
def test_committee_roles_has_a_row_for_each_bill_and_member(spark, tmp_path, monkeypatch, most):
    """classes of bills and of members had replaced the pairs."""
    monkeypatch.setattr(proximity, "CLASS_PART", most)
    people = [(1, 0), (2, 0), (8, 0), (3, 2), (3, 2), (4, 4), (29, 0), (57, 0), (85, 0), (None, 0), (5, None)]
    parts = [(k, f"Brand#{k % 5 + 1}", k % 4) for k in range(1, 19)] + [(7, "Brand#9", 1), (7, "Brand#3", 1), (None, "Brand#1", 0), (20, None, 3), (91, "Brand#25", 1)]
    spark.createDataFrame(people, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    role = lambda k: "Member" if k is None else ("Chair", "Ranking Member", "Member", "Member")[k % 4]
    seats = [(k, f"brand#{n + 1}", role(k)) for k, n in people if n is not None] + [(k, f"brand#{k % 7 + 1}", "Member") for k, _ in people if k is not None]
    bill = lambda k: None if k is None else f"118-{('hres', 's', 'hr', 'hr', 'hr')[k % 5]}-{k}"
    handled = [(bill(k), b and b.lower()) for k, b, _ in parts] + [(bill(k), f"brand#{z % 25 + 1}") for k, _, z in parts if k is not None and k % 6 == 0]
    best, held = ("Chair", "Ranking Member", "Member"), {}
    for b, c in handled:
        for m, at, r in seats:
            if c == at:
                held[b, m] = min(held.get((b, m), 2), best.index(r))
    want = sorted(((b, m, best[r]) for (b, m), r in held.items()), key=str)
    made = {t: f"{tmp_path}/{t}.parquet/*.parquet" for t in ("customer", "part")}
    assert rows(QUERIES["j12_committee_roles"](spark, str(tmp_path))) == want == linked(tmp_path, "j12_committee_roles", **made)


def test_all_roles_are_not_shuffled_nor_broadcast(spark):
    """pairs of bills and members become rows after the last exchange."""
    plan = planned(QUERIES["j12_committee_roles"](spark, SF))
    assert plan.lstrip().startswith("Project") or plan.lstrip().startswith("Generate")
    assert plan.index("Generate inline") < plan.index("SortMergeJoin") < plan.index("Repartition" if "Repartition" in plan else "Exchange")
    assert plan.count("BroadcastHashJoin") == 2 and "LeftOuter, BuildRight" in plan  # the sizes of classes of several arrays
