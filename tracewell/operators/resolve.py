"""Entity resolution: names to ids, with ambiguity as a result of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.text import corporate_name, last_name, person_name, slug

#: Nicknames and the legal first names that they stand for.
NICKNAMES = {
    "chuck": "charles",
    "bernie": "bernard",
    "dan": "daniel",
    "don": "donald",
    "bill": "william",
    "bob": "robert",
    "mike": "michael",
    "jim": "james",
    "joe": "joseph",
    "tom": "thomas",
    "ted": "edward",
    "liz": "elizabeth",
}


#: Lengths of the runs of characters that parts are looked up by.
RUNS = (64, 32, 16, 8, 4, 2, 1)


def containing(whole: DataFrame, text: str, asked: DataFrame, part: Column, on: list[str]) -> DataFrame:
    """Rows of whole joined to rows of asked whose part their text contains, joined by equality.

    A part is looked up by its runs of the greatest power of two that it is long enough for, so that a run
    is half of it at least, and of these by the one that the fewest texts hold; distinct texts are spread to their
    runs of the lengths in use. The part is then looked for in candidates alone. Names that all begin alike
    don't meet in one key. Spread tables are many times what Spark takes them for: they are merged, never broadcast.
    """
    texts = whole.select(F.col(text).alias("_text")).where("_text is not null").distinct()
    a = asked.withColumn("_part", part).where("_part <> ''")
    size = F.coalesce(*(F.when(F.length("_part") >= n, n) for n in RUNS))
    parts = a.select("_part").distinct().withColumn("_size", size)
    # runs are known by a hash: equal hashes of others only add candidates
    runs_of = lambda c, n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.xxhash64(F.substr(F.col(c), i, n)))
    used = parts.agg(F.collect_set("_size").alias("_sizes"))
    sized = texts.join(used, F.lit(True)).select("_text", F.explode("_sizes").alias("_size")).where(F.length("_text") >= F.col("_size"))
    held = sized.select("_text", F.explode(F.array_distinct(runs_of("_text", F.col("_size")))).alias("_run"))
    counts = held.groupBy("_run").agg(F.count("*").alias("_n"))
    looked = parts.select("_part", F.explode(F.array_distinct(runs_of("_part", F.col("_size")))).alias("_run")).join(counts.hint("merge"), "_run", "left")
    # a run that no text holds says that the part is in none
    rarest = looked.groupBy("_part").agg(F.min_by("_run", F.struct(F.coalesce("_n", F.lit(0)), F.col("_run"))).alias("_run"))
    pairs = held.hint("merge").join(rarest, "_run").where(F.contains("_text", F.col("_part"))).select("_text", "_part")
    found = whole.withColumn("_text", F.col(text)).hint("merge").join(pairs, "_text").join(a.hint("merge"), [*on, "_part"])
    return found.drop("_text", "_part")


def resolve_filers(filers: DataFrame, members: DataFrame) -> DataFrame:
    """(filer, state, district, member_id, confidence, method) for distinct filers, by state and last name.

    One candidate whose name contains the last name: 1.0. Several, one of them of the filer's
    district: 0.95. Several otherwise: the one with the smallest id, 0.70. None: null.
    """
    f = filers.select("filer", "state", "district").distinct().withColumn("_last", last_name(F.col("filer")))
    m = members.select(F.col("member_id").alias("_member"), "state", F.col("district").alias("_district"), F.lower("name").alias("_name"))
    found = containing(m, "_name", f, F.lower("_last"), ["state"])
    same = F.col("_district").eqNullSafe(F.col("district")) & F.col("district").isNotNull()
    best = found.groupBy("filer", "state", "district").agg(
        F.count("*").alias("n"), F.min("_member").alias("first"), F.count_if(same).alias("n_same"), F.min(F.when(same, F.col("_member"))).alias("same")
    )
    best = best.toDF("_f", "_s", "_d", "n", "first", "n_same", "same")
    joined = f.join(best, F.expr("filer <=> _f and state <=> _s and district <=> _d"), "left")
    by_district = (F.col("n") > 1) & (F.col("n_same") == 1)
    return joined.select(
        "filer",
        "state",
        "district",
        F.when(by_district, F.col("same")).otherwise(F.col("first")).alias("member_id"),
        F.when(F.col("n") == 1, 1.0).when(by_district, 0.95).when(F.col("n") > 1, 0.70).alias("confidence"),
        F.when(F.col("n") == 1, "exact_state_lastname").when(by_district, "state_district_lastname").when(F.col("n") > 1, "state_lastname_ambiguous").otherwise("unmatched").alias("method"),
    )


def resolve_senate_filers(filers: DataFrame, members: DataFrame) -> DataFrame:
    """(first_name, last_name, member_id, confidence, method) by surname among senators.

    Surnames are compared without what isn't a letter or space and without a generation at the end, in
    any case. Several candidates are narrowed by the first name's first token; of those left the one with
    the smallest id, at 0.70. None: confidence 0.
    """
    clean = F.trim(F.regexp_replace(F.trim(F.regexp_replace("last_name", r"[^a-zA-Z\s]", "")), r"(?i)\s+(jr|sr|ii|iii|iv|v)$", ""))
    f = filers.select("first_name", "last_name").distinct().withColumn("_last", F.lower(clean))
    m = members.where("chamber = 'senate'").select(F.col("member_id").alias("_member"), F.lower("name").alias("_name"))
    token = F.lower(F.element_at(F.split(F.trim("first_name"), r"\s+"), 1))
    found = containing(m, "_name", f, F.col("_last"), [])
    narrow = F.contains(F.col("_name"), token) & (token != "")
    best = found.groupBy("first_name", "last_name").agg(
        F.count("*").alias("n"), F.min("_member").alias("first"), F.count_if(narrow).alias("n_narrow"), F.min(F.when(narrow, F.col("_member"))).alias("narrow")
    )
    best = best.toDF("_f", "_l", "n", "first", "n_narrow", "narrow")
    one = (F.col("n") > 1) & (F.col("n_narrow") == 1)
    return f.join(best, F.expr("first_name <=> _f and last_name <=> _l"), "left").select(
        "first_name",
        "last_name",
        F.when(one, F.col("narrow")).otherwise(F.col("first")).alias("member_id"),
        F.when(F.col("n") == 1, 1.0).when(one, 0.95).when(F.col("n") > 1, 0.70).otherwise(0.0).alias("confidence"),
        F.when(F.col("n") == 1, "exact_senate_lastname").when(one, "senate_firstname_lastname").when(F.col("n") > 1, "senate_lastname_ambiguous").otherwise("unmatched").alias("method"),
    )


def aliases(people: DataFrame) -> DataFrame:
    """(alias, person_id): official name, first and last both ways, nickname and last both ways; never a last name alone."""
    pair = lambda a, b: [F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.concat_ws(" ", a, b)), F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.concat_ws(", ", b, a))]
    forms = F.array_compact(F.array("official", *pair("first", "last"), *pair("nickname", "last")))
    out = people.select("person_id", F.explode(F.array_distinct(F.transform(forms, person_name))).alias("alias"))
    return out.where("alias <> ''").select("alias", "person_id").distinct()


def resolve_aliases(queries: DataFrame, alias_table: DataFrame) -> DataFrame:
    """(query, person_id, status, candidates): a known id wins; else one alias hit is ok, several are ambiguous, none unresolved."""
    by_alias = alias_table.groupBy("alias").agg(F.array_sort(F.collect_set("person_id")).alias("candidates"))
    named = queries.withColumn("alias", person_name(F.col("query"))).join(by_alias, "alias", "left")
    n = F.coalesce(F.size("candidates"), F.lit(0))
    given = F.col("known_id").isNotNull()
    return named.select(
        "query",
        F.when(given, F.col("known_id")).when(n == 1, F.col("candidates")[0]).alias("person_id"),
        F.when(given | (n == 1), "ok").when(n > 1, "ambiguous").otherwise("unresolved").alias("status"),
        F.when(given, F.lit(1)).otherwise(F.greatest(n, F.lit(0))).alias("candidates"),
    )


def stable_slugs(people: DataFrame, existing: DataFrame) -> DataFrame:
    """(person_id, slug): the one that exists, else one made from the name."""
    return people.join(existing.select("person_id", F.col("slug").alias("_slug")), "person_id", "left").select("person_id", F.coalesce("_slug", slug(F.col("name"))).alias("slug"))


def match_tickers(names: DataFrame, titles: DataFrame) -> DataFrame:
    """names (key, name, parent_name) with ticker and basis: own name before parent name, compared without company words.

    Of titles that are alike without them, the first (by ordinal) gives the ticker.
    """
    index = titles.withColumn("_norm", corporate_name(F.col("title"))).where("_norm <> ''").groupBy("_norm").agg(F.upper(F.min_by("ticker", "ordinal")).alias("_ticker"))
    own, parent = index.toDF("_own", "_own_ticker"), index.toDF("_parent", "_parent_ticker")
    return (
        names.withColumn("_own", corporate_name(F.col("name")))
        .withColumn("_parent", corporate_name(F.col("parent_name")))
        .join(own, "_own", "left")
        .join(parent, "_parent", "left")
        .select(
            *names.columns,
            F.coalesce("_own_ticker", "_parent_ticker").alias("ticker"),
            F.when(F.col("_own_ticker").isNotNull(), "own-name").when(F.col("_parent_ticker").isNotNull(), "parent-name").alias("basis"),
        )
    )


def curation_list(recipients: DataFrame, titles: DataFrame, traded: DataFrame) -> DataFrame:
    """(key, name, parent_name, ticker, basis) of recipients whose candidate ticker somebody traded."""
    one = recipients.groupBy("key").agg(F.min("name").alias("name"), F.min("parent_name").alias("parent_name"))
    return match_tickers(one, titles).where(F.col("ticker").isNotNull()).join(traded.select("ticker").distinct(), "ticker", "left_semi")


def loose_name(raw: Column) -> Column:
    """Upper case letters and digits; company words stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(raw), "[^A-Z0-9 ]", " "), r"\s+", " "))


def accept_tier(name: Column, title: Column) -> Column:
    """accept if the name is the title but for case and punctuation, or has two tokens or more without company words; else verify, and always without a title.

    Every matched name is the title without company words, so that says nothing: FRONTIER TECHNOLOGY
    INC against Frontier Group Holdings, Inc. is to be verified.
    """
    tokens = F.filter(F.split(corporate_name(name), " "), lambda t: t != "")
    return F.when(title.isNotNull() & ((loose_name(name) == loose_name(title)) | (F.size(tokens) >= 2)), "accept").otherwise("verify")


def split_tiers(work: DataFrame, titles: DataFrame) -> DataFrame:
    """The work list (key, name, parent_name, ticker, basis) with the issuer's title, the first by ordinal of its ticker, and the tier of the name that matched."""
    first = titles.groupBy(F.upper("ticker").alias("ticker")).agg(F.min_by("title", "ordinal").alias("title"))
    matched = F.when(F.col("basis") == "parent-name", F.col("parent_name")).otherwise(F.col("name"))
    return work.join(first, "ticker", "left").select(*work.columns, "title", accept_tier(matched, F.col("title")).alias("tier"))


def brand_contained(brand: Column, name: Column) -> Column:
    """All tokens of the brand, at least one, are tokens of the name."""
    tokens = lambda c: F.filter(F.split(corporate_name(c), " "), lambda t: t != "")
    return (F.size(tokens(brand)) > 0) & (F.size(F.array_except(tokens(brand), tokens(name))) == 0)


def assemble_verdicts(work: DataFrame, verdicts: DataFrame, key: str = "key") -> DataFrame:
    """Each key of the work list with its one verdict, or the problem: conflict or missing."""
    said = verdicts.groupBy(key).agg(F.count_distinct("verdict").alias("_n"), F.min("verdict").alias("_one"))
    n = F.coalesce("_n", F.lit(0))
    return work.select(key).distinct().join(said, key, "left").select(
        key, F.when(n == 1, F.col("_one")).alias("verdict"), F.when(n == 0, "missing").when(n > 1, "conflict").alias("problem")
    )


def newest_candidate(people: DataFrame, registry: DataFrame) -> DataFrame:
    """(person_id, candidate_id): newest filing of the same last name, state and office, else of the same name and state."""
    newest = [F.col("last_file_date").desc_nulls_last(), F.col("candidate_id")]
    first = Window.partitionBy("last_name", "state", "office").orderBy(*newest)
    # of a name, state and office only the newest filing can be anybody's
    best = registry.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    found = people.alias("p").join(best.alias("r"), ["last_name", "state"])
    order = Window.partitionBy("person_id").orderBy((F.col("r.office") == F.col("p.office")).desc(), *newest)
    return found.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").select("person_id", "candidate_id")


def _matched(names: DataFrame, found: DataFrame) -> DataFrame:
    """(query, person_id, status) from candidates (query, person_id, rank): those of the best rank count, several of them are ambiguous."""
    by = found.groupBy("query", "rank").agg(F.min("person_id").alias("_id"), F.max("person_id").alias("_other"))
    top = by.groupBy("query").agg(F.min_by(F.struct("_id", "_other"), "rank").alias("_top"))
    one = F.col("_top._id") == F.col("_top._other")
    return names.join(top, "query", "left").select(
        "query", F.when(one, F.col("_top._id")).alias("person_id"), F.when(one, "ok").when(F.col("_top._id").isNotNull(), "ambiguous").otherwise("unresolved").alias("status")
    )


def match_roster(names: DataFrame, roster: DataFrame, nicknames: dict[str, str] = NICKNAMES) -> DataFrame:
    """(query, person_id, status) from roster (person_id, first, last): the query ends in the whole surname, which may have several words, and begins with the first name or a nickname of it.

    A query is spread to its endings of one word, two words and so on, which join surnames by
    equality; longer surnames go before shorter ones, given names before nicknames: "John Schultz" isn't
    Wasserman Schultz. Only the first word of the roster's first name counts.
    """
    tokens = lambda c: F.filter(F.split(F.lower(F.trim(c)), r"\s+"), lambda t: t != "")
    q = names.select("query", tokens("query").alias("_t"))
    cut = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_t") - 1, F.lit(1))), lambda n: n < F.size("_t"))
    q = q.select("query", F.try_element_at("_t", F.lit(1)).alias("_first"), "_t", F.explode(cut).alias("_n"))
    q = q.withColumn("_last", F.array_join(F.slice("_t", F.size("_t") - F.col("_n") + 1, F.col("_n")), " "))
    r = roster.select("person_id", F.try_element_at(tokens("first"), F.lit(1)).alias("_rf"), F.array_join(tokens("last"), " ").alias("_last"))
    legal = F.try_element_at(F.create_map(*(F.lit(x) for pair in nicknames.items() for x in pair)), F.col("_first")) if nicknames else F.lit(None)
    named = F.when(F.col("_first") == F.col("_rf"), 0).when(legal == F.col("_rf"), 1)
    found = q.join(r, "_last").withColumn("_how", named).where("_how is not null")
    return _matched(names, found.select("query", "person_id", F.struct((-F.col("_n")).alias("n"), F.col("_how").alias("how")).alias("rank")))


def match_roster_loosely(names: DataFrame, roster: DataFrame) -> DataFrame:
    """As ``match_roster``, but the last word and the surname may contain one another, and first names begin alike: one with the other, or in four letters.

    Equal surnames go before those that contain one another. The containing joins go by equality of rare runs of letters.
    """
    word = lambda n: F.lower(F.element_at(F.split(F.trim("query"), r"\s+"), n))
    q = names.where(F.trim("query") != "").select("query", word(1).alias("_first"), word(-1).alias("_last"))
    r = roster.select("person_id", F.lower(F.trim("first")).alias("_rf"), F.lower(F.trim("last")).alias("_rl")).where("_rl <> ''")
    held = containing(r, "_rl", q, F.col("_last"), []).select("query", "person_id", "_first", "_last", "_rf", "_rl")
    holds = containing(q, "_last", r, F.col("_rl"), []).select(held.columns)
    begins = lambda a, b: F.startswith(F.col(a), F.col(b)) | F.startswith(F.col(a), F.substring(b, 1, 4))
    found = held.unionAll(holds).where(begins("_rf", "_first") | begins("_first", "_rf"))
    return _matched(names, found.select("query", "person_id", F.when(F.col("_last") == F.col("_rl"), 0).otherwise(1).alias("rank")))


def fold_aliases(rows: DataFrame, alias_map: DataFrame, id_col: str) -> DataFrame:
    """Ids that stand for another one are replaced; rows that are then alike become one."""
    m = alias_map.select(F.col("alias_id").alias("_alias"), "main_id")
    return rows.join(m, F.col(id_col) == F.col("_alias"), "left").withColumn(id_col, F.coalesce("main_id", id_col)).select(rows.columns).dropDuplicates()
