"""Data-quality rules, profiles and text checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.scratch import staged

from .ordering import top_rows


#: Words without a neutral use, and loaded phrases.
FORBIDDEN = (
    "corrupt", "crooked", "dishonest", "liar", "traitor", "socialist", "fascist", "communist", "radical", "extremist", "fanatic", "hero", "maverick",
    "crusader", "rammed through", "pushed through", "snuck in", "claims to", "pretends to", "far-left", "far-right", "ultra-left", "ultra-right",
)
#: Codes of states and territories that a profile may have.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "US",
)
#: Words that ground no fact.
STOP_WORDS = ("the", "a", "an", "and", "or", "of", "in", "on", "to", "for", "with", "is", "was", "by", "his", "her", "their")


def rule(field: str, severity: str, message: str, broken: Column) -> Column:
    """The issue if the rule is broken, else null."""
    return F.when(broken, F.struct(F.lit(field).alias("field"), F.lit(severity).alias("severity"), F.lit(message).alias("message")))


def issues(rows: DataFrame, key: str, rules: list[Column]) -> DataFrame:
    """(key, field, severity, message), a row for each broken rule."""
    return rows.select(key, F.inline(F.array_compact(F.array(*rules))))


def profile_issues(profiles: DataFrame, key: str, today: Column) -> DataFrame:
    """(key, field, severity, message): the rules for researched profiles.

    profiles: key, bio, state, in_office (the field as JSON text), bills and votes (title, date,
    confidence), donors (title, confidence); null lists are empty. Dates after today are critical, as
    are a bio under 50 characters and an in_office that isn't a boolean.
    """
    issue = lambda field, severity, message: F.struct(field.alias("field"), F.lit(severity).alias("severity"), message.alias("message"))
    listed = lambda c: F.coalesce(F.col(c), F.array().cast(dict(profiles.dtypes)[c]))
    bio, state = F.coalesce("bio", F.lit("")), F.coalesce("state", F.lit(""))
    given = F.trim("in_office")
    kind = F.when(given.isNull(), "undefined").when(given.startswith('"'), "string").when(given.rlike("^[0-9-]"), "number").otherwise("object")
    late = lambda c, name, field: F.transform(
        F.filter(listed(c), lambda x: x["date"] > today),
        lambda x: issue(F.concat(F.lit(f"data.{name}["), F.coalesce(x["title"], F.lit("undefined")), F.lit(f"].{field}")), "critical", F.concat(F.lit("Future date: "), x["date"].cast("string"))),
    )
    doubtful = lambda c: F.transform(
        F.filter(listed(c), lambda x: x["confidence"] < 0.60),
        lambda x: issue(F.lit("data"), "warning", F.concat(F.lit("Low confidence ("), x["confidence"].cast("string"), F.lit(") on: "), F.coalesce(x["title"], F.lit("undefined")))),
    )
    single = F.array(
        F.when(F.length(bio) < 50, issue(F.lit("data.bio"), "critical", F.concat(F.lit("Bio too short: "), F.length(bio).cast("string"), F.lit(" chars (min 50)")))),
        F.when((state != "") & ~F.upper(state).isin(*US_STATES), issue(F.lit("data.state"), "warning", F.concat(F.lit("Unrecognized state code: "), state))),
        F.when(sum(F.size(listed(c)) for c in ("bills", "votes", "donors")) == 0, issue(F.lit("data"), "info", F.lit("bills, votes, and donors are all empty"))),
        F.when(~F.coalesce(given.isin("true", "false"), F.lit(False)), issue(F.lit("data.inOffice"), "critical", F.concat(F.lit("inOffice must be boolean, got "), kind))),
    )
    found = F.concat(F.array_compact(single), late("bills", "bills", "introducedAt"), late("votes", "votes", "date"), *(doubtful(c) for c in ("bills", "votes", "donors")))
    return profiles.select(key, F.inline(found))


def quality_scores(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, score, passed): 1 less 0.3 for each critical issue and 0.1 for each warning, not below 0; passed without critical ones."""
    n = found.groupBy(key).agg(F.count_if(F.col("severity") == "critical").alias("c"), F.count_if(F.col("severity") == "warning").alias("w"))
    c, w = F.coalesce("c", F.lit(0)), F.coalesce("w", F.lit(0))
    return rows.select(key).distinct().join(n, key, "left").select(key, F.greatest(F.lit(0.0), 1 - 0.3 * c - 0.1 * w).alias("score"), (c == 0).alias("passed"))


def corrected(rows: DataFrame, maps: dict[str, dict[str, str]]) -> DataFrame:
    """Values replaced by those of their column's map (in lower case), with an array of what was corrected. Dates are never repaired."""
    out, notes = rows, []
    for column, known in maps.items():
        table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
        new = F.coalesce(F.try_element_at(table, F.lower(F.trim(column))), F.col(column))
        notes.append(F.when(~new.eqNullSafe(F.col(column)), F.concat(F.lit(f"{column}: "), F.col(column), F.lit(" -> "), new)))
        out = out.withColumn(f"_{column}", new)
    out = out.withColumn("corrections", F.array_compact(F.array(*notes)))
    return out.select(*(F.col(f"_{c}").alias(c) if c in maps else F.col(c) for c in rows.columns), "corrections")


def conformance(docs: DataFrame, json_col: str, kind_col: str, required: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Share of documents of each kind whose fields parse, and counts by failure signature (missing or ill-typed fields, in order)."""
    schema = ", ".join(f"{name} {kind}" for name, kind in required.items())
    parsed = docs.withColumn("_doc", F.from_json(json_col, schema, {"mode": "PERMISSIVE"}))
    bad = F.array_join(F.array_compact(F.array(*(F.when(F.col("_doc")[name].isNull(), F.lit(name)) for name in required))), ",")
    rows = parsed.select(kind_col, bad.alias("signature"))
    rates = rows.groupBy(kind_col).agg(F.count("*").alias("n"), F.avg((F.col("signature") == "").cast("int")).alias("rate"))
    return rates, rows.where("signature <> ''").groupBy(kind_col, "signature").agg(F.count("*").alias("n"))


def shape_profile(docs: DataFrame, key: str, json_col: str) -> DataFrame:
    """(path, docs, types, numeric_strings, sample): one row for each path of the JSON documents; text that isn't JSON, or names a field twice, has the path "!".

    Documents are parsed to variants once and taken apart level by level, as many levels as the
    deepest has, each written before the next; no Python touches a document. Empty objects and arrays have no path.
    """
    rows = docs.select(F.col(key).cast("string").alias("k"), F.try_parse_json(json_col).alias("v")).select("k", F.when(F.col("v").isNull(), "!").otherwise("$").alias("path"), "v")
    leaf = lambda df: df.where(~F.col("kind").rlike("^(OBJECT|ARRAY)"))
    found = []
    while True:
        kinds = rows.withColumn("kind", F.when(F.col("path") == "!", "INVALID").otherwise(F.schema_of_variant("v")))
        level = staged(kinds.withColumn("said", F.variant_get("v", "$", "string")).select("k", "path", "kind", "v", "said"), "shapes")
        found.append(leaf(level).select("k", "path", "kind", "said"))
        nested = level.where(F.col("kind").rlike("^(OBJECT|ARRAY)"))
        if nested.isEmpty():
            break
        inner = nested.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), "key"))
        rows = inner.select("k", F.concat("path", step).alias("path"), F.col("value").alias("v"))
    numbers = "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"
    kind = F.when(F.col("kind") == "INVALID", "invalid").when(F.col("kind") == "VOID", "null").when(F.col("kind") == "BOOLEAN", "boolean").when(F.col("kind").rlike(numbers), "number").otherwise("string")
    numeric = (kind == "string") & F.col("said").rlike(r"^-*(\d+\.?\d*|\.\d+)$")
    leaves = reduce(DataFrame.unionAll, found).select("k", "path", kind.alias("type"), F.coalesce(numeric, F.lit(False)).alias("numeric"), F.substring(F.coalesce("said", F.lit("")), 1, 40).alias("sample"))
    return leaves.groupBy("path").agg(
        F.count_distinct("k").alias("docs"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.count_if("numeric").alias("numeric_strings"), F.min("sample").alias("sample")
    )


def banned_terms(texts: DataFrame, key: str, text: str, terms: list[str] | tuple[str, ...] = FORBIDDEN) -> DataFrame:
    """(key, term): single words between boundaries of ASCII words, phrases and hyphenated terms anywhere, in any case."""
    low = F.lower(text)
    phrase = lambda t: " " in t or "-" in t
    hit = lambda t: F.contains(low, F.lit(t.lower())) if phrase(t) else low.rlike(rf"(?<![a-z0-9_]){t.lower()}(?![a-z0-9_])")
    return texts.select(key, F.explode(F.array_compact(F.array(*(F.when(hit(t), F.lit(t)) for t in terms)))).alias("term"))


def replace_phrases(text: Column, phrases: list[tuple[str, str]]) -> Column:
    """Phrases replaced one after another, in any case."""
    return reduce(lambda c, p: F.regexp_replace(c, f"(?i){p[0]}", p[1]), phrases, text)


def is_grounded(fact: Column, corpus: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Whether some token of a-z and 0-9 of more than three characters, no stop word, stands anywhere in the corpus, in any case."""
    tokens = F.filter(F.split(F.lower(fact), "[^a-z0-9]+"), lambda t: (F.length(t) > 3) & ~t.isin(*stop))
    low = F.lower(F.coalesce(corpus, F.lit("")))
    return F.coalesce(F.exists(tokens, lambda t: F.contains(low, t)), F.lit(False))


def split_facts(rows: DataFrame, key: str, facts: str, corpus: str, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """(key, key_facts, unverified): the facts, blank ones left out, in their order, that the corpus grounds, and the others."""
    said = F.filter(F.coalesce(F.col(facts), F.array().cast("array<string>")), lambda f: f.isNotNull() & (F.trim(F.regexp_replace(f, r"\s+", " ")) != ""))
    held = lambda f: is_grounded(f, F.col(corpus), stop)
    return rows.select(key, F.filter(said, held).alias("key_facts"), F.filter(said, lambda f: ~held(f)).alias("unverified"))


def grounded(text: Column, facts: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Sentences that the facts ground."""
    return F.array_join(F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: is_grounded(s, facts, stop)), " ")


def release_verdict(checks: list[Column], fatal: list[Column]) -> Column:
    """rejected if a fatal check fails, approved_with_warnings from three failed checks on, else approved."""
    failed = reduce(lambda a, b: a + b, ((~c).cast("int") for c in checks), F.lit(0))
    lost = reduce(lambda a, b: a | b, (~c for c in fatal), F.lit(False))
    return F.when(lost, "rejected").when(failed >= 3, "approved_with_warnings").otherwise("approved")


def key_overlap(left: DataFrame, right: DataFrame, key_left: str, key_right: str) -> DataFrame:
    """One row: null share and distinct keys of each side, and keys that both have."""
    side = lambda df, c, name: df.agg(F.avg(F.col(c).isNull().cast("int")).alias(f"{name}_null_share"), F.count_distinct(c).alias(f"{name}_keys"))
    a, b = left.select(F.col(key_left).alias("k")).distinct(), right.select(F.col(key_right).alias("k")).distinct()
    shared = a.join(b, "k", "left_semi").agg(F.count("*").alias("shared_keys"))
    return side(left, key_left, "left").join(side(right, key_right, "right"), F.lit(True)).join(shared, F.lit(True))


def top_keys(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent keys."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(key).asc_nulls_last()).limit(k)


def crosswalk_conflicts(mapped: DataFrame, value: str, theme: str, known: DataFrame) -> DataFrame:
    """(value, problem): values with more than one theme, and values whose theme isn't among the known ones (a column of the same name)."""
    several = mapped.groupBy(value).agg(F.count_distinct(theme).alias("themes")).where("themes > 1").select(value, F.lit("several themes").alias("problem"))
    foreign = mapped.join(known.select(theme).distinct(), theme, "left_anti").select(value).distinct().withColumn("problem", F.lit("unknown theme"))
    return several.unionAll(foreign)


def repeated_prefixes(prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Prefixes that stand in the crosswalk more than once."""
    return prefixes.groupBy(prefix).agg(F.count("*").alias("n")).where("n > 1")


def orphans(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key, not null, the known table doesn't have."""
    return rows.where(F.col(key).isNotNull()).join(known.select(key).distinct(), key, "left_anti")


def require(report: DataFrame, condition: str, message: str) -> None:
    """Raises if any row of a small report breaks the condition."""
    broken = report.where(f"NOT coalesce({condition}, false)").head(5)
    if broken:
        raise ValueError(f"{message}: {[r.asDict() for r in broken]}")


def busiest(df: DataFrame, by: list[str], key: str, k: int) -> DataFrame:
    """The k most frequent keys of each group."""
    return top_rows(df.groupBy(*by, key).agg(F.count("*").alias("n")), by, [F.col("n").desc(), F.col(key).asc_nulls_last()], k)
