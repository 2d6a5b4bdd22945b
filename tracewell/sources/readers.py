"""Sources: saved records of public bodies to tables. Schemas are given, nothing is inferred; bad records go to a table of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.text import iso_date
from tracewell.operators.merge import last_in_batch

HOUSE_FILING = """filingId string, filer struct<name: string, status: string, stateDistrict: string>, signedAt string, year int,
transactions array<struct<holder: string, asset: string, ticker: string, assetType: string, type: string, date: string, notificationDate: string, amountBand: string, filingStatus: string>>,
_corrupt_record string"""
SENATE_FILING = """filingId string, filer struct<firstName: string, lastName: string>, dateReceived string, ptrUrl string,
transactions array<struct<transactionDate: string, owner: string, ticker: string, asset: string, assetType: string, type: string, amountBand: string, comment: string>>,
_corrupt_record string"""
LOBBYING_FILING = """filing_uuid string, filing_year int, filing_period string, filing_type string, registrant struct<name: string>, client struct<name: string>, income string, expenses string,
dt_posted string, filing_document_url string, url string,
lobbying_activities array<struct<general_issue_code: string, general_issue_code_display: string, government_entities: array<struct<name: string>>,
lobbyists: array<struct<lobbyist: struct<id: bigint, first_name: string, middle_name: string, last_name: string>, covered_position: string, new: boolean>>>>, _corrupt_record string"""
CONTRACT_ROLLUP = """spending_level string, district string, cy int, rows array<struct<code: string, name: string, amount: double>>, _corrupt_record string"""
RECIPIENT_ROLLUP = """district string, cy int, rows array<struct<recipient_id: string, name: string, amount: double>>, _corrupt_record string"""
MEMBER_DOCUMENT = """data struct<id: string,
donors: array<struct<name: string, amount: double, type: string>>, votes: array<struct<vote_id: string, date: string, position: string, question: string, url: string>>,
bills: array<struct<bill_id: string, title: string, role: string>>, committees: array<struct<name: string, role: string>>, controversies: array<struct<topic: string, summary: string>>>,
_corrupt_record string"""
PERSON = """id struct<bioguide: string, fec: array<string>>, name struct<first: string, last: string, nickname: string, official_full: string>,
terms array<struct<type: string, start: string, end: string, state: string, district: int>>, _corrupt_record string"""
COMMITTEE = """code string, name string, subcommittees array<struct<code: string, name: string>>, _corrupt_record string"""


_LOBBYISTS = "array<struct<lobbyist: struct<id: bigint, first_name: string, middle_name: string, last_name: string>, covered_position: string, new: boolean>>"
_ACTIVITIES = f"array<struct<general_issue_code: string, general_issue_code_display: string, government_entities: array<struct<name: string>>, lobbyists: {_LOBBYISTS}>>"


def read_json(spark: SparkSession, path: str, schema: str, whole_files: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad): parsed documents with the file they came from, and what doesn't parse with its text."""
    text = spark.read.text(path, wholetext=whole_files).select(F.input_file_name().alias("file"), "value")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = text.select("file", "value", parsed.alias("doc")).withColumn("broken", F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull())
    return rows.where("not broken").select("doc.*", "file").drop("_corrupt_record"), rows.where("broken").select("file", "value")


def house_transactions(filings: DataFrame) -> DataFrame:
    """A row per transaction with its place in the filing; filings without id, filer or transactions are left out."""
    ok = filings.where("filingId is not null and filer is not null and size(transactions) > 0")
    rows = ok.select("filingId", "filer", "year", F.posexplode("transactions").alias("tx_index", "t"))
    url = F.concat(F.lit("https://disclosures-clerk.house.gov/public_disc/ptr-pdfs/"), F.col("year"), F.lit("/"), F.col("filingId"), F.lit(".pdf"))
    return rows.select(
        F.col("filingId").alias("filing_id"), "tx_index", F.col("filer.name").alias("filer"), F.col("filer.stateDistrict").alias("state_district"),
        F.col("t.holder").alias("holder"), F.col("t.asset").alias("asset"), F.col("t.ticker").alias("ticker"), F.col("t.assetType").alias("asset_type"),
        F.col("t.type").alias("tx_type"), iso_date(F.col("t.date")).alias("tx_date"), F.col("t.amountBand").alias("amount_band"),
        F.col("t.filingStatus").alias("filing_status"), url.alias("source_url"), F.col("year").alias("source_year"),
    )


def senate_transactions(filings: DataFrame) -> DataFrame:
    """The same columns from the other chamber's fields; the year comes from the file's path."""
    ok = filings.where("filingId is not null and filer is not null and size(transactions) > 0")
    rows = ok.select("filingId", "filer", "ptrUrl", "file", F.posexplode("transactions").alias("tx_index", "t"))
    return rows.select(
        F.col("filingId").alias("filing_id"), "tx_index", F.concat_ws(" ", "filer.firstName", "filer.lastName").alias("filer"), F.lit(None).cast("string").alias("state_district"),
        F.col("t.owner").alias("holder"), F.col("t.asset").alias("asset"), F.col("t.ticker").alias("ticker"), F.col("t.assetType").alias("asset_type"),
        F.col("t.type").alias("tx_type"), iso_date(F.col("t.transactionDate")).alias("tx_date"), F.col("t.amountBand").alias("amount_band"),
        F.lit("New").alias("filing_status"), F.col("ptrUrl").alias("source_url"), F.nullif(F.regexp_extract("file", r"/(\d{4})/", 1), F.lit("")).cast("int").alias("source_year"),
    )


def disclosures(house: DataFrame, senate: DataFrame) -> DataFrame:
    """Both chambers' transactions as one table."""
    return house_transactions(house).unionByName(senate_transactions(senate))


def lobbying_filings(saved: DataFrame) -> DataFrame:
    """A row per filing: its own fields, and activities in the shape that ``flatten.lobbyists`` takes. Lobbyists without an id are left out."""
    name = lambda p: F.array_join(F.filter(F.transform(F.array(p["first_name"], p["middle_name"], p["last_name"]), F.trim), lambda x: x.isNotNull() & (x != "")), " ")
    person = lambda e: F.struct(e["lobbyist"]["id"].cast("string").alias("lobbyist_id"), name(e["lobbyist"]).alias("name"), F.trim(e["covered_position"]).alias("position"))
    listed = lambda c: F.coalesce(c, F.array())
    activity = lambda a: F.struct(
        F.coalesce(a["general_issue_code_display"], a["general_issue_code"]).alias("issue"),
        F.transform(F.filter(F.coalesce(a["lobbyists"], F.array().cast(_LOBBYISTS)), lambda e: e["lobbyist"]["id"].isNotNull()), person).alias("lobbyists"),
        F.array_compact(listed(a["government_entities"]["name"]).cast("array<string>")).alias("entities"),
    )
    return saved.where("filing_uuid is not null").select(
        F.col("filing_uuid").alias("filing_id"), "filing_year", "filing_period", "filing_type", F.col("registrant.name").alias("registrant_name"), F.col("client.name").alias("client_name"),
        F.col("income").try_cast("double").alias("income"), F.col("expenses").try_cast("double").alias("expenses"), F.col("dt_posted").alias("posted_at"), F.col("filing_document_url").alias("filing_url"), F.col("url").alias("source_url"),
        F.transform(F.coalesce("lobbying_activities", F.array().cast(_ACTIVITIES)), activity).alias("activities"),
    )


def contract_rows(rollups: DataFrame) -> DataFrame:
    """(district, cy, code, name, amount); a rollup that isn't of transactions fails the load."""
    level = F.assert_true(F.col("spending_level") == "transactions", F.lit("spending_level must be transactions"))
    return rollups.where(level.isNull()).select("district", "cy", F.inline("rows"))


def recipient_rows(rollups: DataFrame) -> DataFrame:
    """(district, cy, recipient_key, name, amount); the key is the id, or the name where there is none."""
    rows = rollups.select("district", "cy", F.inline("rows"))
    return rows.select("district", "cy", F.coalesce("recipient_id", "name").alias("recipient_key"), "name", "amount")


#: The columns of the confirmation table, in order, and its kinds of basis.
CONFIRM_COLUMNS = ("recipient_key", "recipient_name", "ticker", "basis", "evidence", "confirmed_at")
CONFIRM_BASES = ("own-name", "parent-name", "manual")


def confirm_problems(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(recipient_key, problem) of rows that break a rule: basis, evidence, ticker, date, unique key, known recipient."""
    bad = lambda broken, what: F.when(broken, F.lit(what))
    checks = F.array_compact(
        F.array(
            bad(~F.coalesce(F.col("basis").isin(*CONFIRM_BASES), F.lit(False)), "basis"),
            bad(F.coalesce(F.length("evidence"), F.lit(0)) < 10, "evidence"),
            bad(~F.coalesce(F.col("ticker").rlike(r"^[A-Z][A-Z.]{0,5}$"), F.lit(False)), "ticker"),
            bad(F.try_to_date("confirmed_at", "yyyy-MM-dd").isNull(), "date"),
        )
    )
    own = rows.select("recipient_key", F.explode(checks).alias("problem"))
    twice = rows.groupBy("recipient_key").count().where("count > 1").select("recipient_key", F.lit("repeated key").alias("problem"))
    foreign = rows.join(known.select("recipient_key"), "recipient_key", "left_anti").select("recipient_key", F.lit("unknown recipient").alias("problem"))
    return own.unionAll(twice).unionAll(foreign)


def read_confirms(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """The confirmation table from a TSV file; any error refuses the whole load."""
    schema = ", ".join(f"{c} string" for c in CONFIRM_COLUMNS)
    rows = spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    broken = confirm_problems(rows, known).head(5)
    if broken:
        raise ValueError(f"confirmations refused: {[tuple(r) for r in broken]}")
    return rows.withColumn("confirmed_at", F.to_date("confirmed_at"))


def member_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """One table for each list of the members' documents, keyed by member_id."""
    one = documents.select(F.col("data.id").alias("member_id"), "data").where("member_id is not null")
    return {name: one.select("member_id", F.inline(f"data.{name}")) for name in ("donors", "votes", "bills", "committees", "controversies")}


def latest_approved(runs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Of runs whose review is ready to apply the latest for each target; ties go to the smaller task id."""
    ready = runs.join(reviews.where("ready_to_apply").select("task_id"), "task_id", "left_semi")
    order = Window.partitionBy("target").orderBy(F.col("updated_at").desc_nulls_last(), "task_id")
    return ready.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def people(records: DataFrame, ordinal: Column) -> DataFrame:
    """(person_id, first, last, nickname, official, chamber, state, district, term_start, term_end): the last term's place, the first one's start; of records with one id that of the later file."""
    last = F.element_at("terms", -1)
    rows = records.where("id.bioguide is not null").select(
        F.col("id.bioguide").alias("person_id"), "name.first", "name.last", "name.nickname", F.col("name.official_full").alias("official"),
        F.when(last["type"] == "sen", "senate").when(last["type"] == "rep", "house").alias("chamber"), last["state"].alias("state"), last["district"].alias("district"),
        iso_date(F.element_at("terms", 1)["start"]).alias("term_start"), iso_date(last["end"]).alias("term_end"), ordinal.alias("_file"),
    )
    return last_in_batch(rows, ["person_id"], "_file").drop("_file")


def committee_codes(definitions: DataFrame) -> DataFrame:
    """(code, name) of committees and, as "parent — name", of their subcommittees."""
    sub = definitions.select("code", "name", F.explode("subcommittees").alias("s"))
    return definitions.select("code", "name").unionAll(sub.select(F.concat("code", "s.code").alias("code"), F.concat_ws(" — ", "name", "s.name").alias("name")))


def membership_roles(members: DataFrame) -> DataFrame:
    """(bioguide, code, role): chair, ranking or member, from the title's text."""
    title = F.lower(F.coalesce("title", F.lit("")))
    role = F.when(title.rlike("ranking"), "Ranking Member").when(title.rlike("chair"), "Chair").otherwise("Member")
    return members.select("bioguide", "code", role.alias("role")).distinct()


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A curated seed table from a CSV file with a header."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
