"""Scalar functions over columns: names, ids, categories, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are no part of a donor's name.
NAME_SUFFIXES = ("JR", "SR", "II", "III", "IV", "ESQ", "PHD", "MD")
#: Words after a surname that are no part of it.
SURNAME_SUFFIXES = ("JR", "SR", "II", "III", "IV", "ESQ", "PHD", "MD")
#: Words that say nothing about a committee.
COMMITTEE_STOP = ("committee", "subcommittee", "on", "and", "the", "of", "house", "senate", "select", "joint")
#: What stands before and after a committee's own name.
COMMITTEE_PATTERNS = (r"^(house|senate|joint)\s+committee\s+on\s+", r"^(house|senate|joint)\s+", r"\s+committee$", r"^the\s+")
#: Words that are no part of a company's name, longest alternatives first where one begins another.
CORPORATE_WORDS = (
    "INCORPORATED", "CORPORATION", "COMPANY", "CORP", "INC", "LLC", "LLP", "LP", "LTD", "CO", "PLC", "SA", "NV", "AG",
    "HOLDINGS?", "GROUP", "INTERNATIONAL", "INTL", "USA", "US", "NORTH AMERICA", "AMERICAS?", "ENTERPRISES?", "INDUSTRIES",
    "TECHNOLOGIES", "TECHNOLOGY", "SYSTEMS?", "SERVICES?", "SOLUTIONS?",
)
#: Titles before, and generations after, a person's name.
TITLES = ("Hon", "Mr", "Mrs", "Ms", "Dr", "Sen", "Rep", "Senator", "Representative")
GENERATIONS = ("jr", "sr", "ii", "iii", "iv", "v")
#: Codes of the kinds of bills and how free text writes them; longer ones first.
BILL_KINDS = {
    "hconres": ("H", "Con", "Res"),
    "sconres": ("S", "Con", "Res"),
    "hjres": ("H", "J", "Res"),
    "sjres": ("S", "J", "Res"),
    "hres": ("H", "Res"),
    "sres": ("S", "Res"),
    "hr": ("H", "R"),
    "s": ("S",),
}
#: First and last of the first two digits of an industry code, and the group's name.
SIC_GROUPS = (
    (1, 9, "Agriculture, Forestry & Fishing"),
    (10, 14, "Mining & Extraction"),
    (15, 17, "Construction"),
    (20, 39, "Manufacturing"),
    (40, 49, "Transportation & Utilities"),
    (50, 51, "Wholesale Trade"),
    (52, 59, "Retail Trade"),
    (60, 67, "Finance, Insurance & Real Estate"),
    (70, 89, "Services"),
    (91, 99, "Public Administration"),
)
#: How the public site's addresses write the kinds of bills.
BILL_URL_KINDS = {
    "hr": "house-bill",
    "s": "senate-bill",
    "hres": "house-resolution",
    "sres": "senate-resolution",
    "hjres": "house-joint-resolution",
    "sjres": "senate-joint-resolution",
    "hconres": "house-concurrent-resolution",
    "sconres": "senate-concurrent-resolution",
}
#: Codes of the House's filings for holders and kinds of transactions.
HOLDER_CODES = {"SP": "spouse", "JT": "joint", "DC": "dependent-child", "": "self"}
TRANSACTION_CODES = {"P": "purchase", "S": "sale", "S (partial)": "sale-partial", "E": "exchange", "X": "exchange"}


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def donor_canonical(raw: Column, extra: str = "") -> Column:
    """Upper case without suffix words and punctuation; null becomes empty. ``extra``: more characters to drop."""
    bare = F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), rf"\b({'|'.join(NAME_SUFFIXES)})\b\.?", "")
    return _squeeze(F.regexp_replace(bare, rf"[.,{extra}]", " "))


def lobbyist_canonical(raw: Column) -> Column:
    """As for donors; apostrophes and backticks go too."""
    return donor_canonical(raw, "'`")


def corporate_name(raw: Column) -> Column:
    """Upper case letters and digits without company words, taken out in one pass."""
    bare = F.regexp_replace(F.upper(raw), "[^A-Z0-9 ]", " ")
    return _squeeze(F.regexp_replace(bare, rf"\b({'|'.join(CORPORATE_WORDS)})\b", " "))


def person_name(raw: Column) -> Column:
    """Lower case, punctuation as space, without tokens of one letter."""
    tokens = F.split(F.regexp_replace(F.lower(raw), "[.,'\"]", " "), r"\s+")
    return F.array_join(F.filter(tokens, lambda t: F.length(t) > 1), " ")


def committee_canonical(raw: Column) -> Column:
    """Parent committee without chamber, "committee on", suffix or article; null when nothing is left."""
    s = F.element_at(F.split(F.lower(raw), r"\s*[—-]\s+"), 1)
    for pattern in COMMITTEE_PATTERNS:
        s = F.regexp_replace(s, pattern, "")
    return F.nullif(_squeeze(F.regexp_replace(s, "[.,]", " ")), F.lit(""))


def slug(raw: Column) -> Column:
    """Lower case, quotes dropped, all else but letters and digits as single dashes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(raw), "['\"]", ""), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def last_name(raw: Column) -> Column:
    """Last token of a name without titles and generations; null when nothing is left."""
    bare = _squeeze(F.regexp_replace(raw, rf"(?i)\b({'|'.join(TITLES)})\b\.?", ""))
    tokens = F.filter(F.split(bare, " "), lambda t: F.length(t) > 0)
    named = F.filter(tokens, lambda t: ~t.rlike(rf"(?i)^({'|'.join(GENERATIONS)})\.?,?$"))
    return F.when(F.size(tokens) == 0, None).when(F.size(named) == 0, tokens[0]).otherwise(F.element_at(named, -1))


def surname(raw: Column) -> Column:
    """Last token of a name without its dots and commas; the one before if it is a generation or a degree and not alone; empty for an empty name."""
    tokens = F.filter(F.split(F.trim(raw), r"\s+"), lambda t: t != "")
    bare = lambda at: F.regexp_replace(F.try_element_at(tokens, F.lit(at)), "[.,]", "")
    suffix = F.upper(bare(-1)).isin(*SURNAME_SUFFIXES) & (F.size(tokens) >= 2)
    return F.when(F.size(tokens) == 0, "").when(suffix, bare(-2)).otherwise(bare(-1))


def regex_escape(raw: Column) -> Column:
    """The text as a pattern that matches it literally."""
    return F.regexp_replace(raw, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def strip_html(raw: Column) -> Column:
    """Tags as space, the five named entities decoded, white space collapsed."""
    s = F.regexp_replace(raw, "<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return _squeeze(s)


def state_district(raw: Column) -> Column:
    """struct(state, district) of two capitals and up to three digits; both null for other text, district null when it has none."""
    pattern = r"^([A-Z]{2})(\d{0,3})$"
    return F.struct(
        F.nullif(F.regexp_extract(raw, pattern, 1), F.lit("")).alias("state"), F.nullif(F.regexp_extract(raw, pattern, 2), F.lit("")).alias("district")
    )


def bill_reference(raw: Column) -> Column:
    """Such as hr-8752, from the first "H.R. 8752" or the like in a text; null if there is none."""
    kinds = "|".join(r"\s*\.?\s*".join(parts) for parts in BILL_KINDS.values())
    pattern = rf"(?i)\b({kinds})\s*\.?\s+(\d+)\b"
    kind = F.lower(F.regexp_replace(F.regexp_extract(raw, pattern, 1), r"[\s.]", ""))
    return F.when(kind != "", F.concat_ws("-", kind, F.regexp_extract(raw, pattern, 2)))


def vote_id_from_url(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/votes/([^/]+/\w+)", 1), F.lit(""))


def congress_from_url(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/votes/(\d+)-", 1), F.lit("")).cast("int")


def bill_id_from_url(url: Column) -> Column:
    """Such as 118/hr/4, from .../bill/118th-congress/house-bill/4."""
    pattern = r"/bill/(\d+)\w+-congress/([^/]+)/(\d+)"
    kind = F.regexp_extract(url, pattern, 2)
    code = F.when(kind.startswith("house"), "hr").when(kind.startswith("senate"), "s").otherwise(kind)
    return F.when(kind != "", F.concat_ws("/", F.regexp_extract(url, pattern, 1), code, F.regexp_extract(url, pattern, 3)))


def iso_date(raw: Column) -> Column:
    """The date at the start of an ISO text, or of a US m/d/y text; null otherwise."""
    us = F.regexp_extract(raw, r"^(\d{1,2})/(\d{1,2})/(\d{4})", 0)
    return F.coalesce(F.try_to_date(F.nullif(F.regexp_extract(raw, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit(""))), F.try_to_date(F.nullif(us, F.lit("")), "M/d/yyyy"))


def bill_source_url(congress: Column, kind: Column, number: Column) -> Column:
    """The public address of a bill; a kind that isn't known stands as it is."""
    known = F.create_map(*(F.lit(x) for pair in BILL_URL_KINDS.items() for x in pair))
    low = F.lower(kind)
    return F.concat(F.lit("https://www.congress.gov/bill/"), congress.cast("string"), F.lit("th-congress/"), F.coalesce(F.try_element_at(known, low), low), F.lit("/"), number.cast("string"))


def normalise_vote(raw: Column) -> Column:
    """yea, nay, abstain; all else is absent."""
    v = F.lower(raw)
    return F.when(v.isin("yea", "yes", "aye"), "yea").when(v.isin("nay", "no"), "nay").when(v == "present", "abstain").otherwise("absent")


def _says(text: Column, *words: str) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in words))


def bill_status(action: Column) -> Column:
    """introduced, passed, failed or signed, from the text of a sponsored bill's latest action; the first that fits."""
    return F.when(_says(action, "became public law", "signed by president"), "signed").when(_says(action, "passed"), "passed").when(_says(action, "failed", "rejected"), "failed").otherwise("introduced")


def researched_bill_status(action: Column) -> Column:
    """The same of a researched bill, whose texts are looser: any signing, agreement or veto counts."""
    return (
        F.when(_says(action, "became public law", "signed"), "signed")
        .when(_says(action, "passed", "agreed to"), "passed")
        .when(_says(action, "failed", "vetoed", "rejected"), "failed")
        .otherwise("introduced")
    )


def _of(table: dict[str, str], code: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), code)


def holder_code(code: Column) -> Column:
    """Whose asset, from a House filing's code; no code is the member; null for a code that isn't known."""
    return _of(HOLDER_CODES, F.coalesce(F.trim(code), F.lit("")))


def transaction_code(code: Column) -> Column:
    """Kind of transaction, from a House filing's code; null for a code that isn't known."""
    return _of(TRANSACTION_CODES, F.trim(code))


def owner(raw: Column) -> Column:
    """Whose asset, from a Senate filing's words."""
    return F.when(_says(raw, "spouse"), "spouse").when(_says(raw, "dependent"), "dependent-child").when(_says(raw, "joint"), "joint").otherwise("self")


def transaction_type(raw: Column) -> Column:
    """Kind of transaction, from a Senate filing's words; other words stay, in lower case."""
    known = F.when(_says(raw, "partial"), "sale-partial").when(_says(raw, "sale"), "sale").when(_says(raw, "purchase"), "purchase").when(_says(raw, "exchange"), "exchange")
    return known.otherwise(F.lower(F.trim(raw)))


def sic_group(sic: Column) -> Column:
    """Major group of an industry code, given as text, from its first two digits; null for digits of no group."""
    two = F.nullif(F.regexp_extract(sic, r"^\s*(\d{1,2})", 1), F.lit("")).cast("int")
    return F.coalesce(*(F.when(two.between(low, high), name) for low, high, name in SIC_GROUPS))


def role_rank(role: Column) -> Column:
    """Sort key of a committee role: chair, ranking, member, other; then the role's text."""
    r = F.lower(role)
    return F.concat(F.when(r.like("chair%"), "1").when(r.like("ranking%"), "2").when(r == "member", "3").otherwise("4"), F.lit("|"), role)


def recency_tier(year: Column, as_of_year: Column | int) -> Column:
    age = F.lit(as_of_year) - year
    return F.when(age <= 1, "active").when(age <= 3, "recent").otherwise("historical")


def _thirds(whole: Column, unit: int, digits: int) -> Column:
    """whole / unit, of whole numbers, to some digits, as a text: rounded by the value of the quotient as a double.

    A quotient that ends in 5 is a double just below, at or just above it; scaled by a power of two it is a
    whole number, so that the comparison is exact.
    """
    step = unit // 10**digits
    quotient = whole / F.lit(float(unit))
    exact = lambda c: c.cast("decimal(38,0)")
    scale = F.when(quotient < 1024, F.lit(2.0**52)).otherwise(F.lit(2.0**42))
    below = exact((quotient * scale).cast("long")) * unit < exact(whole) * exact(scale.cast("long"))
    tie = (whole % step == step // 2) & (quotient < 2.0**20)
    parts = F.floor((whole + step // 2) / step).cast("long") - F.when(tie & below, 1).otherwise(0)
    return F.concat(F.floor(parts / 10**digits).cast("string"), F.lit("."), F.lpad((parts % 10**digits).cast("string"), digits, "0"))


def money_label(amount: Column) -> Column:
    """$1.20M, $340.4K, $99: whole dollars first, halves up; a dash for no number."""
    whole = F.floor(amount.cast("double") + 0.5).cast("long")
    known = amount.isNotNull() & ~F.isnan(amount.cast("double")) & (F.abs(amount.cast("double")) != float("inf"))
    label = F.when(whole >= 1_000_000, F.concat(F.lit("$"), _thirds(whole, 1_000_000, 2), F.lit("M"))).when(whole >= 1_000, F.concat(F.lit("$"), _thirds(whole, 1_000, 1), F.lit("K")))
    return F.when(known, F.coalesce(label, F.concat(F.lit("$"), whole.cast("string")))).otherwise("—")


def even_cycle(year: Column) -> Column:
    """The election cycle, which ends in the even year."""
    return year + year % 2


def congress_number(year: Column) -> Column:
    return F.floor((year - 1789) / 2).cast("int") + 1


def committee_keywords(names: Column, stop: tuple[str, ...] = COMMITTEE_STOP, most: int = 8) -> Column:
    """Up to ``most`` distinct words of five letters or more, in the order of the sorted distinct names.

    Words end at white space and commas; what isn't a letter a-z is then dropped from them, so that
    a hyphen joins its two halves.
    """
    words = F.split(F.array_join(F.array_sort(F.array_distinct(names)), " "), r"[\s,]+")
    letters = F.transform(words, lambda w: F.regexp_replace(F.lower(w), "[^a-z]", ""))
    return F.slice(F.array_distinct(F.filter(letters, lambda w: (F.length(w) >= 5) & ~w.isin(*stop))), 1, most)
