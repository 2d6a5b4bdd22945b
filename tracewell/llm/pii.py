"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

#: The patterns of the base kinds, in the order in which they are listed.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")
#: Patterns of the kinds that the method adds. A secret is what follows a word that names one, or begins as issued keys do.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
NAMED_SECRET = r"""(?i)\b(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth)["']?\s{0,3}[:=]\s{0,3}["']?([A-Za-z0-9+/_=.~-]{16,})"""
ISSUED_SECRET = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{20,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})(?![A-Za-z0-9])"
IPV6 = r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])"
ADDED_KINDS = ("iban", "ssn", "secret", "ipv6")
#: Characters of an account number, by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23,
    "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}
#: Words that, near a span, raise its score.
CONTEXT = {
    "email": {"mail", "email", "contact", "write", "address"},
    "ip": {"ip", "server", "host", "address"},
    "card": {"card", "visa", "credit", "payment"},
    "phone": {"phone", "tel", "call", "mobile", "fax"},
    "iban": {"iban", "bank", "account", "konto", "cuenta", "compte"},
    "ssn": {"ssn", "social", "security"},
    "secret": {"login", "credentials", "bearer", "deploy"},
    "ipv6": {"ip", "ipv6", "server", "host", "address"},
}
#: Score of a match as such, and what a passed check and a word nearby add.
START = {"email": 0.7, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.2, "ssn": 0.3, "secret": 0.2, "ipv6": 0.2}
CHECKED, NEARBY, REACH = 0.5, 0.3, 40
#: A span of an added kind needs this score.
LEAST = 0.6
#: Bits a character that a named secret needs: words and repetitions have fewer.
ENTROPY = 3.0

_IP, _CARD, _PHONE, _IBAN, _SSN, _NAMED, _ISSUED, _IPV6 = map(re.compile, (IP, CARD, PHONE, IBAN, SSN, NAMED_SECRET, ISSUED_SECRET, IPV6))
_WORD = re.compile("[a-z0-9]+")
_DIGIT = re.compile("[0-9]")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    """Checksum of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Checksum of account numbers: moved to the end, letters as 10 to 35, the rest by 97 is 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    """Leftmost non-overlapping matches of EMAIL; goes from one @ to the next, as only it can bring a match."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def _near(text: str, start: int, end: int, kind: str) -> float:
    """What a whole word of the kind's context nearby adds."""
    around = (text[max(0, start - REACH) : start] + " " + text[end : end + REACH]).lower()
    return 0.0 if CONTEXT[kind].isdisjoint(_WORD.findall(around)) else NEARBY


def entropy(text: str) -> float:
    """Bits a character, by the text's own frequencies."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _is_ipv6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return sum(bool(part) for part in text.split(":")) >= 3


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where the account number ends that begins at start: as many characters as its country has, a whole word, with a right checksum; None if it is none."""
    need = IBAN_LENGTHS.get(text[start : start + 2], 0)
    at = [i for i in range(start, end) if text[i] != " "][:need]
    if not need or len(at) < need or (at[-1] + 1 < end and text[at[-1] + 1] != " "):
        return None
    return at[-1] + 1 if mod97(text[start : at[-1] + 1].replace(" ", "")) else None


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of all spans of a text, by kind as listed, then start. Code points, end exclusive.

    Spans of the base kinds always stay; those of the added kinds need LEAST. Null counts as empty.
    """
    text = text or ""
    found: list[tuple[str, int, int, float]] = []

    def add(kind: str, start: int, end: int, checked: bool = False) -> None:
        found.append((kind, start, end, min(1.0, START[kind] + CHECKED * checked + _near(text, start, end, kind))))

    if "@" in text:
        for start, end in _emails(text):
            add("email", start, end)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            add("ip", m.start(), m.end())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            add("card", m.start(), m.end(), True)
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            add("phone", m.start(), m.end())
    n = len(found)
    for m in _IBAN.finditer(text):
        to = _iban_end(text, m.start(), m.end())
        if to:
            add("iban", m.start(), to, True)
    for m in _SSN.finditer(text) if "-" in text else ():
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            add("ssn", m.start(), m.end())
    secrets = [(*m.span(1), entropy(m[1]) >= ENTROPY and bool(_DIGIT.search(m[1]))) for m in _NAMED.finditer(text)] if "=" in text or ":" in text else []
    taken = [x[:2] for x in secrets]
    secrets += [(*m.span(), True) for m in _ISSUED.finditer(text) if not any(i < m.end() and m.start() < j for i, j in taken)]
    for start, end, ok in sorted(secrets):
        add("secret", start, end, ok)
    for m in _IPV6.finditer(text) if ":" in text else ():
        if _is_ipv6(m[0]):
            add("ipv6", m.start(), m.end(), True)
    return found[:n] + [x for x in found[n:] if x[3] >= LEAST]


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row; spans: array of (kind, start, end, score), empty for null and empty texts.

    Works row by row on whole texts: no shuffle. Repeated rows come back as often as they stand
    there; null ids pass through; other columns are not read.
    """
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            out = [[dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(t.as_py())] for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(kind))], [id_col, "spans"])

    of = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {of}, spans array<struct<kind:string,start:long,end:long,score:double>>")


def digest(spans: list[tuple[str, int, int]]) -> str:
    """Lowercase hex SHA-256 of kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, all spans as one string, and the same with scores; then counts of the added kinds."""
    say = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [of_kind(k).alias(f"n_{k}") for k in BASE_KINDS]
    scored = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], F.format_number(s["score"], 1))), ",")
    more = [of_kind(k).alias(f"n_{k}") for k in ADDED_KINDS]
    return found.select(id_col, *counts, F.sha2(say(base), 256).alias("base_sha256"), say(F.col("spans")).alias("spans"), scored.alias("scores"), *more)
