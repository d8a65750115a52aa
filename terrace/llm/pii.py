"""Personal data spans (operator 7).

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod-97 for account numbers), and nearby context words adjust a score in
[0, 1].  The base kinds - email, ip, card, phone - are reported whatever
their score; the kinds the method adds - iban, ssn - only when confirmed:
iban by its country's length and mod-97, ssn by a score of at least ``KEEP``, which its pattern alone
does not reach without a label nearby.  Context words match whole.

Every pattern is scanned once over the whole text in time linear in its
length: quantifiers are possessive and a number pattern may only start
where a run of digits starts, which gives the same leftmost non-overlapping
matches (a later start inside a failed run fails too, and a match never
ends inside a run).

Defined cases: null text is empty (no span); a null row key stays null;
repeated rows each get a result; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrace.llm.common import prepare, table

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = KINDS[:4]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_RUN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){0,7}+(?: ?[A-Z0-9]{1,3})?")
# Characters of an account number by country; of other countries, every group boundary is tried.
IBAN_LENGTHS = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FK,FO,FI,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,XK,LT,LU,MN 21:HR,LV,LI,CH "
    "22:BH,BG,CR,GE,DE,IE,ME,RS,GB,VA 23:GI,IL,IQ,OM,SO,TL,AE 24:AD,CZ,MD,PK,RO,SA,SK,ES,SE,TN,VG 25:LY,PT,ST "
    "26:IS,TR 27:BI,DJ,FR,GR,IT,MR,MC,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE "
    "31:MT,SC 32:LC 33:RU").split()) for c in cs.split(",")}
IBAN_LEAST = 12
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")
DIGITS_ONLY = re.compile(r"[^0-9]")

# Score before context, and the words within REACH characters that change it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
def whole_words(*words: str, before: str = r"(?<![^\W\d_])") -> re.Pattern:
    return re.compile(rf"{before}(?:{'|'.join(words)})(?:s|ed|ing)?(?![^\W\d_])")


CONTEXT = {
    "email": whole_words("e?mail", "contact", "write"), "ip": whole_words("ip", "address", "addresses", "host", "server"),
    "card": whole_words("card", "visa", "credit", "payment"),
    "phone": whole_words("(?:tele|cell)?phone", "call", "tel", "mobile"),
    "iban": whole_words("iban", "account", "bank"),
    "ssn": whole_words("ssn", "social security", before=""),       # also the end of a name: userSSN
}
AGAINST = whole_words("version", "order", "serial", "isbn", "example")
REACH = 40
GAIN, LOSS, KEEP = 0.2, 0.2, 0.5
LABEL = 0.4                 # gain of an ssn, whose context words name it: outweighs a loss


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """A match belongs to one ``@``: the local characters before it, a dotted domain after."""
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            pos = domain.end()
        at = text.find("@", max(at + 1, pos))


def iban_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that mod-97 confirms, of their country's length, whatever follows them."""
    pos = 0
    while head := IBAN_START.search(text, pos):
        start, pos = head.start(), head.end()
        run = IBAN_RUN.match(text, start)[0]
        length = IBAN_LENGTHS.get(run[:2])
        for n in range(len(run), IBAN_LEAST - 1, -1):
            after = text[start + n:start + n + 1]
            if run[n - 1] == " " or after.isascii() and after.isalnum():
                continue
            size = n - run.count(" ", 0, n)
            if (size == length if length else size >= IBAN_LEAST) and mod97(run[:n]):
                pos = start + n
                yield start, pos
                break


def score(text: str, kind: str, start: int, end: int) -> float:
    # One character more on either side tells whether a word begins or ends within reach.
    lo = max(0, start - REACH - 1)
    before, after = text[lo:start].lower(), text[end:end + REACH + 1].lower()
    first = 1 if start > REACH else 0

    def near(words: re.Pattern) -> bool:
        return words.search(before, first) is not None or any(m.end() <= REACH for m in words.finditer(after))

    s = PRIOR[kind] + (LABEL if kind == "ssn" else GAIN) * near(CONTEXT[kind]) - LOSS * near(AGAINST)
    return round(min(1.0, max(0.0, s)), 3)


def find_spans(text: str) -> list[tuple[int, int, str, int, float]]:
    """(start, kind order, kind, end, score) by start, then kind order."""
    spans: list[tuple[int, int, str]] = [(s, 0, e) for s, e in email_spans(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = DIGITS_ONLY.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGITS_ONLY.sub("", m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
        spans += [(start, 4, end) for start, end in iban_spans(text)]
        spans += [(m.start(), 5, m.end()) for m in SSN.finditer(text)]
    spans.sort()
    scored = [(s, k, KINDS[k], e, score(text, KINDS[k], s, e)) for s, k, e in spans]
    return [x for x in scored if x[1] < len(BASE_KINDS) or x[4] >= KEEP]


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind_order", pa.int32()), ("kind", pa.string()),
                            ("end", pa.int32()), ("score", pa.float64())]))
SPANS_SQL = "array<struct<start:int,kind_order:int,kind:string,end:int,score:double>>"


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans of every row, scanned where the row lies (no shuffle)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in SPANS.value_type]
        for b in batches:
            found = [[dict(zip(names, s)) for s in find_spans(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, SPANS)], ["doc_id", "spans"])

    src = docs.select("doc_id", "text")
    out = StructType([src.schema["doc_id"], StructField("spans", StructType.fromDDL(f"s {SPANS_SQL}")[0].dataType)])
    return src.mapInArrow(scan, out)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(prepare(spark), sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
